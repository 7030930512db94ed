import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from corvane.llm import decontam, order_minhash, simhash


def plain_fingerprint(text):
    import xxhash

    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, budget=2):
    """{row: component} for (key, fingerprint) rows with keys."""
    least = {}
    for k, f in fps:
        least[f] = min(k, least.get(f, k))
    up = {f: f for f in least}

    def find(f):
        while up[f] != f:
            f = up[f]
        return f

    own = list(least)
    for i, a in enumerate(own):
        for b in own[i + 1 :]:
            if (a ^ b).bit_count() <= budget:
                x, y = find(a), find(b)
                if x != y:
                    keep, drop = (x, y) if least[x] < least[y] else (y, x)
                    up[drop] = keep
                    least[keep] = min(least[keep], least[drop])
    return {f: least[find(f)] for f in own}


def test_fingerprints_and_groups(odd, texts):
    got = simhash.near_duplicates(odd).collect()
    comp = plain_components([(k, plain_fingerprint(t)) for k, t in texts if k is not None])
    want = Counter((k, f"{plain_fingerprint(t):016x}", comp.get(plain_fingerprint(t))) for k, t in texts)
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


@pytest.mark.parametrize("node_rows", [8, 100_000])
def test_trie_join_equals_all_pairs(spark, node_rows):
    rnd = random.Random(9)
    seeds = [rnd.getrandbits(64) for _ in range(25)]
    fps = {0, (1 << 64) - 1} | {s ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randint(0, 4))) for s in seeds for _ in range(8)}
    rows = [(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(sorted(f & ((1 << 64) - 1) for f in fps))]
    links = simhash.similar_links(spark.createDataFrame(rows, "fp long, rep long"), 2, node_rows).collect()
    want = plain_components([(i, f & ((1 << 64) - 1)) for f, i in rows])
    up = {i: i for _, i in rows}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for r in links:
        x, y = find(r["u"]), find(r["v"])
        up[max(x, y)] = min(x, y)
    assert {i: find(i) for _, i in rows} == {i: want[f & ((1 << 64) - 1)] for f, i in rows}


def test_walk_gives_each_pair_once():
    rnd = np.random.default_rng(1)
    base = rnd.integers(0, 1 << 63, 400, dtype=np.uint64)
    a = np.unique(np.concatenate([base, base ^ np.uint64(1), base ^ np.uint64(1 << 60)]))
    got = Counter((int(i), int(j)) for x, y in simhash.walk_pairs(a, a, 0, 0, 2) for i, j in zip(x, y))
    want = {(i, j) for i in range(len(a)) for j in range(i + 1, len(a)) if int(a[i] ^ a[j]).bit_count() <= 2}
    assert set(got) == want and max(got.values()) == 1


def test_order_minhash(odd, texts, spark):
    got = order_minhash.neighbour_likeness(odd, buckets=4).collect()
    order = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = Counter()
    for i, (k, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        m = len(t) // 4
        e = t[: len(t) - m] + nxt[:m]
        want[k, len(t), hashlib.sha256(e.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
    by = {r["doc_id"]: r for r in got}
    assert by[1]["fingerprint"] == by[2]["fingerprint"] and by[1]["near_next"] == 1.0 and by[3]["near_next"] == 1.0
    assert by[7]["near_next"] == 0.0 and by[8]["near_edited"] == 1.0
    alone = {r["doc_id"]: r["fingerprint"] for r in order_minhash.fingerprints(odd).collect()}
    assert alone == {r["doc_id"]: r["fingerprint"] for r in got}
    assert order_minhash.neighbour_likeness(odd.limit(0)).count() == 0
    single = order_minhash.neighbour_likeness(spark.createDataFrame([(5, "a b c d")], "doc_id long, text string")).first()
    assert single["near_next"] == 1.0


def test_order_matters_and_repeats_count(spark):
    words = [f"w{i}" for i in range(200)]
    swapped = words[100:] + words[:100]
    rows = [(1, " ".join(words)), (2, " ".join(swapped)), (3, " ".join(words * 2)), (4, " ".join([*words[:150], *["x"] * 50]))]
    fp = {r["doc_id"]: r["fingerprint"] for r in order_minhash.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), sketches=64).collect()}
    like = lambda a, b: sum(fp[a][i : i + 8] == fp[b][i : i + 8] for i in range(0, len(fp[a]), 8)) / 64
    assert like(1, 4) > 0.35 and like(1, 2) < 0.75 and like(1, 3) < 0.9


def plain_align(a, b):
    best, t = 0, [[0] * (len(a) + 1) for _ in range(len(b) + 1)]
    for i in range(1, len(b) + 1):
        for j in range(1, len(a) + 1):
            t[i][j] = max(0, t[i - 1][j - 1] + (decontam.MATCH if a[j - 1] == b[i - 1] else decontam.MISMATCH), t[i - 1][j] + decontam.GAP, t[i][j - 1] + decontam.GAP)
            best = max(best, t[i][j])
    return best


def test_alignment_against_a_plain_program():
    rnd = random.Random(6)
    for _ in range(200):
        a, b = ([rnd.choice("abcde") for _ in range(rnd.randint(1, 12))] for _ in range(2))
        n, s, e = decontam.align(a, b)
        assert 0 <= s <= e <= len(a) and n <= min(e - s, len(b))
        if plain_align(a, b):
            assert n > 0
    assert decontam.align(list("xxabcdexx"), list("abcde")) == (5, 2, 7)


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


@pytest.mark.parametrize("bound", [200_000, 0])
def test_decontamination(spark, odd, monkeypatch, bound):
    monkeypatch.setattr(decontam, "BROADCAST_SEEDS", bound)
    w = ITEM.split()
    edited = " ".join([*w[:8], "extra", *w[8:14], *w[15:]])
    docs = [(1, f"clean text before. {ITEM.upper()}! and after"), (2, f"Some words {edited} more words"), (3, "nothing of the sort " * 30), (4, " ".join(w[:6]) + " and then it goes its own way"), (5, None), (6, ""), (7, ITEM), (7, ITEM)]
    items = spark.createDataFrame([(10, ITEM, "x"), (11, "two words", "x"), (12, None, "x"), (13, "", "x"), (14, ITEM, "x")], "item_id long, text string, k string")
    d = spark.createDataFrame([(*x, 1, 2) for x in docs], "doc_id long, text string, item long, k int")
    got = Counter((r["doc_id"], r["item_id"]) for r in decontam.contaminated(d, items).collect())
    assert got == Counter({(1, 10): 1, (1, 14): 1, (2, 10): 1, (2, 14): 1, (7, 10): 2, (7, 14): 2})
    one = decontam.contaminated(d, items).where("doc_id = 1 and item_id = 10").first()
    assert (one["score"], one["start_word"], one["end_word"]) == (1.0, 3, 23)
    assert decontam.contaminated(odd, items).count() == 0
    assert decontam.contaminated(d.limit(0), items).count() == 0 and decontam.contaminated(d, items.limit(0)).count() == 0
