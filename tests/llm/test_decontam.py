"""Decontamination against plain programs: the aligner, all pairs, copies with planted edits."""

import random
from collections import Counter

import pytest

from corvane.llm import decontam as D
from corvane.llm import queries


def plain_align(a, b):
    """Best (score, matched, start) over all cells, and its end, by the textbook table."""
    best, end = (0, 0, 0), 0
    up = [(0, 0, j) for j in range(len(a) + 1)]
    for w in b:
        row = [(0, 0, 0)]
        for j in range(1, len(a) + 1):
            s, m, x = up[j - 1]
            hit = a[j - 1] == w
            s1, m1, x1 = up[j]
            s2, m2, x2 = row[j - 1]
            row.append(max((s + (D.MATCH if hit else D.MISMATCH), m + hit, x), (s1 + D.GAP, m1, x1), (s2 + D.GAP, m2, x2), (0, 0, j)))
        top = max(row)
        if top[:2] > best[:2] or (best[1] and top > best):
            best, end = top, row.index(top)
        up = row
    return (best[1], best[2], end) if best[1] else (0, 0, 0)


def test_alignment_equals_the_plain_table():
    rnd = random.Random(6)
    for size in (3, 5, 30):
        for _ in range(150):
            a, b = ([f"w{rnd.randrange(size)}" for _ in range(rnd.randint(1, 14))] for _ in range(2))
            assert D.align(a, b) == plain_align(a, b), (a, b)
    words = [f"w{i % 700}" for i in range(6000)]
    assert D.align(words, words[1000:5000])[0] == 4000  # one row of cells, not a table


def test_every_intact_run_holds_a_seed():
    rnd = random.Random(2)
    for m in [*range(1, 41), 60, 97]:
        n, run = D.seed_size(m)
        rank = [rnd.randrange(5) for _ in range(m - n + 1)]
        kept = D.rarest(rank, run - n + 1)
        assert all(any(a <= k and k + n <= a + run for k in kept) for a in range(m - run + 1))
        lost = int(m * 0.2 + 1e-9)
        for _ in range(30):  # no way to change that many words leaves less than the run
            gone = sorted(rnd.sample(range(m), lost))
            runs = [y - x - 1 for x, y in zip([-1, *gone], [*gone, m])]
            assert max(runs) >= run


def prose(rnd, n, size=400):
    return [f"t{rnd.randrange(size)}" for _ in range(n)]


def planted(seed=4):
    """(documents, items, which document rows hold an edited copy of which item at 0.8 or more)."""
    rnd = random.Random(seed)
    items = [(i, " ".join(prose(rnd, rnd.choice([3, 5, 6, 9, 10, 15, 20, 38, 59])))) for i in range(30)]
    items += [(0, items[0][1]), (None, " ".join(prose(rnd, 15))), (31, None), (32, " ,. "), (33, items[5][1])]
    docs, copies = [], set()
    for i, (_, t) in enumerate(items):
        w = D.words_of(t or "")
        if not w:
            continue
        for kind in range(4):
            e = list(w)
            for at in rnd.sample(range(len(w)), int(len(w) * 0.2 + 1e-9) if kind else 0):
                e[at] = "other" if kind == 1 else None if kind == 2 else rnd.choice(["new", None])
            e = [x for x in e if x]
            copies.add((len(docs), i))
            docs.append((len(docs), " ".join(prose(rnd, rnd.randint(0, 60)) + e + prose(rnd, rnd.randint(0, 60))).upper()))
    docs += [(1000 + i, " ".join(prose(rnd, 80))) for i in range(40)] + [(2000, None), (2001, ""), (None, items[3][1]), (None, items[3][1])]
    return docs, items, copies


def all_pairs(docs, items):
    """Every document against every item, aligned over the whole text."""
    out = Counter()
    for k, t in docs:
        words = D.words_of((t or "").lower())
        for name, it in items:
            w = D.words_of((it or "").lower())
            if words and w and sum((Counter(w) & Counter(words)).values()) >= 0.8 * len(w) and plain_align(words, w)[0] / len(w) >= 0.8 - 1e-12:
                out[k, name] += 1
    return out


@pytest.mark.parametrize("bound", [200_000, 0])
def test_found_rows_equal_all_pairs(spark, monkeypatch, bound):
    monkeypatch.setattr(D, "BROADCAST_SEEDS", bound)
    docs, items, copies = planted()
    got = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")).collect()
    have, want = Counter((r["doc_id"], r["item_id"]) for r in got), all_pairs(docs, items)
    assert not have - want and sum((have & want).values()) >= 0.99 * sum(want.values())
    # all planted copies: a fifth of the words replaced or left out, at any place
    assert all(have[docs[d][0], items[i][0]] for d, i in copies if want[docs[d][0], items[i][0]])
    assert sum(bool(want[docs[d][0], items[i][0]]) for d, i in copies) >= 0.9 * len(copies)


@pytest.mark.parametrize("bound", [200_000, 0])
def test_repeated_and_null_items(spark, monkeypatch, bound):
    monkeypatch.setattr(D, "BROADCAST_SEEDS", bound)
    rnd = random.Random(3)
    a, b, c = (" ".join(prose(rnd, 20)) for _ in range(3))
    items = spark.createDataFrame([(1, a), (1, b), (None, c)], "item_id long, text string")
    docs = spark.createDataFrame([(1, a), (2, b), (3, c)], "doc_id long, text string")
    assert {tuple(r) for r in D.contaminated(docs, items).collect()} == {(1, 1, 1.0, 0, 20), (2, 1, 1.0, 0, 20), (3, None, 1.0, 0, 20)}


def test_very_long_text_and_item(spark):
    rnd = random.Random(5)
    long = prose(rnd, 5000, 100_000)
    edited = [w for i, w in enumerate(long) if i % 9]
    text = prose(rnd, 30_000, 100_000) + edited + prose(rnd, 2000, 100_000)
    got = D.contaminated(spark.createDataFrame([(1, " ".join(text)), (2, " ".join(prose(rnd, 30_000, 100_000)))], "doc_id long, text string"), spark.createDataFrame([(7, " ".join(long))], "item_id long, text string")).collect()
    assert [(r["doc_id"], r["item_id"]) for r in got] == [(1, 7)] and got[0]["score"] == pytest.approx(len(edited) / 5000, abs=0.01)


def test_registered_query_finds_what_all_pairs_find(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = Counter((r["doc_id"], r["item_id"]) for r in queries.QUERIES["op7_decontamination"](spark, sf).collect())
    want = Counter()
    for k, t in docs:
        words = D.words_of((t or "").lower())
        have = Counter(words)
        for name, it in items:
            w = D.words_of(it.lower())
            if sum(min(n, have[x]) for x, n in Counter(w).items()) >= 0.8 * len(w):
                n, s, e = D.align(words, w)
                want[k, name] += n / len(w) >= 0.8
    assert set(+want) - set(got) == set() and len(+want) > 0
