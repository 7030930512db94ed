"""Order MinHash against a plain program over the same hashes."""

import hashlib
import random
import re

import pytest
import xxhash

from corvane.llm import order_minhash as O
from corvane.llm import queries


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def h(*parts):
    """XXH64 of the parts in line, each seeded by the one before: strings as UTF-8, integers as 4 or 8 bytes."""
    seed = 42
    for kind, x in parts:
        raw = x.encode() if kind == "s" else (x & (1 << 32) - 1).to_bytes(4, "little") if kind == "i" else (x & (1 << 64) - 1).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(raw, seed=seed)
    return signed(seed)


def plain_sketch(text, words=3, sketches=16):
    ws = [w for w in re.split(r"[ \t\n\x0b\f\r]+", text or "") if w]
    if not ws:
        return [0] * sketches
    grams = [ws[i : i + words] for i in range(max(1, len(ws) - words + 1))]
    seen, ids = {}, []
    for g in grams:
        x = h(*(("s", w) for w in g))
        n = seen[x] = seen.get(x, -1) + 1
        ids.append(h(("l", x), ("i", n)))
    out = []
    for i in range(sketches):
        ranks = sorted((h(("l", i), ("l", x)), p) for p, x in enumerate(ids))[:2]
        out.append(h(*(("l", r) for r, _ in sorted(ranks, key=lambda v: v[1]))))
    return out


def as_text(sketch):
    return "".join(f"{x & (1 << 64) - 1:016x}"[:8] for x in sketch)


def check(got, rows):
    """``rows`` (key, text) in order."""
    made = [plain_sketch(t) for _, t in rows]
    like = lambda a, b: sum(x == y for x, y in zip(a, b)) / len(a)
    want = []
    for i, (k, t) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        m = len(t) // 4
        e = t[: len(t) - m] + nxt[:m]
        se = plain_sketch(e)
        want.append((k, len(t), hashlib.sha256(e.encode()).hexdigest(), as_text(made[i]), as_text(se), like(made[i], se), like(made[i], made[(i + 1) % len(rows)])))
    cols = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    key = lambda r: (r[0] is not None, r[0] or 0, *map(str, r[1:]))
    assert sorted((tuple(r[c] for c in cols) for r in got), key=key) == sorted(want, key=key)


def test_odd_rows_equal_a_plain_program(odd, texts):
    order = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    check(O.neighbour_likeness(odd, buckets=4).collect(), order)


@pytest.mark.parametrize("buckets", [1, 7])
def test_random_documents_equal_a_plain_program(spark, buckets):
    rnd = random.Random(8)
    rows = [(i * 3, " ".join(rnd.choice("abcdefgh") * rnd.randint(1, 2) for _ in range(rnd.choice([0, 1, 2, 3, 5, 30, 200])))) for i in range(200)]
    rows[50] = (150, rows[49][1])
    check(O.neighbour_likeness(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), buckets=buckets).collect(), rows)


def test_registered_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    check(queries.QUERIES["op9_order_minhash"](spark, "/root/testdata/sf0.001").collect(), docs)


def test_both_kmers_come_from_one_order(spark):
    # the two least are different k-mers in text order: swapping the only two of a text changes every sketch
    rows = [(1, "a b c d"), (2, "b c d a")]
    fp = {r["doc_id"]: r["fingerprint"] for r in O.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()}
    three = {r["doc_id"]: r["fingerprint"] for r in O.fingerprints(spark.createDataFrame([(1, "a b c"), (2, "b c a b")], "doc_id long, text string"), words=2).collect()}
    assert len(fp[1]) == 16 * 8 and fp[1] != fp[2] and three[1] != three[2]
