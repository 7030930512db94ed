import random

import pytest

from corvane.llm import shingle_join


def plain_set(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_components(texts):
    sets = {k: plain_set(t) for k, t in texts}
    up = {k: k for k in sets}

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in sets:
        for b in sets:
            x, y = sets[a], sets[b]
            if a < b and (x == y or len(x & y) >= 0.8 * len(x | y)):
                i, j = find(a), find(b)
                up[max(i, j)] = min(i, j)
    return {k: find(k) for k in sets}


def copies(seed=5):
    rnd = random.Random(seed)
    prose = lambda n: [f"w{rnd.randrange(4000)}" for _ in range(n)]
    line, texts = prose(12), []
    for _ in range(25):
        base = prose(rnd.choice([3, 5, 9, 40, 120, 300])) + line * rnd.randrange(2)
        for _ in range(rnd.randint(1, 5)):
            t = list(base)
            for _ in range(rnd.randrange(1 + max(1, len(t) // 45))):
                t[rnd.randrange(len(t))] = f"x{rnd.randrange(4000)}"
            texts.append(" ".join(t))
    base = prose(200)
    for i in range(24):  # a chain: its ends are far apart
        base[(i * 7) % 200] = f"y{i}"
        texts.append(" ".join(base))
    texts += [None, "", " \n", "One two", "one TWO", "É a b c d e", "é a b c d e"]
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("pairs", [1_000_000, 400])
def test_components_equal_all_pairs(spark, monkeypatch, pairs):
    monkeypatch.setattr(shingle_join, "PAIRS", pairs)
    monkeypatch.setattr(shingle_join, "PAIRS_A_ROW", 8 if pairs else 0)
    texts = copies()
    d = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = shingle_join.near_duplicates(d)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == plain_components(texts)
    assert got.count() == len(texts) and shingle_join.near_duplicates(d.limit(0)).count() == 0


def test_stage_drops_near_copies_beyond_two_bits(spark):
    import corpus_pipeline as P

    rnd = random.Random(1)
    base = [f"w{rnd.randrange(900)}" for _ in range(200)]
    edited = list(base)
    for i in (20, 70, 120, 170):
        edited[i] = "other"
    other = " ".join(rnd.sample(base, 200))
    d = spark.createDataFrame([(4, " ".join(edited)), (3, " ".join(base)), (5, other)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in P.drop_near_duplicates(spark, d, "").collect()) == [3, 5]


def test_stages_decide_by_row(spark, tmp_path):
    import corpus_pipeline as P

    rnd = random.Random(2)
    one, two, item = (" ".join(f"w{rnd.randrange(900)}" for _ in range(80)) for _ in range(3))
    # id 2 has a copy of row 1 and a clean text of its own; id 4 a benchmark passage and a clean text
    d = spark.createDataFrame([(1, one), (2, one), (2, two)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["text"]) for r in P.drop_near_duplicates(spark, d, "").collect()) == [(1, one), (2, two)]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    d = spark.createDataFrame([(4, item), (4, two), (None, item), (None, one)], "doc_id long, text string")
    assert sorted(r["text"] for r in P.drop_benchmark_passages(spark, d, str(tmp_path)).collect()) == sorted([one, two])


def test_texts_shuffled_to_the_pairs_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "SENT_PAIRS", 0)
    texts = copies(8)
    got = shingle_join.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string").repartition(3))
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == plain_components(texts)


def test_filters_leave_no_alike_pair_out():
    import numpy as np

    rnd = random.Random(11)
    for _ in range(300):
        n = rnd.choice([1, 3, 20, 90, 400])
        a = {rnd.getrandbits(64) for _ in range(n)}
        b = set(rnd.sample(sorted(a), rnd.randint(int(n * 0.7), n))) | {rnd.getrandbits(64) for _ in range(rnd.randint(0, max(1, n // 6)))}
        x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
        if len(a & b) >= 0.8 * len(a | b):
            assert shingle_join.may_reach(shingle_join.parities(x), shingle_join.parities(y), len(x), len(y), 0.8)
            p, q = shingle_join.short_parities(x), shingle_join.short_parities(y)
            assert sum(((i ^ j) & (1 << 64) - 1).bit_count() for i, j in zip(p, q)) <= (len(x) + len(y)) * 0.2 / 1.8 + 1e-6
    far = [np.array(sorted(rnd.getrandbits(64) for _ in range(300)), np.uint64) for _ in range(2)]
    assert not shingle_join.may_reach(*map(shingle_join.parities, far), 300, 300, 0.8)


def test_a_long_passage_that_unlike_rows_share(spark):
    rnd = random.Random(12)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(f"w{rnd.randrange(9000)}" for _ in range(rnd.choice([2, 12, 25]))) + " " + passage) for i in range(120)]
    got = shingle_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == plain_components(rows)
