"""Each stage of the pipeline against a plain program, row by row, and the whole against the stages in line."""

import hashlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as P
from corvane.llm import decontam, language_id
from corvane.llm._common import tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def plain_languages(spark, rows, model):
    lab = language_id.Labeller(model)
    got = lab.label([r["text"] for r in rows])
    return [r for r, (lang, share, _) in zip(rows, got) if lang is not None and share >= P.LEAST_SCORE and r["doc_id"] is not None]


def plain_groups(rows):
    """Rows kept: of each group of five-word similarity 0.8 and more that with the least id."""
    sets = []
    for r in rows:
        w = (r["text"] or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    pairs = 0
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or (min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b)):
                pairs += a != b
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    best = {}
    for i, r in enumerate(rows):
        key = (r["doc_id"] is None, r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest(), i)
        best[find(i)] = min(best.get(find(i), key), key)
    return [rows[k[3]] for k in best.values()], pairs


def plain_clean(rows, items):
    out = []
    for r in rows:
        words = decontam.words_of((r["text"] or "").lower())
        have = Counter(words)
        bad = False
        for it in items:
            w = decontam.words_of(it.lower())
            if w and sum(min(n, have[x]) for x, n in Counter(w).items()) >= 0.8 * len(w):
                bad = bad or decontam.align(words, w)[0] >= 0.8 * len(w) - 1e-9
        if not bad:
            out.append(r)
    return out


def same(got, want):
    assert Counter(map(tuple, got)) == Counter(map(tuple, want))


def test_stages_equal_plain_programs(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    rows = docs.collect()
    extra = [(9001, "", "en", "s", 0), (9002, "12 34 !!", "en", "s", 8), (9003, None, None, None, None), (None, rows[0]["text"], "en", "s", 1), (rows[1]["doc_id"], rows[2]["text"], "en", "s", 1)]
    made = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    path = str(tmp_path / "docs")
    made.write.parquet(path)
    docs = spark.read.parquet(path)
    model = language_id.train(docs.where(~language_id.held_out()))
    one = P.identify_language(spark, docs, SF)
    want = plain_languages(spark, docs.collect(), model)
    assert one.columns == docs.columns and len(want) < docs.count()
    same(one.collect(), want)

    step = str(tmp_path / "one")
    docs.where("doc_id is null or doc_id <> 9003").write.parquet(step)  # null ids too, which the first stage drops
    own = spark.read.parquet(step)
    want, pairs = plain_groups(own.collect())
    two = P.drop_near_duplicates(spark, own, SF)
    assert pairs > 0 and two.columns == docs.columns and len(want) < own.count()
    same(two.collect(), want)  # all pairs of 0.8 and more: recall 1

    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = plain_clean(own.collect(), items)
    three = P.drop_benchmark_passages(spark, own, SF)
    assert len(want) < own.count() and three.columns == docs.columns
    same(three.collect(), want)

    lib = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for r in own.collect():
        ids = lib.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), sha(np.array(ids, "<u4").tobytes()), sha(lib.decode(ids, skip_special_tokens=False).encode())))
    same(P.encode_tokens(spark, own, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect(), want)


def test_empty_tables(spark, docs, tmp_path):
    docs.limit(0).write.parquet(str(tmp_path / "none"))
    none = spark.read.parquet(str(tmp_path / "none"))
    for name, stage in P.STAGES:
        assert stage(spark, none, SF).count() == 0, name


def test_run_is_the_stages_in_line(spark, docs):
    now = docs
    for _, stage in P.STAGES:
        now = stage(spark, now, SF)
    same(P.run(spark, SF).collect(), now.collect())
    assert [n for n, _ in P.STAGES] == ["language ID", "SimHash near-dedup", "benchmark decontamination", "BPE encoding and decoding"]
