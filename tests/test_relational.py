import pytest
from pyspark.sql import functions as F

from corvane.functions import maps
from corvane.operators import relational as R
from corvane.plans.expr import ExpressionError, predicate


def ids(df, c="id"):
    return sorted(r[c] for r in df.collect())


def test_missing_values_in_predicates(spark):
    d = spark.createDataFrame([("a", 1), ("b", None), ("c", 0)], "id string, x int")
    assert ids(R.select_rows(d, "x != 1")) == ["b", "c"]
    assert ids(R.select_rows(d, "x > 0")) == ["a"]
    assert ids(R.select_rows(d, "not (x > 0)")) == ["b", "c"]
    assert ids(R.select_rows(d, "x in [0, 1]")) == ["a", "c"]
    assert ids(R.select_rows(d, "x.isna() or x == 0")) == ["b", "c"]
    assert ids(R.select_rows(d, "")) == ["a", "b", "c"]
    assert ids(R.select_rows(d, "-1 < x <= 0")) == ["c"]


@pytest.mark.parametrize("bad", ["x ==", "nope > 1", "__import__('os')", "x.mean()"])
def test_bad_predicates(spark, bad):
    d = spark.createDataFrame([("a", 1)], "id string, x int")
    with pytest.raises(ExpressionError):
        predicate(bad, d.columns)
    row = R.mark_rows(d, bad).first()
    assert row["filter_pass"] is False and row["filter_pass_error"]


def test_rows_of_one_id_travel_together(spark):
    d = spark.createDataFrame([("a", 1), ("a", 5), ("b", 1)], "id string, x int")
    assert ids(R.filter_by_id(d, "x > 3")) == ["a", "a"]


def sample(spark, rows):
    kind = "id string, sha256 string, transcripts map<string,struct<text:string,model:string,version:string,confidence:double,status:string,extra:map<string,string>>>, errors map<string,string>"
    return spark.createDataFrame(rows, kind)


def entry(text, status=None):
    return (text, "m", None, None, status, None)


def test_attach_route(spark):
    base = sample(spark, [("a", "h1", {}, {}), ("b", "h2", {}, {}), ("c", None, {}, {})])
    other = sample(spark, [("a", "h1", {"m": entry("x")}, {}), ("b", "h2", {}, {"asr": "boom"}), ("d", "h4", {"m": entry("y")}, {})])
    with pytest.raises(R.AlignmentError, match="not aligned"):
        R.attach_route(base, other, "m", "s")
    got = {r["id"]: r["transcripts"]["m"] for r in R.attach_route(base, other, "m", "s", "left").collect()}
    assert (got["a"]["text"], got["a"]["extra"]["source_manifest"]) == ("x", "s")
    assert (got["b"]["text"], got["b"]["status"]) == ("", "failed")
    assert (got["c"]["text"], got["c"]["status"]) == (None, "missing")
    with pytest.raises(R.AlignmentError, match="digests differ"):
        R.attach_route(base, sample(spark, [("a", "zz", {"m": entry("x")}, {})]), "m", "s", "left")
    with pytest.raises(R.AlignmentError, match="duplicate"):
        R.attach_route(base, other.union(other), "m", "s", "left")
    with pytest.raises(R.AlignmentError, match="required"):
        R.attach_route(base.where("id = 'c'"), sample(spark, [("c", "h", {"m": entry("x")}, {})]), "m", "s", "left", require_hashes=True)


def test_sidecar_and_gold_guards(spark):
    base = spark.createDataFrame([("a", "h1"), ("b", "h2")], "id string, sha256 string")
    side = spark.createDataFrame([("a", "h1", 3)], "id string, sha256 string, score int")
    assert {r["id"]: r["score"] for r in R.sidecar_merge(base, side, columns=["score"]).collect()} == {"a": 3, "b": None}
    for bad in ([("a", "zz", 1)], [("a", None, 1)], [("a", "h1", 1), ("a", "h1", 2)]):
        with pytest.raises(R.AlignmentError):
            R.sidecar_merge(base, spark.createDataFrame(bad, "id string, sha256 string, score int"), columns=["score"])
    gold = spark.createDataFrame([("a", "t")], "id string, gold_text string")
    assert ids(R.inject_gold(base, gold)) == ["a"]
    with pytest.raises(R.AlignmentError):
        R.inject_gold(base, gold, "left").count()
    assert {r["id"]: r["gold_text"] for r in R.inject_gold(base, gold, "left", "allow_empty").collect()} == {"a": "t", "b": ""}


def test_merge_shards_and_balance(spark):
    d = spark.createDataFrame([("a", "11" * 32, "p", 3.0), ("b", None, "q", 2.0), ("a", "11" * 32, "p", 3.0), ("c", "ff" * 32, "r", None)], "id string, sha256 string, source_path string, duration double")
    assert ids(R.merge_dedup(d, d)) == ["a", "b", "c"]
    got = {r["id"]: r["shard"] for r in R.with_shard(d, 4).distinct().collect()}
    assert got["a"] == int("11" * 8, 16) % 4 and got["c"] == int("ff" * 8, 16) % 4
    shards = {r["id"]: r["shard"] for r in R.balanced_shards(R.merge_dedup(d), 2).collect()}
    assert shards == {"a": 0, "b": 1, "c": 1}


def test_cross_split_and_leakage(spark):
    d = spark.createDataFrame([("a", "x", "train"), ("b", "x", "dev"), ("c", "", "dev"), ("d", "", "train"), ("e", None, "train")], "id string, k string, split string")
    assert [(r["value"], r["splits"]) for r in R.cross_split(d, "split", ["k"]).collect()] == [("x", ["dev", "train"])]
    assert [tuple(r) for r in R.leakage(d.where("split = 'train'"), d.where("split = 'dev'"), ["k"]).collect()] == [("k", 1, 1)]


def test_upsert_and_copy(spark):
    d = sample(spark, [("a", "h", {"m": entry("x"), "n": entry(" ")}, {})])
    out = R.copy_transcripts(d, {"m": "n", "absent": "z"}).first()["transcripts"]
    assert out["n"]["text"] == "x" and "z" not in out
    q = spark.range(1).select(F.create_map(F.lit("k"), F.lit("1")).alias("m")).select(maps.put(F.col("m"), k=F.lit("2"), j=F.lit("3")).alias("m")).first()["m"]
    assert q == {"k": "2", "j": "3"}
