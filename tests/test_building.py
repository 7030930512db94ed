"""Reports, plans and releases: errors, refusals and the rules that the queries' data do not reach."""

import pytest
from pyspark.sql import functions as F

from corvane.operators import building, reports
from corvane.operators.relational import AlignmentError

ROW = "id string, model string, scored boolean, substitutions long, deletions long, insertions long, reference_length long, bucket string, type string, subtype string"


def test_report_refuses_what_cannot_be_reported(spark):
    row = lambda i, m, ok=True, b="x": (i, m, ok, 1, 0, 0, 10, b, None, None)
    frame = lambda *rows: spark.createDataFrame(list(rows), ROW)
    with pytest.raises(AlignmentError, match="repeated"):
        reports.evaluation_report(frame(row("a", "m"), row("a", "m")))
    with pytest.raises(AlignmentError, match="no scored"):
        reports.evaluation_report(frame(row("a", "m", False)))
    with pytest.raises(AlignmentError, match="without metrics"):
        reports.evaluation_report(frame(row("a", "m"), row("b", "m", False)), allow_missing=False)
    r = reports.evaluation_report(frame(row("a", "m"), row("b", "m", False), row("a", "n"), row("c", "n", True, "noise")), "m", "n", [("g", None, 0.0), ("h", "gone", 0.0)], 20)
    got = {(x["section"], x["bucket"], x["model"]): (x["samples"], x["corpus_cer"], x["char_acc"]) for x in r.corpus.collect()}
    assert got["overall", None, "m"] == (1, 0.1, 0.9) and got["empty_ref", None, "n"][0] == 1 and got["bucket", "noise", "n"][0] == 1
    assert r.delta.first()["delta_cer"] == 0.0 and {x["name"]: (x["skipped"], x["passed"]) for x in r.gates.collect()} == {"g": (False, True), "h": (True, True)}


def test_buckets(spark):
    rows = [("a", "t", "s"), (None, " t ", "s"), ("  ", None, "s"), (None, None, None), ("a", None, "a")]
    got = spark.createDataFrame(rows, "b string, t string, s string").select(reports.effective_bucket(F.col("b"), F.col("t"), F.col("s")).alias("x"), reports.effective_bucket(F.col("b"), F.col("t"), F.col("s"), True).alias("y")).collect()
    assert [tuple(r) for r in got] == [("a/s", "s"), ("t/s", "s"), ("s", "s"), ("unclassified", "unclassified"), ("a", "a")]


def test_metric_requests(spark):
    d = spark.createDataFrame([("a", "ab", "ab")], "id string, r string, h string")
    for bad in ({"wanted": ["wer"]}, {"hyps": {}}, {"hyps": {"m": "no"}}):
        with pytest.raises(ValueError):
            reports.run_metrics(d, "r", **{"hyps": {"m": "h"}, **bad})
    assert reports.run_metrics(d, "r", {"m": "h"}, unicode=False).first()["cer"] == 0.0


def test_attach_refuses_shared_runs_and_other_snapshots(spark):
    from corvane.operators.dataset import snapshot_digest

    s = spark.createDataFrame([("a", "1"), ("b", "2")], "id string, sha256 string")
    t = spark.createDataFrame([("a", "1", "x"), ("b", "9", "y")], "id string, sha256 string, text string")
    own = snapshot_digest(s, "id", ["sha256"]).first()["digest"]
    runs = lambda *rows: spark.createDataFrame(list(rows), "run string, family string, artifact string, execution string, snapshot string")
    with pytest.raises(AlignmentError, match="independent"):
        reports.attach_routes(s, runs(("r", "f", "a", "e", own), ("q", "f", "b", "e", own)), {"r": t, "q": t})
    with pytest.raises(AlignmentError, match="tables differ"):
        reports.attach_routes(s, runs(("r", "f", "a", "e", own)), {})
    with pytest.raises(AlignmentError, match="another snapshot"):
        reports.attach_routes(s, runs(("r", "f", "a", "e", "zz")), {"r": t})
    with pytest.raises(AlignmentError, match="digests differ"):
        reports.attach_routes(s, runs(("r", "f", "a", "e", own)), {"r": t})


def test_release_is_written_once(spark, tmp_path):
    d = spark.createDataFrame([("a", 1), ("b", 2)], "id string, x long")
    first = building.publish(d, str(tmp_path), "v1")
    assert first["state"] == "published" and spark.read.parquet(str(tmp_path / "v1" / "rows")).count() == 2
    assert building.publish(d.orderBy(F.desc("id")), str(tmp_path), "v1") == first | {"state": "unchanged"}
    with pytest.raises(building.ReleaseError, match="another digest"):
        building.publish(d.withColumn("x", F.col("x") + 1), str(tmp_path), "v1")
    with pytest.raises(building.ReleaseError, match="refused"):
        building.publish(d, str(tmp_path), "v2", gates={"g": 1, "h": 0})
    assert not (tmp_path / "v2").exists()


def test_build_refuses_leaks_and_shortfalls(spark, tmp_path):
    s = spark.createDataFrame([("a", "g", "x", None), ("b", "g", "y", None), ("c", "h", "z", None)], "id string, group_id string, gold_text string, candidate_text string")
    plan = lambda rows, lacks=(): building.Plan(spark.createDataFrame(rows, "id string, split string, stratum string"), spark.createDataFrame(list(lacks), "split string, stratum string, requested long, available long, reason string"), None)
    with pytest.raises(building.ReleaseError, match="two_splits"):
        building.build(s, plan([("a", "dev", "o"), ("b", "train", "o")]), str(tmp_path), "r")
    with pytest.raises(building.ReleaseError, match="shortfalls"):
        building.build(s, plan([("a", "dev", "o")], [("dev", "o", 2, 1, "x")]), str(tmp_path), "r")
    assert building.build(s, plan([("a", "dev", "o"), ("c", "train", "o")]), str(tmp_path), "r")["rows"] == 2
    with pytest.raises(AlignmentError, match="blocked"):
        building.stamp_plan(s, plan([("a", "train", "o")]).rows, F.col("gold_text"), F.lit("why"))


def test_freeze_and_audit(spark, tmp_path):
    snap = spark.createDataFrame([("a", "1"), ("b", "2")], "id string, sha256 string")
    row = "id string, sha256 string, annotation_state string, gold_kind string, reviewed_category string, category string, decision string"
    good = spark.createDataFrame([("a", "1", "second_review", "speech", "", "speech", None), ("b", "2", "rejected", None, None, "speech", None)], row)
    assert building.freeze(good, snap, str(tmp_path), "w", ["speech"], F.lit(True))["state"] == "published"
    bad = good.withColumn("annotation_state", F.lit("annotated"))
    assert {r["problem"]: r["n"] for r in building.freeze_problems(bad, snap, ["speech"], F.lit(True)).collect()} == {"dual_review_incomplete": 2}
    with pytest.raises(building.ReleaseError):
        building.freeze(bad, snap, str(tmp_path), "x", ["speech"], F.lit(True))
    pool = spark.createDataFrame([(f"i{i}", f"g{i % 5}", "h", False, i) for i in range(20)], "id string, group_id string, sha256 string, is_human_verified boolean, n long")
    draws = building.audit_plan(pool, {"low": (F.col("n") < 10, 2)}, 4)
    assert draws.groupBy("draw").count().count() == 2 and draws.count() == 6
    digest = building.audit_digest(pool, draws, ["group_id", "sha256"])
    assert len(digest) == 64 and digest == building.audit_digest(pool.repartition(3), draws, ["group_id", "sha256"]) != building.audit_digest(pool, draws.limit(3), ["group_id", "sha256"])
    stamped = building.stamp_audit(pool.unionByName(pool.limit(1).withColumn("id", F.lit("out"))), pool, draws, digest).collect()
    assert sum(r["review_queue"] == "pseudo_audit" for r in stamped) == draws.select("id").distinct().count() and [r["review_queue"] for r in stamped if r["id"] == "out"] == [None]
    with pytest.raises(AlignmentError):
        building.audit_plan(pool.withColumn("is_human_verified", F.lit(True)), {}, 4)


def test_prepare_holds_whole_groups(spark):
    s = spark.createDataFrame([(f"s{i}", f"c{i // 2}", "src") for i in range(20)], "id string, call string, other string")
    contract = s.select("id", F.when(F.col("id") == "s3", "incomplete").otherwise("classifiable").alias("readiness"))
    rows, counts = building.prepare(s, contract, {"call": ["call"]}, random_target=2, calibration_target=1)
    role = {r["id"]: r["role"] for r in rows.collect()}
    assert role["s2"] == role["s3"] == "governance_hold" and len(role) == 20
    assert sum(r["n"] for r in counts.collect()) == 20


def test_review_summary_needs_buckets(spark):
    d = spark.createDataFrame([("a", "t"), ("b", " ")], "id string, type string").withColumn("transcripts", F.create_map(F.lit("m"), F.struct(F.lit("x").alias("text"))))
    with pytest.raises(AlignmentError):
        reports.review_summary(d, ["m"], [])
    wide, counts = reports.review_summary(d.where("id = 'a'"), ["m", "none"], [])
    assert wide.first()["m_text"] == "x" and wide.first()["none_text"] == "" and counts.first()["n"] == 1


def test_noise_bands_without_scores(spark):
    rows = [(1.0, 1.0, "success"), (3.4, 3.4, "success"), (3.5, 3.5, "success"), (float("nan"), 4.0, "success"), (None, 4.0, "success"), (4.0, 4.0, "failed")]
    d = spark.createDataFrame(rows, "b double, o double, s string")
    band = lambda **k: [tuple(r["x"]) for r in d.select(reports.noise_band(F.col("b"), F.col("o"), F.col("s"), (3.0, 3.0), **k).alias("x")).collect()]
    assert band() == [("noisy", True), ("moderate", False), ("clean", False)] + [("unknown", None)] * 3
    assert band(calibrated=False) == [("unknown", None)] * 6
