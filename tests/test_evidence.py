import pytest
from pyspark.sql import functions as F

from corvane.operators import evidence


def test_acoustic_states(spark):
    rows = [("gone", {"no_target_speech": "true", "no_target_speech_trusted": "1"}, {}), ("label", {}, {"human_crosstalk_confirmed": "yes"}), ("untrusted", {"no_target_speech": "true", "overlap_detected": "true", "crosstalk_suspected": "1"}, None),
            ("back", {"background_only": "true", "vad_calibrated": "true", "vad_speech_present": "false"}, {}), ("none", None, None)]
    d = spark.createDataFrame(rows, "id string, quality map<string,string>, labels map<string,string>")
    got = {r["id"]: r["e"] for r in d.select("id", evidence.acoustic_evidence().alias("e")).collect()}
    assert {k: e["state"] for k, e in got.items()} == {"gone": "environment_confirmed", "label": "crosstalk_confirmed", "untrusted": "unknown", "back": "background_only", "none": "unknown"}
    assert got["untrusted"]["gaps"][:3] == ["no_target_speech_untrusted", "overlap_untrusted", "crosstalk_suspected_not_sufficient"] and got["back"]["vad_speech_present"] is False and got["none"]["no_target_speech"] is None


def test_business_names_keep_no_human_grade(spark):
    rows = [("business_consistent", "auto_classified", "gold"), ("business_consistent", "auto_classified", "pseudo_verbatim_high"), ("non_speech", "auto_classified", "x"), (None, "retry", None)]
    d = spark.createDataFrame(rows, "c string, s string, g string")
    got = [r["m"] for r in d.select(evidence.older_names(F.col("c"), F.col("s"), F.lit(None).cast("string"), evidence.BUSINESS_NAMES, F.col("g")).alias("m")).collect()]
    assert [(m["type"], m["label_tier"]) for m in got] == [("business_consistent", "semantic_only"), ("business_consistent", "pseudo_verbatim_high"), ("non_speech", "no_transcript"), ("inference_incomplete", "none")]


def test_verifier_failures_stay_with_their_pair(spark):
    def call(pairs):
        if any("boom" in a for a, _ in pairs):
            raise RuntimeError("down")
        return ["conflict" if a[0] != b[0] else "certainly" for a, b in pairs]

    rows = [("a", "a"), ("ab", "ac"), ("x", "y"), ("boom", "x"), (None, "x"), ("", "")]
    got = evidence.verify(spark.createDataFrame(rows, "a string, b string").coalesce(1), call, "a", "b").collect()
    assert [r["verdict"] for r in got] == ["equivalent", "unclear", "conflict", "unclear", "unclear", "unclear"]


def test_release_keeps_rows(spark):
    cache = {"m": object()}
    assert evidence.release_models(spark.range(5).toDF("id"), cache).count() == 5 and not cache


@pytest.mark.parametrize(("parts", "want"), [([[1, 2], [3]], (0, True)), ([[1, 2], [2]], (1, False)), ([[1, 2, 3], [4]], (0, False))])
def test_packages(spark, parts, want):
    frame = lambda ids: spark.createDataFrame([(i,) for i in ids], "id long")
    assert tuple(evidence.package_checks(frame([1, 2, 3]), {str(i): frame(p) for i, p in enumerate(parts)}).first()) == want
