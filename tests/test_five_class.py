"""The first two five-class forms and the strict risks: one case for each outcome."""

import pytest
from pyspark.sql import functions as F

from corvane.operators import five_class as V
from tests.test_classify import FAM, LONG, gathered, six

ACOUSTIC = {"acoustic_state": "string", "no_target_speech": "boolean", "target_speech_present": "boolean", "short_response_missed": "boolean", "unclear_polarity": "boolean", "human_no_target": "boolean"}


def test_texts(spark):
    rows = [("我需要贷款", "我不需要贷款"), ("我需要贷款", "我不需要保险"), ("需要吗", "不需要"), ("需要", "不需要"), ("可以可以的呀", "不行")]
    d = spark.createDataFrame(rows, "a string, b string")
    got = d.select(V.same_proposition(F.col("a"), F.col("b")).alias("p"), V.hedged(F.col("a")).alias("h"), V._apart(F.col("a"), F.col("b")).alias("x"), V.answers(F.col("b")).alias("t")).collect()
    assert [r["p"] for r in got][:2] == [True, False] and [r["h"] for r in got] == [False, False, True, False, False]
    assert [r["x"] for r in got] == [False, True, False, False, False] and [r["t"] for r in got] == [False, False, True, True, False]


def state(name, kind, text=None):
    return (name, kind, text)


@pytest.mark.parametrize(
    ("states", "acoustic", "want"),
    [
        ([state("a", "stable_text", "我需要贷款"), state("b", "stable_text", "我不需要贷款")], {}, "semantic_reversal"),
        ([state("a", "stable_text", "我需要贷款"), state("b", "unstable", "我不需要贷款")], {}, None),
        ([state("a", "stable_text", "需要"), state("b", "stable_empty")], {"state": "environment_confirmed"}, "hallucinated_assertion"),
        ([state("a", "stable_text", "需要"), state("b", "stable_empty")], {}, None),
        ([state("a", "stable_text", "需要"), state("b", "stable_empty")], {"state": "environment_confirmed", "short_response_missed": True}, None),
        ([state("a", "stable_text", "需要"), state("b", "stable_empty")], {"unclear_polarity": True}, "short_polarity_ambiguity"),
        ([state("a", "stable_text", "需要吗"), state("b", "stable_empty")], {"state": "environment_confirmed"}, None),
        ([state("a", "stable_text", "需要"), state("b", "stable_text", "需要")], {"unclear_polarity": True}, None),
    ],
)
def test_strict_risk(spark, states, acoustic, want):
    d = spark.createDataFrame([(states,)], "states array<struct<family:string,state:string,text:string>>")
    got = d.select(V.strict_risk(F.col("states"), {k: F.lit(v) for k, v in acoustic.items()}).alias("r")).first()["r"]
    assert got == want


def test_divergence(spark):
    rows = [(["我要贷款", "我要保险"], True), (["好的", "好的啊"], False), ([LONG, LONG], False), (["今天天气很好啊我们", "明天开会在八点半"], True), (["是", "是"], False)]
    got = spark.createDataFrame(rows, "t array<string>, w boolean").select(V.divergent(F.col("t")).alias("d"), "w").collect()
    assert [r["d"] for r in got] == [r["w"] for r in got]


def test_first_form(spark):
    other = "明天上午九点他们到机场接人然后回去"
    cases = {
        "gold": six(*[LONG] * 6), "two": six(LONG, LONG, LONG, LONG, "", ""), "reversal": six("我需要贷款", "我需要贷款", "我不需要贷款", "我不需要贷款", "我需要贷款", "我需要贷款"), "hard": six(LONG, LONG, other, other, LONG, LONG), "excluded": six(*[LONG] * 6),
        "rest": six(LONG, LONG, (None, "failed"), (None, "failed"), (None, "failed"), (None, "failed")), "noise": six(LONG, LONG, "", "", "", ""), "ghost": six("需要", "需要", "", "", "", ""), "mail": six("请语音留言", LONG, LONG, LONG, LONG, LONG), "bad": six(*[LONG] * 6),
        "asks": six("可以", "可以", "可以", "可以", "可以", "可以"),
    }
    d = gathered(spark, cases).withColumns({n: F.lit(None).cast(k) for n, k in ACOUSTIC.items()})
    runs = F.transform("routes", lambda r: r["run_id"])
    d = d.withColumns({"broken": F.col("id") == "bad", "acoustic_state": F.when(F.col("id").isin("noise", "ghost"), "environment_confirmed"), "excluded_runs": F.when(F.col("id") == "excluded", runs).when(F.col("id") == "rest", F.slice(runs, 1, 2))})
    got = {r["id"]: r for r in V.classify_five_v1(d, FAM, "语音留言", {"qwen": 2.0}).collect()}
    assert {k: (r["category"], r["reason"]) for k, r in got.items()} == {
        "gold": ("gold_candidate", "gold_candidate"), "two": ("manual", "manual_annotation_insufficient_evidence"), "reversal": ("semantic_risk", "semantic_reversal"), "hard": ("hardcase", "hardcase_substantive_divergence"), "excluded": ("route_excluded", "all_routes_excluded"),
        "rest": ("manual", "partial_exclude_rest_failed"), "noise": ("environment_noise", "environment_noise_confirmed"), "ghost": ("semantic_risk", "hallucinated_assertion"), "mail": ("voicemail", "voicemail_any_route"), "bad": ("invalid_audio", "broken_or_invalid_audio"),
        "asks": ("gold_candidate", "gold_candidate"),
    }
    assert got["gold"]["candidate_text"] == LONG and got["gold"]["selected_run_id"] and got["noise"]["candidate_text"] is None
    assert got["reversal"]["review_priority"] == "P0" and got["rest"]["review_priority"] == "P1" and got["mail"]["review_priority"] == "P2" and got["bad"]["review_priority"] is None


def test_second_form(spark):
    other = "明天上午九点他们到机场接人然后回去"
    cases = {
        "gold": six(LONG, LONG, LONG, LONG, "", ""), "risk": six("需要", "需要", "不需要", "不需要", "", ""), "background": six(*[""] * 6), "quiet": six(*[""] * 6), "human": six(LONG, LONG, "", "", "", ""), "short": six("好的", "好的", "", "", "", ""), "tiny": six(*[LONG] * 6),
        "opposed": six(LONG, LONG, LONG, LONG, other, other), "unstable": six(LONG, other, LONG, LONG, LONG, LONG), "missing": six(LONG, LONG, (None, "failed"), (None, "failed"), "", ""), "edge": six(*[""] * 6),
    }
    d = gathered(spark, cases).withColumn("energy", F.when(F.col("id") == "quiet", "inaudible").when(F.col("id") == "tiny", "audio_too_short").when(F.col("id") == "edge", "borderline").otherwise("audible"))
    got = {r["id"]: r["reason"] for r in V.classify_five_v2(d, FAM).collect()}
    assert got == {
        "gold": "gold_candidate", "risk": "semantic_reversal", "background": "environment_noise_background", "quiet": "environment_noise_silence", "human": "environment_noise_human_noise", "short": "critical_short_response_unsupported", "tiny": "environment_noise_audio_too_short",
        "opposed": "substantive_divergence_non_strict_risk", "unstable": "family_unstable", "missing": "insufficient_family_evidence", "edge": "energy_borderline",
    }
