import pytest

from corvane.operators import classify, consensus, routes

FAM = routes.Families({"kimi": ["k1", "k2"], "glm": ["g1", "g2"], "qwen": ["q1", "q2"]})
ENTRY = "struct<text:string,model:string,version:string,confidence:double,status:string,extra:map<string,string>>"


def samples(spark, cases):
    rows = [(i, 10.0, False, {k: (v[0] if isinstance(v, tuple) else v, k, None, None, v[1] if isinstance(v, tuple) else None, None) for k, v in c.items()}) for i, c in cases.items()]
    return spark.createDataFrame(rows, f"id string, duration double, broken boolean, transcripts map<string,{ENTRY}>")


def six(*texts):
    return dict(zip(("k1", "k2", "g1", "g2", "q1", "q2"), texts))


LONG = "今天下午三点我们在公司会议室见面讨论合同"


@pytest.mark.parametrize("status, entry", [("missing", None), ("missing", (None, None)), ("success_empty", ("", None)), ("success_empty", (" ", None)), ("failed", ("x", "failed")), ("missing", ("x", "pending")), ("success_text", ("x", None))])
def test_run_status_matrix(spark, status, entry):
    d = samples(spark, {"a": {} if entry is None else {"k1": entry}})
    got = routes.explode_routes(d, routes.Families({"kimi": ["k1"]})).first()
    assert got["status"] == status


V1 = {"qwen": ["q1", "q2"], "sensevoice": ["g1", "g2"], "kimi": ["k1", "k2"]}


def test_v1_outcomes(spark):
    cases = {
        "gold": six(*[LONG] * 6), "empty": six(*[""] * 6), "missing_q": six(LONG, LONG, LONG, LONG, "", ""), "flip": six("需要", "需要", "不需要", "不需要", "需要", "需要"),
        "lone": six(LONG, "", "", "", "", ""), "hard": six(LONG, LONG, "完全不同的内容一二三四五六七八", "完全不同的内容一二三四五六七八", "另外一种说法甲乙丙丁戊己庚辛", "另外一种说法甲乙丙丁戊己庚辛"),
        "cluster": six(LONG, LONG, LONG, LONG, LONG, "别的话别的话别的话别的话别的话"),
    }
    got = {r["id"]: r for r in classify.classify_v1(samples(spark, cases), V1).collect()}
    want = {"gold": "auto_gold", "empty": "noise", "missing_q": "qwen_missing", "flip": "semantic_inversion", "lone": "qwen_missing", "hard": "hardcase", "cluster": "consensus_gold"}
    assert {k: r["type"] for k, r in got.items()} == want
    assert got["gold"]["label"] == LONG and got["gold"]["support_count"] == 6 and got["flip"]["decision"] == "auto_accept"


def test_v2_outcomes(spark):
    from pyspark.sql import functions as F

    cases = {"high": six(*[LONG] * 6), "silent": six(*[""] * 6), "sanitized": six("滚", "滚", "可以可以", "可以可以", "可以可以", "可以可以"), "flip": six("我需要", "我需要", "不需要", "不需要", "我需要", "我需要")}
    d = samples(spark, cases).withColumns({"speech_ratio": F.when(F.col("id") == "silent", 0.01), "vad_edge_risk": F.lit(None).cast("boolean"), "overlap_risk": F.lit(False), "has_speech": F.lit(None).cast("boolean")})
    got = {r["id"]: (r["type"], r["dataset_role"]) for r in classify.classify_v2(d, V1).collect()}
    assert got == {"high": ("pseudo_gold_high", "train_candidate"), "silent": ("true_silence", "exclude"), "sanitized": ("semantic_sanitization", "eval_candidate"), "flip": ("semantic_inversion", "eval_candidate")}


def gathered(spark, cases):
    from pyspark.sql import functions as F

    d = consensus.gather(routes.explode_routes(samples(spark, cases), FAM))
    n = F.lit(None)
    return d.withColumns({"broken": F.lit(False), "noise_band": F.lit("clean"), "noise_risk": F.lit(False), "dnsmos_status": F.lit("success"), "crosstalk": n.cast("boolean"), "governance_hold": n.cast("boolean"),
                          "energy": F.lit("audible"), "dnsmos_bak": n.cast("double"), "dnsmos_ovrl": n.cast("double"), "dnsmos_sig": n.cast("double"), "crosstalk_confirmed": F.lit(False)})


def test_v3_outcomes(spark):
    other = "明天上午九点他们到机场接人然后回去"
    cases = {
        "high": six(*[LONG] * 6), "incomplete": six(LONG, LONG, LONG, LONG, LONG, (None, None)), "presence": six(LONG, LONG, LONG, LONG, "", ""), "empty": six(*[""] * 6),
        "flip": six("需要", "需要", "不需要", "不需要", "需要", "需要"), "correction": six(LONG, LONG, LONG, LONG, other, other), "unstable": six(LONG, LONG, LONG, other, LONG, LONG),
    }
    got = {r["id"]: r for r in classify.classify_v3(gathered(spark, cases), FAM).collect()}
    want = {"high": "pseudo_high", "incomplete": "inference_incomplete", "presence": "speech_presence_disagreement", "empty": "all_empty_unverified", "flip": "semantic_risk", "correction": "qwen_correction_candidate", "unstable": "family_unstable"}
    assert {k: r["type"] for k, r in got.items()} == want
    assert got["flip"]["review_priority"] == "P0" and got["high"]["disposition"] == "pseudo_pending_audit" and got["incomplete"]["disposition"] == "machine_retry"
    assert got["correction"]["candidate_text"] == LONG


def test_five_classes(spark):
    cases = {"gold": six(LONG, LONG, LONG, LONG, "", ""), "risk": six("需要", "需要", "不需要", "不需要", "", ""), "background": six(*[""] * 6), "human": six(LONG, LONG, "", "", "", ""), "short": six("好的", "好的", "", "", "", "")}
    got = {r["id"]: (r["category"], r["noise_kind"]) for r in classify.classify_five(gathered(spark, cases), FAM).collect()}
    assert got == {"gold": ("gold_candidate", None), "risk": ("semantic_risk", None), "background": ("environment_noise", "background"), "human": ("environment_noise", "human_noise"), "short": ("hardcase", None)}


def test_external_and_cliques(spark):
    from pyspark.sql import functions as F

    d = spark.createDataFrame([("a", "x", "x", ""), ("b", "", "", None), ("c", "x", "", ""), ("d", "x", "y", ""), ("e", "x", "y", "kept")], "id string, h string, g string, preassigned string")
    got = {r["id"]: r["type"] for r in classify.classify_external(d, "h", "g").collect()}
    assert got == {"a": "auto_gold", "b": "noise", "c": "hardcase", "d": "hardcase", "e": "kept"}
    t, f = F.lit(True), F.lit(False)
    c = consensus.max_cliques(["a", "b", "c"], {("a", "b"): t, ("a", "c"): f, ("b", "c"): t})
    assert spark.range(1).select(c.alias("c")).first()["c"] == [["a", "b"], ["b", "c"]]


def test_v3_route_quarantine(spark):
    fast = "一二三四五六七八九十" * 30
    cases = {"one": six(fast, LONG, LONG, LONG, LONG, LONG), "two": six(fast, fast, fast, fast, LONG, LONG), "failed": six(fast, LONG, (None, "failed"), LONG, LONG, LONG), "none": six(*[LONG] * 6)}
    d = gathered(spark, cases)
    plain = {r["id"]: (r["type"], r["disposition"]) for r in classify.classify_v3(d, FAM).collect()}
    assert plain["one"] == plain["two"] == ("implausible_speech_rate", "audio_exclude") and plain["none"][0] == "pseudo_high"
    got = {r["id"]: r for r in classify.classify_v3(d, FAM, quarantine=True, least_families=2).collect()}
    assert {k: (r["type"], r["disposition"]) for k, r in got.items()} == {"one": ("hardcase", "human_blind"), "two": ("route_quarantine", "route_quarantine"), "failed": ("route_quarantine", "route_quarantine"), "none": ("pseudo_high", "pseudo_pending_audit")}
    few = {r["id"]: (r["type"], r["disposition"]) for r in classify.classify_v3(d, FAM, quarantine=True, least_families=1).collect()}
    assert few["failed"] == ("inference_incomplete", "route_quarantine") and few["two"][0] != "route_quarantine"
    assert "implausible_speech_rate" in got["one"]["risk_tags"] and "implausible_speech_rate" not in got["none"]["risk_tags"]
    assert {x["comparison_text"] for x in got["one"]["routes"]} == {fast, LONG} and got["two"]["review_queue"] == "retry"
