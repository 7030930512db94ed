import random
import re
import time

from pyspark.sql import functions as F

from corvane.operators import classify_semantic, consensus, routes, semantics
from tests.test_classify import FAM, LONG, samples, six


def values(spark, rows, f, kind="a string, b string"):
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {kind}")
    return [r["o"] for r in sorted(d.select("i", f().alias("o")).collect(), key=lambda r: r["i"])]


def test_differences_and_conflicts(spark):
    rows = [("我需要", "我不需要"), ("好的", "好的"), ("要一万", "要一千"), ("不去", "去"), ("今天来", "明天来"), ("", "x"), ("三百块", "五百块"), (None, "x")]
    got = values(spark, rows, lambda: semantics.polarity_conflict(F.col("a"), F.col("b")))
    assert got == ["rejection_sanitization", None, "critical_slot", "rejection_sanitization", None, None, "critical_slot", None]
    d = values(spark, [("abcd", "abXd"), ("aa", "a"), ("", "q")], lambda: semantics.difference(F.col("a"), F.col("b")))
    assert [tuple(x) for x in d] == [("c", "X"), ("a", ""), ("", "q")]


def test_business_fields(spark):
    texts = ["", "请您留言", "他不在", "不需要谢谢", "没有了谢谢", "回头再打给我", "请问您是哪位", "你说吧", "嗯嗯", "是的", "喂你好", "我同意办理", "明天三点五百块", "今天天气"]
    got = values(spark, [(t,) for t in texts], lambda: semantics.business_fields(F.col("a")), "a string")
    assert [g["act"] for g in got] == ["empty", "voicemail", "absence", "refusal", "refusal", "callback", "identity_inquiry", "continue_listening", "brief_response", "affirmation_undetermined", "greeting", "acceptance", "unknown", "unknown"]
    assert got[12]["slots"] == ["amount:五百块", "time:三点", "time:明天"] and got[3]["polarity"] == "negative"
    pair = values(spark, [("不要", "不需要"), ("需要", "不需要"), ("嗯", "今天天气"), ("", "")], lambda: semantics.fields_compatible(semantics.business_fields(F.col("a")), semantics.business_fields(F.col("b"))))
    assert pair == ["equivalent", "conflict", "insufficient", "insufficient"]


def test_text_that_may_vote(spark):
    rows = [("<|zh|>你好，123",), ("打开APP看看",), ("hello there",), ("你好hello",), ("。。",), ("提示词",), ("Привет",)]
    got = values(spark, rows, lambda: semantics.classify_text(F.col("a"), ["提示词"]), "a string")
    assert [g["text"] for g in got] == ["你好123", "打开看看", "", "", "", "", ""]
    assert [g["reasons"] for g in got][2:] == [["non_chinese"], ["non_chinese"], ["punct_or_symbol"], ["prompt_echo"], ["non_chinese"]]
    strict = values(spark, [("打开APP看看",), ("你好",)], lambda: semantics.classify_text(F.col("a"), strict=True), "a string")
    assert [g["disposition"] for g in strict] == ["excluded", "eligible"]
    lang = values(spark, [("你好",), ("你好 hello",), ("hello",), ("ok",), ("。",), ("打开APP",)], lambda: semantics.speech_language(F.col("a")), "a string")
    assert lang == ["zh", "mixed", "non_zh", "unknown", "empty", "zh"]


def made(spark, cases):
    d = consensus.gather(routes.explode_routes(samples(spark, cases), FAM))
    n = F.lit(None)
    return d.withColumns({"broken": F.lit(False), "acoustic": n.cast("string"), "speech_absent": n.cast("boolean"), "retry_count": F.lit(0), "presence": n.cast("string"), "retry_open": F.lit(True)})


def test_tolerant_outcomes(spark):
    far = "明天上午九点他们到机场接人然后回去"
    cases = {"gold": six(*[LONG] * 6), "risk": six("我需要", "我需要", "我不需要", "我不需要", "我需要", "我需要"), "hard": six(LONG, LONG, far, far, LONG, LONG), "gap": six(LONG, LONG, LONG, LONG, LONG, (None, None)), "foreign": six(LONG, LONG, LONG, LONG, "hello there friend", "hello there friend"), "empty": six(*[""] * 6), "affirm": six("好的", "好的", "好的", "好的", "", "")}
    got = {r["id"]: (r["category"], r["status"]) for r in classify_semantic.classify_tolerant(made(spark, cases), FAM).collect()}
    assert got == {"gold": ("gold", "candidate"), "risk": ("semantic_risk", "manual_review"), "hard": ("hardcase", "manual_review"), "gap": (None, "retry"), "foreign": (None, "hold"), "empty": (None, "hold"), "affirm": (None, "hold")}


def test_business_outcomes(spark):
    cases = {"same": six("不需要", "不需要", "不要了", "不要了", "不用", "不用"), "risk": six("需要", "需要", "不需要", "不需要", "需要", "需要"), "mail": six("请您留言", "请您留言", "语音信箱请留言", "语音信箱请留言", "请您留言", "请您留言"), "verbatim": six(*[LONG] * 6), "open": six(LONG, LONG, LONG, LONG, "今天天气", "今天天气"), "empty": six(*[""] * 6)}
    got = {r["id"]: (r["category"], r["coverage"], r["label_grade"]) for r in classify_semantic.classify_business(made(spark, cases), FAM).collect()}
    assert got["same"] == ("business_consistent", "A", "semantic_only") and got["risk"][0] == "semantic_risk" and got["mail"][0] == "voicemail"
    assert got["verbatim"] == ("business_consistent", "A", "pseudo_verbatim_high") and got["open"][1] == "U" and got["empty"][1] == "U"


def plain_speech_language(text):
    body = re.sub(r"\bEMO_[A-Z]+\b", "", re.sub(r"<\|.*?\|>", "", text or "")).strip(" ")
    if not any(c.isalpha() or c.isdecimal() for c in body):
        return "empty"
    tokens, han = [t for t in re.findall("[A-Za-z]+", body) if len(t) > 1], any("一" <= c <= "\u9fff" for c in body)
    short = lambda t: t.upper() in semantics.ABBREVIATIONS or re.fullmatch("[A-Z]{2,6}", t) or (len(t) <= 8 and not t.isupper() and not t.islower())
    foreign = any(not short(t) if han else len(t) >= 3 for t in tokens)
    return ("mixed" if foreign else "zh") if han else "non_zh" if foreign else "unknown"


def test_speech_language_reads_a_text_once(spark):
    """Each word of a text used to be held against the whole text again: this one took minutes."""
    rnd = random.Random(5)
    parts = ["好", "你", " ", " ", "7", "é", "。", "<|zh|>", "EM<||>O_X ", "EMO_SAD", "ok", "ai", "aid", "App", "wifi", "WIFI", "QWERTYU", "QWERTY", "QWERTYUIO", "Qwertyui", "Qwertyuio", "qwertyuio", "a", "B", "id", "x1"]
    texts = [None, ""] + ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 6))) for _ in range(1500)]
    long = ["hello ok " * 60_000, "你好 AI " * 60_000]
    began = time.time()
    got = values(spark, [(t,) for t in texts + long], lambda: semantics.speech_language(F.col("a")), "a string")
    assert time.time() - began < 20
    assert got == [plain_speech_language(t) for t in texts] + ["non_zh", "zh"]
