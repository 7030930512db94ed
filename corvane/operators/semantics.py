"""What two transcripts say: aligned differences, business fields, text that may vote."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvane.functions import text
from corvane.functions.maps import let
from corvane.operators import lexicon

# Spans that turn a proposition round, in pairs.
FLIPS = [("不好", "好"), ("不需要", "需要"), ("不同意", "同意"), ("不可以", "可以"), ("不要", "要"), ("不是", "是"), ("没有", "有"), ("不行", "行"), ("不用", "要"), ("不能", "能"), ("不想", "想"), ("不要再打", "再打"), ("一万", "一千"), ("一千", "一签"), ("一万", "一签")]
# Bare negations.
NEGATIONS = ["不", "没", "沒", "别", "別"]
AMOUNT = "[零〇一二三四五六七八九十百千万亿0-9]+"

# Phrases of speech acts.
CONTINUE = ["你说", "你说吧", "嗯你说", "啊你说", "哦你说", "唔你说", "你讲", "你讲吧", "请说", "请讲", "继续说", "你继续说", "你继续讲"]
REFUSAL = ["不需要", "不用了", "不要再打", "别打", "不想", "不考虑", "拒绝", "没兴趣", "不去了", "不要", "不用", "不行"]
ABSENCE = ["他歇了", "她歇了", "他不在", "她不在", "他出去了", "人不在", "他休息了"]
CALLBACK = ["稍后联系", "稍后再联系", "回头打", "回头再打", "等会再打", "等一下再打", "待会儿联系", "一会再打", "晚点再打", "回头联系"]
IDENTITY = ["你是谁", "哪位", "您是哪位", "什么事", "找谁", "请问你是", "请问您是", "哪里", "谁啊", "谁呀", "怎么了", "哪位啊", "你哪位"]
VOICEMAIL = ["语音留言", "语音信箱", "转至语音", "已转留言", "提示音后留言", "滴声后留言", "请你留言", "请您留言", "来电原因我会帮你确认", "通知机主", "屏幕留言", "录音超时", "通信助理", "通讯助理", "电话助理", "语音助理"]
BRIEF = ["嗯", "哦", "好", "行", "对", "啊", "嗯嗯", "啊啊", "好好", "哦哦", "嗯对", "对对", "哎", "好啊", "行啊", "对啊", "嗯啊", "唔", "嗯哼"]
BARE_AFFIRM = ["需要", "要", "可以", "好的", "好吧", "行吧", "是", "是的", "是啊", "有", "有啊"]
GREETING = ["你好", "您好", "喂", "哎你好", "喂你好", "诶你好", "嗨你好", "你好对", "喂你好对"]
SHORT_REFUSAL = ["没有", "没有了", "没有没有", "没有没有没有", "没有谢谢", "没有了谢谢", "没有了谢谢啊", "啊没有", "暂时没有", "不是", "不是的", "不是不是", "啊没有谢谢", "没有嗯"]
REFUSAL_START = ["没有了谢谢", "没有谢谢", "没有没有", "暂时没有", "啊没有"]
ACCEPT = ["我同意", "同意办理", "可以办理", "帮我办理"]
AFFIRM, FILL = ["办理", "同意", "需要", "可以", "好的", "好"], ["嗯", "啊", "哦", "呃", "唔"]
# Edges that ask to go on, single words that refuse, marks of an inquiry, of attendance and of a question with "not", openers of greetings.
GO_ON, BARE_REFUSAL, WHO, NOT_GOING, HAVE_OR_NOT, HELLO, OPENERS = ["你说", "你讲", "请说"], ["不", "没", "别"], "谁", "不去", "有没有", "你好", "喂哎诶嗨啊哦"
# The state of a dialogue after an act.
DIALOGUE = {
    "empty": "no_speech_text", "voicemail": "automated_prompt", "absence": "party_unavailable", "refusal": "closed", "callback": "deferred", "identity_inquiry": "opening",
    "continue_listening": "listen", "brief_response": "listen", "affirmation_undetermined": "listen", "greeting": "opening", "acceptance": "open",
}
# Abbreviations that are not foreign speech.
ABBREVIATIONS = ["AI", "APP", "ATM", "CPU", "GPS", "ID", "LCD", "LED", "NFC", "PDF", "POS", "QR", "SIM", "SMS", "TV", "URL", "USB", "VIP", "WIFI"]
# A run of letters that counts as foreign beside Han: a long one, all capitals beyond an abbreviation's length, or small letters that are no abbreviation.
FOREIGN = rf"[A-Za-z]{{9}}|(?<![A-Za-z])(?:[A-Z]{{7,8}}|(?!(?:{'|'.join(ABBREVIATIONS).lower()})(?![A-Za-z]))[a-z]{{2,8}})(?![A-Za-z])"


def _any(c: Column, phrases: list[str]) -> Column:
    return c.rlike(text.phrase_pattern(phrases))


def _shared(a: Column, b: Column) -> Column:
    """Length of the common prefix."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x.eqNullSafe(y) & x.isNotNull() & (x != ""))
    first = F.array_position(same, False)
    return F.when((a == "") | (b == ""), F.lit(0)).otherwise(F.when(first > 0, first - 1).otherwise(F.least(F.length(a), F.length(b)))).cast("int")


def difference(a: Column, b: Column) -> Column:
    """struct(left, right): what remains between the common prefix and the common suffix."""
    cut = lambda s, n: F.substring(s, n + 1, F.length(s))

    def tails(n):
        x, y = cut(a, n), cut(b, n)
        return let(_shared(F.reverse(x), F.reverse(y)), lambda m: F.struct(F.substring(x, F.lit(1), F.length(x) - m).alias("left"), F.substring(y, F.lit(1), F.length(y) - m).alias("right")))

    return let(_shared(a, b), tails)


def polarity_conflict(a: Column, b: Column) -> Column:
    """polarity_flip, rejection_sanitization, critical_slot or null: a clear contradiction of two texts."""

    def of(d):
        x, y = d["left"], d["right"]
        flip = F.array(*[F.lit(f"{p}|{q}") for n, m in FLIPS for p, q in ((n, m), (m, n))])
        wiped = (x.isin(NEGATIONS) & (y == "")) | (y.isin(NEGATIONS) & (x == ""))
        amounts = x.rlike(f"^{AMOUNT}$") & y.rlike(f"^{AMOUNT}$") & (x != y)
        return F.when(F.array_contains(flip, F.concat_ws("|", x, y)), "polarity_flip").when(wiped, "rejection_sanitization").when(amounts, "critical_slot")

    return F.when((F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != "") & (a != b), let(difference(a, b), of))


def business_fields(c: Column, unicode: bool = True) -> Column:
    """struct(act, intent, polarity, negation_scope, subject, slots, dialogue_state, next_action, commitment, evidence) of a short answer, by the first act that fits."""

    def of(b):
        short_no = b.isin(SHORT_REFUSAL) | (~F.contains(b, F.lit(HAVE_OR_NOT)) & b.rlike(f"^(?:{text.phrase_pattern(REFUSAL_START)})") & (F.length(b) <= 12))
        asks = _any(b, IDENTITY) | ((F.length(b) <= 10) & F.contains(b, F.lit(WHO)))
        go_on = (b.isin(CONTINUE) | b.rlike(f"^(?:{text.phrase_pattern(GO_ON)})|(?:{text.phrase_pattern(GO_ON)})$")) & ~b.rlike("[不没]")
        greets = b.isin(GREETING) | (~b.rlike("[谁哪]") & F.contains(b, F.lit(HELLO)) & (F.length(b) <= 8) & b.rlike(f"^[{OPENERS}]"))
        act = (
            F.when(b == "", "empty").when(_any(b, VOICEMAIL), "voicemail").when(_any(b, ABSENCE), "absence").when(short_no | _any(b, REFUSAL) | b.isin(*BARE_REFUSAL), "refusal").when(_any(b, CALLBACK), "callback").when(asks, "identity_inquiry")
            .when(go_on, "continue_listening").when(b.isin(BRIEF), "brief_response").when(b.isin(BARE_AFFIRM), "affirmation_undetermined").when(greets, "greeting").when(_any(b, ACCEPT), "acceptance").otherwise("unknown")
        )
        who = F.when(b.rlike("^[他她]"), "third_party").when(F.startswith(b, F.lit("我")), "caller").otherwise("unspecified")
        slots = F.array_sort(F.array_distinct(F.concat(
            F.transform(F.regexp_extract_all(b, F.lit("[0-9零〇一二三四五六七八九十百千万亿]+(?:元|块|万|千)"), F.lit(0)), lambda x: F.concat(F.lit("amount:"), x)),
            F.transform(F.regexp_extract_all(b, F.lit("(?:今天|明天|后天|大后天|[0-9一二三四五六七八九十]+点(?:半)?)"), F.lit(0)), lambda x: F.concat(F.lit("time:"), x)),
        )))
        pick = lambda a, table, other: F.coalesce(*[F.when(a == k, v) for k, v in table.items()], other)

        def rest(a):
            return F.struct(
                a.alias("act"),
                F.when((a == "refusal") & F.contains(b, F.lit(NOT_GOING)), "decline_attendance").otherwise(pick(a, {"empty": "none", "voicemail": "mailbox_prompt", "absence": "third_party_unavailable", "refusal": "decline_offer", "callback": "defer_contact", "identity_inquiry": "ask_identity", "continue_listening": "yield_floor", "brief_response": "backchannel", "affirmation_undetermined": "possible_assent", "greeting": "greeting", "acceptance": "stated_assent"}, F.lit("unknown"))).alias("intent"),
                F.when(a == "refusal", "negative").when(a.isin("affirmation_undetermined", "acceptance"), "positive").when(a == "unknown", "unknown").otherwise("neutral").alias("polarity"),
                pick(a, {"refusal": "predicate", "unknown": "unknown"}, F.lit("none")).alias("negation_scope"),
                pick(a, {"empty": "none", "voicemail": "system", "absence": "third_party", "continue_listening": "other", "brief_response": "unspecified"}, who).alias("subject"), slots.alias("slots"), pick(a, DIALOGUE, F.lit("unknown")).alias("dialogue_state"),
                pick(a, {"empty": "none", "voicemail": "leave_message", "absence": "no_commitment", "refusal": "stop_or_decline", "callback": "call_later", "identity_inquiry": "identify_caller", "continue_listening": "yield_floor", "unknown": "unknown"}, F.lit("undetermined")).alias("next_action"),
                pick(a, {"empty": "none", "voicemail": "none", "absence": "none", "refusal": "stated_refusal", "unknown": "unknown"}, F.lit("undetermined")).alias("commitment"), F.substring(b, 1, 24).alias("evidence"),
            )

        return let(act, rest)

    return let(F.replace(text.comparison_form(c, unicode), F.lit("您"), F.lit("你")), of)


def fields_compatible(x: Column, y: Column) -> Column:
    """equivalent, conflict or insufficient; an unknown side confirms nothing."""
    known = lambda f: ~x[f].isin("unknown") & ~y[f].isin("unknown")
    vague = ["unspecified", "unknown"]
    return (
        F.when((x["act"] == "empty") & (y["act"] == "empty"), "insufficient").when((x["act"] == "empty") | (y["act"] == "empty"), "conflict").when(~known("act"), "insufficient").when(x["act"] != y["act"], "conflict")
        .when((x["polarity"] != y["polarity"]) & known("polarity"), "conflict").when(x["polarity"] != y["polarity"], "insufficient").when((x["intent"] != y["intent"]) & known("intent"), "conflict")
        .when((x["subject"] != y["subject"]) & ~x["subject"].isin(vague) & ~y["subject"].isin(vague), "conflict").when(x["slots"] != y["slots"], "conflict").when((x["next_action"] != y["next_action"]) & known("next_action"), "conflict").otherwise("equivalent")
    )


def speech_language(c: Column) -> Column:
    """zh, non_zh, mixed, unknown or empty: foreign speech in the body, abbreviations aside.

    Every rule is one pattern that is sought in the body, so a text is read a fixed number of times.
    """

    def of(body):
        mixed = F.when(body.rlike(FOREIGN), "mixed").otherwise("zh")
        return F.when(~body.rlike(r"[\p{L}\p{N}]"), "empty").when(body.rlike(text.CJK), mixed).when(body.rlike("[A-Za-z]{3}"), "non_zh").otherwise("unknown")

    tags = lambda x: F.contains(x, F.lit("<|")) | F.contains(x, F.lit("EMO_"))
    return let(text.text_or_empty(c), lambda x: let(F.when(tags(x), text.clean_control_tags(x)).otherwise(F.trim(x)), of))


def echo_form(c: Column) -> Column:
    """For whole-text comparison with prompts: letters, marks and digits only."""
    return F.regexp_replace(text.clean_control_tags(text.text_or_empty(c)), r"[\p{P}\p{S}\p{Z}\p{C}]", "")


def classify_text(c: Column, echoes: list[str] = (), digits: bool = True, strict: bool = False) -> Column:
    """struct(text, reasons, disposition): the Han characters (and digits) that may vote.

    Foreign speech and echoes of prompts empty a text; with ``strict`` any other
    letter does, and such routes are excluded instead of counting as empty.
    """

    def of(body):
        other = body.rlike(rf"[\p{{L}}&&[^{text.HAN}A-Za-z\x{{c0}}-\x{{24f}}]]")
        runs = F.regexp_extract_all(body, F.lit("[A-Za-z]+"), F.lit(0))
        han = body.rlike(f"[{text.HAN}]")
        wordy = F.size(runs) > 0 if strict else F.exists(runs, lambda t: ~(han & t.rlike("^[A-Z]{2,6}$")) & ((F.length(t) >= 3) | (~han & (F.length(t) >= 2)) | (han & ~t.rlike("^[A-Z]+$") & (F.length(t) >= 2))))
        echo = body.isin(list(echoes)) if echoes else F.lit(False)
        kept = F.regexp_replace(body, f"[^{text.HAN}{'0-9' if digits else ''}]", "")
        reasons = F.array_compact(F.array(F.when(echo, "prompt_echo"), F.when(other | wordy, "non_chinese")))
        empty = F.when((F.size(reasons) == 0) & (kept == ""), F.array(F.lit("punct_or_symbol"))).otherwise(F.array().cast("array<string>"))
        out = F.when((F.size(reasons) > 0) | (kept == ""), "").otherwise(kept)
        return F.struct(out.alias("text"), F.concat(reasons, empty).alias("reasons"), F.when(F.lit(strict) & (F.size(reasons) > 0), "excluded").otherwise("eligible").alias("disposition"))

    return let(echo_form(c), of)


def is_affirmation(c: Column) -> Column:
    return (F.trim(c) != "") & ~c.rlike("[不没别]") & (_any(c, AFFIRM) | F.trim(c).isin(FILL))


def critical_short(c: Column, most: int = 4) -> Column:
    """A short answer whose polarity counts."""
    return (text.han_chars(c) <= most) & text.polarity(c, lexicon.NEGATIVE, lexicon.POSITIVE, lexicon.FILLER).isin("positive", "negative", "mixed")
