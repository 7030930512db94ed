"""Text normal forms, language and polarity as column expressions.

Everything is built in, save Unicode NFKC, which has no built-in: it is an
Arrow UDF that callers leave out for text known to be ASCII (``nfkc=False``).
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from corvane.functions.maps import let

CONTROL_TAG = r"<\|.*?\|>"
LOOSE_TAG = r"\b(?:EMO_[A-Z]+)\b"
BRACKETS = r"【[^】]*】"
SPACES = r"[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{1c}-\x{1f}]+"

# Punctuation removed before comparisons, and for tolerant keys.
COMPARE_PUNCT = "，。！？、；：\"\"''（）【】《》…—·,.!?;:'\"()[]{}"
TOLERANT_PUNCT = "，。！？、；：\"\"''（）【】《》…—·,.!?;:'\"()[]{}—－-…"

# Traditional forms with one simplified form, in order.
TRADITIONAL = "現麼嗎為這個後對說話請問時間電無關機國學開門長聲語車東來過還會從經聽見點線歲號裡鐘戶幫應該頭務聯繫撥暫員與於臺業歡迎進選擇確認實際價錢萬億親愛謝"
SIMPLIFIED = "现么吗为这个后对说话请问时间电无关机国学开门长声语车东来过还会从经听见点线岁号里钟户帮应该头务联系拨暂员与于台业欢迎进选择确认实际价钱万亿亲爱谢"

# Markers of double negation.
AMBIGUOUS = ["不是不", "不是不要", "不是不需要", "不能不"]
# Sentence-end particles that do not change an answer.
EDGE_PARTICLES = ["啊", "呀", "呢"]
# Code-point ranges of Han ideographs.
HAN = r"\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}\x{20000}-\x{2a6df}\x{2a700}-\x{2b73f}\x{2b740}-\x{2b81f}\x{2b820}-\x{2ceaf}\x{2ceb0}-\x{2ebef}\x{30000}-\x{3134f}"
CJK, LATIN = r"[\x{4e00}-\x{9fff}]", "[A-Za-z]"


def nfkc(c: Column) -> Column:
    """Unicode NFKC, Arrow-batched."""
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.str.normalize("NFKC")

    return run(c)


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def clean_control_tags(c: Column) -> Column:
    """Control tags removed, ends trimmed; null stays null."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, CONTROL_TAG, ""), LOOSE_TAG, ""))


def normalize_text(c: Column, unicode: bool = True, brackets: bool = False, lower: bool = True, punctuation: bool = True, whitespace: bool = True, fillers: Iterable[str] = ()) -> Column:
    """Versioned profile: tags, NFKC, brackets, lower case, category P, white space, fillers, in this order. Null: empty."""
    out = F.regexp_replace(text_or_empty(c), CONTROL_TAG, "")
    if unicode:
        out = nfkc(out)
    if brackets:
        out = F.regexp_replace(out, BRACKETS, "")
    if lower:
        out = F.lower(out)
    if punctuation:
        out = F.regexp_replace(out, r"\p{P}", "")
    if whitespace:
        out = F.regexp_replace(out, SPACES, "")
    for word in fillers:
        out = F.replace(out, F.lit(word), F.lit(""))
    return out


def comparison_text(c: Column, punct: str = COMPARE_PUNCT, unicode: bool = True) -> Column:
    """For comparing only: tags, NFKC, a fixed punctuation set and white space removed; case and wording stay."""
    out = clean_control_tags(text_or_empty(c))
    out = nfkc(out) if unicode else out
    return F.regexp_replace(F.translate(out, punct, ""), SPACES, "")


def to_simplified(c: Column) -> Column:
    return F.translate(c, TRADITIONAL, SIMPLIFIED)


def comparison_form(c: Column, unicode: bool = True) -> Column:
    return to_simplified(comparison_text(c, TOLERANT_PUNCT, unicode))


def tolerance_key(form: Column, homophones: Iterable[tuple[str, str]] = ()) -> Column:
    """Polite pronoun, homophones, and one trailing particle that is not the whole text."""
    out = F.replace(form, F.lit("您"), F.lit("你"))
    for a, b in homophones:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.regexp_replace(out, f"(?s)^(.+)(?:{'|'.join(EDGE_PARTICLES)})$", "$1")


def count_of(c: Column, cls: str) -> Column:
    """How many characters of a class stand in a text; runs of others are taken out at once."""
    return F.length(F.regexp_replace(c, f"[^{cls[1:-1]}]+", ""))


def han_chars(c: Column) -> Column:
    return count_of(text_or_empty(c), f"[{HAN}]")


def detect_language(c: Column) -> Column:
    """zh, en, mixed, empty or unknown, by the shares of CJK and Latin letters."""
    def named(x):
        cjk, latin = x["cjk"], x["latin"]
        both = cjk + latin
        return (
            F.when(x["blank"], "empty")
            .when(both == 0, "unknown")
            .when((cjk / both >= 0.2) & (latin / both >= 0.2), "mixed")
            .when(cjk / both >= 0.8, "zh")
            .when(latin / both >= 0.8, "en")
            .when((cjk > 0) & (latin == 0), "zh")
            .when((latin > 0) & (cjk == 0), "en")
            .otherwise("unknown")
        )

    cleaned = F.trim(clean_control_tags(text_or_empty(c)))
    return let(cleaned, lambda v: let(F.struct(count_of(v, CJK).alias("cjk"), count_of(v, LATIN).alias("latin"), (F.regexp_replace(v, SPACES, "") == "").alias("blank")), named))


def lexical_content(c: Column, unicode: bool = True) -> Column:
    """Letters and digits only."""
    v = clean_control_tags(text_or_empty(c))
    return F.regexp_replace(nfkc(v) if unicode else v, r"[^\p{L}\p{N}]", "")


def content_language(c: Column, unicode: bool = True) -> Column:
    lex = lexical_content(c, unicode)
    return F.when(lex == "", "empty").otherwise(detect_language(lex))


def detect_script(c: Column) -> Column:
    return F.when(F.translate(c, TRADITIONAL, "") != c, "zh-Hant").when(c.rlike(CJK), "zh-Hans").otherwise("")


def phrase_pattern(phrases: Iterable[str]) -> str:
    """Alternation of escaped phrases, the longest first, so that the leftmost choice is the longest."""
    items = sorted({p.strip() for p in phrases if p.strip()}, key=lambda p: (-len(p), p))
    return "|".join(re.sub(r"([\\.\[\]{}()*+?^$|])", r"\\\1", p) for p in items)


def semantic_class(c: Column, negative: Iterable[str], positive: Iterable[str]) -> Column:
    """negative wins over positive; else none."""
    v = F.trim(text_or_empty(c))
    return F.when(v == "", "none").when(v.rlike(phrase_pattern(negative)), "negative").when(v.rlike(phrase_pattern(positive)), "positive").otherwise("none")


def polarity(c: Column, negative: Iterable[str], positive: Iterable[str], filler: Iterable[str]) -> Column:
    """Polarity with scope: positives are sought outside negative phrases; both: mixed."""
    v = F.trim(text_or_empty(c))
    neg = v.rlike(phrase_pattern(negative))
    pos = F.regexp_replace(v, phrase_pattern(negative), "").rlike(phrase_pattern(positive))
    return (
        F.when(v == "", "unknown")
        .when(v.rlike(phrase_pattern(AMBIGUOUS)), "mixed")
        .when(neg & pos, "mixed")
        .when(neg, "negative")
        .when(pos, "positive")
        .when(is_filler(v, filler), "neutral")
        .otherwise("unknown")
    )


def is_filler(v: Column, filler: Iterable[str]) -> Column:
    return v.rlike(f"^(?:{phrase_pattern(filler)})$")


def number_set(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(r"\d+(?:\.\d+)?"), F.lit(0))))


def token_presence(c: Column, tokens: Iterable[str]) -> Column:
    """Sorted array of the tokens present; a token found is masked before shorter ones are sought."""
    items = sorted({t.strip() for t in tokens if t.strip()}, key=lambda t: (-len(t), t))
    start = F.struct(text_or_empty(c).alias("rest"), F.array().cast("array<string>").alias("hits"))

    def step(acc, t):
        hit = F.contains(acc["rest"], t)
        return F.struct(F.replace(acc["rest"], t, F.repeat(F.lit("\0"), F.length(t))).alias("rest"), F.when(hit, F.array_append(acc["hits"], t)).otherwise(acc["hits"]).alias("hits"))

    return F.aggregate(F.array(*[F.lit(t) for t in items]), start, step, lambda a: F.array_sort(a["hits"]))


def resolve_family(model: Column, families: dict[str, list[str]]) -> Column:
    """Exact alias, else the longest alias that is a prefix, else the name itself; blank: unknown."""
    key = F.lower(F.trim(text_or_empty(model)))
    alias = {f.lower(): f for f in families} | {a.lower(): f for f, names in families.items() for a in names}
    out = F.when(key == "", "unknown")
    for a, f in alias.items():
        out = out.when(key == a, f)
    for a, f in sorted(alias.items(), key=lambda x: -len(x[0])):
        out = out.when(F.startswith(key, F.lit(a)), f)
    return out.otherwise(key)


def tag_list(c: Column) -> Column:
    """A tag cell as a sorted array: split at commas, else at bars; trimmed, without blanks."""
    v = F.trim(text_or_empty(c))
    parts = F.when(F.contains(v, F.lit(",")), F.split(v, ",")).when(F.contains(v, F.lit("|")), F.split(v, r"\|")).otherwise(F.array(v))
    return F.array_sort(F.array_distinct(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")))


def split_tags(c: Column) -> Column:
    """Tags of a tagged transcript: struct(tags array, text)."""
    return F.struct(F.regexp_extract_all(text_or_empty(c), F.lit(r"<\|(.*?)\|>"), F.lit(1)).alias("tags"), F.trim(F.regexp_replace(text_or_empty(c), CONTROL_TAG, "")).alias("text"))


def hotwords(vocabulary: str) -> list[str]:
    """A vocabulary cell split at slashes, commas and bars."""
    return [w.strip() for w in re.split(r"[/，,|]", vocabulary or "") if w.strip()]


def blank_exact(c: Column, words: Iterable[str]) -> Column:
    """The text, or empty if all of it is one of the words."""
    return F.when(F.trim(c).isin(list(words)), "").otherwise(c)


def audio_stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/\\]*)$", 1), r"\.[^.]*$", "")


def export_id(c: Column) -> Column:
    """An id without its 16-hex prefix."""
    return F.regexp_replace(c, r"^[0-9a-f]{16}_", "")
