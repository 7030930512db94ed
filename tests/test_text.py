import random

import pytest
from pyspark.sql import functions as F

from corvane.functions import similarity as S
from corvane.functions import text as T
from corvane.operators import consensus, lexicon


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").select("i", f(F.col("v")).alias("o")).collect()
    return [r["o"] for r in sorted(rows)]


def test_normal_forms(spark):
    assert column(spark, ["<|zh|>ＡＢ，c 【x】", None, ""], T.normalize_text) == ["abcx", "", ""]
    assert column(spark, ["a【note】b"], lambda c: T.normalize_text(c, brackets=True)) == ["ab"]
    assert column(spark, ["<|en|> Don't  stop! "], T.comparison_text) == ["Dontstop"]
    assert column(spark, ["您要嗎？"], lambda c: T.tolerance_key(T.comparison_form(c))) == ["你要吗"]
    assert column(spark, ["好啊", "啊", "好吗"], lambda c: T.tolerance_key(c)) == ["好", "啊", "好吗"]


def test_language_and_script(spark):
    got = column(spark, ["", " ", "...", "不需要", "hello", "不需要hello", "<|zh|>"], T.detect_language)
    assert got == ["empty", "empty", "unknown", "zh", "en", "mixed", "empty"]
    assert column(spark, ["現在", "现在", "x"], T.detect_script) == ["zh-Hant", "zh-Hans", ""]
    assert column(spark, ["."], T.content_language) == ["empty"]


def test_polarity(spark):
    got = column(spark, ["不需要", "需要", "不是不要", "嗯嗯", "不用但是可以", "", "天气"], consensus.polarity_of)
    assert got == ["negative", "positive", "mixed", "neutral", "mixed", "unknown", "unknown"]
    assert column(spark, ["不需要", "需要"], lambda c: T.semantic_class(c, lexicon.V1_NEGATIVE, lexicon.V1_POSITIVE)) == ["negative", "positive"]


def test_conflict_tags(spark):
    got = column(spark, [["不需要", "需要"], ["嗯", "好的"], ["滚", "可以"], ["要3个", "要4个"], ["好", "好"], ["不用但是可以"] * 2, ["一样"]], consensus.conflict_tags, "array<string>")
    assert "negation_flip" in got[0] and "filler_affirmation" in got[1] and "rejection_sanitization" in got[2] and "critical_token_conflict" in got[3]
    assert got[4:] == [[], ["content_complexity"], []]


def test_families_and_cells(spark):
    assert column(spark, ["QWEN", "qwen2_x", "foo", " ", None], lambda c: T.resolve_family(c, lexicon.FAMILIES)) == ["qwen", "qwen", "foo", "unknown", "unknown"]
    assert column(spark, ["b, a,,a", "x|y", "one", None], T.tag_list) == [["a", "b"], ["x", "y"], ["one"], []]
    assert column(spark, ["/a/b.c.wav", "b.wav"], T.audio_stem) == ["b.c", "b"]
    assert column(spark, ["不需要了"], lambda c: T.token_presence(c, lexicon.CRITICAL)) == [["不需要"]]
    assert T.hotwords("甲/乙，丙|丁, ") == ["甲", "乙", "丙", "丁"]


def plain_counts(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            t[i][j] = max(i, j) if not (i and j) else min(t[i - 1][j] + 1, t[i][j - 1] + 1, t[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
    i, j, s, d, n = len(a), len(b), 0, 0, 0
    while i or j:
        if i and j and a[i - 1] == b[j - 1] and t[i][j] == t[i - 1][j - 1]:
            i, j = i - 1, j - 1
        elif i and j and t[i][j] == t[i - 1][j - 1] + 1:
            i, j, s = i - 1, j - 1, s + 1
        elif j and t[i][j] == t[i][j - 1] + 1:
            j, n = j - 1, n + 1
        else:
            i, d = i - 1, d + 1
    return s, d, n


def test_edit_kinds_against_a_plain_program(spark):
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("ab不好") for _ in range(rnd.randint(0, 9)))
    rows = [(word(), word()) for _ in range(150)] + [("", ""), ("", "ab"), ("ab", ""), (None, "x")]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", S.edit_kinds(F.col("a"), F.col("b")).alias("k")).collect()
    for r in got:
        a, b = r["a"] or "", r["b"] or ""
        assert (r["k"]["substitutions"], r["k"]["deletions"], r["k"]["insertions"]) == plain_counts(a, b)
        assert r["k"]["cer"] == pytest.approx(sum(plain_counts(a, b)) / max(len(a), 1), abs=1e-6)
    ops = S.alignment("abc", "axc")
    assert [o for *_, o in ops] == ["equal", "substitution", "equal"]


def test_similarity_rules(spark):
    rows = spark.createDataFrame([("", ""), ("a", ""), ("不需要", "需要"), ("é", "e")], "a string, b string")
    got = rows.select(S.text_similarity(F.col("a"), F.col("b")).alias("s"), S.symmetric_distance(F.col("a"), F.col("b")).alias("d")).collect()
    assert [tuple(r) for r in got] == [(1.0, None), (0.0, 1.0), (0.666667, 0.333333), (0.0, 1.0)]
