"""The five-class rule sets before acoustic scores, and the strict semantic risks that all of them share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import hashing, similarity, text
from corvane.functions.maps import let
from corvane.operators import consensus
from corvane.operators.classify import Rule, chain, five_class_states, harmless
from corvane.operators.routes import Families

# Complete answers, negation marks, fillers that state nothing, question and hedge marks, objects.
TEMPLATES = ["不需要", "需要", "不要", "要", "不用", "用", "不可以", "可以", "不是", "是", "没有", "有", "好的", "好"]
NEGATION = ["不", "没", "無", "无", "别", "別", "未"]
UNKNOWN = ["不知道", "不清楚", "嗯", "啊", "哦", "呃", "额", "唔", "喂", "谁啊"]
QUESTIONS = ["吗", "嗎", "么", "麼", "呢", "？", "?"]
HEDGES = ["如果", "假如", "要是", "可能", "好像", "据说", "他说", "她说"]
DOUBLE = ["不是不", "不能不"]
OBJECTS = ["贷款", "保险", "服务", "信用卡", "理财", "产品", "业务", "套餐", "优惠", "活动"]
#: Longest short answer in Han characters, distances from which texts differ in substance (any, and where one is not short).
SHORT, FAR, FAR_LONG, LONG = 4, 0.30, 0.15, 4
POLAR = ("positive", "negative")


def objects(t: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(t, F.lit("(" + "|".join(OBJECTS) + ")"), F.lit(1)))


def hedged(t: Column) -> Column:
    """Questions, hedges and double negations: no statement."""
    return t.rlike(text.phrase_pattern([*QUESTIONS, *HEDGES, *DOUBLE]))


def says_nothing(t: Column) -> Column:
    s = text.to_simplified(F.trim(t))
    return (s == "") | s.isin(*UNKNOWN)


def proposition(t: Column) -> Column:
    """The tolerant key without its negation marks."""
    return F.regexp_replace(text.tolerance_key(text.to_simplified(t)), text.phrase_pattern(NEGATION), "")


def answers(t: Column) -> Column:
    """Whether a text is a complete answer, or at most six Han characters that end in one."""
    s = text.to_simplified(F.trim(t))
    ends = s.rlike(f"(?:{text.phrase_pattern(TEMPLATES)})$")
    return F.coalesce((s != "") & (s.isin(*TEMPLATES) | ((text.han_chars(s) <= 6) & ends)), F.lit(False))


def same_proposition(a: Column, b: Column) -> Column:
    """Equal, or one more character in one that holds the other, and all but one of the shorter's in place."""

    def of(p):
        x, y = p["x"], p["y"]
        shared = F.size(F.filter(F.zip_with(F.split(x, ""), F.split(y, ""), lambda u, v: u.eqNullSafe(v) & u.isNotNull() & (u != "")), lambda s: s))
        near = (F.abs(F.length(x) - F.length(y)) <= 1) & (shared >= F.greatest(F.lit(1), F.least(F.length(x), F.length(y)) - 1)) & (F.contains(x, y) | F.contains(y, x))
        return (x != "") & (y != "") & ((x == y) | near)

    return let(F.struct(proposition(a).alias("x"), proposition(b).alias("y")), of)


def _apart(a: Column, b: Column) -> Column:
    """Both name objects and none is the same."""
    x, y = objects(a), objects(b)
    return (F.size(x) > 0) & (F.size(y) > 0) & ~F.arrays_overlap(x, y)


def _views(states: Column) -> Column:
    """array of (family, text, polarity, states something) of the families with a stable text."""
    said = F.filter(states, lambda s: s["state"] == "stable_text")
    return F.transform(said, lambda s: F.struct(s["family"].alias("family"), s["text"].alias("text"), consensus.polarity_of(s["text"]).alias("pol"), (~hedged(s["text"]) & ~says_nothing(s["text"])).alias("states")))


def reversal(views: Column) -> Column:
    """Whether two families state the same proposition with opposite polarity."""

    def pair(a, b):
        opposite = a["pol"].isin(*POLAR) & b["pol"].isin(*POLAR) & (a["pol"] != b["pol"])
        return F.when(opposite & a["states"] & b["states"] & ~_apart(a["text"], b["text"]), same_proposition(a["text"], b["text"])).otherwise(False)

    return F.exists(similarity.pairs(views, pair), lambda x: x)


def strict_risk(states: Column, acoustic: dict[str, Column]) -> Column:
    """hallucinated_assertion, short_polarity_ambiguity, semantic_reversal or null, in this order.

    ``acoustic``: state, and the flags short_response_missed, target_speech_present,
    no_target_speech, gaps, unclear_polarity, unclear_generally,
    human_no_target, human_unclear (nullable). A risk without its evidence of
    sound is none.
    """
    yes = lambda n: F.coalesce(acoustic[n], F.lit(False)) if n in acoustic else F.lit(False)
    state = F.coalesce(acoustic["state"], F.lit("unknown")) if "state" in acoustic else F.lit("unknown")
    empty = F.size(F.filter(states, lambda s: s["state"] == "stable_empty"))

    def of(views):
        polar = F.filter(views, lambda v: v["pol"].isin(*POLAR))
        asserted = F.exists(polar, lambda v: v["states"])
        confirmed = yes("human_no_target") | state.isin("environment_confirmed", "crosstalk_confirmed") | (yes("no_target_speech") & (state != "unknown") & ~yes("gaps"))
        heard = yes("short_response_missed") | (yes("target_speech_present") & ~yes("human_no_target"))
        hallucinated = (empty > 0) & asserted & confirmed & ~heard
        kinds, texts = F.size(F.array_distinct(F.transform(polar, lambda v: v["pol"]))), F.array_distinct(F.transform(views, lambda v: v["text"]))
        short = F.forall(views, lambda v: text.han_chars(v["text"]) <= SHORT) & F.exists(views, lambda v: answers(v["text"]))
        conflict = (kinds >= 2) | ((kinds > 0) & (empty > 0))
        ambiguous = (F.size(views) > 0) & short & conflict & ~((F.size(texts) == 1) & (empty == 0)) & (yes("human_unclear") | yes("unclear_polarity"))
        return F.when(hallucinated, "hallucinated_assertion").when(ambiguous, "short_polarity_ambiguity").when(reversal(views), "semantic_reversal")

    return let(_views(states), of)


def risk_without_sound(states: Column) -> Column:
    """As ``strict_risk`` without acoustic evidence; then opposite polarities that share an object or are both short."""

    def close(a, b):
        opposite = a["pol"].isin(*POLAR) & b["pol"].isin(*POLAR) & (a["pol"] != b["pol"])
        shared = F.arrays_overlap(objects(a["text"]), objects(b["text"]))
        return F.when(opposite, shared | ((text.han_chars(a["text"]) <= SHORT) & (text.han_chars(b["text"]) <= SHORT))).otherwise(False)

    return let(_views(states), lambda v: F.when(reversal(v) | F.exists(similarity.pairs(v, close), lambda x: x), "semantic_reversal"))


def divergent(texts: Column) -> Column:
    """Whether two of the texts differ in substance: other objects, a distance of 0.30, or of 0.15 where one has four Han characters."""

    def pair(a, b):
        def of(d):
            long = (text.han_chars(a) >= LONG) | (text.han_chars(b) >= LONG)
            return _apart(a, b) | F.coalesce(d >= FAR, F.lit(False)) | (long & F.coalesce(d >= FAR_LONG, F.lit(True)))

        key = lambda t: text.tolerance_key(t)
        return F.when(harmless(a, b), F.lit(False)).otherwise(let(similarity.symmetric_distance(key(a), key(b)), of))

    return F.exists(similarity.pairs(texts, pair), lambda x: x)


def agreeing(texts: Column) -> Column:
    """The first text and all that are harmlessly equal to every one taken before."""
    return F.aggregate(texts, F.array().cast("array<string>"), lambda acc, t: F.when(F.forall(acc, lambda x: harmless(t, x)), F.array_append(acc, t)).otherwise(acc))


def _picked(weights: dict[str, float], seed: str) -> Column:
    """The weighted draw among the stable families, from the row's id."""
    weight = F.create_map(*[x for f, w in weights.items() for x in (F.lit(f), F.lit(w))]) if weights else F.create_map(F.lit(""), F.lit(1.0))
    items = F.transform("st", lambda s: F.struct(F.coalesce(F.try_element_at(weight, s["family"]), F.lit(1.0)).alias("w"), s["run_id"].alias("run"), s["text"].alias("text")))
    draw = hashing.unit_52(seed, F.col("id"), "five_class")

    def of(xs):
        total = F.aggregate(xs, F.lit(0.0), lambda t, x: t + x["w"])
        start = F.struct(F.lit(0.0).alias("at"), F.lit(None).cast("string").alias("run"), F.lit(None).cast("string").alias("text"))

        def step(acc, x):
            here = acc["run"].isNull() & (draw * total < acc["at"] + x["w"])
            return F.struct((acc["at"] + x["w"]).alias("at"), F.when(here, x["run"]).otherwise(acc["run"]).alias("run"), F.when(here, x["text"]).otherwise(acc["text"]).alias("text"))

        return F.aggregate(xs, start, step)

    return let(items, of)


def _finish(made: DataFrame, before: list[str], weights: dict[str, float], seed: str) -> DataFrame:
    c = F.col
    made = made.withColumn("_p", F.when(c("category") == "gold_candidate", _picked(weights, seed)))
    priority = F.when(c("category").isin("semantic_risk", "hardcase"), "P0").when(c("category").isin("environment_noise", "manual"), "P1").when(~c("category").isin("invalid_audio", "route_excluded"), "P2")
    return made.select(*before, "category", "decision", "reason", c("_p")["text"].alias("candidate_text"), c("_p")["run"].alias("selected_run_id"), priority.alias("review_priority"))


def first_states(gathered: DataFrame, families: Families) -> DataFrame:
    """Adds ``states`` of the first form: a family with fewer texts than runs is unstable, one that only failed has none.

    Texts that conflict in meaning inside a family make it unstable. ``said`` is
    the first text of an unstable family; ``excluded`` routes do not count.
    """
    out = F.coalesce(F.col("excluded_runs"), F.array().cast("array<string>"))

    def one(name: str) -> Column:
        members = F.filter("routes", lambda r: (r["family"] == name) & ~F.array_contains(out, r["run_id"]))
        want = len(families.runs[name])

        def of(x):
            said, none = x["said"], x["none"]
            texts = F.transform(said, lambda r: r["comparison_text"])
            pol = F.array_distinct(F.transform(texts, consensus.polarity_of))
            fine = F.forall(similarity.pairs(texts, harmless), lambda v: v) & ~(F.array_contains(pol, "positive") & F.array_contains(pol, "negative"))
            state = F.when((F.size(said) >= want) & fine, "stable_text").when(F.size(said) > 0, "unstable").when(none >= want, "stable_empty").otherwise("unavailable")
            first = F.get(said, F.lit(0))
            return F.struct(F.lit(name).alias("family"), state.alias("state"), F.when(state == "stable_text", first["comparison_text"]).alias("text"), first["comparison_text"].alias("said"), first["run_id"].alias("run_id"))

        return let(F.struct(consensus.spoken(members).alias("said"), F.size(F.filter(members, lambda r: r["status"] == "success_empty")).alias("none")), of)

    return gathered.withColumn("states", F.array(*[one(f) for f in families.ordered()]))


def classify_five_v1(gathered: DataFrame, families: Families, voicemail: str | None = None, weights: dict[str, float] | None = None, seed: str = "selection_five_class_v1", least: int = 3) -> DataFrame:
    """Adds (category, decision, reason, candidate_text, selected_run_id, review_priority): the first five-class form.

    ``gathered``: id, duration, broken, routes, excluded_runs (array), and the
    nullable acoustic columns acoustic_state, no_target_speech,
    target_speech_present, short_response_missed, unclear_polarity,
    human_no_target. Order: invalid, all routes excluded, some excluded and the
    rest failed, voicemail, strict risk, confirmed noise, gold candidate
    (``least`` stable families that agree, none opposing; blocked where an empty
    family or short answers conflict and the sound is unknown), substantial
    divergence, manual annotation.
    """
    c = F.col
    flag = lambda n: F.coalesce(c(n), F.lit(False))
    d = first_states(gathered, families)
    out = F.coalesce(c("excluded_runs"), F.array().cast("array<string>"))
    live = F.filter("routes", lambda r: ~F.array_contains(out, r["run_id"]))
    able = F.filter(live, lambda r: r["status"].isin("success_text", "success_empty"))
    of = lambda s: F.filter("states", lambda x: x["state"] == s)
    acoustic = {"state": c("acoustic_state"), "no_target_speech": c("no_target_speech"), "target_speech_present": c("target_speech_present"), "short_response_missed": c("short_response_missed"), "unclear_polarity": c("unclear_polarity"), "human_no_target": c("human_no_target")}
    d = d.withColumns({"live": F.size(live), "able": able, "st": of("stable_text"), "se": F.size(of("stable_empty")), "un": F.size(of("unstable"))})
    texts = F.transform("st", lambda s: s["text"])
    pols = F.transform("st", lambda s: consensus.polarity_of(s["text"]))
    short = F.array_distinct(F.filter(F.transform("st", lambda s: F.when(text.han_chars(s["text"]) <= SHORT, consensus.polarity_of(s["text"]))), lambda x: x.isin(*POLAR)))
    asks = ((c("se") > 0) & F.exists(pols, lambda x: x.isin(*POLAR))) | (F.size(short) >= 2)
    every = F.filter(F.transform("states", lambda s: F.coalesce(s["text"], s["said"])), lambda x: x.isNotNull())
    state = F.coalesce("acoustic_state", F.lit("unknown"))
    noisy = state.isin("environment_confirmed", "crosstalk_confirmed") | ((state == "background_only") & (flag("no_target_speech") | flag("human_no_target")))
    agree = (F.size("st") >= least) & F.forall(similarity.pairs(texts, harmless), lambda x: x) & (c("un") == 0)
    vm = F.exists("able", lambda r: r["raw_text"].rlike(voicemail)) if voicemail else F.lit(False)
    d = d.withColumns({"risk": strict_risk(c("states"), acoustic), "asks": asks, "agree": agree})
    made = chain(d, [
        Rule(flag("broken") | (c("duration") <= 0), "invalid_audio", "exclude", "broken_or_invalid_audio"), Rule((F.size("routes") > 0) & (c("live") == 0), "route_excluded", "exclude", "all_routes_excluded"),
        Rule(F.size("able") == 0, "manual", "manual_review", "partial_exclude_rest_failed"), Rule(vm, "voicemail", "exclude", "voicemail_any_route"),
        *[Rule(c("risk") == r, "semantic_risk", "manual_review", r) for r in ("hallucinated_assertion", "short_polarity_ambiguity", "semantic_reversal")],
        Rule(noisy, "environment_noise", "manual_review", "environment_noise_confirmed"), Rule(c("agree") & c("asks") & (state == "unknown"), "manual", "manual_review", "gold_blocked_missing_acoustic"),
        Rule(c("agree"), "gold_candidate", "audit_pending", "gold_candidate"), Rule((F.size(every) >= 2) & divergent(every), "hardcase", "manual_review", "hardcase_substantive_divergence"),
        Rule(F.lit(True), "manual", "manual_review", "manual_annotation_insufficient_evidence"),
    ])
    return _finish(made.withColumnRenamed("type", "category"), gathered.columns, weights or {}, seed)


def classify_five_v2(gathered: DataFrame, families: Families, voicemail: str | None = None, weights: dict[str, float] | None = None, seed: str = "selection_five_class_v2", least: int = 2) -> DataFrame:
    """Adds the same columns by the second form: exclusive family states, noise from energy alone.

    ``gathered``: id, duration, broken, routes, energy (state). Order: invalid,
    voicemail, risk without sound, noise (too short; all families empty and
    audible or inaudible; two empty and one text that is no critical short
    answer), gold candidate (``least`` stable families that agree, none opposing,
    none unstable), hardcase by cause.
    """
    c = F.col
    d = five_class_states(gathered, families)
    of = lambda s: F.filter("states", lambda x: x["state"] == s)
    d = d.withColumns({"st": of("stable_text"), "se": F.size(of("stable_empty")), "un": F.size(of("unstable")), "na": F.size(of("unavailable"))})
    texts = F.transform("st", lambda s: s["text"])
    n, e, nt = len(families.ordered()), c("energy"), F.size("st")
    d = d.withColumns({"risk": risk_without_sound(c("states")), "held": agreeing(texts), "any_agree": F.exists(similarity.pairs(texts, harmless), lambda x: x), "differ": divergent(texts)})
    clean = (c("un") == 0) & (c("na") == 0)
    auto = ~(c("any_agree")) & e.isin("audible", "inaudible")
    only = F.get("st", F.lit(0))["text"]
    critical = (text.han_chars(only) <= SHORT) & consensus.polarity_of(only).isin("positive", "negative", "mixed")
    empty, shape = (c("se") == n) & clean, (c("se") >= 2) & (nt == 1) & clean
    gold = (F.size("held") >= least) & (F.size("held") == nt) & (c("un") == 0)
    vm = F.exists("routes", lambda r: r["raw_text"].rlike(voicemail)) if voicemail else F.lit(False)
    made = chain(d, [
        Rule(F.coalesce(c("broken"), F.lit(False)) | (c("duration") <= 0), "invalid_audio", "exclude", "broken_or_invalid_audio"), Rule(vm, "voicemail", "exclude", "voicemail_any_route"),
        Rule(c("risk").isNotNull(), "semantic_risk", "manual_review", "semantic_reversal"), Rule(e == "audio_too_short", "environment_noise", "auto_empty", "environment_noise_audio_too_short"),
        Rule(auto & empty & (e == "audible"), "environment_noise", "auto_empty", "environment_noise_background"), Rule(auto & empty & (e == "inaudible"), "environment_noise", "auto_empty", "environment_noise_silence"),
        Rule(auto & shape & (e == "audible") & ~critical, "environment_noise", "auto_empty", "environment_noise_human_noise"), Rule(gold, "gold_candidate", "audit_pending", "gold_candidate"),
        Rule(e == "borderline", "hardcase", "manual_review", "energy_borderline"), Rule(e == "failed", "hardcase", "manual_review", "energy_failed"), Rule(c("un") > 0, "hardcase", "manual_review", "family_unstable"),
        Rule(shape & critical, "hardcase", "manual_review", "critical_short_response_unsupported"), Rule((c("se") >= 2) & (nt == 1), "hardcase", "manual_review", "single_text_family_not_auto_noise"),
        Rule(c("differ"), "hardcase", "manual_review", "substantive_divergence_non_strict_risk"), Rule((c("na") > 0) | (nt + c("se") < n), "hardcase", "manual_review", "insufficient_family_evidence"), Rule(F.lit(True), "hardcase", "manual_review", "unresolved_rules"),
    ])
    return _finish(made.withColumnRenamed("type", "category"), gathered.columns, weights or {}, seed)
