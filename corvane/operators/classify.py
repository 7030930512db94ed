"""Rule sets: ordered chains, the first match wins, as one ``when`` over a row of features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import hashing, similarity, text
from corvane.operators import consensus, lexicon
from corvane.operators.routes import Families
from corvane.plans.expr import predicate


@dataclass(frozen=True)
class Rule:
    """What a matching row becomes."""

    when: Column
    type: str
    decision: str
    reason: str


def chain(df: DataFrame, rules: list[Rule], names: tuple[str, str, str] = ("type", "decision", "reason")) -> DataFrame:
    """Adds the outcome of the first rule that holds; a null condition does not hold."""
    made = [F.when(F.coalesce(r.when, F.lit(False)), F.struct(F.lit(r.type).alias(names[0]), F.lit(r.decision).alias(names[1]), F.lit(r.reason).alias(names[2]))) for r in rules]
    return df.withColumn("_o", F.coalesce(*made)).select(*df.columns, *[F.col("_o")[n].alias(n) for n in names])


# --- user expressions --------------------------------------------------------


def classify_by_expressions(df: DataFrame, rules: list[tuple[str, str]], default: str = "review_queue", label: str = "classification_bucket") -> DataFrame:
    """``rules`` (bucket, expression) in order; rows that none takes get the default bucket."""
    out = F.lit(default)
    for bucket, expr in reversed(rules):
        out = F.when(predicate(expr, df.columns), F.lit(bucket)).otherwise(out)
    return df.withColumn(label, out)


def legacy_gold(samples: DataFrame, base: str | None = None) -> DataFrame:
    """Adds ``gold_text``: the base route's text if it has one, else that of the route a hash of the id picks."""
    models = F.array_sort(F.map_keys(F.map_filter("transcripts", lambda _, t: F.trim(F.coalesce(t["text"], F.lit(""))) != "")))
    picked = F.try_element_at("transcripts", F.get(models, hashing.hash_pick(F.col("id"), F.greatest(F.size(models), F.lit(1)))))["text"]
    own = F.nullif(F.trim(F.try_element_at("transcripts", F.lit(base))["text"]), F.lit("")) if base else F.lit(None).cast("string")
    return samples.withColumn("gold_text", F.coalesce(own, picked))


# --- first rule set -------------------------------------------------------------


def views(samples: DataFrame, families: dict[str, list[str]]) -> DataFrame:
    """Adds ``views``: (model, family, text, norm, raw) for every transcript, sorted by model."""

    def one(e):
        t = text.clean_control_tags(F.coalesce(e["value"]["text"], F.lit("")))
        return F.struct(e["key"].alias("model"), text.resolve_family(e["key"], families).alias("family"), F.trim(t).alias("text"), text.normalize_text(F.trim(t), unicode=False).alias("norm"), F.coalesce(F.try_element_at(e["value"]["extra"], F.lit("raw_text")), F.lit("")).alias("raw"))

    return samples.withColumn("views", F.array_sort(F.transform(F.map_entries("transcripts"), one)))


#: Similarity of two views, from the map that ``v1_features`` adds.
_sim = similarity.looked_up("model")


def _class(t: Column) -> Column:
    return text.semantic_class(t, lexicon.V1_NEGATIVE, lexicon.V1_POSITIVE)


def _classes(items: Column) -> Column:
    """Distinct non-none classes of a list of views."""
    return F.array_distinct(F.filter(F.transform(items, lambda v: _class(v["text"])), lambda c: c != "none"))


def family_semantic(items: Column, family: str | Column) -> Column:
    c = _classes(F.filter(items, lambda v: (v["family"] == family) & (v["text"] != "")))
    return F.when(F.size(c) == 0, "none").when(F.size(c) == 1, F.get(c, F.lit(0))).otherwise("conflict")


def _texts(items: Column) -> Column:
    return F.transform(items, lambda v: v["text"])


def _families(items: Column) -> Column:
    return F.array_distinct(F.transform(items, lambda v: v["family"]))


def v1_features(samples: DataFrame, families: dict[str, list[str]] | None = None, voicemail: str | None = None, consensus_at: float = 0.90, primary: str = "qwen", secondary: str = "sensevoice") -> DataFrame:
    d = views(samples, families or lexicon.FAMILIES)
    d = similarity.with_similarities(d, "views", "model", "norm", sim=similarity.character_similarity)
    d = d.withColumn("said", F.filter("views", lambda v: v["text"] != ""))
    hit = (lambda v: v["text"].rlike(voicemail) | v["raw"].rlike(voicemail)) if voicemail else (lambda v: F.lit(False))
    d = d.withColumn("vm", F.filter("said", hit))
    # settled columns: each is used by many conditions below
    d = d.withColumns({
        "n": F.size("views"), "n_said": F.size("said"), "said_families": _families(F.col("said")), "all_families": _families(F.col("views")),
        "sem_primary": family_semantic(F.col("said"), primary), "sem_secondary": family_semantic(F.col("said"), secondary),
        "min_said": similarity.pairwise_min(F.col("said"), _sim), "classes": _classes(F.col("said")),
        "cluster": similarity.greedy_cluster(F.col("said"), "model", "family", consensus_at, _sim),
        "vm_min": similarity.pairwise_min(F.col("vm"), _sim), "vm_cluster": similarity.greedy_cluster(F.col("vm"), "model", "family", consensus_at, _sim),
        "primary_views": F.filter("views", lambda v: v["family"] == primary),
        "polar": F.transform(F.array_distinct(F.transform("said", lambda v: v["family"])), lambda f: F.struct(f.alias("family"), family_semantic(F.col("said"), f).alias("sem"))),
    })
    count = lambda c: F.size(F.filter("polar", lambda p: p["sem"] == c))
    return d.withColumns({"pos_families": count("positive"), "neg_families": count("negative")})


def classify_v1(samples: DataFrame, families: dict[str, list[str]] | None = None, voicemail: str | None = None, strict: float = 0.95, consensus_at: float = 0.90, dominant: float = 0.75, empty_ratio: float = 0.75, primary: str = "qwen", secondary: str = "sensevoice") -> DataFrame:
    """Adds (type, decision, reason, label, selected_model, support_count, min_similarity).

    ``samples`` has id, duration, broken (boolean), transcripts.
    """
    d = v1_features(samples, families, voicemail, consensus_at, primary, secondary)
    c = F.col
    opposite = c("sem_primary").isin("positive", "negative") & c("sem_secondary").isin("positive", "negative") & (c("sem_primary") != c("sem_secondary"))
    majority = ((c("pos_families") >= 2) & (c("pos_families") > c("neg_families"))) | ((c("neg_families") >= 2) & (c("neg_families") > c("pos_families")))
    vm2 = F.size(_families(c("vm"))) >= 2
    vm_cluster_ok = (F.size("vm_cluster") / F.greatest(F.size("vm"), F.lit(1)) >= dominant) & (similarity.pairwise_min(c("vm_cluster"), _sim) >= consensus_at)
    lone = ((c("n") - c("n_said")) / c("n") >= empty_ratio) & (F.size("said_families") == 1)
    cluster_ok = (F.size("cluster") / F.greatest(c("n"), F.lit(1)) >= dominant) & (F.size(_families(c("cluster"))) >= 2) & (F.size(_classes(c("cluster"))) <= 1) & (similarity.pairwise_min(c("cluster"), _sim) >= consensus_at)
    rules = [
        Rule(F.coalesce(c("broken"), F.lit(False)) | F.coalesce(c("duration") <= 0, F.lit(False)), "noise", "auto_empty", "broken_or_invalid_audio"),
        Rule((c("n") > 0) & (c("n_said") == 0), "noise", "auto_empty", "empty_asr_transcripts"),
        Rule(vm2 & (c("vm_min") >= strict), "voicemail", "auto_accept", "voicemail_strict_consensus"),
        Rule(vm2 & vm_cluster_ok, "voicemail", "auto_accept", "voicemail_dominant_cluster"),
        Rule(vm2, "voicemail", "manual_review", "voicemail_low_agreement"),
        Rule(opposite & majority, "semantic_inversion", "auto_accept", "semantic_inversion_majority"),
        Rule(opposite, "semantic_inversion", "model_review", "semantic_inversion_unresolved"),
        Rule((F.size("primary_views") > 0) & ~F.exists("primary_views", lambda v: v["text"] != "") & F.exists("said", lambda v: v["family"] != primary), "qwen_missing", "model_review", "primary_family_empty_conflict"),
        Rule(lone & (F.size("all_families") >= 3), "hallucination", "auto_empty", "hallucination_other_families_empty"),
        Rule(lone, "hallucination", "model_review", "hallucination_candidate_isolated_family"),
        Rule((c("n_said") < 2) | (F.size("said_families") < 2), "hardcase", "model_review", "insufficient_independent_families"),
        Rule((c("n_said") == c("n")) & (c("min_said") >= strict) & (F.size("classes") <= 1), "auto_gold", "auto_accept", "all_models_strict_consensus"),
        Rule(cluster_ok, "consensus_gold", "auto_accept", "dominant_cross_family_cluster"),
        Rule(F.lit(True), "hardcase", "model_review", "no_reliable_consensus"),
    ]
    d = chain(d, rules)
    side = F.when(c("pos_families") > c("neg_families"), "positive").otherwise("negative")
    side_views = F.filter("said", lambda v: F.exists("polar", lambda p: (p["family"] == v["family"]) & (p["sem"] == side)))
    support = (
        F.when(c("reason") == "voicemail_dominant_cluster", c("vm_cluster")).when(c("type") == "voicemail", c("vm")).when(c("reason") == "semantic_inversion_majority", side_views)
        .when(c("type") == "consensus_gold", c("cluster")).when(c("type") == "noise", F.slice("said", 1, 0)).when(c("type") == "qwen_missing", F.filter("said", lambda v: v["family"] != primary)).otherwise(c("said"))
    )
    d = d.withColumn("support", support)
    chosen = similarity.medoid(F.col("support"), _sim)
    accept = c("decision") == "auto_accept"
    return d.withColumns({
        "label": F.when(accept, chosen["text"]).when(c("decision") == "auto_empty", ""), "selected_model": F.when(accept, chosen["model"]),
        "support_count": F.size("support"), "support_families": F.size(_families(c("support"))), "min_similarity": similarity.pairwise_min(c("support"), _sim),
    }).select(*samples.columns, "type", "decision", "reason", "label", "selected_model", "support_count", "support_families", "min_similarity")


# --- second rule set ------------------------------------------------------------


def classify_v2(samples: DataFrame, families: dict[str, list[str]] | None = None, voicemail: str | None = None, strict: float = 0.95, consensus_at: float = 0.90, dominant: float = 0.75, empty_ratio: float = 0.75, short_seconds: float = 2.0, short_chars: int = 6, silence_ratio: float = 0.05, auto_empty: bool = False, primary: str = "qwen") -> DataFrame:
    """Adds (type, decision, reason, dataset_role). ``samples`` also has speech_ratio, vad_edge_risk, overlap_risk, has_speech (nullable)."""
    d = v1_features(samples, families, voicemail, consensus_at, primary)
    c = F.col
    reject = text.phrase_pattern(lexicon.REJECT)
    by_family = F.transform("said_families", lambda f: F.filter("said", lambda v: v["family"] == f))
    d = d.withColumn("groups", by_family)
    tokens = lambda t: text.token_presence(t, lexicon.CRITICAL)
    conflict = lambda g: (F.size(g) >= 2) & (similarity.pairwise_min(g, _sim) < consensus_at)
    d = d.withColumns({
        "speech": F.when(F.coalesce(c("vad_edge_risk"), F.lit(False)), F.lit(True)).otherwise(F.coalesce(c("has_speech"), c("speech_ratio") > silence_ratio)),
        "inner_conflict": F.exists("groups", conflict),
        "voters": F.transform(F.filter("groups", lambda g: ~conflict(g)), lambda g: similarity.medoid(g, _sim)),
        "token_conflict": F.size(F.array_distinct(F.transform("said", lambda v: tokens(v["text"])))) > 1,
        "sanitized": F.exists("said", lambda v: v["text"].rlike(reject)) & F.exists("said", lambda v: ~v["text"].rlike(reject) & (_class(v["text"]) == "positive")),
        "short": F.coalesce(c("duration") <= short_seconds, F.lit(False)) | F.exists("said", lambda v: F.length(v["text"]) <= short_chars),
        "first_texts": F.transform("groups", lambda g: F.get(g, F.lit(0))["text"]),
    })
    first_classes = F.array_distinct(F.filter(F.transform("first_texts", _class), lambda x: x != "none"))
    first_tokens = F.array_distinct(F.transform("first_texts", tokens))
    allowed = (F.size("said_families") >= 2) & ((F.size(F.array_distinct("first_texts")) == 1) | ((F.size(first_classes) <= 1) & (F.size(first_tokens) == 1) & (F.size(F.get(first_tokens, F.lit(0))) > 0)))
    lone = ((c("n") - c("n_said")) / c("n") >= empty_ratio) & (F.size("said_families") == 1)
    spoken = F.coalesce(c("speech"), F.lit(not auto_empty))
    silent = F.when(c("speech").isNotNull(), ~c("speech")).otherwise(F.lit(auto_empty))
    vm2 = F.size(_families(c("vm"))) >= 2
    vm_cluster_ok = (F.size("vm_cluster") / F.greatest(F.size("vm"), F.lit(1)) >= dominant) & (similarity.pairwise_min(c("vm_cluster"), _sim) >= consensus_at)
    pool = F.when(c("n_said") == c("n"), c("said")).when(F.size("voters") >= 2, c("voters")).otherwise(c("said"))
    high = (F.size(_families(pool)) >= 2) & (similarity.pairwise_min(pool, _sim) >= strict) & (F.size(_classes(pool)) <= 1)
    cluster_ok = (F.size("cluster") / F.greatest(c("n"), F.lit(1)) >= dominant) & (F.size(_families(c("cluster"))) >= 2) & (F.size(_classes(c("cluster"))) <= 1) & (similarity.pairwise_min(c("cluster"), _sim) >= consensus_at)
    rules = [
        Rule(F.coalesce(c("broken"), F.lit(False)) | F.coalesce(c("duration") <= 0, F.lit(False)), "invalid_audio", "exclude", "broken_or_invalid_audio"),
        Rule(c("overlap_risk"), "overlap_crosstalk", "model_review", "overlap_or_crosstalk_signal"),
        Rule((c("n") > 0) & (c("n_said") == 0) & silent, "true_silence", "auto_empty", "all_empty_weak_speech_evidence"),
        Rule((c("n") > 0) & (c("n_said") == 0), "possible_vad_miss", "model_review", "all_empty_possible_speech_or_unknown"),
        Rule(vm2 & (c("vm_min") >= strict), "voicemail", "auto_accept", "voicemail_strict_consensus"),
        Rule(vm2 & vm_cluster_ok, "voicemail", "auto_accept", "voicemail_dominant_cluster"),
        Rule(vm2, "voicemail", "manual_review", "voicemail_low_agreement"),
        Rule((c("pos_families") > 0) & (c("neg_families") > 0), "semantic_inversion", "model_review", "semantic_polarity_family_conflict"),
        Rule(c("sanitized"), "semantic_sanitization", "model_review", "reject_or_profanity_vs_positive"),
        Rule(c("token_conflict"), "critical_token_conflict", "model_review", "critical_token_presence_conflict"),
        Rule(c("short") & ~allowed, "short_utterance_risk", "model_review", "short_utterance_without_strict_agreement"),
        Rule(lone & spoken, "model_missing", "model_review", "empty_majority_single_family_with_speech_or_unknown"),
        Rule(lone & (F.size("all_families") >= 3), "hallucination", "auto_empty", "hallucination_isolated_family_weak_speech"),
        Rule(lone, "hallucination", "model_review", "hallucination_isolated_family_weak_speech"),
        Rule((F.size("primary_views") > 0) & ~F.exists("primary_views", lambda v: v["text"] != "") & F.exists("said", lambda v: v["family"] != primary), "model_missing", "model_review", "primary_family_empty_conflict"),
        Rule(c("inner_conflict") & (F.size("voters") < 2), "family_internal_conflict", "model_review", "family_internal_conflict_blocks_voting"),
        Rule((c("n_said") < 2) | (F.size("said_families") < 2), "hardcase", "model_review", "insufficient_independent_families"),
        Rule(high, "pseudo_gold_high", "auto_accept", "strict_cross_family_consensus"),
        Rule(cluster_ok, "pseudo_gold_medium", "model_review", "dominant_cross_family_cluster"),
        Rule(F.lit(True), "hardcase", "model_review", "no_reliable_consensus"),
    ]
    d = chain(d, rules)
    role = (
        F.when((c("decision") == "exclude") | c("type").isin("invalid_audio", "voicemail", "true_silence"), "exclude")
        .when(((c("type") == "pseudo_gold_high") & (c("decision") == "auto_accept")) | (c("type") == "pseudo_gold_medium"), "train_candidate")
        .otherwise("eval_candidate")
    )
    return d.withColumn("dataset_role", role).select(*samples.columns, "type", "decision", "reason", "dataset_role")


# --- third rule set -------------------------------------------------------------


def quality_state(band: Column, risk: Column, status: Column, calibrated: Column) -> Column:
    """One of failed, unsupported, uncalibrated, scored_noisy, scored_ok, not_scored; an uncalibrated score is neither noisy nor ok."""
    return (
        F.when(status == "failed", "failed").when(status == "unsupported", "unsupported").when(status.isNull(), "not_scored").when(~F.coalesce(calibrated, F.lit(False)), "uncalibrated")
        .when((band == "noisy") | F.coalesce(risk, F.lit(False)), "scored_noisy").otherwise("scored_ok")
    )


def speech_rate(samples: DataFrame, most: float = 25.0, chars: int = 80) -> DataFrame:
    """Adds ``fast``: route ids whose text of at least ``chars`` characters is faster than ``most`` a second."""
    fast = F.filter("routes", lambda r: (F.length(r["comparison_text"]) >= chars) & (F.col("duration") > 0) & (F.length(r["comparison_text"]) / F.col("duration") > most))
    return samples.withColumn("fast", F.transform(fast, lambda r: r["run_id"]))


def classify_v3(gathered: DataFrame, families: Families, voicemail: str | None = None, high: float = 0.98, medium: float = 0.95, medium_families: int = 3, quarantine: bool = False, least_families: int = 3) -> DataFrame:
    """Adds the v3 outcome to samples with gathered routes.

    A route that speaks faster than people do excludes the sample; with
    ``quarantine`` it only loses its vote, as if it had failed: a family that is
    incomplete for that alone does not hold the sample up, unless fewer than
    ``least_families`` remain, which asks for a retry of the routes.

    ``gathered`` has id, duration, broken, routes, and nullable noise_band,
    noise_risk, dnsmos_status, crosstalk, governance_hold. Adds type, decision,
    reason, review_priority, review_queue, disposition, risk_tags, polarity,
    candidate_text, support_families, min_similarity.
    """
    c, n_fam = F.col, len(families.ordered())
    d = speech_rate(gathered)
    if quarantine:
        mute = lambda r: F.when(F.array_contains("fast", r["run_id"]), r.withField("status", F.lit("failed")).withField("comparison_text", F.lit(""))).otherwise(r)
        d = d.withColumn("_routes", c("routes")).withColumn("routes", F.transform("routes", mute))
    d = d.withColumn("short", consensus.is_short(c("duration"), c("routes")))
    d = consensus.family_states(d, families, high)
    # families that lack a run for another reason than its speed
    lacking = F.filter("routes", lambda r: r["status"].isin("failed", "missing") & ~(F.lit(quarantine) & F.array_contains("fast", r["run_id"])))
    active = F.size(F.filter("families", lambda f: f["status"] != "incomplete"))
    d = d.withColumn("texts", F.transform(consensus.spoken(c("routes")), lambda r: r["comparison_text"]))
    for name, at, only in (("teach", high, families.teaching()), ("full", high, None), ("part", medium, None)):
        d = consensus.with_consensus(d, at, name, families, only)
    state = lambda *s: F.exists("families", lambda f: f["status"].isin(*s))
    empty_n = F.size(F.filter("routes", lambda r: r["status"] == "success_empty"))
    pol = F.transform("texts", consensus.polarity_of)
    clear = F.array_distinct(F.filter(pol, lambda p: p.isin("positive", "negative")))
    d = d.withColumns({
        "unstable": state("unstable_presence", "unstable_semantic", "unstable_text"), "incomplete": F.size(lacking) > 0, "active": active, "presence": (empty_n > 0) & (F.size("texts") > 0),
        "polarity": F.when(F.size(pol) == 0, "unknown").when(F.array_contains(pol, "mixed") | (F.size(clear) > 1), "mixed").when(F.size(clear) == 1, F.get(clear, F.lit(0))).when(F.array_contains(pol, "unknown"), "unknown").otherwise("neutral"),
        "noisy": F.coalesce(c("noise_band") == "noisy", F.lit(False)) | F.coalesce(c("noise_risk"), F.lit(False)),
        "quality_unknown": F.coalesce(c("noise_band"), F.lit("unknown")).isin("unknown") | F.coalesce(c("dnsmos_status"), F.lit("failed")).isin("failed", "unsupported") | c("noise_risk").isNull(),
        "same_text": F.size(F.array_distinct("texts")) <= 1,
        "affirms": F.exists("texts", lambda t: consensus.polarity_of(t) == "positive"),
        "agree": consensus.full_agreement(c("routes"), c("short"), high),
    })
    extra = F.array(
        F.when(c("presence"), "presence_conflict"), F.when(c("short"), "short_utterance_risk"), F.when(c("noisy"), "noisy_audio"), F.when(c("quality_unknown") & ~c("noisy"), "quality_unknown"),
        F.when(F.coalesce(c("crosstalk"), F.lit(False)), "crosstalk_suspected"), F.when(c("unstable"), "family_instability"), F.when((c("polarity") == "mixed") & c("same_text") & F.array_contains(pol, "mixed"), "content_complexity"),
    )
    rate = F.array_compact(F.array(F.when(F.lit(quarantine) & (F.size("fast") > 0), "implausible_speech_rate")))
    d = d.withColumn("risk_tags", F.array_sort(F.array_union(F.array_union(consensus.conflict_tags(c("texts")), F.array_compact(extra)), rate)))
    tag = lambda t: F.array_contains("risk_tags", t)
    critical = tag("critical_token_conflict") | ((c("polarity") == "mixed") & ~c("same_text"))
    semantic = F.arrays_overlap("risk_tags", F.array(*[F.lit(t) for t in consensus.SEMANTIC_TAGS]))
    target_status = F.get(F.filter("families", lambda f: f["family"] == families.target), F.lit(0))
    teachers_stable = F.forall(F.filter("families", lambda f: f["family"].isin(*families.teaching())), lambda f: f["status"] == "stable_text")
    teaching = c("teach")["families"] >= len(families.teaching())
    own = F.filter("routes", lambda r: (r["family"] == families.target) & (r["comparison_text"] != ""))
    taught = F.filter("routes", lambda q: F.array_contains(c("teach")["runs"], q["run_id"]))
    differs = (F.size(own) > 0) & ~F.exists(own, lambda r: F.exists(taught, lambda q: consensus.SIM(r, q) >= high))
    correction = teachers_stable & teaching & target_status["status"].isin("stable_text", "unstable_text", "unstable_semantic") & differs
    vm = (lambda r: r["raw_text"].rlike(voicemail) | r["comparison_text"].rlike(voicemail)) if voicemail else (lambda r: F.lit(False))
    vm_families = F.size(F.filter("families", lambda f: (f["status"] == "stable_text") & F.forall(F.filter("routes", lambda r: r["family"] == f["family"]), vm)))
    clean = (c("dnsmos_status") == "success") & c("noise_band").isin("clean", "moderate") & ~c("noise_risk") & ~F.coalesce(c("crosstalk"), F.lit(False))
    d = d.withColumns({"critical_risk": critical, "semantic_risk": semantic})
    d = chain(d, [
        Rule(c("broken") | (c("duration") <= 0), "invalid_audio", "exclude", "broken_or_invalid_audio"),
        Rule((F.size("fast") > 0) & F.lit(quarantine) & (c("active") < least_families), "route_quarantine", "retry", "implausible_routes_quarantined_insufficient_families"),
        Rule((F.size("fast") > 0) & F.lit(not quarantine), "implausible_speech_rate", "exclude", "chars_per_sec_exceeds_human_speech"),
        Rule(c("incomplete"), "inference_incomplete", "retry", "configured_runs_incomplete"),
        Rule(c("semantic_risk"), "semantic_risk", "manual_review", "semantic_risk_tags"),
        Rule(c("critical_risk"), "critical_content_risk", "manual_review", "critical_token_or_mixed_polarity"),
        Rule(tag("content_complexity"), "content_complexity", "manual_review", "identical_text_content_complexity"),
        Rule(F.size("texts") == 0, "all_empty_unverified", "manual_review", "all_configured_runs_success_empty"),
        Rule(c("presence"), "speech_presence_disagreement", "manual_review", "success_empty_and_nonempty_mixed"),
        Rule(vm_families >= 2, "voicemail_candidate", "manual_review", "voicemail_multi_stable_family"),
        Rule(correction, "qwen_correction_candidate", "manual_review", "teachers_stable_consensus_qwen_differs"),
        Rule(c("unstable"), "family_unstable", "manual_review", "family_dual_run_unstable"),
        Rule(c("noisy") | c("quality_unknown") | c("crosstalk"), "audio_quality_risk", "manual_review", "dnsmos_noisy_or_unknown_or_crosstalk"),
        Rule(c("full")["ambiguous"], "hardcase", "manual_review", "consensus_ambiguous"),
        Rule(F.forall("families", lambda f: f["status"] == "stable_text") & c("agree")["ok"] & clean & (c("full")["families"] == n_fam), "pseudo_high", "audit_pending", "configured_family_strict_consensus"),
        Rule(~c("part")["ambiguous"] & (c("part")["families"] >= medium_families), "pseudo_medium", "manual_review", "three_plus_family_consensus"),
        Rule(F.lit(True), "hardcase", "manual_review", "no_unique_reliable_consensus"),
    ])
    d = route_review(d)
    first = F.get(F.filter("families", lambda f: (f["status"] == "stable_text")), F.lit(0))["medoid"]["comparison_text"]
    chosen = F.when(c("type") == "pseudo_high", c("full")["text"]).when(c("type") == "qwen_correction_candidate", c("teach")["text"]).otherwise(F.coalesce(c("part")["text"], first))
    d = d.withColumns({
        "disposition": disposition(c("type"), c("decision"), c("risk_tags"), F.coalesce(c("governance_hold"), F.lit(False)), c("review_queue")),
        "candidate_text": F.when(c("type").isin("invalid_audio", "implausible_speech_rate"), "").otherwise(chosen),
        "support_families": F.when(c("type") == "pseudo_high", c("full")["families"]).when(c("type") == "pseudo_medium", c("part")["families"]),
        "min_similarity": F.when(c("type") == "pseudo_high", c("agree")["min_similarity"]).when(c("type") == "pseudo_medium", c("part")["min_similarity"]),
    })
    if quarantine:
        d = d.withColumn("disposition", F.when((F.size("fast") > 0) & (c("disposition") == "audio_exclude"), "route_quarantine").otherwise(c("disposition"))).withColumn("routes", c("_routes"))
    return d.select(*gathered.columns, "type", "decision", "reason", "review_priority", "review_queue", "disposition", "risk_tags", "polarity", "candidate_text", "support_families", "min_similarity")


def route_review(d: DataFrame) -> DataFrame:
    """Adds (review_priority, review_queue) for an outcome; needs type, decision, affirms."""
    t, dec = F.col("type"), F.col("decision")
    priority = (
        F.when(t.isin("semantic_risk", "critical_content_risk"), "P0").when(t == "speech_presence_disagreement", F.when(F.col("affirms"), "P0").otherwise("P1"))
        .when(t.isin("all_empty_unverified", "qwen_correction_candidate", "family_unstable", "audio_quality_risk"), "P1").when(t.isin("quality_uncalibrated", "route_quarantine", "implausible_speech_rate", "pseudo_high"), None).otherwise("P2")
    )
    queue = F.when(t == "voicemail_candidate", "voicemail_isolation").when(t == "quality_uncalibrated", "calibration_hold").when(t == "route_quarantine", "retry").when(t == "pseudo_high", "pseudo_audit").otherwise("manual_review")
    out = dec.isin("retry", "exclude", "hold")
    return d.withColumns({"review_priority": F.when(~out, priority), "review_queue": F.when(dec == "retry", "retry").when(dec == "exclude", "exclude").when(dec == "hold", "calibration_hold").otherwise(queue)})


def disposition(type_: Column, decision: Column, tags: Column, hold: Column, queue: Column) -> Column:
    """Exactly one disposition for an outcome."""
    return (
        F.when(type_ == "invalid_audio", "audio_exclude").when(type_ == "route_quarantine", "route_quarantine").when((type_ == "implausible_speech_rate") | ((decision == "exclude") & (type_ != "inference_incomplete")), "audio_exclude")
        .when((type_ == "inference_incomplete") | (decision == "retry"), F.when(F.array_contains(tags, "implausible_speech_rate"), "route_quarantine").otherwise("machine_retry"))
        .when(type_ == "quality_uncalibrated", "calibration_hold").when(type_.isin("all_empty_unverified", "speech_presence_disagreement"), "presence_confirm")
        .when((type_ == "voicemail_candidate") | (queue == "voicemail_isolation"), "voicemail_isolation")
        .when((type_ == "pseudo_high") | (decision == "audit_pending"), F.when(hold, "governance_hold").otherwise("pseudo_pending_audit"))
        .when((type_ == "pseudo_medium") & hold, "governance_hold").when(type_ == "qwen_correction_candidate", "train_assisted")
        .when((type_ == "content_complexity") | (F.array_contains(tags, "content_complexity") & ~type_.isin("semantic_risk", "critical_content_risk")), "content_complexity")
        .when(decision == "hold", "calibration_hold").when(hold & ~type_.isin("semantic_risk", "critical_content_risk"), "governance_hold").otherwise("human_blind")
    )


# --- five classes -----------------------------------------------------------------


def dnsmos_states(bak: Column, ovrl: Column, sig: Column, status: Column) -> Column:
    """struct(noise, speech): noisy/moderate/clean and strong/weak/unknown, unavailable without a successful score."""
    there = (status == "success") & bak.isNotNull() & ovrl.isNotNull()
    noise = F.when(~F.coalesce(there, F.lit(False)), "unavailable").when((bak < 3.0) | (ovrl < 2.8), "noisy").when((bak >= 3.5) & (ovrl >= 3.2), "clean").otherwise("moderate")
    speech = F.when(~F.coalesce(there, F.lit(False)) | sig.isNull(), "unavailable").when(sig >= 3.5, "strong").when(sig <= 2.8, "weak").otherwise("unknown")
    return F.struct(noise.alias("noise"), speech.alias("speech"))


def energy_state(ms: Column, rms: Column, peak: Column, share: Column, margin: float = 3.0) -> Column:
    """audio_too_short, inaudible, audible or borderline; failed where a measure is missing."""
    missing = ms.isNull() | rms.isNull() | peak.isNull() | share.isNull()
    loud = (rms >= -50 + margin) & (peak >= -40 + margin) & (share >= 0.02)
    quiet = (rms < -50 - margin) & (peak < -40 - margin)
    return F.when(missing, "failed").when(ms < 300, "audio_too_short").when(loud, "audible").when(quiet | (share == 0), "inaudible").otherwise("borderline")


def five_class_states(gathered: DataFrame, families: Families) -> DataFrame:
    """Adds ``states``: for each family (family, state, text, raw_text, run_id) with exclusive states
    stable_text, stable_empty, unstable, unavailable."""

    def one(name: str) -> Column:
        members = F.filter("routes", lambda r: r["family"] == name)
        said = consensus.spoken(members)
        texts = F.transform(said, lambda r: text.tolerance_key(text.to_simplified(r["comparison_text"])))
        state = F.when(F.size(F.filter(members, lambda r: r["status"].isin("failed", "missing"))) > 0, "unavailable").when(F.size(said) == 0, "stable_empty").when((F.size(said) == F.size(members)) & (F.size(F.array_distinct(texts)) == 1), "stable_text").otherwise("unstable")
        first = F.get(said, F.lit(0))
        ok = state == "stable_text"
        return F.struct(F.lit(name).alias("family"), state.alias("state"), F.when(ok, first["comparison_text"]).alias("text"), F.when(ok, first["raw_text"]).alias("raw_text"), F.when(ok, first["run_id"]).alias("run_id"))

    return gathered.withColumn("states", F.array(*[one(f) for f in families.ordered()]))


def harmless(a: Column, b: Column) -> Column:
    """Texts that mean the same: equal, equal once simplified, or equal tolerant keys unless only one asks a question."""
    asks = lambda t: t.rlike("[吗吧]")
    sa, sb = text.to_simplified(a), text.to_simplified(b)
    return (sa == sb) | ((text.tolerance_key(sa) == text.tolerance_key(sb)) & (asks(a) == asks(b)))


def classify_five(gathered: DataFrame, families: Families, voicemail: str | None = None, seed: str = "five_class") -> DataFrame:
    """Adds (category, reason, noise_kind, confidence, candidate_text, selected_run_id, review_priority).

    ``gathered`` has id, duration, broken, routes, energy (state), and nullable
    dnsmos_bak, dnsmos_ovrl, dnsmos_sig, dnsmos_status, crosstalk_confirmed.
    Order: invalid, voicemail, semantic risk, environment noise, gold candidate
    (two stable families with harmless differences), hardcase.
    """
    c = F.col
    d = five_class_states(gathered, families).withColumn("dns", dnsmos_states(c("dnsmos_bak"), c("dnsmos_ovrl"), c("dnsmos_sig"), c("dnsmos_status")))
    of = lambda s: F.filter("states", lambda x: x["state"] == s)
    d = d.withColumns({"st": of("stable_text"), "se": F.size(of("stable_empty")), "un": F.size(of("unstable")), "na": F.size(of("unavailable"))})
    d = d.withColumn("nt", F.size("st"))
    n = len(families.ordered())
    texts = F.transform("st", lambda s: s["text"])
    vm = (lambda r: r["raw_text"].rlike(voicemail)) if voicemail else (lambda r: F.lit(False))
    agree = similarity.pairs(texts, harmless)
    d = d.withColumns({"any_agree": F.exists(agree, lambda x: x), "all_agree": F.forall(agree, lambda x: x), "pol": F.array_distinct(F.transform(texts, consensus.polarity_of)), "all_empty": (c("se") == n)})
    human = (c("se") >= 2) & (c("nt") == 1) & (c("un") == 0) & (c("na") == 0)
    only = F.get("st", F.lit(0))["text"]
    critical_short = (text.han_chars(only) <= 4) & consensus.polarity_of(only).isin("positive", "negative", "mixed")
    noise, speech, e = c("dns")["noise"], c("dns")["speech"], c("energy")
    no_gold = ~((c("nt") >= 2) & F.coalesce(c("any_agree"), F.lit(False))) & (e != "failed")
    from corvane.operators import five_class  # which builds on this module

    risk = five_class.risk_without_sound(c("states")).isNotNull()
    gold = (c("nt") >= 2) & c("all_agree") & (c("un") == 0)
    made = chain(d, [
        Rule(c("broken") | (c("duration") <= 0), "invalid_audio", "high", "broken_or_invalid_audio"),
        Rule(F.exists("routes", vm), "voicemail", "high", "voicemail_any_route"),
        Rule(risk, "semantic_risk", "high", "semantic_reversal"),
        Rule(e == "audio_too_short", "environment_noise", "high", "environment_noise_audio_too_short"),
        Rule(no_gold & c("all_empty") & (e == "inaudible"), "environment_noise", "high", "environment_noise_silence"),
        Rule(no_gold & c("all_empty") & (e == "audible") & (noise == "clean") & (speech == "strong"), "hardcase", "low", "empty_asr_but_clean_strong_speech"),
        Rule(no_gold & c("all_empty") & (e == "audible") & (noise == "noisy"), "environment_noise", "high", "environment_noise_background"),
        Rule(no_gold & c("all_empty") & (e == "audible"), "environment_noise", "medium", "environment_noise_background"),
        Rule(no_gold & c("all_empty") & (e == "borderline") & (noise == "noisy"), "environment_noise", "medium", "environment_noise_background_borderline_dnsmos"),
        Rule(no_gold & human & ~critical_short & (e == "audible") & (noise == "noisy"), "environment_noise", "high", "environment_noise_human_noise"),
        Rule(no_gold & human & ~critical_short & (e == "audible"), "environment_noise", "medium", "environment_noise_human_noise"),
        Rule(no_gold & human & ~critical_short & (e == "borderline") & (noise == "noisy"), "environment_noise", "medium", "environment_noise_human_noise_borderline_dnsmos"),
        Rule(gold, "gold_candidate", "high", "gold_candidate"),
        Rule(e == "borderline", "hardcase", "low", "energy_borderline"),
        Rule(e == "failed", "hardcase", "low", "energy_failed"),
        Rule(c("un") > 0, "hardcase", "low", "family_unstable"),
        Rule((c("se") >= 2) & (c("nt") == 1) & critical_short, "hardcase", "low", "critical_short_response_unsupported"),
        Rule((c("se") >= 2) & (c("nt") == 1), "hardcase", "low", "single_text_family_not_auto_noise"),
        Rule(five_class.divergent(texts), "hardcase", "low", "substantive_divergence_non_strict_risk"),
        Rule((c("na") > 0) | (c("nt") + c("se") < n), "hardcase", "low", "insufficient_family_evidence"),
        Rule(F.lit(True), "hardcase", "low", "unresolved_rules"),
    ], ("category", "confidence", "reason"))
    kind = F.when(c("category") == "environment_noise", F.when(c("reason").endswith("too_short"), "audio_too_short").when(c("reason").endswith("silence"), "silence").when(c("reason").contains("background"), "background").when(F.coalesce(c("crosstalk_confirmed"), F.lit(False)), "crosstalk").otherwise("human_noise"))
    # weighted pick among the families' representatives: a draw from the id, laid over the summed weights
    draw = hashing.unit_52(seed, c("id"), "five_class")
    weighted = F.transform("st", lambda s: F.struct(F.when(s["family"] == "qwen", 2.0).otherwise(1.0).alias("w"), s.alias("s")))
    total = F.aggregate(weighted, F.lit(0.0), lambda t, x: t + x["w"])
    step = F.aggregate(weighted, F.struct(F.lit(0.0).alias("at"), F.lit(None).cast("string").alias("run"), F.lit(None).cast("string").alias("t")), lambda acc, x: F.struct((acc["at"] + x["w"]).alias("at"), F.when(acc["run"].isNull() & (draw * total < acc["at"] + x["w"]), x["s"]["run_id"]).otherwise(acc["run"]).alias("run"), F.when(acc["run"].isNull() & (draw * total < acc["at"] + x["w"]), text.clean_control_tags(x["s"]["raw_text"])).otherwise(acc["t"]).alias("t")))
    picked = F.when(c("category") == "gold_candidate", step)
    made = made.withColumn("noise_kind", kind).withColumn("_p", picked)
    return made.select(*gathered.columns, "category", "reason", "noise_kind", "confidence", c("_p")["t"].alias("candidate_text"), c("_p")["run"].alias("selected_run_id"), F.when(c("category").isin("semantic_risk", "hardcase"), "P0").when(c("category") != "invalid_audio", "P2").alias("review_priority"))


# --- external references ------------------------------------------------------------


def classify_external(df: DataFrame, hyp: str, gold: str, preassigned: str = "preassigned", voicemail: str | None = None, unicode: bool = True) -> DataFrame:
    """Adds (type, decision, reason): preassigned, voicemail, noise (both blank), hardcase (blank reference), auto_gold (equal normal forms), hardcase."""
    a, b = text.normalize_text(F.col(hyp), unicode=unicode), text.normalize_text(F.col(gold), unicode=unicode)
    given = F.nullif(F.trim(F.coalesce(F.col(preassigned), F.lit(""))), F.lit(""))
    vm = F.coalesce(F.col(hyp).rlike(voicemail) | F.col(gold).rlike(voicemail), F.lit(False)) if voicemail else F.lit(False)
    d = df.withColumns({"_a": a, "_b": b, "_g": given})
    out = chain(d, [
        Rule(F.col("_g").isNotNull(), "preassigned", "auto_accept", "preassigned_type"), Rule(vm, "voicemail", "manual_review", "voicemail_pattern"),
        Rule((F.col("_a") == "") & (F.col("_b") == ""), "noise", "auto_empty", "both_blank"), Rule(F.col("_b") == "", "hardcase", "model_review", "blank_reference"),
        Rule(F.col("_a") == F.col("_b"), "auto_gold", "auto_accept", "exact_match"), Rule(F.lit(True), "hardcase", "model_review", "texts_differ"),
    ])
    return out.withColumn("type", F.coalesce("_g", "type")).drop("_a", "_b", "_g")
