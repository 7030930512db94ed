"""Rule sets over family representatives: tolerant wording, and business fields."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import similarity, stats, text
from corvane.operators import consensus, semantics
from corvane.operators.classify import Rule, chain
from corvane.operators.routes import Families


def representatives(gathered: DataFrame, families: Families) -> DataFrame:
    """Adds ``rep_{family}``: (family, state, text, raw, run, lang, key) with one state of stable_text, stable_empty, conflict, gap, foreign."""
    out = {}
    for name in families.ordered():
        members = F.filter("routes", lambda r: r["family"] == name)
        said = consensus.spoken(members)
        first, last = F.get(said, F.lit(0)), F.get(said, F.size(said) - 1)
        lang = text.detect_language(first["raw_text"])
        clash = semantics.polarity_conflict(text.to_simplified(first["comparison_text"]), text.to_simplified(last["comparison_text"])).isNotNull()
        state = (
            F.when(F.exists(members, lambda r: r["status"].isin("failed", "missing")), "gap").when(F.size(said) == 0, "stable_empty").when(F.size(said) < F.size(members), "gap")
            .when((F.size(said) >= 2) & clash, "conflict").when(lang != "zh", "foreign").otherwise("stable_text")
        )
        form = text.to_simplified(first["comparison_text"])
        out[f"rep_{name}"] = F.struct(F.lit(name).alias("family"), state.alias("state"), form.alias("text"), first["raw_text"].alias("raw"), first["run_id"].alias("run"), F.when(F.size(said) > 0, lang).alias("lang"), text.tolerance_key(form).alias("key"))
    return gathered.withColumns(out)


def relation(a: Column, b: Column) -> Column:
    """equivalent, conflict, divergent or unclear, of two representatives; null unless both vote."""
    dist = similarity.symmetric_distance(a["key"], b["key"])
    both = (a["state"] == "stable_text") & (b["state"] == "stable_text")
    return F.when(both, F.when((a["text"] == b["text"]) | (a["key"] == b["key"]), "equivalent").when(semantics.polarity_conflict(a["text"], b["text"]).isNotNull(), "conflict").when(dist >= 0.25, "divergent").otherwise("unclear"))


def business_relation(a: Column, b: Column) -> Column:
    """equivalent, conflict or unclear by wording, contradiction and fields; null unless both vote."""
    both = (a["state"] == "stable_text") & (b["state"] == "stable_text")
    fields = semantics.fields_compatible(semantics.business_fields(a["raw"], unicode=False), semantics.business_fields(b["raw"], unicode=False))
    return F.when(both, F.when((a["text"] == b["text"]) | (a["key"] == b["key"]), "equivalent").when(semantics.polarity_conflict(a["text"], b["text"]).isNotNull(), "conflict").otherwise(F.when(fields == "insufficient", "unclear").otherwise(fields)))


def _voted(gathered: DataFrame, families: Families, how) -> tuple[DataFrame, list[str]]:
    """Representatives, pair relations, the largest clique (first by family order) and counts."""
    names = families.ordered()
    d = representatives(gathered, families)
    reps = {n: F.col(f"rep_{n}") for n in names}
    d = d.withColumns({f"rel_{a}_{b}": how(reps[a], reps[b]) for a, b in combinations(names, 2)})
    rel = {(a, b): F.col(f"rel_{a}_{b}") for a, b in combinations(names, 2)}
    cliques = consensus.max_cliques(names, {p: c == "equivalent" for p, c in rel.items()})
    states = F.array(*[reps[n] for n in names])
    d = d.withColumns({"reps": states, "clique": F.coalesce(F.get(cliques, F.lit(0)), F.array().cast("array<string>")), "relations": F.array_compact(F.array(*rel.values()))})
    inside = lambda p: F.array_contains("clique", p[0]) & F.array_contains("clique", p[1])
    touch = lambda p: F.array_contains("clique", p[0]) | F.array_contains("clique", p[1])
    left = F.array_compact(F.array(*[F.when(touch(p) & ~inside(p), c) for p, c in rel.items()]))
    count = lambda s: F.size(F.filter("reps", lambda r: r["state"] == s))
    d = d.withColumns({"m": count("stable_text"), "empty_n": count("stable_empty"), "gap_n": count("gap"), "inner_n": count("conflict"), "foreign_n": count("foreign"), "left_rel": left})
    d = d.withColumn("k", F.size("clique"))
    return d.withColumn("chosen", F.get(F.filter("reps", lambda r: F.array_contains(F.col("clique"), r["family"])), F.lit(0))), names


def classify_tolerant(gathered: DataFrame, families: Families) -> DataFrame:
    """Adds (category, status, reason, candidate_text, selected_run_id).

    ``gathered`` has id, duration, broken, routes, and nullable acoustic (state),
    speech_absent (calibrated: no speech), retry_count. Order: invalid, semantic
    risk, affirmation or noise against empty, gaps, foreign speech, remaining
    families, support, presence, gold.
    """
    d, _ = _voted(gathered, families, relation)
    c = F.col
    conflict = F.array_contains("relations", "conflict") | (c("inner_n") > 0)
    affirm = (c("empty_n") > 0) & F.exists("reps", lambda r: (r["state"] == "stable_text") & semantics.is_affirmation(r["text"]))
    noisy, absent = F.coalesce(c("acoustic"), F.lit("unknown")).isin("environment_confirmed", "crosstalk_confirmed"), F.coalesce(c("speech_absent"), F.lit(False))
    divergent = F.array_contains("relations", "divergent")
    rest = c("m") > c("k")
    ok = (c("k") >= 2) & stats.ratio_rule(c("k"), c("m"))
    d = chain(d, [
        Rule(c("broken") | (c("duration") <= 0), None, "excluded", "broken_or_invalid_audio"),
        Rule(conflict | (affirm & absent), "semantic_risk", "manual_review", "semantic_conflict_requires_review"),
        Rule(affirm & noisy, "semantic_risk", "manual_review", "noise_with_affirmation_hallucination_risk"),
        Rule(affirm, None, "hold", "affirmation_without_audio_evidence"),
        Rule(noisy & (c("m") == 0), "noise", "candidate", "acoustic_noise_confirmed"),
        Rule((c("gap_n") > 0) & (F.coalesce(c("retry_count"), F.lit(0)) < 1), None, "retry", "unresolved_route_gap"),
        Rule(c("gap_n") > 0, None, "hold", "unresolved_route_gap"),
        Rule(c("foreign_n") > 0, None, "hold", "cross_language_unverified"),
        Rule(rest & (F.array_contains("left_rel", "divergent") | ((c("k") == 0) & divergent)), "hardcase", "manual_review", "substantive_family_divergence"),
        Rule(rest, None, "hold", "residual_difference_unverified"),
        Rule(~ok & divergent, "hardcase", "manual_review", "substantive_family_divergence"),
        Rule(~ok & (c("empty_n") == F.size("reps")), None, "hold", "all_empty_acoustic_evidence_missing"),
        Rule(~ok, None, "hold", "insufficient_chinese_consensus"),
        Rule(c("empty_n") > 0, None, "hold", "presence_disagreement_unconfirmed"),
        Rule(F.lit(True), "gold", "candidate", "chinese_tolerant_consensus"),
    ], ("category", "status", "reason"))
    gold = c("category") == "gold"
    return d.select(*gathered.columns, "category", "status", "reason", F.when(gold, text.clean_control_tags(c("chosen")["raw"])).alias("candidate_text"), F.when(gold, c("chosen")["run"]).alias("selected_run_id"))


def classify_business(gathered: DataFrame, families: Families) -> DataFrame:
    """Adds (category, status, reason, coverage, label_grade, candidate_text).

    ``gathered`` has id, duration, broken, routes, and nullable presence
    (speech_present, confirmed_absent), retry_open. Every row falls in one of
    the coverage classes A (automatic), H (human), U (unresolved).
    """
    d, names = _voted(gathered, families, business_relation)
    c = F.col
    d = d.withColumn("acts", F.transform(F.filter("reps", lambda r: r["state"] == "stable_text"), lambda r: semantics.business_fields(r["raw"], unicode=False)["act"]))
    absent, present = F.coalesce(c("presence") == "confirmed_absent", F.lit(False)), F.coalesce(c("presence") == "speech_present", F.lit(False))
    mailbox = F.size(F.filter("acts", lambda a: a == "voicemail")) >= 2
    empty, mixed = c("empty_n") == len(names), (c("empty_n") > 0) & (c("m") > 0)
    ok = (c("k") >= 2) & stats.ratio_rule(c("k"), c("m"))
    d = chain(d, [
        Rule(c("broken") | (c("duration") <= 0), None, "excluded", "broken_or_invalid_audio"),
        Rule(F.array_contains("relations", "conflict") | (c("inner_n") > 0), "semantic_risk", "manual_review", "business_conflict_requires_review"),
        Rule(mailbox, "voicemail", "auto_classified", "voicemail_scene_consensus"),
        Rule(empty & absent, "non_speech", "auto_classified", "speech_presence_confirmed_absent"),
        Rule(empty & present, "hardcase", "manual_review", "empty_text_but_speech_present"),
        Rule(empty, None, "hold", "empty_output_presence_unconfirmed"),
        Rule(mixed & absent, "semantic_risk", "manual_review", "text_on_confirmed_absent_audio"),
        Rule(mixed & ~present, None, "hold", "empty_and_text_presence_unconfirmed"),
        Rule((c("k") > 0) & (c("m") > c("k")), None, "hold", "residual_business_objection"),
        Rule(~ok & (c("gap_n") > 0) & F.coalesce(c("retry_open"), F.lit(False)), None, "retry", "route_gap_retry_open"),
        Rule(~ok & (c("gap_n") > 0), "hardcase", "manual_review", "independent_evidence_insufficient"),
        Rule(~ok & (c("foreign_n") > 0), None, "hold", "language_unresolved"),
        Rule(~ok, None, "hold", "business_unverified"),
        Rule(F.lit(True), "business_consistent", "auto_classified", "business_field_consensus"),
    ], ("category", "status", "reason"))
    coverage = F.when(c("status") == "auto_classified", "A").when(c("status") == "manual_review", "H").otherwise("U")
    keys = F.array_distinct(F.transform(F.filter("reps", lambda r: F.array_contains(c("clique"), r["family"])), lambda r: r["key"]))
    body = F.nullif(text.clean_control_tags(c("chosen")["raw"]), F.lit(""))
    auto = c("category").isin("business_consistent", "voicemail") & body.isNotNull()
    grade = F.when(~F.coalesce(auto, F.lit(False)), "no_transcript").when((c("category") == "business_consistent") & (F.size(keys) == 1), "pseudo_verbatim_high").otherwise("semantic_only")
    return d.select(*gathered.columns, "category", "status", "reason", coverage.alias("coverage"), grade.alias("label_grade"), F.when(auto, body).alias("candidate_text"))
