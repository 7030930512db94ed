"""Acoustic evidence from stored measures, field names for older consumers, verifiers, and invariants of a sorted batch."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.maps import get, let


def flag(c: Column) -> Column:
    """true, false or null of a stored text."""
    v = F.lower(F.trim(c))
    return F.when(v.isin("true", "1", "yes"), True).when(v.isin("false", "0", "no"), False)


def acoustic_evidence(quality: str = "quality", labels: str = "labels") -> Column:
    """struct(state, no_target_speech, overlap, human_crosstalk, background_only, vad_speech_present, gaps) of two text maps.

    A measure counts with its ``_trusted`` mark only; the quality map comes
    before the labels. States in order: environment_confirmed (trusted absence
    of target speech), crosstalk_confirmed (trusted overlap, or people),
    background_only, unknown. ``gaps`` names what is missing or not trusted.
    """
    q, both = (lambda n: get(quality, n)), (lambda n: F.coalesce(flag(get(quality, n)), flag(get(labels, n))))
    is_ = lambda c: F.coalesce(c, F.lit(False))
    any_ = lambda n: is_(flag(q(n))) | is_(flag(get(labels, n)))
    absent, sure = is_(both("no_target_speech")), is_(both("no_target_speech_trusted"))
    over, over_sure, human = is_(both("overlap_detected")), is_(both("overlap_detected_trusted")), is_(both("human_crosstalk_confirmed"))
    background = F.coalesce(F.nullif(q("background_label"), F.lit("")), get(labels, "background_label"), F.lit(""))
    diagnosed = F.coalesce(F.nullif(q("noise_diagnosis_status"), F.lit("")), q("dnsmos_status"), F.lit(""))

    def of(x):
        state = F.when(x["gone"], "environment_confirmed").when(x["over"] | x["human"], "crosstalk_confirmed").when(x["back"], "background_only").otherwise("unknown")
        return F.struct(
            state.alias("state"), F.when(x["gone"], True).alias("no_target_speech"), x["over"].alias("overlap"), x["human"].alias("human_crosstalk"), x["back"].alias("background_only"),
            F.when(x["vad"], both("vad_speech_present")).alias("vad_speech_present"), x["gaps"].alias("gaps"),
        )

    gaps = F.array_compact(F.array(
        F.when(absent & ~sure, "no_target_speech_untrusted").when(~absent, "no_target_speech_missing"), F.when(over & ~over_sure, "overlap_untrusted").when(~over, "overlap_detector_missing"),
        F.when(is_(flag(q("crosstalk_suspected"))) & ~(over & over_sure) & ~human, "crosstalk_suspected_not_sufficient"), F.when(~any_("vad_calibrated"), "vad_uncalibrated"),
        F.when(diagnosed == "not_required", "noise_diagnosis_not_required").when(~is_(flag(q("calibrated"))), "dnsmos_uncalibrated"),
    ))
    back = is_(both("background_only")) | background.isin("music", "noise", "background")
    return let(F.struct((absent & sure).alias("gone"), (over & over_sure).alias("over"), human.alias("human"), back.alias("back"), any_("vad_calibrated").alias("vad"), gaps.alias("gaps")), of)


# What a class and status are called by older consumers:
# (class, status) -> type, decision, priority, queue, tier, source, annotation state.
TOLERANT_NAMES = {
    ("semantic_risk", "manual_review"): ("semantic_risk", "manual_review", "P0", "manual_review", "none", "none", "manual_review"),
    ("hardcase", "manual_review"): ("hardcase", "manual_review", "P0", "manual_review", "none", "none", "manual_review"),
    ("noise", "candidate"): ("noise", "exclude", None, "noise_archive", "none", "acoustic_evidence", "noise_archive"),
    ("voicemail", "candidate"): ("voicemail", "audit_pending", "P2", "voicemail_spot_audit", "model_candidate", "model_consensus", "candidate"),
    ("gold", "candidate"): ("gold", "audit_pending", "P2", "spot_audit", "model_candidate", "model_consensus", "candidate"),
}
BUSINESS_NAMES = {
    ("semantic_risk", "manual_review"): ("semantic_risk", "manual_review", "P0", "manual_review", "none", "none", "manual_review"),
    ("hardcase", "manual_review"): ("hardcase", "manual_review", "P0", "manual_review", "none", "none", "manual_review"),
    ("non_speech", "auto_classified"): ("non_speech", "audit_pending", "P2", "non_speech_spot_audit", "no_transcript", "speech_presence", "auto_classified"),
    ("voicemail", "auto_classified"): ("voicemail", "audit_pending", "P2", "voicemail_spot_audit", "semantic_only", "model_consensus", "auto_classified"),
    ("business_consistent", "auto_classified"): ("business_consistent", "audit_pending", "P2", "spot_audit", "semantic_only", "model_consensus", "auto_classified"),
}
#: Grades that an automatic row never carries on.
HUMAN_GRADES = ["human_verbatim", "trusted_external_verbatim", "gold"]


def older_names(category: Column, status: Column, reason: Column, names: dict = TOLERANT_NAMES, grade: Column | None = None) -> Column:
    """struct(type, decision, review_priority, review_queue, label_tier, label_source, annotation_state).

    Excluded and broken rows first, then the table; a retry is a quarantine if
    its reason says so; anything else is held. ``grade`` replaces the tier
    ``semantic_only`` unless it is empty or a human one.
    """
    fields = ("type", "decision", "review_priority", "review_queue", "label_tier", "label_source", "annotation_state")
    made = lambda v, tier=None: F.struct(*[(tier if n == "label_tier" and tier is not None else F.lit(x).cast("string")).alias(n) for n, x in zip(fields, v)])
    why = F.coalesce(reason, F.lit(""))
    out = F.when((status == "excluded") | (why == "broken_or_invalid_audio"), made(("invalid_audio", "exclude", None, "exclude", "none", "none", "excluded")))
    own = F.when(F.coalesce(grade, F.lit("none")).isin("", "none", *HUMAN_GRADES), F.lit("semantic_only")).otherwise(grade) if grade is not None else None
    for (c, s), v in names.items():
        out = out.when((category == c) & (status == s), made(v, own if v[4] == "semantic_only" else None))
    quarantined = F.contains(why, F.lit("quarantine")) | F.contains(why, F.lit("speech_rate"))
    for cond, kind in ((quarantined, "route_quarantine"), (~quarantined, "inference_incomplete")):
        out = out.when((status == "retry") & cond, made((kind, "retry", None, "retry", "none", "none", "retry")))
    return out.otherwise(made(("hold_unclassified", "hold", None, "hold", "none", "none", "hold")))


def verify(df: DataFrame, call: Callable[[list[tuple[str, str]]], list[str]], first: str, second: str, name: str = "verdict", allowed: tuple[str, ...] = ("equivalent", "conflict", "unclear"), batch: int = 64) -> DataFrame:
    """Adds ``name``: what a caller's verifier says of two texts, in Arrow batches.

    A batch that fails is tried pair by pair; a pair that fails, and an answer
    that is not allowed, is ``unclear``. Equal texts are ``equivalent`` and are
    not sent; a null or empty text makes a pair ``unclear``.
    """
    @F.pandas_udf("string")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        out = ["unclear"] * len(a)
        todo = []
        for i, (x, y) in enumerate(zip(a, b)):
            if x and y:
                if x == y:
                    out[i] = "equivalent"
                else:
                    todo.append((i, (x, y)))
        for at in range(0, len(todo), batch):
            part = todo[at : at + batch]
            try:
                got = call([p for _, p in part])
                if len(got) != len(part):
                    raise ValueError("as many answers as pairs")
            except Exception:
                got = []
                for _, p in part:
                    try:
                        got.append(call([p])[0])
                    except Exception:
                        got.append("unclear")
            for (i, _), g in zip(part, got):
                out[i] = g if g in allowed else "unclear"
        return pd.Series(out)

    return df.withColumn(name, run(F.col(first), F.col(second)))


def release_models(df: DataFrame, *caches: dict) -> DataFrame:
    """The rows unchanged; the caches of loaded models that callers hold are emptied, on the driver and in the workers."""
    for c in caches:
        c.clear()

    def run(batches):
        import gc

        gc.collect()
        yield from batches

    return df.mapInArrow(run, df.schema)


def batch_counts(df: DataFrame, fields: list[str], tags: list[str] = ()) -> DataFrame:
    """Rows (field, value, n): counts by each field (null: ``None``) and by each member of tag arrays, from one pass."""
    cells = [F.array(F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f).cast("string"), F.lit("None")).alias("value"))) for f in fields]
    named = lambda t: lambda x: F.struct(F.lit(t).alias("field"), x.alias("value"))
    cells += [F.transform(F.coalesce(F.col(t), F.array().cast("array<string>")), named(t)) for t in tags]
    return df.select(F.explode(F.concat(*cells)).alias("c")).select("c.*").groupBy("field", "value").agg(F.count("*").alias("n"))


def package_checks(full: DataFrame, parts: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """One row (parts_overlap, parts_cover): ids in more than one part, and whether the parts together are the whole."""
    out = None
    for p in parts.values():
        ids = p.select(F.col(key).alias("k")).distinct()
        out = ids if out is None else out.union(ids)
    counts = out.groupBy("k").agg(F.count("*").alias("n"))
    j = counts.join(full.select(F.col(key).alias("f")).distinct(), F.col("k") == F.col("f"), "full")
    return j.agg(F.count_if(F.col("n") > 1).alias("parts_overlap"), (F.count_if(F.col("k").isNull() | F.col("f").isNull()) == 0).alias("parts_cover"))
