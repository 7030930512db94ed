"""Sample-level text metrics, corpus reports, business rates and gates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import similarity, stats, text
from corvane.operators import lexicon
from corvane.runtime import settle

#: Types whose reference is empty by nature; they are reported apart.
EMPTY_REFERENCE = ("true_silence", "invalid_audio", "noise", "empty_gold", "non_speech")


def edit_metrics(df: DataFrame, ref: str, hyps: dict[str, str], unicode: bool = True) -> DataFrame:
    """Long rows: each sample once for each named hypothesis column, with its edits against the reference.

    Adds model, substitutions, deletions, insertions, reference_length, cer and
    scored (both texts present as columns, the hypothesis not null).
    """
    long = df.withColumn("_h", F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(c).alias("hyp")) for n, c in hyps.items()])))
    long = long.withColumns({"model": F.col("_h")["model"], "hypothesis": F.col("_h")["hyp"]}).drop("_h")
    kinds = similarity.edit_kinds(text.normalize_text(F.col(ref), unicode=unicode), text.normalize_text(F.col("hypothesis"), unicode=unicode))
    return long.withColumn("_k", kinds).select(*long.columns, "_k.*", F.col("hypothesis").isNotNull().alias("scored"))


def corpus(rows: DataFrame, *by: str) -> DataFrame:
    """Sums of edits, corpus_cer = errors / max(length, 1) and char_acc = max(0, 1 - cer), null without reference characters."""
    s = rows.groupBy(*by).agg(F.count("*").alias("samples"), *[F.sum(c).cast("long").alias(c) for c in ("substitutions", "deletions", "insertions", "reference_length")])
    s = s.withColumn("errors", F.col("substitutions") + F.col("deletions") + F.col("insertions"))
    s = s.withColumn("corpus_cer", F.col("errors") / F.greatest("reference_length", F.lit(1)))
    return s.withColumn("char_acc", F.when(F.col("reference_length") > 0, F.greatest(F.lit(0.0), 1 - F.col("corpus_cer"))))


def summary(rows: DataFrame, model: str = "model", group: str = "type") -> DataFrame:
    """Two levels in one pass (grouping sets): each model over all rows and per group; mean and overall accuracy."""
    d = rows.withColumn("_acc", F.when(F.col("scored"), F.greatest(F.lit(0.0), 1 - F.col("cer"))))
    s = d.groupingSets([[F.col(model), F.col(group)], [F.col(model)]], F.col(model), F.col(group)).agg(
        F.grouping(F.col(group)).alias("_all"), F.count_if(F.col("scored")).alias("rows"), F.count_if(~F.col("scored")).alias("skipped"),
        F.coalesce(F.sum(F.when(F.col("scored"), F.col("substitutions") + F.col("deletions") + F.col("insertions"))), F.lit(0)).alias("edits"),
        F.coalesce(F.sum(F.when(F.col("scored"), F.col("reference_length"))), F.lit(0)).alias("reference_length"), F.avg("_acc").alias("mean_acc"),
    )
    overall = F.when(F.col("rows") == 0, None).when(F.col("reference_length") == 0, F.when(F.col("edits") > 0, 0.0).otherwise(1.0)).otherwise(F.round(F.greatest(F.lit(0.0), 1 - F.col("edits") / F.col("reference_length")), 6))
    return s.select(F.col(model).alias("model"), F.when(F.col("_all") == 1, "all").otherwise(F.col(group)).alias("grp"), "rows", "skipped", "edits", "reference_length", overall.alias("overall_acc"), F.round("mean_acc", 6).alias("mean_acc"))


def vs_base(summary_rows: DataFrame, base: str) -> DataFrame:
    """Adds the accuracy differences to the base model's row of the same group; the base's own are null."""
    from pyspark.sql import Window

    w = Window.partitionBy("grp")
    own = lambda c: F.max(F.when(F.col("model") == base, F.col(c))).over(w)
    diff = lambda c: F.when(F.col("model") != base, F.round(F.col(c) - own(c), 6))
    return summary_rows.withColumns({"overall_delta": diff("overall_acc"), "mean_delta": diff("mean_acc")})


def gold_facts(df: DataFrame) -> DataFrame:
    """Adds kind, semantic, group and role of reference labels by their fallback chains.

    Needs nullable gold_text, gold_kind, type, human_semantic, polarity. Of the
    groups (leakage_group_id, call_group_id, source_group_id, group_id) and roles
    (dataset_role, eval_role, split, reservation_role) those that are columns
    count, in this order.
    """
    blank = lambda c: F.nullif(F.trim(F.lower(F.col(c))), F.lit(""))
    kind = F.coalesce(blank("gold_kind"), F.when(F.col("type").isin(*EMPTY_REFERENCE) | (F.col("gold_text") == ""), "non_speech").otherwise("speech"))
    own = lambda *names: [F.col(c).cast("string") for c in names if c in df.columns]
    roles = [F.when(F.lower(F.trim(c)).isin("eval_core", "eval_random"), F.lower(F.trim(c))) for c in own("dataset_role", "eval_role", "split", "reservation_role")]
    group = F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in own("leakage_group_id", "call_group_id", "source_group_id", "group_id")], F.col("id").cast("string"))
    return df.withColumns({"kind": kind, "semantic": F.coalesce(blank("human_semantic"), blank("polarity"), F.lit("unknown")), "group_key": group, "role": F.coalesce(*roles, F.lit(""))})


def business_flags(df: DataFrame, noise: Iterable[str], silence: Iterable[str]) -> dict[str, tuple[Column, Column]]:
    """(hit, eligible) of each rate. Needs kind, semantic, gold_text, tags (array), status, pred_polarity, pred_text."""
    ok, pos = F.col("status").isin("success_text", "success_empty"), F.col("pred_polarity") == "positive"
    unclear = F.col("pred_polarity").isin("mixed", "unknown")
    non_speech = F.col("kind") == "non_speech"
    overlap = lambda tags: F.arrays_overlap("tags", F.array(*[F.lit(t) for t in tags]))
    far = ok & ~F.col("semantic").isin("mixed", "unknown") & (non_speech | F.col("semantic").isin("negative", "neutral"))
    return {
        "nfr": (pos, (F.col("semantic") == "negative") & ok), "far": (pos, far), "nahr": (pos, non_speech & overlap(noise) & ok), "nahr_silence": (pos, non_speech & overlap(silence) & ok),
        "faer": (pos, ok & (F.col("semantic") == "neutral") & ~non_speech & text.is_filler(F.trim(F.col("gold_text")), lexicon.FILLER)),
        "nshr": (F.trim("pred_text") != "", non_speech & ok), "positive_retention": (pos, (F.col("semantic") == "positive") & ok),
        "inference_failure_rate": (F.col("status").isin("failed", "missing"), F.lit(True)), "semantic_unk_rate": (unclear, ok), "far_unk_as_risk_upper": (pos | unclear, far),
    }


def business_rates(df: DataFrame, flags: dict[str, tuple[Column, Column]], *by: str) -> DataFrame:
    """Long rows (by.., metric, numerator, denominator, value): all rates from one aggregate; value null where the denominator is 0."""
    one = df.groupBy(*by).agg(*[x for n, (hit, ok) in flags.items() for x in (F.count_if(F.coalesce(hit & ok, F.lit(False))).alias(f"{n}__n"), F.count_if(F.coalesce(ok, F.lit(False))).alias(f"{n}__d"))])
    rows = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"{n}__n").alias("numerator"), F.col(f"{n}__d").alias("denominator")) for n in flags])
    return one.select(*by, F.explode(rows).alias("r")).select(*by, "r.*").withColumn("value", stats.rate(F.col("numerator"), F.col("denominator")))


def sliced(df: DataFrame, slices: dict[str, Column]) -> DataFrame:
    """Each row once for every slice it is in, beside ``all``."""
    names = F.array_compact(F.array(F.lit("all"), *[F.when(F.coalesce(cond, F.lit(False)), F.lit(n)) for n, cond in slices.items()]))
    return df.withColumn("slice", F.explode(names))


def completeness(df: DataFrame, examples: int = 200) -> DataFrame:
    """One row: expected, complete, incomplete and the first sorted incomplete ids."""
    bad = F.col("status").isin("failed", "missing")
    first = df.where(bad).select("id").orderBy("id").limit(examples).agg(F.array_sort(F.collect_list("id")).alias("incomplete_examples"))
    return df.agg(F.count("*").alias("expected"), F.count_if(~bad).alias("complete"), F.count_if(bad).alias("incomplete")).join(F.broadcast(first), F.lit(True))


def bootstrap_delta(df: DataFrame, group: str, base: tuple[str, str], cand: tuple[str, str], iterations: int = 1000, seed: int = 42, exact_groups: int | None = None) -> DataFrame:
    """Rows (iterations, low, high): interval of candidate minus baseline ratio of sums, resampling groups.

    The draws come from one seeded generator over the groups in order, at every
    size; the sums (32 bytes a group) are read in order by one task. A caller
    who has too many groups for that names a bound, ``exact_groups``: beyond it
    the interval is that of ``poisson_delta``.
    """
    spark = df.sparkSession
    names = ["na", "da", "nb", "db"]
    sums = df.groupBy(F.col(group).alias("g")).agg(*[F.sum(c).alias(n) for c, n in zip((*base, *cand), names)])
    n = sums.count()
    if n == 0 or iterations <= 0:
        return spark.createDataFrame([(0, None, None)], "iterations int, low double, high double")
    if exact_groups is not None and n > exact_groups:
        return poisson_delta(df, group, base, cand, iterations, seed)

    def run(batches):
        import numpy as np
        import pandas as pd

        rows = np.concatenate([b.to_numpy(float) for b in batches])
        for i, times in stats.draws(len(rows), iterations, seed):
            at, m = np.fromiter(times, np.int64, len(times)), np.fromiter(times.values(), float, len(times))
            na, da, nb, db = (m[:, None] * rows[at]).sum(axis=0)
            yield pd.DataFrame({"i": [i], "delta": [nb / max(db, 1) - na / max(da, 1)]})

    ordered = settle(sums.orderBy("g")).coalesce(1).select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names])
    return _bounds(ordered.mapInPandas(run, "i int, delta double"), iterations)


def _bounds(deltas: DataFrame, iterations: int) -> DataFrame:
    low, high = stats.percentile_bounds([r["delta"] for r in deltas.select("delta").collect()])  # one number an iteration
    return deltas.sparkSession.createDataFrame([(iterations, low, high)], "iterations int, low double, high double")


def poisson_delta(df: DataFrame, group: str, base: tuple[str, str], cand: tuple[str, str], iterations: int = 1000, seed: int = 42) -> DataFrame:
    """As ``bootstrap_delta`` with another estimator: each group's multiplicity is Poisson(1), from a hash, for any number of groups."""
    names = ["na", "da", "nb", "db"]
    sums = df.groupBy(F.col(group).alias("g")).agg(*[F.sum(c).alias(n) for c, n in zip((*base, *cand), names)])
    return _bounds(stats.poisson_bootstrap(sums, "g", *names, iterations=iterations, seed=seed), iterations)


def release_gate(metrics: DataFrame, thresholds: dict[str, tuple[str, float | None]], least: int = 30) -> DataFrame:
    """One row (verdict, failed, open): pass, fail, needs_review or incomplete.

    ``thresholds``: metric -> ("max" or "min", limit or None). A metric that is
    missing makes the verdict incomplete; a null limit or too small a
    denominator never passes, it needs review.
    """
    spec = metrics.sparkSession.createDataFrame([(m, how, None if lim is None else float(lim)) for m, (how, lim) in thresholds.items()], "metric string, how string, threshold double")
    j = spec.join(metrics.select("metric", "value", "denominator"), "metric", "left")
    state = (
        F.when(F.col("denominator").isNull(), "incomplete").when(F.col("threshold").isNull() | (F.col("denominator") < least) | F.col("value").isNull(), "needs_review")
        .when(F.when(F.col("how") == "max", F.col("value") <= F.col("threshold")).otherwise(F.col("value") >= F.col("threshold")), "pass").otherwise("fail")
    )
    names = lambda s: F.array_sort(F.collect_set(F.when(F.col("state") == s, F.col("metric"))))
    a = j.withColumn("state", state).agg(names("fail").alias("failed"), names("needs_review").alias("open"), names("incomplete").alias("missing"))
    return a.withColumn("verdict", F.when(F.size("missing") > 0, "incomplete").when(F.size("failed") > 0, "fail").when(F.size("open") > 0, "needs_review").otherwise("pass"))


def regression_gate(base: DataFrame, cand: DataFrame, limits: dict[str, float]) -> DataFrame:
    """Rows (bucket, delta, limit, state): candidate minus baseline cer per bucket; a bucket that is absent passes as skipped."""
    spec = base.sparkSession.createDataFrame(list(limits.items()), "bucket string, threshold double")
    j = spec.join(base.select("bucket", F.col("corpus_cer").alias("b")), "bucket", "left").join(cand.select("bucket", F.col("corpus_cer").alias("c")), "bucket", "left")
    return j.select("bucket", (F.col("c") - F.col("b")).alias("delta"), "threshold", F.when(F.col("b").isNull() | F.col("c").isNull(), "skipped").when(F.col("c") - F.col("b") <= F.col("threshold"), "pass").otherwise("fail").alias("state"))


def wilson_gate(audited: DataFrame, layer: str, bad: str, group: str, critical: str, least: int = 500, most: float = 0.01, layer_least: int = 200, layer_most: float = 0.02) -> DataFrame:
    """Rows (layer, groups, errors, upper, critical, passed) for all rows and each layer; groups count once."""
    g = audited.groupBy(layer, group).agg(F.max(F.col(bad).cast("int")).alias("bad"), F.max(F.col(critical).cast("int")).alias("crit"))
    s = g.groupingSets([[F.col(layer)], []], F.col(layer)).agg(F.grouping(F.col(layer)).alias("_all"), F.count("*").alias("groups"), F.sum("bad").alias("errors"), F.sum("crit").alias("critical"))
    s = s.withColumn("upper", stats.wilson(F.col("errors"), F.col("groups"))["upper"])
    whole = F.col("_all") == 1
    ok = (F.col("groups") >= F.when(whole, least).otherwise(layer_least)) & (F.col("upper") <= F.when(whole, most).otherwise(layer_most)) & (F.col("critical") == 0)
    return s.select(F.when(whole, "all").otherwise(F.col(layer)).alias("layer"), "groups", "errors", "upper", "critical", ok.alias("passed"))
