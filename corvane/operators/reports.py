"""Evaluation reports, route alignment reports and counts over finished batches."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import hashing, similarity, text
from corvane.functions.maps import let
from corvane.operators import metrics
from corvane.operators.relational import AlignmentError
from corvane.runtime import settle


def _filled(c: Column) -> Column:
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def effective_bucket(bucket: Column, type_: Column, subtype: Column, by_subtype: bool = False) -> Column:
    """The first filled of bucket and type, with the subtype behind it where that says more; ``unclassified`` without any."""
    main, sub = F.coalesce(_filled(bucket), _filled(type_), _filled(subtype), F.lit("unclassified")), _filled(subtype)
    joined = sub if by_subtype else F.concat_ws("/", main, sub)
    return F.when(sub.isNotNull() & (sub != main), joined).otherwise(main)


def without_reference(*labels: Column) -> Column:
    """Whether any of the labels names a type whose reference is empty by nature."""
    return F.coalesce(F.greatest(*[F.coalesce(_filled(c).isin(*metrics.EMPTY_REFERENCE), F.lit(False)) for c in labels], F.lit(False)), F.lit(False))


class Report(NamedTuple):
    """``coverage``: one row a model; ``corpus``: rows (section, bucket, model, ..); ``delta``: one row; ``gates``: one row a gate."""

    coverage: DataFrame
    corpus: DataFrame
    delta: DataFrame | None
    gates: DataFrame | None


def corpus_sections(rows: DataFrame) -> DataFrame:
    """Rows (section, bucket, model, sums, corpus_cer, char_acc) of scored rows, in one pass of grouping sets.

    Sections: ``overall`` (rows with a reference by nature), ``empty_ref`` (the
    others), ``bucket`` (both, by effective bucket).
    """
    d = rows.where("scored")
    sums = [F.sum(c).cast("long").alias(c) for c in ("substitutions", "deletions", "insertions", "reference_length")]
    g = d.groupingSets([["model", "no_ref"], ["model", "bucket"]], "model", "no_ref", "bucket").agg(F.grouping("bucket").alias("_whole"), F.count("*").alias("samples"), *sums)
    section = F.when(F.col("_whole") == 0, "bucket").when(F.col("no_ref"), "empty_ref").otherwise("overall")
    errors = F.col("substitutions") + F.col("deletions") + F.col("insertions")
    g = g.withColumn("section", section).withColumn("errors", errors).withColumn("corpus_cer", errors / F.greatest("reference_length", F.lit(1)))
    acc = F.when(F.col("reference_length") > 0, F.greatest(F.lit(0.0), 1 - F.col("corpus_cer")))
    return g.select("section", "bucket", "model", "samples", "substitutions", "deletions", "insertions", "errors", "reference_length", "corpus_cer", acc.alias("char_acc"))


def evaluation_report(rows: DataFrame, baseline: str | None = None, candidate: str | None = None, gates: Iterable[tuple[str, str | None, float]] = (), iterations: int = 1000, seed: int = 42, allow_missing: bool = True) -> Report:
    """The report of an evaluated table.

    ``rows``: one row a sample and model: id, model, scored, the edits, and the
    labels bucket, type, subtype (nullable). A repeated (id, model), no scored
    row at all, and, unless allowed, a sample that no model scored are errors.
    ``gates``: (name, bucket or None for overall, greatest rise of the error
    rate); a bucket that does not occur passes as skipped, a model that has no
    row in it fails.
    """
    spark = rows.sparkSession
    labels = [F.col(c) for c in ("bucket", "type", "subtype")]
    d = settle(rows.select("id", "model", "scored", "substitutions", "deletions", "insertions", "reference_length", effective_bucket(*labels).alias("bucket"), without_reference(*labels).alias("no_ref")))
    if repeated := [r["id"] for r in d.groupBy("id", "model").count().where("count > 1").orderBy("id").limit(10).collect()]:
        raise AlignmentError(f"repeated ids: {repeated}")
    any_ = d.groupBy("id").agg(F.max(F.col("scored").cast("int")).alias("any"))
    total, scored = any_.agg(F.count("*"), F.coalesce(F.sum("any"), F.lit(0))).first()
    if not scored:
        raise AlignmentError("no scored sample")
    if scored < total and not allow_missing:
        raise AlignmentError(f"{total - scored} samples without metrics")
    coverage = d.groupBy("model").agg(F.count_if("scored").alias("scored"), F.count_if(F.col("scored") & F.col("no_ref")).alias("empty_ref_excluded")).select("model", F.lit(total).alias("total"), F.lit(total - scored).alias("missing_gold"), "scored", "empty_ref_excluded")
    corpus = settle(corpus_sections(d))
    if not baseline or not candidate:
        return Report(coverage, corpus, None, None)
    side = lambda m: corpus.where(F.col("model") == m).select("section", "bucket", F.col("corpus_cer").alias(f"cer_{m}"), F.coalesce("char_acc", F.lit(0.0)).alias(f"acc_{m}"))
    pairs = side(baseline).join(side(candidate).withColumnsRenamed({"section": "s", "bucket": "b"}), F.col("section").eqNullSafe(F.col("s")) & F.col("bucket").eqNullSafe(F.col("b")), "full")
    pairs = settle(pairs.select(F.coalesce("section", "s").alias("section"), F.coalesce("bucket", "b").alias("bucket"), (F.col(f"cer_{candidate}") - F.col(f"cer_{baseline}")).alias("delta_cer"), (F.col(f"acc_{candidate}") - F.col(f"acc_{baseline}")).alias("delta_char_acc")))
    errors = F.col("substitutions") + F.col("deletions") + F.col("insertions")
    wide = d.where("scored").groupBy("id").agg(*[F.sum(F.when(F.col("model") == m, x)).alias(f"{n}{i}") for i, m in enumerate((baseline, candidate)) for n, x in (("e", errors), ("n", F.col("reference_length")))]).where("n0 is not null and n1 is not null")
    bounds = metrics.bootstrap_delta(wide, "id", ("e0", "n0"), ("e1", "n1"), iterations, seed)
    delta = pairs.where("section = 'overall'").select("delta_cer", "delta_char_acc").join(F.broadcast(bounds), F.lit(True))
    spec = spark.createDataFrame([(n, b, float(x)) for n, b, x in gates], "name string, gate_bucket string, threshold double")
    view = pairs.where("section in ('overall', 'bucket')").select(F.when(F.col("section") == "bucket", F.col("bucket")).alias("b"), "delta_cer", F.lit(True).alias("there"))
    met = spec.join(F.broadcast(view), F.col("gate_bucket").eqNullSafe(F.col("b")), "left")
    skipped = F.col("gate_bucket").isNotNull() & F.col("there").isNull()
    return Report(coverage, corpus, delta, met.select("name", F.col("gate_bucket").alias("bucket"), "delta_cer", "threshold", skipped.alias("skipped"), (skipped | F.coalesce(F.col("delta_cer") <= F.col("threshold"), F.lit(False))).alias("passed")))


def exact_by_type(rows: DataFrame, base: str) -> DataFrame:
    """Rows (model, grp, rows, exact, exact_rate, overall_acc, exact_delta, overall_delta): per type and over all, with differences to the base model."""
    acc = F.round(F.greatest(F.lit(0.0), 1 - F.col("cer")), 6)
    d = rows.where("scored").withColumns({"_exact": (acc == 1.0).cast("long"), "_edits": F.col("substitutions") + F.col("deletions") + F.col("insertions")})
    g = d.groupingSets([["model", "type"], ["model"]], "model", "type").agg(F.grouping("type").alias("_all"), F.count("*").alias("rows"), F.sum("_exact").alias("exact"), F.sum("_edits").alias("edits"), F.sum("reference_length").alias("n"))
    overall = F.when(F.col("n") <= 0, F.when(F.col("edits") == 0, 1.0).otherwise(0.0)).otherwise(F.round(F.greatest(F.lit(0.0), 1 - F.col("edits") / F.col("n")), 6))
    g = g.select("model", F.when(F.col("_all") == 1, "all").otherwise(F.col("type")).alias("grp"), "rows", "exact", F.round(F.col("exact") / F.col("rows"), 6).alias("exact_rate"), overall.alias("overall_acc"))
    w = Window.partitionBy("grp")
    own = lambda c: F.max(F.when(F.col("model") == base, F.col(c))).over(w)
    diff = lambda c: F.when(F.col("model") != base, F.round(F.col(c) - own(c), 6))
    return g.withColumns({"exact_delta": diff("exact_rate"), "overall_delta": diff("overall_acc")})


def reference_metrics(ref: Column, hyp: Column, comparable: Column | bool = True) -> Column:
    """struct(cer, reason, insertions, reference_length): no rate where texts cannot be compared by characters.

    Reasons in order: mixed_language (either text), language_mismatch (not
    comparable), empty_reference (insertions are given), reference_length.
    """
    ok = comparable if isinstance(comparable, Column) else F.lit(comparable)

    def mixed(v):
        def of(n):
            both = n["cjk"] + n["latin"]
            return (n["cjk"] > 0) & (n["latin"] > 0) & (n["cjk"] / both >= 0.2) & (n["latin"] / both >= 0.2)

        return F.coalesce(let(F.struct(text.count_of(v, text.CJK).alias("cjk"), text.count_of(v, text.LATIN).alias("latin")), of), F.lit(False))

    r, h = F.coalesce(ref, F.lit("")), F.coalesce(hyp, F.lit(""))
    reason = F.when(mixed(r) | mixed(h), "mixed_language").when(~F.coalesce(ok, F.lit(False)), "language_mismatch").when(r == "", "empty_reference").otherwise("reference_length")
    return let(reason, lambda x: F.struct(F.when(x == "reference_length", similarity.edits(r, h) / F.length(r)).alias("cer"), x.alias("reason"), F.when(x == "empty_reference", F.length(h)).alias("insertions"), F.length(r).alias("reference_length")))


def run_metrics(df: DataFrame, ref: str, hyps: dict[str, str], wanted: Iterable[str] = ("cer",), unicode: bool = True) -> DataFrame:
    """Checks the request, then gives ``edit_metrics``: only known metrics, only columns of the table, at least one hypothesis."""
    if bad := set(wanted) - {"cer"}:
        raise ValueError(f"metrics not known: {sorted(bad)}")
    if not hyps:
        raise ValueError("no hypothesis column")
    if bad := {ref, *hyps.values()} - set(df.columns):
        raise ValueError(f"columns not in the table: {sorted(bad)}")
    return metrics.edit_metrics(df, ref, hyps, unicode)


def noise_trigger(routes: dict[str, list[Column]], foreign: Column) -> Column:
    """array of reasons: no family has a usable text; some route is foreign or mixed speech. Empty: no diagnosis is asked for."""
    usable = [F.greatest(*[F.coalesce(F.trim(c) != "", F.lit(False)) for c in cols], F.lit(False)) for cols in routes.values()]
    none = ~F.greatest(*usable, F.lit(False))
    return F.array_compact(F.array(F.when(none, "all_families_no_valid_transcript"), F.when(F.coalesce(foreign, F.lit(False)), "non_chinese_transcript")))


def noise_report(rows: DataFrame) -> DataFrame:
    """Rows (kind, value, n): samples by status and by trigger (both reasons are a trigger of their own). Needs status, reasons."""
    r = F.col("reasons")
    both = F.array_contains(r, "all_families_no_valid_transcript") & F.array_contains(r, "non_chinese_transcript")
    trigger = F.when(both, "both").otherwise(F.get(r, F.lit(0)))
    cells = F.array(F.struct(F.lit("status").alias("kind"), F.coalesce("status", F.lit("")).alias("value")), F.struct(F.lit("trigger").alias("kind"), trigger.alias("value")))
    return rows.select(F.explode(cells).alias("c")).select("c.*").where("value is not null").groupBy("kind", "value").agg(F.count("*").alias("n"))


def score_distinct(rows: DataFrame, score, digest: str = "sha256", key: str = "id") -> DataFrame:
    """Scores each distinct digest of the triggered rows once and gives every row its digest's score.

    ``score``: DataFrame (digest) -> DataFrame (digest, ..). Rows that ask for no
    diagnosis, and digests without a result, keep nulls and their status.
    """
    asked = rows.where(F.size("reasons") > 0).select(digest).where(F.col(digest).isNotNull()).distinct()
    got = score(asked).withColumn("_got", F.lit(True))
    out = rows.join(got, digest, "left")
    status = F.when(F.size("reasons") == 0, "not_required").when(F.col("_got").isNull(), "failed").otherwise("success")
    keep = [c for c in got.columns if c not in (digest, "_got")]
    return out.select(*rows.columns, status.alias("noise_status"), *[F.when(F.size("reasons") > 0, F.col(c)).alias(c) for c in keep])


def dnsmos_candidates(states: list[Column], energy: Column) -> Column:
    """array of reasons to ask for an acoustic score, from the family states and the energy state."""
    n = lambda s: sum((F.when(c == s, 1).otherwise(0) for c in states), F.lit(0))
    heard = energy.isin("audible", "borderline")
    clean = (n("unstable") == 0) & (n("unavailable") == 0)
    empty = (n("stable_empty") == len(states)) & (n("stable_text") == 0) & clean
    shape = (n("stable_empty") >= 2) & (n("stable_text") == 1) & clean
    return F.array_compact(F.array(F.when(empty & heard, "all_stable_empty_audible_or_borderline"), F.when(shape & heard, "two_empty_one_text_audible_or_borderline")))


def noise_band(bak: Column, ovrl: Column, status: Column, floors: tuple[float, float], calibrated: bool = True, clean: tuple[float, float] | None = None) -> Column:
    """struct(band, risk) recomputed from stored scores; unknown and null without finite scores or calibration.

    A row is at risk below either floor. It is ``noisy`` then; else ``clean`` if
    both scores reach the clean floors (half a point above the floors unless
    given), else ``moderate``.
    """
    high = clean or (floors[0] + 0.5, floors[1] + 0.5)
    known = F.lit(calibrated) & F.coalesce(status == "success", F.lit(False)) & bak.isNotNull() & ovrl.isNotNull() & ~F.isnan(bak) & ~F.isnan(ovrl) & (F.abs(bak) < float("inf")) & (F.abs(ovrl) < float("inf"))
    risk = (bak < floors[0]) | (ovrl < floors[1])
    band = F.when(risk, "noisy").when((bak >= high[0]) & (ovrl >= high[1]), "clean").otherwise("moderate")
    return F.struct(F.when(known, band).otherwise("unknown").alias("band"), F.when(known, risk).alias("risk"))


def attach_routes(samples: DataFrame, runs: DataFrame, routes: dict[str, DataFrame], key: str = "id", digest: str = "sha256") -> DataFrame:
    """Left join of every run's texts, after its provenance is checked; adds one column a run and the snapshot's digest.

    ``runs``: rows (run, family, artifact, execution, snapshot). An artifact, or
    an execution of one family, that serves twice, a run without a table, and a
    snapshot digest that differs from the samples' are errors. ``routes``: run ->
    (key, digest, text); a row whose digest differs from the sample's is an error.
    """
    from corvane.operators.dataset import snapshot_digest

    twice = runs.groupBy("artifact").count().where("count > 1").select("artifact").union(runs.groupBy("family", "execution").count().where("count > 1").select("execution"))
    if bad := [r[0] for r in twice.limit(10).collect()]:
        raise AlignmentError(f"used as two independent runs: {bad}")
    listed = runs.collect()  # one row a run
    if bad := sorted({r["run"] for r in listed} ^ set(routes)):
        raise AlignmentError(f"runs and tables differ: {bad}")
    own = snapshot_digest(samples, key, [digest]).first()["digest"]
    if bad := sorted(r["run"] for r in listed if r["snapshot"] != own):
        raise AlignmentError(f"runs over another snapshot: {bad}")
    out = samples
    for run in sorted(routes):
        t = routes[run].select(F.col(key).alias("_k"), F.col(digest).alias("_d"), F.col("text").alias(run))
        out = out.join(t, F.col(key) == F.col("_k"), "left")
        differ = out.where(F.col("_k").isNotNull() & ~F.col("_d").eqNullSafe(F.col(digest))).select(key).orderBy(key).limit(5).collect()
        if differ:
            raise AlignmentError(f"{run}: digests differ: {[r[0] for r in differ]}")
        out = out.drop("_k", "_d")
    return out.withColumn("snapshot", F.lit(own))


def delivery_reconcile(cleaned: DataFrame, routes: dict[str, DataFrame], classified: DataFrame, sheet: DataFrame, key: str = "id") -> DataFrame:
    """Rows (stage, rows, ids, missing, extra, repeated): every stage against the cleaned ids; all zeros mean nothing was lost."""
    base = cleaned.select(F.col(key).alias("k")).where("k is not null")
    whole = base.distinct()
    out = None
    for name, t in {"cleaned": cleaned, **routes, "classified": classified, "sheet": sheet}.items():
        own = t.select(F.col(key).alias("k")).groupBy("k").agg(F.count("*").alias("n"))
        met = own.join(whole.withColumnRenamed("k", "b"), F.col("k") == F.col("b"), "full")
        row = met.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("k").alias("ids"), F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("b").isNull()).alias("extra"), F.count_if(F.col("n") > 1).alias("repeated"))
        row = row.select(F.lit(name).alias("stage"), "*")
        out = row if out is None else out.union(row)
    return out


def outer_merge(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """Full outer merge by key; columns of both are taken from the left where it has a value."""
    both = [c for c in left.columns if c in right.columns and c != key]
    r = right.withColumnsRenamed({c: f"_r_{c}" for c in [key, *both]})
    j = left.join(r, F.col(key) == F.col(f"_r_{key}"), "full")
    return j.select(F.coalesce(key, f"_r_{key}").alias(key), *[F.coalesce(c, f"_r_{c}").alias(c) if c in both else F.col(c) for c in left.columns if c != key], *[c for c in right.columns if c not in (key, *both)])


def align_to_order(order: DataFrame, rows: DataFrame, how: str = "left", key: str = "id", position: str = "position") -> DataFrame:
    """Rows in the order of another table: left keeps all its ids, inner those with a row, outer adds the others behind."""
    if how not in ("left", "inner", "outer"):
        raise ValueError(f"how: {how}")
    o = order.select(F.col(key).alias("_k"), F.col(position).alias("_p"))
    j = o.join(rows, F.col("_k") == F.col(key), {"outer": "full"}.get(how, how))
    return j.withColumn(key, F.coalesce("_k", key)).withColumnRenamed("_p", position).drop("_k").orderBy(F.col(position).asc_nulls_last(), key)


def shadow_compare(df: DataFrame, old: Column, new: Column) -> DataFrame:
    """Rows (old, new, n, changed): cross table of two rule sets over the same rows."""
    d = df.select(F.coalesce(old, F.lit("none")).alias("old"), F.coalesce(new, F.lit("none")).alias("new"))
    return d.groupBy("old", "new").agg(F.count("*").alias("n")).withColumn("changed", F.col("old") != F.col("new"))


def availability(df: DataFrame, stages: dict[str, Column], dual: Column) -> DataFrame:
    """One row: rows, those that pass each stage and all before it, and the review jobs (two for rows that need two readers)."""
    within, cols = F.lit(True), []
    for name, cond in stages.items():
        within = within & F.coalesce(cond, F.lit(False))
        cols.append(F.count_if(within).alias(name))
    twice = within & F.coalesce(dual, F.lit(False))
    return df.agg(F.count("*").alias("rows"), *cols, (F.count_if(within) + F.count_if(twice)).alias("review_jobs"))


def review_summary(df: DataFrame, routes: list[str], labels: list[str], bucket: str = "type", key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(wide rows: key, bucket, labels, one text column a route; counts by bucket). A row without a bucket is an error."""
    if bad := [r[0] for r in df.where(_filled(F.col(bucket)).isNull()).select(key).orderBy(key).limit(10).collect()]:
        raise AlignmentError(f"rows without {bucket}: {bad}")
    said = lambda r: F.coalesce(F.try_element_at("transcripts", F.lit(r))["text"], F.lit("")).alias(f"{r}_text")
    return df.select(key, bucket, *labels, *map(said, routes)), df.groupBy(bucket).agg(F.count("*").alias("n"))


def pairwise_accuracy(df: DataFrame, pairs: Iterable[tuple[str, str]], unicode: bool = True) -> DataFrame:
    """Adds ``<b>_vs_<a>_acc`` for each pair of text columns: 1 - edits / reference length, at least 0; null without a reference."""
    cols = {}
    for a, b in pairs:
        r, h = (text.normalize_text(F.coalesce(F.col(c), F.lit("")), unicode=unicode) for c in (a, b))
        cols[f"{b}_vs_{a}_acc"] = let(F.struct(r.alias("r"), h.alias("h")), lambda x: F.when(F.length(x["r"]) > 0, F.round(F.greatest(F.lit(0.0), 1 - similarity.edits(x["r"], x["h"]) / F.length(x["r"])), 6)))
    return df.withColumns(cols)


def candidate_order(df: DataFrame, candidates: list[str], seed: str = "blind", key: str = "id") -> DataFrame:
    """Adds ``blind``: array of (slot, source, text), the candidates of each row in an order of its own, drawn by a hash."""
    items = F.array_sort(F.array(*[F.struct(F.sha2(F.concat_ws("\0", F.lit(seed), F.col(key).cast("string"), F.lit(c)), 256).alias("h"), F.lit(c).alias("source"), F.col(c).alias("text")) for c in candidates]))
    return df.withColumn("blind", F.transform(items, lambda x, i: F.struct((i + 1).alias("slot"), x["source"].alias("source"), x["text"].alias("text"))))


def bucket_windows(df: DataFrame, bucket: Column, size: int, key: str = "id", salts: int = 64) -> DataFrame:
    """Adds ``bucket`` and ``batch``: rows of a bucket in batches of ``size``, numbered within its salted parts, none mixed of two buckets."""
    d = df.withColumn("bucket", bucket).withColumn("_s", F.pmod(hashing.shard_of(F.sha2(F.col(key).cast("string"), 256), salts), F.lit(salts)))
    n = F.floor((F.row_number().over(Window.partitionBy("bucket", "_s").orderBy(key)) - 1) / size)
    return d.withColumn("batch", F.concat_ws("-", F.col("bucket").cast("string"), F.col("_s").cast("string"), n.cast("string"))).drop("_s")


def random_subset(df: DataFrame, n: int, seed: int = 42, key: str = "id") -> DataFrame:
    """``n`` rows by hash of seed and key: the same rows whatever the order and the partitions."""
    return df.orderBy(hashing.stable_unit(seed, "subset", F.col(key).cast("string")), F.col(key)).limit(n)


def representative(reps: Column, order: list[str]) -> Column:
    """struct(family, text, distance, support, reason): the text with the least mean distance of its key to the others.

    ``reps``: array of (family, text, key), one a family; fewer than two give
    null. A distance is edits / longer length, 1 if a key is empty or null. Ties:
    more families with the same text, then the order of families. The distances of a row are computed once, before the expression reads them.
    """
    rank = F.array(*map(F.lit, order))

    def of(row):
        reps, n = row["reps"], F.size(row["reps"])

        def scored(x, i):
            far = lambda y: (x["key"] == "") | (y["key"] == "")
            part = lambda y, j: F.get(row["edits"], i * n + j) / F.greatest(F.length(x["key"]), F.length(y["key"]))
            apart = F.transform(reps, lambda y, j: F.struct(y["family"].alias("family"), F.when(~far(y), similarity.round_binary(part(y, j), 6)).alias("d")))
            others = F.transform(F.filter(apart, lambda y: y["family"] != x["family"]), lambda y: F.coalesce(y["d"], F.lit(1.0)))
            mean = similarity.round_binary(F.aggregate(others, F.lit(0.0), lambda t, v: t + v) / (n - 1), 6)
            place = F.array_position(rank, x["family"])
            return F.struct(mean.alias("distance"), (-F.size(F.filter(reps, lambda y: y["text"] == x["text"]))).alias("support"), F.when(place > 0, place).otherwise(10_000).alias("place"), x["family"].alias("family"), x["text"].alias("text"))

        return F.when(n >= 2, let(F.transform(reps, scored), best))

    def best(all_):
        top = F.array_min(all_)
        tied = F.filter(all_, lambda x: x["distance"] == F.array_min(all_)["distance"])
        supported = F.filter(tied, lambda x: x["support"] == F.array_min(all_)["support"])
        reason = F.when(F.size(tied) == 1, "min_mean_tolerant_distance").when(F.size(supported) < F.size(tied), "exact_transcript_support").otherwise("configured_family_order")
        return F.struct(top["family"].alias("family"), top["text"].alias("text"), top["distance"].alias("distance"), (-top["support"]).alias("support"), reason.alias("reason"))

    return let(F.struct(reps.alias("reps"), similarity.edits_of_all(F.transform(reps, lambda x: x["key"])).alias("edits")), of)
