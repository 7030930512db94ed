"""Filters, guarded joins, de-duplication and reports over sample tables.

A guard that must stop a job (duplicate ids, unequal hashes) is one small
aggregate that the driver reads before the join is used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import hashing, similarity, text
from corvane.functions.maps import upsert
from corvane.plans.expr import ExpressionError, predicate
from corvane.runtime import scratch


class AlignmentError(ValueError):
    """Tables that must agree do not."""


# --- filters ---------------------------------------------------------------


def mark_rows(df: DataFrame, expr: str, label: str = "filter_pass") -> DataFrame:
    """Adds the predicate's value; no row is dropped. A bad expression marks all rows false and says why in ``{label}_error``."""
    try:
        return df.withColumns({label: predicate(expr, df.columns), f"{label}_error": F.lit(None).cast("string")})
    except ExpressionError as e:
        return df.withColumns({label: F.lit(False), f"{label}_error": F.lit(str(e))})


def select_rows(df: DataFrame, expr: str) -> DataFrame:
    """Rows where the predicate holds; a bad expression raises."""
    return df.where(predicate(expr, df.columns))


def filter_by_id(df: DataFrame, expr: str, key: str = "id") -> DataFrame:
    """Rows whose id has any row where the predicate holds: rows of one id travel together."""
    return df.join(df.where(predicate(expr, df.columns)).select(key).distinct(), key, "left_semi")


def filled(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Missing values replaced per field; text fields without a default become empty."""
    return df.select(*[F.coalesce(F.col(c), F.lit(defaults[c] if c in defaults else "")).alias(c) if c in defaults or c.endswith("_text") else F.col(c) for c in df.columns])


def transcript_diff(df: DataFrame, a: str, b: str) -> DataFrame:
    """``match`` or ``mismatch`` of two routes' texts; missing texts are empty."""
    of = lambda m: F.coalesce(F.try_element_at("transcripts", F.lit(m))["text"], F.lit(""))
    return df.withColumn("transcript_diff", F.when(of(a) == of(b), "match").otherwise("mismatch"))


def copy_transcripts(df: DataFrame, mapping: dict[str, str], only_if_missing: bool = True) -> DataFrame:
    """Copies map entries source -> target; a target with text stays unless told otherwise."""
    t = F.col("transcripts")
    for src, dst in mapping.items():
        have, old = F.try_element_at(t, F.lit(src)), F.try_element_at(t, F.lit(dst))["text"]
        take = have.isNotNull()
        if only_if_missing:
            take &= F.trim(F.coalesce(old, F.lit(""))) == ""
        t = F.when(take, upsert(t, F.create_map(F.lit(dst), have))).otherwise(t)
    return df.withColumn("transcripts", t)


# --- guarded joins -----------------------------------------------------------


def require_unique(df: DataFrame, keys: Iterable[str], what: str) -> None:
    twice = df.groupBy(*keys).count().where("count > 1").limit(5).collect()
    if twice:
        raise AlignmentError(f"{what} has duplicate keys: {[tuple(r)[:-1] for r in twice]}")


def alignment_report(base: DataFrame, other: DataFrame, key: str = "id", digest: str | None = "sha256", examples: int = 20) -> DataFrame:
    """One row: counts and the first sorted examples of missing ids, extra ids and unequal digests; digests absent on a side are unchecked."""
    a = base.select(F.col(key).alias("k"), (F.col(digest) if digest else F.lit(None).cast("string")).alias("da"), F.lit(1).alias("ia"))
    b = other.select(F.col(key).alias("k"), (F.col(digest) if digest else F.lit(None).cast("string")).alias("db"), F.lit(1).alias("ib"))
    both = a.join(b, "k", "full_outer")
    kind = (
        F.when(F.col("ib").isNull(), "missing")
        .when(F.col("ia").isNull(), "extra")
        .when((F.coalesce("da", F.lit("")) == "") | (F.coalesce("db", F.lit("")) == ""), "unchecked")
        .when(F.col("da") != F.col("db"), "mismatch")
        .otherwise("same")
    )
    marked = both.select("k", kind.alias("kind"))
    # the examples come from a rank in each kind, so no list of all ids is ever built
    first = marked.where("kind in ('missing', 'extra', 'mismatch')").withColumn("r", F.row_number().over(Window.partitionBy("kind").orderBy("k"))).where(F.col("r") <= examples)
    counts = marked.agg(*[F.count(F.when(F.col("kind") == k, 1)).alias(n) for k, n in (("missing", "missing_ids"), ("extra", "extra_ids"), ("mismatch", "hash_mismatches"), ("unchecked", "hash_unchecked"), ("same", "hash_equal"))])
    shown = first.agg(*[F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col("k")))).alias(n) for k, n in (("missing", "missing_examples"), ("extra", "extra_examples"), ("mismatch", "mismatch_examples"))])
    return counts.withColumn("one", F.lit(1)).join(shown.withColumn("one", F.lit(1)), "one").drop("one")


def attach_route(base: DataFrame, other: DataFrame, model: str, source: str, id_policy: str = "exact", digest: str = "sha256", overwrite: bool = False, require_hashes: bool = False) -> DataFrame:
    """Join one route's transcripts onto the samples by id, guarded by content digest.

    ``exact``: the id sets must be equal; ``left``: extra ids are ignored and
    missing ones get an explicit ``missing`` entry. Duplicate ids, unequal
    digests, and an entry that exists already (without ``overwrite``) raise. A
    joined row without the entry is ``failed`` if it has errors, else ``missing``.
    """
    if id_policy not in ("exact", "left"):
        raise ValueError("id_policy must be 'exact' or 'left'")
    require_unique(base, ["id"], "base")
    require_unique(other, ["id"], source)
    r = alignment_report(base, other, digest=digest).first()
    if id_policy == "exact" and (r["missing_ids"] or r["extra_ids"]):
        raise AlignmentError(f"{source}: ids are not aligned: missing={r['missing_ids']}, extra={r['extra_ids']}")
    if r["hash_mismatches"]:
        raise AlignmentError(f"{source}: digests differ: {r['mismatch_examples'][:5]}")
    if require_hashes and r["hash_unchecked"]:
        raise AlignmentError(f"{source}: digests are required on both sides")
    if not overwrite and not base.where(F.map_contains_key("transcripts", F.lit(model))).isEmpty():
        raise AlignmentError(f"transcript {model} exists already")
    kind = base.schema["transcripts"].dataType.valueType
    entry = F.try_element_at("transcripts", F.lit(model))
    joined = other.select("id", entry.alias("entry"), F.lit(True).alias("there"), (F.size(F.coalesce("errors", F.create_map().cast("map<string,string>"))) > 0).alias("bad") if "errors" in other.columns else F.lit(False).alias("bad"))
    extra = F.create_map(F.lit("source_manifest"), F.lit(source))
    state = F.when(F.col("there").isNull(), "missing").when(F.col("bad"), "failed").otherwise("missing")
    empty = F.struct(*[(F.when(F.col("bad"), F.lit("")) if n == "text" else state if n == "status" else extra if n == "extra" else F.lit(None)).cast(f.dataType).alias(n) for n, f in zip(kind.names, kind.fields)])
    kept = F.struct(*[(upsert(F.col("entry")["extra"], extra) if n == "extra" else F.col("entry")[n]).alias(n) for n in kind.names])
    out = base.join(joined, "id", "left")
    made = F.when(F.col("entry").isNull(), empty).otherwise(kept)
    return out.withColumn("transcripts", upsert(F.col("transcripts"), F.create_map(F.lit(model), made))).drop("entry", "there", "bad")


def sidecar_merge(base: DataFrame, sidecar: DataFrame, key: str = "id", digest: str = "sha256", columns: Iterable[str] = ()) -> DataFrame:
    """Left join on (id, digest). A sidecar row without digest, a repeated key, or an id that has another digest raise."""
    if not sidecar.where(F.col(digest).isNull() | (F.col(digest) == "")).isEmpty():
        raise AlignmentError("sidecar rows need a digest")
    require_unique(sidecar, [key, digest], "sidecar")
    other = sidecar.select(key, F.col(digest).alias("_d")).join(base.select(key, digest), key).where(F.col("_d") != F.col(digest))
    if not other.isEmpty():
        raise AlignmentError("sidecar and base disagree on digests")
    return base.join(sidecar.select(key, digest, *columns), [key, digest], "left")


def inject_gold(samples: DataFrame, gold: DataFrame, align: str = "intersection", missing_gold: str = "fail", key: str = "id") -> DataFrame:
    """Join reference texts by id: inner for ``intersection``, left for ``left`` (missing texts empty if allowed)."""
    require_unique(gold, [key], "gold")
    if align == "intersection":
        return samples.join(gold.select(key, "gold_text"), key)
    out = samples.join(gold.select(key, "gold_text"), key, "left")
    if missing_gold == "fail" and not out.where("gold_text is null").isEmpty():
        raise AlignmentError("samples without gold")
    return out.withColumn("gold_text", F.coalesce("gold_text", F.lit("")))


def one_sided(a: DataFrame, b: DataFrame, key: str = "id") -> DataFrame:
    """Ids on one side only: (key, side)."""
    left = a.select(key).distinct().join(b.select(key), key, "left_anti").withColumn("side", F.lit("left"))
    return left.union(b.select(key).distinct().join(a.select(key), key, "left_anti").withColumn("side", F.lit("right")))


def reconcile(sheet: DataFrame, results: DataFrame, key: str, left: str, right: str, threshold: float = 0.8, unicode: bool = True) -> DataFrame:
    """Left join sheet to results by a key unique on the right; normal forms, similarity, verdict and reason."""
    require_unique(results, [key], "results")
    joined = sheet.join(results.select(key, F.col(right).alias("_r"), F.lit(True).alias("_there")), key, "left")
    a, b = text.normalize_text(F.col(left), unicode=unicode), text.normalize_text(F.col("_r"), unicode=unicode)
    out = joined.withColumns({"left_norm": a, "right_norm": b}).withColumn("similarity", similarity.character_similarity(F.col("left_norm"), F.col("right_norm")))
    reason = F.when(F.col("_there").isNull(), "no_result").when((F.col("left_norm") == "") & (F.col("right_norm") == ""), "both_empty").when((F.col("left_norm") == "") | (F.col("right_norm") == ""), "one_empty").when(F.col("similarity") >= threshold, "similar").otherwise("different")
    return out.withColumn("reason", reason).withColumn("accepted", F.col("reason").isin("similar", "both_empty")).withColumnRenamed("_r", "right_text").drop("_there")


def leakage(train: DataFrame, held: DataFrame, keys: Iterable[str], key: str = "id") -> DataFrame:
    """Rows (kind, train_rows, keys): what the training rows share with the held rows, for each kind of key. Nulls and blanks never match."""
    out = None
    for k in keys:
        there = held.where(F.col(k).isNotNull() & (F.col(k).cast("string") != "")).select(k).distinct()
        part = train.join(there, k, "left_semi").agg(F.count("*").alias("train_rows"), F.countDistinct(k).alias("keys")).select(F.lit(k).alias("kind"), "train_rows", "keys")
        out = part if out is None else out.union(part)
    return out


def cross_split(df: DataFrame, split: str, keys: Iterable[str]) -> DataFrame:
    """Rows (kind, value, splits): key values that occur in more than one split; one aggregate instead of a join of splits."""
    pairs = df.select(split, F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("value")) for k in keys])).alias("p")).select(split, "p.*")
    found = pairs.where("value is not null and value <> ''").groupBy("kind", "value").agg(F.array_sort(F.collect_set(split)).alias("splits"))
    return found.where(F.size("splits") > 1)


def snapshot_alignment(a: DataFrame, b: DataFrame, key: str, fields: Iterable[str]) -> DataFrame:
    """Rows (problem, n): ids on one side, and fields that differ, nulls being equal to nulls."""
    x = a.select(F.col(key).alias("k"), F.lit(1).alias("ia"), *[F.col(f).alias(f"a_{f}") for f in fields])
    y = b.select(F.col(key).alias("k"), F.lit(1).alias("ib"), *[F.col(f).alias(f"b_{f}") for f in fields])
    found = F.array(F.when(F.col("ib").isNull(), "missing"), F.when(F.col("ia").isNull(), "extra"), *[F.when(F.col("ia").isNotNull() & F.col("ib").isNotNull() & ~F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}")), f"{f}_differs") for f in fields])
    return x.join(y, "k", "full_outer").select(F.explode(F.array_compact(found)).alias("problem")).groupBy("problem").agg(F.count("*").alias("n"))


def score_once(df: DataFrame, key: str, score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Score each distinct content once and give the result to all its rows; rows without the key are left without a score."""
    scored = score(df.where(F.col(key).isNotNull()).dropDuplicates([key]))
    return df.join(scored, key, "left")


# --- sets, shards, reports ---------------------------------------------------


def merge_dedup(*tables: DataFrame) -> DataFrame:
    """Union by name without repeats of (content digest, id), in digest order; of repeats the least row is kept."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    out = out.withColumn("_d", hashing.sample_digest(F.col("sha256"), F.col("source_path")))
    others = [c for c in out.columns if c not in ("_d", "id")]
    kept = out.groupBy("_d", "id").agg(F.min(F.struct(*others)).alias("_s"))
    return kept.select("id", *[F.col("_s")[c].alias(c) for c in others], "_d").orderBy("_d", "id").drop("_d")


def with_shard(df: DataFrame, n: int) -> DataFrame:
    return df.withColumn("shard", hashing.shard_of(hashing.sample_digest(F.col("sha256"), F.col("source_path")), n))


#: Rows that one step of the greedy rule deals.
STEP_ROWS = 4_000_000


def balanced_shards(df: DataFrame, n: int, weight: str = "duration", key: str = "id", step_rows: int = STEP_ROWS) -> DataFrame:
    """Rows (key, shard): longest first onto the lightest shard, ties to the lowest number; a missing weight is 1.

    The rule is sequential at every size. Rows are sorted by ranges into parts of
    about ``step_rows``; one part after another is streamed through a task that
    holds the shards' loads only, and hands them on to the next.
    """
    import pyarrow as pa
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_type

    spark = df.sparkSession
    rows = df.select(F.col(key).alias("k"), F.coalesce(F.col(weight).cast("double"), F.lit(1.0)).alias("w"), hashing.sample_digest(F.col("sha256"), F.col("source_path")).alias("d"))
    order = [F.desc("w"), F.col("d"), F.col("k")]
    parts = max(1, -(-rows.count() // step_rows))
    path = scratch(spark, "shards")
    rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()).write.partitionBy("part").parquet(f"{path}/sorted")
    kind = df.schema[key].dataType

    def dealt(loads):
        def run(batches):
            import heapq

            heap = [(x, i) for i, x in enumerate(loads)]
            heapq.heapify(heap)
            for b in batches:
                shard = []
                for w in b.column(1).to_pylist():
                    load, i = heap[0]
                    heapq.heapreplace(heap, (load + w, i))
                    shard.append(i)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shard, pa.int32()), pa.nulls(len(shard), pa.float64())], ["k", "shard", "load"])
            ends = sorted((i, x) for x, i in heap)
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa_kind), pa.array([i for i, _ in ends], pa.int32()), pa.array([x for _, x in ends], pa.float64())], ["k", "shard", "load"])

        return run

    pa_kind = to_arrow_type(kind)
    made = T.StructType([T.StructField("k", kind), T.StructField("shard", T.IntegerType()), T.StructField("load", T.DoubleType())])
    sorted_kind = T.StructType([*rows.schema, T.StructField("part", T.IntegerType())])
    loads, out = [0.0] * n, []
    for p in range(parts):
        part = spark.read.schema(sorted_kind).parquet(f"{path}/sorted").where(F.col("part") == p)
        step = f"{path}/step-{p}"
        part.select("k", "w", "d").coalesce(1).sortWithinPartitions(*order).mapInArrow(dealt(loads), made).write.parquet(step)
        out.append(spark.read.parquet(step))
        loads = [r["load"] for r in out[-1].where("load is not null").orderBy("shard").select("load").collect()]
    return reduce(DataFrame.union, out).where("load is null").select(F.col("k").alias(key), "shard")


def compare(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: total, match, mismatch and match_rate (4 digits) of two text columns; missing is empty."""
    same = F.coalesce(F.col(a), F.lit("")) == F.coalesce(F.col(b), F.lit(""))
    return df.agg(F.count("*").alias("total"), F.count_if(same).alias("match"), F.count_if(~same).alias("mismatch")).withColumn("match_rate", F.when(F.col("total") > 0, F.round(F.col("match") / F.col("total"), 4)))


def manifest_stats(df: DataFrame, audio_ext: str = r"(?i)\.(wav|pcm|mp3|flac|m4a|ogg)$") -> DataFrame:
    """One row: files, hours, broken; histograms come from ``histogram``."""
    return df.agg(
        F.count("*").alias("files"), F.round(F.coalesce(F.sum("duration"), F.lit(0.0)) / 3600, 2).alias("hours"),
        F.count_if(F.col("duration").isNull() & F.col("source_path").rlike(audio_ext)).alias("broken"),
    )


def histogram(df: DataFrame, c: Column, name: str = "value") -> DataFrame:
    return df.groupBy(F.coalesce(c.cast("string"), F.lit("unknown")).alias(name)).agg(F.count("*").alias("n"))
