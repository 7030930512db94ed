"""Leakage groups, releases, warehouse gates and review states."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.operators.components import connected_components
from corvane.runtime import settle


def leakage_groups(samples: DataFrame, fields: dict[str, Iterable[str]], key: str = "id") -> DataFrame:
    """Rows (key, component): samples joined by any shared identity, every alias field being one.

    ``fields``: kind -> columns; blank values join nothing. A star from each
    value's least id replaces all pairs, so a value that a third of all rows
    share gives one edge a row.
    """
    cells = F.array(*[F.struct(F.lit(kind).alias("kind"), F.trim(F.col(c).cast("string")).alias("value")) for kind, cols in fields.items() for c in cols])
    marks = samples.select(F.col(key).alias("k"), F.explode(cells).alias("c")).select("k", "c.*").where("value is not null and value <> ''")
    heads = marks.groupBy("kind", "value").agg(F.min("k").alias("head"), F.count("*").alias("n")).where("n > 1")
    edges = marks.join(heads, ["kind", "value"]).where("k <> head").select(F.col("k").alias("u"), F.col("head").alias("v"))
    comp = connected_components(edges)
    return samples.select(key).join(comp.withColumnRenamed("node", key), key, "left").select(key, F.coalesce("component", F.col(key)).alias("component"))


def group_ids(groups: DataFrame, key: str = "id") -> DataFrame:
    """Rows (key, group_id): a name from the sorted members, the same recipe at every size.

    The members' digest is taken row by row over sorted partitions, so no group
    is ever held as a list; a group's rows are read by one task, in order.
    """
    kind = groups.schema["component"].dataType.simpleString()

    def named(batches):
        import hashlib

        import pyarrow as pa

        at, digest, some = None, None, False
        for b in batches:
            out = []
            for c, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if c != at:
                    if digest:
                        out.append((at, "lg_" + digest.hexdigest()[:16]))
                    at, digest, some = c, hashlib.sha256(), False
                if k is not None:
                    digest.update((("|" if some else "") + k).encode())
                    some = True
            ids, names = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field(0).type), pa.array(names, pa.string())], ["component", "group_id"])
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([at], b.schema.field(0).type), pa.array(["lg_" + digest.hexdigest()[:16]])], ["component", "group_id"])

    members = groups.where("component is not null").select("component", F.col(key).cast("string").alias("k"))
    names = members.repartition("component").sortWithinPartitions("component", "k").mapInArrow(named, f"component {kind}, group_id string")
    return groups.join(names, "component").select(key, "group_id")


def size_histogram(groups: DataFrame) -> DataFrame:
    return groups.groupBy("component").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("groups"))


def formal_gold(d: dict[str, Column]) -> Column:
    """Whether a row's evidence makes it formal gold: all conditions, people distinct."""
    people = F.filter(F.array(d["annotator"], d["reviewer"], d["adjudicator"]), lambda x: x.isNotNull() & (x != ""))
    return (
        F.coalesce(d["verified"], F.lit(False)) & d["state"].isin("second_review", "adjudicated") & d["gold_text"].isNotNull() & d["kind"].isin("speech", "non_speech")
        & ((d["kind"] == "speech") == (d["gold_text"] != "")) & (F.size(people) >= 2) & (F.size(F.array_distinct(people)) == F.size(people)) & ((d["state"] != "adjudicated") | (F.coalesce(d["adjudicator"], F.lit("")) != ""))
    )


def warehouse_counts(df: DataFrame) -> DataFrame:
    """Rows (field, value, n) by category, state and kind, from one pass of grouping sets."""
    cols = [F.col(c) for c in ("category", "state", "kind")]
    s = df.groupingSets([[c] for c in cols], *cols).agg(F.count("*").alias("n"), F.grouping_id(*cols).alias("g"))
    field = F.when(F.col("g") == 3, "category").when(F.col("g") == 5, "state").otherwise("kind")
    value = F.when(F.col("g") == 3, F.col("category")).when(F.col("g") == 5, F.col("state")).otherwise(F.col("kind"))
    return s.select(field.alias("field"), F.coalesce(value, F.lit("unknown")).alias("value"), "n")


def conservation(df: DataFrame, parts: dict[str, Column]) -> DataFrame:
    """One row: total, the count of each part, and whether they add up."""
    a = df.agg(F.count("*").alias("total"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in parts.items()])
    total = sum((F.col(n) for n in parts), F.lit(0))
    return a.withColumn("conserved", F.col("total") == total)


def coverage(df: DataFrame, auto: Column, human: Column) -> DataFrame:
    """Rows (bucket, n): A, H or U, each row in exactly one."""
    return df.groupBy(F.when(F.coalesce(auto, F.lit(False)), "A").when(F.coalesce(human, F.lit(False)), "H").otherwise("U").alias("bucket")).agg(F.count("*").alias("n"))


def snapshot_digest(df: DataFrame, key: str, columns: Iterable[str], fan: int = 4096) -> DataFrame:
    """One row (rows, digest): digest of all rows in key order within ``fan`` buckets of the key's digest.

    A row's line is its key and columns as text, each with its length before it
    (null: ``~``). A bucket's digest is that of its rows' digests, ordered by key
    and digest, all digits; the snapshot's is that of the buckets' in order.
    Buckets are streamed over sorted partitions, so no list of rows is built.
    """
    import pyarrow as pa

    def named(batches):
        import hashlib

        at, digest, n = None, None, 0
        end = lambda: pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([n], pa.int64()), pa.array([digest.hexdigest()])], ["b", "n", "d"])
        for batch in batches:
            for b, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if b != at:
                    if n:
                        yield end()
                    at, digest, n = b, hashlib.sha256(), 0
                digest.update(h.encode())
                n += 1
        if n:
            yield end()

    field = lambda c: F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("~"))
    line = F.sha2(F.concat(*[field(c) for c in (key, *columns)]), 256)
    where = F.pmod(F.conv(F.substring(F.sha2(F.coalesce(F.col(key).cast("string"), F.lit("")), 256), 1, 8), 16, 10).cast("long"), F.lit(fan)).cast("int")
    rows = df.select(where.alias("b"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), line.alias("h"))
    buckets = rows.repartition("b").sortWithinPartitions("b", "k", "h").select("b", "h").mapInArrow(named, "b int, n long, d string")
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "d"))), lambda x: x["d"]), "")
    return buckets.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.sha2(whole, 256).alias("digest"))


def requires_dual_review(d: dict[str, Column], roles: Iterable[str] = ("eval_random", "eval_core")) -> Column:
    """Formal evaluation roles, P0, unresolved categories, H coverage, pseudo audits, and candidates for empty gold."""
    f = lambda c: F.coalesce(c, F.lit(False))
    return (
        f(d["role"].isin(*roles)) | f(d["priority"] == "P0") | f(d["category"].isin("semantic_risk", "hardcase")) | f(d["coverage"] == "H") | f(d["queue"] == "pseudo_audit")
        | f(d["type"].isin("all_empty_unverified", "speech_presence_disagreement")) | f(F.array_contains(d["tags"], "presence_conflict"))
    )


def review_step(rows: DataFrame) -> DataFrame:
    """Adds (next_state, promoted, refused): what a review row does to a sample.

    ``rows``: stage (first, second, adjudicate, spot_check), state, decision
    (accept, reject), conflict, dual, person, first_person, second_person. A
    second reader must be another person, and an adjudicator a third.
    """
    c = F.col
    same = lambda a, b: F.coalesce(c(a) == c(b), F.lit(False))
    refused = (
        F.when((c("stage") == "second") & c("first_person").isNull(), "needs_first").when((c("stage") == "second") & same("person", "first_person"), "same_person")
        .when((c("stage") == "adjudicate") & (F.coalesce(c("state"), F.lit("")) != "conflict"), "not_in_conflict").when((c("stage") == "adjudicate") & (same("person", "first_person") | same("person", "second_person")), "same_person")
    )
    nxt = (
        F.when(c("stage") == "first", F.when(c("decision") == "reject", "rejected").otherwise("annotated"))
        .when(c("stage") == "second", F.when(c("conflict"), "conflict").otherwise("second_review"))
        .when(c("stage") == "adjudicate", F.when(c("decision") == "reject", "rejected").otherwise("adjudicated"))
        .when(c("stage") == "spot_check", F.when(c("conflict"), "conflict").otherwise("passed"))
    )
    promoted = refused.isNull() & (((c("stage") == "first") & (c("decision") != "reject") & ~c("dual")) | ((c("stage") == "second") & ~c("conflict")) | ((c("stage") == "adjudicate") & (c("decision") != "reject")))
    return rows.withColumns({"next_state": F.when(refused.isNull(), nxt).otherwise(c("state")), "promoted": F.coalesce(promoted, F.lit(False)), "refused": refused})


def annotation_tasks(rows: DataFrame, key: str = "id", question: str = "question") -> DataFrame:
    """One task per sample with the sorted union of its questions."""
    return rows.groupBy(key).agg(F.array_sort(F.collect_set(question)).alias("questions"))


def eval_ready(df: DataFrame) -> DataFrame:
    """One row: gold ratio, duplicate ids, empty ids, missing audio, and the trust level (formal, pseudo, legacy)."""
    a = df.agg(
        F.count("*").alias("rows"), F.count_if(F.col("gold_text").isNotNull()).alias("gold"), (F.count("id") - F.countDistinct("id")).alias("duplicate_ids"), F.count_if(F.coalesce("id", F.lit("")) == "").alias("empty_ids"),
        F.count_if(F.coalesce("source_path", F.lit("")) == "").alias("missing_audio"), F.count_if(F.coalesce("is_human_verified", F.lit(False))).alias("verified"), F.count_if(F.col("label_source") == "model").alias("model_labels"),
    )
    level = F.when((F.col("verified") == F.col("rows")) & (F.col("rows") > 0), "formal").when(F.col("model_labels") > 0, "pseudo").otherwise("legacy")
    return a.withColumn("gold_ratio", F.when(F.col("rows") > 0, F.round(F.col("gold") / F.col("rows"), 4))).withColumn("trust", level)
