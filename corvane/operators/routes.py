"""Routes: one row per sample and machine transcript, its run status and texts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import text

FAILED, MISSING = ("failed", "error", "fail"), ("missing", "pending", "running")


@dataclass(frozen=True)
class Families:
    """Route keys of each family, in family order; ``teachers`` vote on the target family."""

    runs: dict[str, list[str]]
    target: str = "qwen"
    teachers: tuple[str, ...] = ()
    order: tuple[str, ...] = field(default=())

    def ordered(self) -> list[str]:
        return list(self.order or self.runs)

    def teaching(self) -> list[str]:
        return list(self.teachers or [f for f in self.ordered() if f != self.target])

    def keys(self) -> list[tuple[str, str, int]]:
        return [(f, k, i) for i, f in enumerate(self.ordered()) for k in self.runs[f]]


def run_status(entry: Column) -> Column:
    """success_text, success_empty, failed or missing, of a transcript entry that may be null."""
    status = F.lower(F.trim(F.coalesce(entry["status"], F.lit(""))))
    inner = F.lower(F.trim(F.coalesce(F.try_element_at(entry["extra"], F.lit("inference_status")), F.try_element_at(entry["extra"], F.lit("status")), F.lit(""))))
    raw = F.coalesce(F.try_element_at(entry["extra"], F.lit("raw_text")), entry["text"])
    return (
        F.when(entry.isNull(), "missing")
        .when(status.isin(*FAILED), "failed")
        .when(status.isin(*MISSING), "missing")
        .when(inner.isin(*FAILED), "failed")
        .when(inner == "missing", "missing")
        .when(entry["text"].isNull(), "missing")
        .when(F.trim(raw) == "", "success_empty")
        .otherwise("success_text")
    )


def explode_routes(samples: DataFrame, families: Families, keep: tuple[str, ...] = ("id", "duration"), unicode: bool = True) -> DataFrame:
    """Rows (keep.., family, family_rank, run_id, status, raw_text, comparison_text) for every configured route, present or not."""
    wanted = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(i).alias("family_rank"), F.lit(k).alias("run_id"), F.try_element_at("transcripts", F.lit(k)).alias("entry")) for f, k, i in families.keys()])
    long = samples.select(*keep, F.explode(wanted).alias("r")).select(*keep, "r.*")
    raw = F.coalesce(F.try_element_at(F.col("entry")["extra"], F.lit("raw_text")), F.col("entry")["text"], F.lit(""))
    long = long.withColumns({"status": run_status(F.col("entry")), "raw_text": raw})
    return long.withColumn("comparison_text", F.when(F.col("status") == "success_text", text.comparison_text(F.col("raw_text"), unicode=unicode)).otherwise("")).drop("entry")


def route_integrity(routes: DataFrame) -> DataFrame:
    """Rows (run_id, success, missing, failed) over all samples."""
    return routes.groupBy("run_id").agg(F.count_if(F.col("status").startswith("success")).alias("success"), F.count_if(F.col("status") == "missing").alias("missing"), F.count_if(F.col("status") == "failed").alias("failed"))


def readiness(routes: DataFrame) -> DataFrame:
    """Rows (id, readiness): incomplete if any configured route failed or is missing, else classifiable."""
    return routes.groupBy("id").agg(F.when(F.bool_or(F.col("status").isin("failed", "missing")), "incomplete").otherwise("classifiable").alias("readiness"))


def hash_replica(key: Column, n: int) -> Column:
    from corvane.functions.hashing import replica_of

    return replica_of(key, n)
