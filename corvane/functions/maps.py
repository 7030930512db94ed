"""Map columns: upsert, typed reads, flat views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, f) -> Column:
    """``f(value)`` with the value computed once and shared: a lambda variable instead of a copied expression."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def upsert(old: Column, new: Column) -> Column:
    """Entries of ``new`` replace those of ``old``; null maps are empty."""
    return F.when(new.isNull(), old).when(old.isNull(), new).otherwise(F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k)), new))


def put(old: Column, **entries: Column) -> Column:
    """Upsert single entries; an entry whose value is null is stored as null."""
    pairs = [x for k, v in entries.items() for x in (F.lit(k), v)]
    return upsert(old, F.create_map(*pairs))


def get(c: Column | str, key: str, kind: str = "string") -> Column:
    """Typed read of an entry: null if it is absent or has another form."""
    value = F.try_element_at(F.col(c) if isinstance(c, str) else c, F.lit(key))
    return value if kind == "string" else value.try_cast(kind)


def truthy(c: Column) -> Column:
    """True for true, 1, yes, y in any case; null for null; else false."""
    return F.lower(F.trim(c)).isin("true", "1", "yes", "y")


def flat_view(samples: DataFrame, models: list[str], quality: list[str], labels: list[str]) -> DataFrame:
    """Wide projection: ``{model}_text``, ``quality_{k}`` and ``label_{k}`` columns."""
    return samples.select(
        *[c for c in samples.columns if c not in ("transcripts", "quality", "labels")],
        *[F.try_element_at("transcripts", F.lit(m))["text"].alias(f"{m}_text") for m in models],
        *[get("quality", k).alias(f"quality_{k}") for k in quality],
        *[get("labels", k).alias(f"label_{k}") for k in labels],
    )


def add_lineage(lineage: Column, operator: str, version: str, params: str = "{}") -> Column:
    """One struct appended."""
    names = ["input_key", "output_key", "output_path", "cache_key"]
    entry = F.struct(F.lit(operator).alias("operator"), F.lit(version).alias("version"), F.lit(params).alias("params"), *[F.lit(None).cast("string").alias(n) for n in names])
    return F.array_append(F.coalesce(lineage, F.array().cast("array<struct<operator:string,version:string,params:string,input_key:string,output_key:string,output_path:string,cache_key:string>>")), entry)
