"""Chains of named operators, declared as data (YAML or dicts), as one lazy DataFrame."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions.maps import add_lineage, upsert
from corvane.operators import relational

Operator = Callable[..., DataFrame]
_REGISTRY: dict[str, tuple[str, Operator]] = {}


def operator(name: str, version: str = "1.0.0") -> Callable[[Operator], Operator]:
    """Register a DataFrame -> DataFrame function under ``category.name``."""

    def add(f: Operator) -> Operator:
        if name in _REGISTRY and _REGISTRY[name][1] is not f:
            raise ValueError(f"{name} is registered already")
        _REGISTRY[name] = (version, f)
        return f

    return add


def operators() -> dict[str, str]:
    return {n: v for n, (v, _) in sorted(_REGISTRY.items())}


operator("quality.filter")(relational.mark_rows)
operator("quality.select")(relational.select_rows)
operator("quality.filter_by_id")(relational.filter_by_id)
operator("quality.transcript_diff")(relational.transcript_diff)
operator("quality.copy_transcripts")(relational.copy_transcripts)
operator("runtime.release_models")(lambda df: df)


def load(text: str) -> dict[str, Any]:
    """A plan from YAML or JSON text: {name, filter?, steps: [{operator, params?}]}."""
    import yaml

    plan = yaml.safe_load(text)
    if not isinstance(plan, dict) or not isinstance(plan.get("steps"), list):
        raise ValueError("a plan needs a list of steps")
    for s in plan["steps"]:
        if s.get("operator") not in _REGISTRY:
            raise ValueError(f"unknown operator {s.get('operator')}")
    return plan


def fingerprint(plan: dict[str, Any]) -> str:
    """Digest of the steps with their versions and parameters."""
    steps = [{"operator": s["operator"], "version": _REGISTRY[s["operator"]][0], "params": s.get("params") or {}} for s in plan["steps"]]
    return hashlib.sha256(json.dumps({"filter": plan.get("filter"), "steps": steps}, sort_keys=True).encode()).hexdigest()


def run(df: DataFrame, plan: dict[str, Any], lineage: bool = False) -> DataFrame:
    """The whole chain as one plan that Catalyst sees at once; nothing runs before an action."""
    if plan.get("filter"):
        df = relational.filter_by_id(df, plan["filter"])
    for s in plan["steps"]:
        version, f = _REGISTRY[s["operator"]]
        df = f(df, **(s.get("params") or {}))
        if lineage and "lineage" in df.columns:
            df = df.withColumn("lineage", add_lineage(F.col("lineage"), s["operator"], version, json.dumps(s.get("params") or {}, sort_keys=True)))
    return df


def completed_or(df: DataFrame, name: str, f: Callable[[DataFrame], DataFrame], force: bool = False) -> DataFrame:
    """Apply ``f`` to the rows whose status for ``name`` is not completed, and mark those completed."""
    done = F.coalesce(F.try_element_at("status", F.lit(name)) == "completed", F.lit(False)) & F.lit(not force)
    fresh = f(df.where(~done)).withColumn("status", upsert(F.col("status"), F.create_map(F.lit(name), F.lit("completed"))))
    return df.where(done).unionByName(fresh, allowMissingColumns=True)
