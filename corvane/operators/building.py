"""Building data sets: gold evidence to pools, sampling plans, releases that do not change, audit plans, freezing."""

from __future__ import annotations

import json
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import hashing
from corvane.operators import dataset, sampling
from corvane.operators.relational import AlignmentError
from corvane.runtime import drop_path, settle

# Risk tags that make a human row high-risk, kinds without formal gold, final states.
HIGH_RISK = ["short_utterance", "noisy_audio", "crosstalk_suspected", "negation_flip", "false_affirmation_candidate", "filler_affirmation", "rejection_sanitization", "critical_token_conflict", "presence_conflict"]
ABSTAIN = ["unintelligible", "ambiguous_target", "invalid"]
FINAL = ["annotated", "second_review", "adjudicated", "rejected"]
# Strata and pools in their order.
STRATA = ["negative_reject", "filler_neutral", "confirmed_non_speech", "noisy_crosstalk_speech", "positive", "other"]
POOLS = ["qwen_error_fix", "human_high_risk", "human_ordinary", "pseudo_high_audited"]


def _yes(c: Column) -> Column:
    return F.coalesce(F.lower(c.cast("string")).isin("true", "1", "yes"), F.lit(False))


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _tags() -> Column:
    return F.coalesce(F.col("risk_tags"), F.array().cast("array<string>"))


def eval_stratum() -> Column:
    """The layer of a formal gold row, by ordered rules. Needs gold_kind, human_semantic, human_noise, human_crosstalk, gold_text, duration, risk_tags."""
    short = (F.coalesce("duration", F.lit(99.0)) <= 2.0) | (F.length(_text("gold_text")) <= 6) | F.array_contains(_tags(), "short_utterance")
    disturbed = (_text("human_noise") == "noisy") | _yes(F.col("human_crosstalk"))
    kind, semantic = _text("gold_kind"), _text("human_semantic")
    return (
        F.when(kind == "non_speech", "confirmed_non_speech").when(semantic == "negative", "negative_reject").when((semantic == "neutral") & short, "filler_neutral")
        .when((kind == "speech") & disturbed, "noisy_crosstalk_speech").when(semantic == "positive", "positive").otherwise("other")
    )


def blocked_target() -> Column:
    """Why a row's text is no target of speech training, or null. Needs category, status, label_tier, label_grade, label_source, is_human_verified, pseudo_audit_passed."""
    human = F.coalesce("is_human_verified", F.lit(False))
    tier = F.coalesce(F.nullif(F.col("label_tier"), F.lit("")), "label_grade", F.lit(""))
    return (
        F.when(tier.isin("semantic_only", "no_transcript"), "semantic_layer_not_verbatim")
        .when((tier == "pseudo_verbatim_high") & ~F.coalesce("pseudo_audit_passed", F.lit(False)), "pseudo_verbatim_pending_audit")
        .when((_text("status") == "auto_classified") & ~human, "auto_classified_not_accepted")
        .when(F.coalesce(F.col("category").isin("business_consistent", "non_speech"), F.lit(False)) & ~human, "auto_business_not_verbatim")
        .when(F.col("category").isNull() & F.col("status").isNull(), F.lit(None))
        .when((_text("category") == "noise") & ~human, "noise_not_speech_target")
        .when(_text("category").isin("semantic_risk", "hardcase") & ~human, "unreviewed_manual")
        .when(_text("status").isin("hold", "retry", "excluded", "manual_review", "candidate") & ~human, F.concat(F.lit("status_"), F.col("status"), F.lit("_not_accepted")))
        .when((_text("label_source") == "model_consensus") & ~human, "model_candidate_not_human")
    )


def high_risk() -> Column:
    """Whether a human row is hard: risk tags, negative or mixed meaning, noise, crosstalk, at most two seconds, one to six characters."""
    gold = F.length(_text("gold_text"))
    return (
        F.arrays_overlap(_tags(), F.array(*map(F.lit, HIGH_RISK))) | _text("human_semantic").isin("negative", "mixed") | (_text("human_noise") == "noisy") | _yes(F.col("human_crosstalk"))
        | F.coalesce(F.col("duration") <= 2.0, F.lit(False)) | ((gold > 0) & (gold <= 6))
    )


def train_pool(confirmed_error: Column, evidence: Column, non_speech: bool = True, audit: bool = True) -> Column:
    """The pool of a row, or null. ``evidence``: formal gold evidence; ``confirmed_error``: the target route is known to be wrong."""
    human = F.coalesce("is_human_verified", F.lit(False))
    spoken = (_text("gold_kind") == "speech") & (F.trim(_text("gold_text")) != "")
    silent = F.lit(non_speech) & (_text("gold_kind") == "non_speech") & F.coalesce(F.col("gold_text") == "", F.lit(False))
    gold = F.coalesce(evidence, F.lit(False)) & human & (spoken | silent)
    audited = F.coalesce(F.col("pseudo_audit_passed"), F.lit(False)) & ~F.coalesce(F.col("pseudo_audit_stopped"), F.lit(False))
    pseudo = ((_text("type") == "pseudo_high") | (_text("label_tier") == "pseudo_high")) & (F.trim(_text("candidate_text")) != "") & (audited | (F.lit(not audit) & (_text("decision") == "auto_accept")))
    return F.when(blocked_target().isNotNull(), F.lit(None)).when(gold, F.when(F.coalesce(confirmed_error, F.lit(False)), "qwen_error_fix").when(high_risk(), "human_high_risk").otherwise("human_ordinary")).when(pseudo, "pseudo_high_audited")


ALL = (1 << 31) - 1


class Plan(NamedTuple):
    """``rows``: (id, split, stratum); ``shortfalls``: (split, stratum, requested, available, reason); ``left_out``: (id, split, reason)."""

    rows: DataFrame
    shortfalls: DataFrame
    left_out: DataFrame


def sampling_plan(samples: DataFrame, random_target: int, core: dict[str, int], train_size: int, pools: dict[str, float], seed: int = 42, max_per_call: int = 3, limits: dict[str, float] | None = None) -> Plan:
    """The plan of a release, split by split; what one takes, its groups and its duplicates are closed to the next.

    ``samples``: id, group_id, role, drawn (the reservation), call, dup, formal
    (formal gold), abstain, stratum, pool, gold_kind, human_semantic, disturbed.
    eval_random takes the drawn formal rows, then others of its reserved groups,
    by rank; eval_core its strata by quota; dev every formal row of its role, one
    of each duplicate; train its role's pools, the last of which takes the remainder. ``limits``: min_positive,
    min_negative, min_disturbed, max_non_speech, max_pseudo as shares of
    ``train_size``. Too few rows are reported, never made up.
    """
    if train_size <= 0 or abs(sum(pools.values()) - 1) > 1e-9 or min(pools.values()) < 0:
        raise ValueError("train_size must be positive and the pools' shares sum to 1")
    spark, s = samples.sparkSession, settle(samples)
    if [r for r in s.groupBy("id").count().where("count > 1").limit(1).collect()]:
        raise AlignmentError("repeated ids")
    short, parts = [], []
    rank = lambda salt: hashing.rank_key(seed, salt, F.col("id").cast("string"))

    def lack(split, stratum, want, got, why):
        if got < want:
            short.append((split, stratum, want, got, why))

    own = s.where("role = 'eval_random' and formal and not abstain")
    first = settle(own.orderBy((~F.coalesce("drawn", F.lit(False))).cast("int"), *rank("eval_random")).limit(random_target).select("id", "group_id", "dup", F.lit("eval_random").alias("split"), F.lit("overall").alias("stratum")))
    lack("eval_random", "overall", random_target, first.count(), "insufficient_dual_reviewed_evaluable_samples")
    parts.append(first)
    taken, groups = first.select("id", F.lit(None).cast(s.schema["call"].dataType).alias("call"), "dup"), first.select("group_id").distinct()

    def draw(pool: DataFrame, n: int, split: str, stratum: str, taken: DataFrame, per_call: int = max_per_call) -> tuple[DataFrame, int]:
        got = settle(sampling.pick_quota(pool.select("id", "call", "dup"), n, seed, f"{split}:{stratum}", per_call, taken))
        parts.append(got.join(s.select("id", "group_id"), "id").select("id", "group_id", "dup", F.lit(split).alias("split"), F.lit(stratum).alias("stratum")))
        return settle(taken.union(got)), got.count()

    free = s.join(groups, "group_id", "left_anti")
    ready = free.where("role = 'eval_core_reserve' and formal and not abstain")
    for name, n in core.items():
        taken, got = draw(ready.where(F.col("stratum") == name), n, "eval_core", name, taken)
        lack("eval_core", name, n, got, "stratum_quota_shortfall")
    taken, _ = draw(free.where("role = 'dev' and formal and not abstain"), ALL, "dev", "overall", taken, ALL)
    left = train_size
    for i, (name, ratio) in enumerate(pools.items()):
        n = max(0, left) if i == len(pools) - 1 else round(train_size * ratio)
        left -= n
        taken, got = draw(free.where((F.col("role") == "train_pool") & (F.col("pool") == name)), n, "train", name, taken)
        lack("train", name, n, got, "train_pool_quota_shortfall")
    rows = settle(relational_union(parts))
    train = rows.where("split = 'train'").join(s.select("id", "gold_kind", "human_semantic", "disturbed"), "id")
    have = train.agg(
        F.count_if(_text("human_semantic") == "positive").alias("positive"), F.count_if(_text("human_semantic") == "negative").alias("negative"), F.count_if((_text("gold_kind") == "speech") & F.coalesce("disturbed", F.lit(False))).alias("disturbed"),
        F.count_if(_text("gold_kind") == "non_speech").alias("non_speech"), F.count_if(F.col("stratum") == "pseudo_high_audited").alias("pseudo"),
    ).first()
    for name, share in (limits or {}).items():
        side, what = name.split("_", 1)
        bound = int(train_size * share + 0.999999) if side == "min" else int(train_size * share)
        if (side == "min" and have[what] < bound) or (side == "max" and have[what] > bound):
            short.append(("train", f"cross:{what}", bound, have[what], f"cross_constraint_{name}" + ("_exceeded" if side == "max" else "")))
    out = s.where("role in ('eval_random', 'eval_core_reserve')").where("abstain or not formal").select("id", F.when(F.col("role") == "eval_random", "eval_random").otherwise("eval_core").alias("split"), F.when(F.col("abstain"), "abstain").otherwise("not_ready").alias("reason"))
    return Plan(rows.select("id", "split", "stratum"), spark.createDataFrame(short, "split string, stratum string, requested long, available long, reason string"), out)


def relational_union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stamp_plan(samples: DataFrame, plan: DataFrame, target: Column, blocked: Column | None = None) -> DataFrame:
    """The planned rows with split, stratum and target_text; a train row whose target is blocked is an error."""
    out = samples.drop("split", "stratum").join(plan, "id").withColumn("target_text", F.when((F.col("split") != "train") | (F.col("stratum") != "pseudo_high_audited"), target).otherwise(F.col("candidate_text")))
    if blocked is not None:
        bad = out.where((F.col("split") == "train") & blocked.isNotNull() & (F.col("stratum") != "pseudo_high_audited")).select("id").orderBy("id").limit(5).collect()
        if bad:
            raise AlignmentError(f"blocked targets in train: {[r[0] for r in bad]}")
    return out


def prepare(samples: DataFrame, contract: DataFrame, fields: dict[str, Iterable[str]], key: str = "id", **draws) -> tuple[DataFrame, DataFrame]:
    """Input contract, leakage groups and reservation together: (rows with readiness, group_id, role, drawn; counts by readiness and role).

    ``contract``: (key, readiness). Rows that are not classifiable are held, with
    their whole groups.
    """
    groups = dataset.group_ids(dataset.leakage_groups(samples, fields, key), key)
    rows = samples.select(key).join(groups, key).join(contract.select(key, "readiness"), key, "left")
    rows = settle(rows.withColumn("readiness", F.coalesce("readiness", F.lit("invalid"))))
    roles = sampling.reserve(rows.select(F.col(key).alias("id"), "group_id", (F.col("readiness") != "classifiable").alias("hold")), **draws)
    out = rows.join(roles.select(F.col("id").alias(key), "role", "drawn"), key)
    return out, out.groupBy("readiness", "role").agg(F.count("*").alias("n"))


# --- releases ---------------------------------------------------------------------


class ReleaseError(ValueError):
    """A release that exists differs, or a gate refused it."""


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def publish(df: DataFrame, root: str, release: str, key: str = "id", gates: dict[str, int] | None = None) -> dict:
    """Write a release once: {release, state, rows, digest}.

    ``gates``: name -> number of offending rows; any that is not zero refuses
    the release. The rows go to a stage folder with a note of their digest, and
    the folder is renamed as a whole. A release of that name with the same digest is left
    (``unchanged``), one with another digest is an error; nothing is overwritten.
    """
    spark = df.sparkSession
    if bad := {n: c for n, c in (gates or {}).items() if c}:
        raise ReleaseError(f"gates refused the release: {bad}")
    got = dataset.snapshot_digest(df, key, [c for c in sorted(df.columns) if c != key]).first()
    note = {"release": release, "rows": got["rows"], "digest": got["digest"]}
    final = f"{root.rstrip('/')}/{release}"
    if _exists(spark, final):
        old = json.loads(spark.read.text(f"{final}/release.json").first()[0])
        if old["digest"] != note["digest"]:
            raise ReleaseError(f"{release} exists with another digest")
        return note | {"state": "unchanged"}
    stage = f"{root.rstrip('/')}/.stage-{release}-{note['digest'][:12]}"
    if _exists(spark, stage):
        drop_path(spark, stage)
    df.write.parquet(f"{stage}/rows")
    spark.createDataFrame([(json.dumps(note),)], "value string").coalesce(1).write.text(f"{stage}/release.json")
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(final).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(stage), jvm.org.apache.hadoop.fs.Path(final)) or _exists(spark, f"{final}/.stage-{release}-{note['digest'][:12]}"):
        raise ReleaseError(f"{release} was published by another writer")
    return note | {"state": "published"}


def build(samples: DataFrame, plan: Plan, root: str, release: str, group: str = "group_id", target: str = "gold_text", allow_shortfall: bool = False) -> dict:
    """Stamp the plan, check that no group lies in two splits and that nothing falls short, and publish."""
    rows = settle(stamp_plan(samples, plan.rows, F.col(target)))
    leaks = rows.groupBy(group).agg(F.countDistinct("split").alias("n")).where("n > 1").count()
    lacks = 0 if allow_shortfall else plan.shortfalls.count()
    return publish(rows, root, release, gates={"groups_in_two_splits": leaks, "shortfalls": lacks})


def audit_plan(pool: DataFrame, layers: dict[str, tuple[Column, int]], least: int, seed: int = 42) -> DataFrame:
    """Rows (draw, id): the frozen draw of an audit, overall and for each protected layer, one member of as many groups by rank.

    ``pool``: id, group_id, sha256, is_human_verified and what the layers read.
    A repeated id, a row without group or digest, and a row that was read by
    people before are errors: the draw must not know the outcome.
    """
    p = settle(pool)
    n = p.agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"), F.count_if(F.coalesce("group_id", F.lit("")) == "").alias("loose"), F.count_if(F.coalesce("sha256", F.lit("")) == "").alias("blank"), F.count_if(F.coalesce("is_human_verified", F.lit(False))).alias("seen")).first()
    if not n["n"] or n["n"] != n["ids"] or n["loose"] or n["blank"] or n["seen"]:
        raise AlignmentError(f"no pool for an audit: {n.asDict()}")
    out = sampling.one_per_group(p, "group_id", least, seed, "overall").select(F.lit("overall").alias("draw"), "id")
    for name, (cond, k) in layers.items():
        out = out.union(sampling.one_per_group(p.where(F.coalesce(cond, F.lit(False))), "group_id", k, seed, f"layer:{name}").select(F.lit(name).alias("draw"), "id"))
    return out


def audit_digest(pool: DataFrame, draws: DataFrame, columns: Iterable[str]) -> str:
    """Digest of an audit's scope (every candidate's columns) and its draws."""
    a = dataset.snapshot_digest(pool, "id", columns).first()["digest"]
    b = dataset.snapshot_digest(draws.select(F.concat_ws("|", "draw", "id").alias("k")), "k", []).first()["digest"]
    return hashing_text(f"{a}|{b}")


def hashing_text(value: str) -> str:
    import hashlib

    return hashlib.sha256(value.encode()).hexdigest()


def stamp_audit(rows: DataFrame, pool: DataFrame, draws: DataFrame, digest: str) -> DataFrame:
    """Adds review_queue, pseudo_audit_sampled and pseudo_audit_plan: drawn rows are pending, the others of the pool wait."""
    scope, drawn = pool.select("id", F.lit(True).alias("_in")), draws.select("id").distinct().withColumn("_d", F.lit(True))
    j = rows.join(scope, "id", "left").join(drawn, "id", "left")
    return j.withColumns({"review_queue": F.when(F.col("_d"), "pseudo_audit").when(F.col("_in"), "pseudo_audit_pool"), "pseudo_audit_sampled": F.when(F.col("_in"), F.coalesce("_d", F.lit(False))), "pseudo_audit_plan": F.when(F.col("_d"), F.lit(digest))}).drop("_in", "_d")


# --- warehouse --------------------------------------------------------------------


def open_reason(dual: Column) -> Column:
    """Why a row is not finished, or null. Needs annotation_state, gold_kind, decision."""
    state = F.coalesce("annotation_state", F.lit(""))
    excluded = (state == "rejected") | F.coalesce(F.col("gold_kind").isin(*ABSTAIN), F.lit(False)) | F.coalesce(F.lower("decision").isin("reject", "rejected"), F.lit(False))
    return (
        F.when(state.isin("", "pending", "manual_review"), "pending_annotation").when(state == "conflict", "unresolved_conflict").when(~state.isin(*FINAL), F.concat(F.lit("incomplete_state:"), state))
        .when(F.coalesce(dual, F.lit(False)) & ~state.isin("second_review", "adjudicated", "rejected"), "dual_review_incomplete").when(excluded, F.lit(None))
        .when(F.coalesce("gold_kind", F.lit("")) == "", "missing_gold_kind")
    )


def freeze_problems(reviewed: DataFrame, snapshot: DataFrame, categories: Iterable[str], dual: Column, key: str = "id", digest: str = "sha256") -> DataFrame:
    """Rows (problem, n) that keep a batch from being frozen; none: it may be.

    missing, extra and changed rows against the snapshot (key, digest), repeated
    ids and audio, a final category that is not allowed, and open rows by reason.
    """
    r, s = reviewed, snapshot.select(F.col(key).alias("_k"), F.col(digest).alias("_d"))
    met = r.select(key, digest).join(s, F.col(key) == F.col("_k"), "full")
    kind = F.when(F.col(key).isNull(), "missing").when(F.col("_k").isNull(), "extra").when(~F.col(digest).eqNullSafe(F.col("_d")), "changed_audio")
    twice = lambda c, name: r.where(F.col(c).isNotNull()).groupBy(c).count().where("count > 1").select(F.lit(name).alias("problem"))
    final = F.coalesce(F.nullif(F.trim("reviewed_category"), F.lit("")), F.nullif(F.trim("category"), F.lit("")))
    rows = met.select(kind.alias("problem")).union(twice(key, "repeated_id")).union(twice(digest, "duplicate_audio"))
    rows = rows.union(r.select(F.when(~F.coalesce(final.isin(*categories), F.lit(False)), "category_not_allowed"))).union(r.select(open_reason(dual)))
    return rows.where("problem is not null").groupBy("problem").agg(F.count("*").alias("n"))


def freeze(reviewed: DataFrame, snapshot: DataFrame, root: str, release: str, categories: Iterable[str], dual: Column, key: str = "id", digest: str = "sha256") -> dict:
    """Publish a finished batch; any problem refuses it."""
    bad = {r["problem"]: r["n"] for r in freeze_problems(reviewed, snapshot, categories, dual, key, digest).collect()}
    return publish(reviewed, root, release, key, bad)


def annotation_package(rows: DataFrame, candidates: list[str], batch: str, key: str = "id", digest: str = "sha256") -> DataFrame:
    """The whole batch for annotators: key, digest, batch, question and blind candidates; labels and names of routes stay behind."""
    from corvane.operators.reports import candidate_order

    d = candidate_order(rows, candidates, batch, key)
    texts = F.transform("blind", lambda x: F.struct(x["slot"].alias("slot"), F.coalesce(x["text"], F.lit("")).alias("text")))
    return d.select(key, digest, F.lit(batch).alias("batch"), F.coalesce("review_queue", F.lit("")).alias("review_queue"), texts.alias("candidates"))
