"""Deterministic draws: splits, reservations, quotas, audits. All ranks are hashes, so order and partitions do not matter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import hashing, stats
from corvane.runtime import settle


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows; each partition keeps its own first ``n`` before they meet."""
    return df.orderBy(*order).limit(n)


def group_split(df: DataFrame, group: str, ratios: dict[str, float], seed: int = 0, stratum: str | None = None) -> DataFrame:
    """Adds ``split``: a group is never divided. Its stratum is the commonest of its rows (ties: the lesser name).

    Rows without a group raise. The last boundary is 1, whatever the sum of the shares rounds to.
    """
    if not ratios or min(ratios.values()) < 0 or sum(ratios.values()) <= 0:
        raise ValueError("ratios must be non-negative with a positive total")
    if not df.where(F.col(group).isNull()).isEmpty():
        raise ValueError(f"rows without {group}")
    s = F.coalesce(F.col(stratum).cast("string"), F.lit("None")) if stratum else F.lit("all")
    counts = df.groupBy(F.col(group).cast("string").alias("_g"), s.alias("_s")).agg(F.count("*").alias("n"))
    main = counts.groupBy("_g").agg(F.min(F.struct((-F.col("n")).alias("n"), "_s"))["_s"].alias("_s"))
    point = hashing.stable_unit(seed, F.col("_s"), F.col("_g"))
    total, at, out = sum(ratios.values()), 0.0, None
    names = list(ratios)
    for name in names:
        at += ratios[name] / total
        bound = F.lit(1.1 if name == names[-1] else at)
        out = F.when(point < bound, name) if out is None else out.when(point < bound, name)
    return df.join(main.select("_g", out.alias("split")), F.col(group).cast("string") == F.col("_g")).drop("_g")


def reserve(samples: DataFrame, seed: int = 42, random_target: int = 2000, core_ratio: float = 0.15, calibration_target: int = 3000, dev_ratio: float = 0.10) -> DataFrame:
    """Rows (id, group_id, role, drawn): the frozen reservation, in this order.

    ``samples``: (id, group_id, hold). Groups with a held row are governance_hold.
    The first ``random_target`` free ids by rank are drawn; their whole groups
    become eval_random. Of the other groups a hashed share is eval_core_reserve,
    the first ``calibration_target`` by rank give one drawn id each, the first
    floor(n * ``dev_ratio``) of the rest are dev, the others train_pool.
    """
    s = settle(samples.select("id", "group_id", F.coalesce("hold", F.lit(False)).alias("hold")))
    held = s.where("hold").select("group_id").distinct()
    free = s.join(held, "group_id", "left_anti")
    drawn = settle(top(free, random_target, *hashing.rank_key(seed, "eval_random", F.col("id"))).select("id", "group_id"))
    taken = drawn.select("group_id").distinct()
    rest = free.join(taken, "group_id", "left_anti").select("group_id").distinct()
    rest = settle(rest.withColumn("core", hashing.stable_unit(seed, "eval_core_reserve", F.col("group_id")) < core_ratio))
    pool = rest.where("not core").select("group_id")
    cal = settle(top(pool, calibration_target, *hashing.rank_key(seed, "calibration_group", F.col("group_id"))))
    after = pool.join(cal, "group_id", "left_anti")
    dev = top(after, int(after.count() * dev_ratio), *hashing.rank_key(seed, "dev_group", F.col("group_id"))) if dev_ratio else after.limit(0)
    picks = free.join(cal, "group_id").groupBy("group_id").agg(F.min_by("id", F.struct(*hashing.rank_key(seed, "calibration_sample", F.col("id")))).alias("id"))
    tag = lambda d, r: d.select("group_id", F.lit(r).alias("role"))
    roles = tag(held, "governance_hold").union(tag(taken, "eval_random")).union(tag(rest.where("core"), "eval_core_reserve")).union(tag(cal, "calibration")).union(tag(dev, "dev"))
    first = drawn.select("id").union(picks.select("id")).withColumn("_d", F.lit(True))
    out = s.join(roles, "group_id", "left").join(first, "id", "left")
    return out.select("id", "group_id", F.coalesce("role", F.lit("train_pool")).alias("role"), F.coalesce("_d", F.lit(False)).alias("drawn"))


def one_per_group(df: DataFrame, group: str, k: int, seed: int, salt: str, key: str = "id") -> DataFrame:
    """The first ``k`` groups by rank, one member each: the first by rank."""
    chosen = top(df.select(group).distinct(), k, *hashing.rank_key(seed, f"{salt}_group", F.col(group).cast("string")))
    member = F.struct(*hashing.rank_key(seed, f"{salt}_sample", F.col(key).cast("string")))
    return df.join(chosen, group).groupBy(group).agg(F.min_by(key, member).alias(key))


def spot_audit(df: DataFrame, category: str = "category", stratum: str = "stratum", key: str = "id", share: float = 0.01, least: int = 100, seed: str = "spot_audit") -> DataFrame:
    """Adds ``spot_quota`` and ``spot_selected``.

    Each category's quota is min(n, max(least, ceil(n share))). First one row of
    each stratum in order of its name, then the others by hash. Equivalent to
    one rank: first rows of strata come before all others.
    """
    c, k = F.col(category), F.col(key).cast("string")
    n = df.groupBy(category).agg(F.count("*").alias("_n"))
    lead = df.groupBy(category, stratum).agg(F.min(F.struct(hashing.digest(seed, c, k).alias("h"), F.col(key).alias("id")))["id"].alias("_first"))
    rows = df.join(n, category).join(lead, [category, stratum])
    rows = rows.withColumn("spot_quota", stats.spot_quota(F.col("_n"), share, least)).withColumn("_is", F.col(key) == F.col("_first"))
    order = [F.desc("_is"), F.when(F.col("_is"), F.col(stratum)), hashing.digest(seed, c, F.lit("fill"), k), F.col(key)]
    return _first_of(rows, [category], order, F.col("spot_quota"), key, "spot_selected").drop("_n", "_first", "_is")


def _first_of(rows: DataFrame, by: list[str], order: list[Column], quota: Column, key: str, name: str, salts: int = 64) -> DataFrame:
    """Adds ``name``: whether a row is among the first ``quota`` of its group.

    Each group is ranked in salted parts first; only rows within the quota of
    their own part are ranked again, so no task orders a whole group.
    """
    part = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(salts))
    near = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*by, part).orderBy(*order))).withColumn("_q", quota)
    best = near.where(F.col("_r") <= F.col("_q")).withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_r") <= F.col("_q"))
    return rows.join(best.select(F.col(key).alias("_key"), F.lit(True).alias(name)), F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key").withColumn(name, F.coalesce(name, F.lit(False)))


def review_order(df: DataFrame, score: Column, seed: str = "review_batch_v3", key: str = "id") -> list[Column]:
    """Order of a review batch: P0 by hash, P1 by score then hash, P2 by hash, others by hash."""
    p, k = F.coalesce(F.col("review_priority"), F.lit("")), F.col(key).cast("string")
    prio = F.when(p == "P0", 0).when(p == "P1", 1).when(p == "P2", 2).otherwise(3)
    salt = F.when(p == "P0", f"{seed}|p0").when(p == "P1", seed).when(p == "P2", f"{seed}|p2").otherwise(f"{seed}|o")
    return [prio, F.when(p == "P1", -score).otherwise(0), F.sha2(F.concat_ws("\0", salt, k), 256), F.col(key)]


def review_batch(df: DataFrame, score: Column, limit: int, seed: str = "review_batch_v3", key: str = "id") -> DataFrame:
    """The first ``limit`` rows of the review order that are still open."""
    open_ = ~F.coalesce(F.col("annotation_state"), F.lit("")).isin("second_review", "adjudicated", "rejected", "human_accepted")
    return top(df.where(open_), limit, *review_order(df, score, seed, key))


def spot_check(df: DataFrame, layer: str, rate: float, seed: str = "review_batch_v3", key: str = "id", blocked: str = "blocked") -> DataFrame:
    """ceil(rate n) of each layer by hash; all of a layer that has a blocked row."""
    sizes = df.groupBy(layer).agg(F.count("*").alias("_n"), F.max(F.coalesce(F.col(blocked), F.lit(False))).alias("_b"))
    order = [F.sha2(F.concat(F.lit(seed), F.col(layer), F.lit("\0"), F.col(key).cast("string")), 256), F.col(key)]
    d = _first_of(df.join(sizes, layer), [layer], order, F.ceil(F.col("_n") * rate), key, "_in")
    return d.where(F.col("_b") | F.col("_in")).drop("_n", "_b", "_in")


def pick_quota(candidates: DataFrame, n: int, seed: int, salt: str, max_per_call: int = 3, used: DataFrame | None = None, key: str = "id") -> DataFrame:
    """The first ``n`` candidates by rank of which no duplicate key repeats and no call has more than ``max_per_call``.

    ``candidates``: (id, call, dup), the last two nullable. ``used``: (call, n)
    and earlier picks' (id, dup) of strata before. A row is passed over only
    for rows of its own call or duplicate key that stand before it and were
    taken; each such choice falls in that order. Duplicates across calls make
    the choice sequential: it is settled by rounds, each of which fixes at
    least the first open row of every call and key, until no row is open.
    """
    rank = hashing.rank_key(seed, salt, F.col(key).cast("string"))
    rows = candidates.select(F.col(key).alias("id"), "call", "dup", *[c.alias(f"r{i}") for i, c in enumerate(rank)])
    if used is not None:
        rows = rows.join(used.where("id is not null").select("id"), "id", "left_anti").join(used.where("dup is not null").select("dup").distinct(), "dup", "left_anti")
        before = used.where("call is not null").groupBy("call").agg(F.count("*").alias("had"))
    else:
        before = candidates.sparkSession.createDataFrame([], "call string, had long").withColumn("call", F.col("call").cast(candidates.schema["call"].dataType))
    rows = settle(rows.join(before, "call", "left").withColumn("had", F.coalesce("had", F.lit(0))))
    order = [F.col("r0"), F.col("r1")]
    taken = rows.limit(0).select("id", "call", "dup", "r0", "r1")
    # rows without a key are alone in their window, wherever they lie
    own = lambda c: F.coalesce(F.concat(F.lit("k"), F.col(c).cast("string")), F.concat(F.lit("n"), F.col("id").cast("string")))
    while not rows.isEmpty():
        by_dup = F.when(F.col("dup").isNotNull(), F.row_number().over(Window.partitionBy(own("dup")).orderBy(*order))).otherwise(1)
        by_call = F.when(F.col("call").isNotNull(), F.row_number().over(Window.partitionBy(own("call")).orderBy(*order)) + F.col("had")).otherwise(0)
        d = rows.withColumns({"_d": by_dup, "_c": by_call})
        # first of its key, and within its call's room even if all before it are taken: sure to be taken
        sure = settle(d.where((F.col("_d") == 1) & (F.col("_c") <= max_per_call)).select("id", "call", "dup", "r0", "r1"))
        taken = settle(taken.union(sure))
        left = rows.join(sure.select("id"), "id", "left_anti").join(sure.where("dup is not null").select("dup").distinct(), "dup", "left_anti")
        full = sure.where("call is not null").groupBy("call").agg(F.count("*").alias("more"))
        left = left.join(full, "call", "left").withColumn("had", F.col("had") + F.coalesce("more", F.lit(0))).drop("more")
        rows = settle(left.where(F.col("call").isNull() | (F.col("had") < max_per_call)))
    return top(taken, n, *order).select("id", "call", "dup")


def quota_plan(candidates: DataFrame, strata: list[tuple[str, int]], seed: int, max_per_call: int = 3) -> tuple[DataFrame, DataFrame]:
    """Strata in order, each with its quota; picks of one count as used in the next. (plan, shortfalls)."""
    plan, short = None, []
    for name, n in strata:
        own = candidates.where(F.col("stratum") == name)
        got = settle(pick_quota(own, n, seed, name, max_per_call, plan)).withColumn("stratum", F.lit(name))
        have = got.count()
        if have < n:
            short.append((name, n, have))
        plan = got if plan is None else plan.union(got)
    spark = candidates.sparkSession
    return plan, spark.createDataFrame(short, "stratum string, wanted int, got int")
