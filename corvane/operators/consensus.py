"""Family evidence, risk tags and cross-family consensus.

A sample has a fixed handful of routes, so all of it is array expressions over
one row per sample: no shuffle beyond the one that gathers the routes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import similarity, text
from corvane.functions.maps import let
from corvane.operators import lexicon
from corvane.operators.routes import Families

SEMANTIC_TAGS = ["negation_flip", "false_affirmation", "filler_affirmation", "rejection_sanitization"]


def gather(routes: DataFrame, keep: tuple[str, ...] = ("id", "duration")) -> DataFrame:
    """One row per sample with ``routes``: its route structs in order of family and run."""
    one = F.struct("family_rank", "run_id", "family", "status", "raw_text", "comparison_text")
    return routes.groupBy(*keep).agg(F.array_sort(F.collect_list(one)).alias("routes"))


#: Similarity of two route structs, from the map that ``family_states`` adds.
SIM = similarity.looked_up("run_id")


def spoken(routes: Column) -> Column:
    """Routes with a text to compare."""
    return F.filter(routes, lambda r: (r["status"] == "success_text") & (r["comparison_text"] != ""))


def polarity_of(t: Column) -> Column:
    return text.polarity(t, lexicon.NEGATIVE, lexicon.POSITIVE, lexicon.FILLER)


def conflict_tags(texts: Column) -> Column:
    """Sorted risk tags of a set of texts that should agree."""
    filler = lambda x: text.is_filler(x, lexicon.FILLER)
    affirm, reject = text.phrase_pattern(lexicon.AFFIRMATION), text.phrase_pattern(lexicon.REJECT)

    def fact(x):
        pol = polarity_of(x)
        return F.struct(
            pol.alias("pol"), filler(x).alias("filler"), x.rlike(affirm).alias("affirms"), x.rlike(reject).alias("rejects"),
            F.array_join(text.number_set(x), " ").alias("numbers"), F.array_join(text.token_presence(x, lexicon.CRITICAL), " ").alias("tokens"),
        )

    def tags(f):
        has = lambda p: F.exists(f, lambda x: x["pol"] == p)
        many = lambda n: F.size(F.array_distinct(F.transform(f, lambda x: x[n]))) > 1
        flip = has("positive") & has("negative")
        found = F.array(
            F.when(flip, "negation_flip"),
            # neutral texts are whole fillers, which the next tag handles; an unclear text beside an affirmation is what counts
            F.when(~flip & has("positive") & has("unknown"), "false_affirmation"),
            F.when(F.exists(f, lambda x: x["filler"]) & F.exists(f, lambda x: ~x["filler"] & ((x["pol"] == "positive") | x["affirms"])), "filler_affirmation"),
            F.when(F.exists(f, lambda x: x["rejects"]) & F.exists(f, lambda x: ~x["rejects"] & (x["pol"] == "positive")), "rejection_sanitization"),
            F.when(has("mixed") | many("numbers") | many("tokens"), "critical_token_conflict"),
        )
        return F.array_sort(F.array_compact(found))

    none = F.array().cast("array<string>")

    def of(t):
        same = F.when(polarity_of(F.get(t, F.lit(0))) == "mixed", F.array(F.lit("content_complexity"))).otherwise(none)
        return F.when(F.size(t) < 2, none).when(F.size(F.array_distinct(t)) == 1, same).otherwise(let(F.transform(F.array_distinct(t), fact), tags))

    return let(F.filter(texts, lambda x: x != ""), of)


def pair_conflict(a: Column, b: Column) -> Column:
    """Whether two texts of one family differ in what they mean."""
    tags = F.array(*[F.lit(x) for x in [*SEMANTIC_TAGS, "critical_token_conflict"]])
    return F.when(a == b, False).otherwise(F.arrays_overlap(conflict_tags(F.array(a, b)), tags))


def medoid_of(routes: Column) -> Column:
    return let(F.array_sort(routes), lambda r: similarity.medoid(r, SIM))


def is_short(duration: Column, routes: Column, seconds: float = 2.0, chars: int = 6) -> Column:
    return F.coalesce(duration <= seconds, F.lit(False)) | F.exists(spoken(routes), lambda r: F.length(r["comparison_text"]) <= chars)


def family_states(samples: DataFrame, families: Families, threshold: float = 0.98) -> DataFrame:
    """Adds ``families``: for each family (family, rank, status, vote: struct or null, min_similarity), by priority
    incomplete, stable_empty, unstable_presence, unstable_semantic, stable_text, unstable_text.

    Short samples need equal texts instead of similar ones. Needs ``routes`` and ``short``.
    """

    def one(name: str, rank: int) -> Column:
        def of(members, said):
            x, y = F.get(said, F.lit(0)), F.get(said, F.lit(1))
            sim = F.when(F.size(said) >= 2, SIM(x, y))
            status = (
                F.when(F.exists(members, lambda r: r["status"].isin("failed", "missing")), "incomplete")
                .when(F.size(said) == 0, "stable_empty")
                .when(F.size(said) < F.size(members), "unstable_presence")
                .when((F.size(said) >= 2) & pair_conflict(x["comparison_text"], y["comparison_text"]), "unstable_semantic")
                .when((F.size(said) >= 2) & F.when(F.col("short"), x["comparison_text"] == y["comparison_text"]).otherwise(sim >= threshold), "stable_text")
                .otherwise("unstable_text")
            )
            return F.struct(F.lit(name).alias("family"), F.lit(rank).alias("rank"), status.alias("status"), medoid_of(said).alias("medoid"), sim.alias("min_similarity"))

        return let(F.filter("routes", lambda r: r["family"] == name), lambda members: let(spoken(members), lambda said: of(members, said)))

    if "sims" not in samples.columns:
        samples = similarity.with_similarities(samples, "routes", "run_id", "comparison_text")
    return samples.withColumn("families", F.array(*[one(f, i) for i, f in enumerate(families.ordered())]))


def votes(states: Column) -> Column:
    """Representatives of the families with a stable text."""
    return F.transform(F.filter(states, lambda s: s["status"] == "stable_text"), lambda s: s["medoid"])


def clusters(v: Column, least: float) -> Column:
    """Greedy clusters from every seed in which all pairs are similar; more families first, then the higher least
    similarity, then the lesser run ids; each member set once."""

    def of(by):
        def grow(seed):
            return F.aggregate(by, F.array(seed), lambda acc, c: F.when((c["run_id"] != seed["run_id"]) & F.forall(acc, lambda m: SIM(c, m) >= least), F.array_append(acc, c)).otherwise(acc))

        def rank(c):
            return F.struct((-F.size(F.array_distinct(F.transform(c, lambda m: m["family"])))).alias("less"), (-F.coalesce(similarity.pairwise_min(c, SIM), F.lit(0.0))).alias("minus_min"), F.array_sort(F.transform(c, lambda m: m["run_id"])).alias("runs"), F.array_sort(c).alias("members"))

        return F.array_sort(F.array_distinct(F.transform(F.transform(by, grow), rank)))

    return let(F.array_sort(v, _by_family), of)


def with_consensus(samples: DataFrame, least: float, name: str, families: Families, only: list[str] | None = None) -> DataFrame:
    """Adds ``{name}``: struct(ambiguous, families, min_similarity, runs, text, run_id) of the best cluster, fields null if none.

    A cluster counts only if every route of its families agrees with a member.
    Best clusters that tie with other texts are ambiguous.
    """
    states = F.col("families") if only is None else F.filter("families", lambda s: s["family"].isin(*only))
    made = samples.withColumn("_c", clusters(votes(states), least))

    def covered(c):
        names = F.array_distinct(F.transform(c["members"], lambda m: m["family"]))
        texts = F.transform(c["members"], lambda m: m["comparison_text"])
        own = F.filter(spoken(F.col("routes")), lambda r: F.array_contains(names, r["family"]))
        near = F.forall(own, lambda r: F.exists(c["members"], lambda m: SIM(r, m) >= least))
        return F.when(F.col("short"), F.forall(own, lambda r: F.array_contains(texts, r["comparison_text"]))).otherwise(near)

    made = made.withColumn("_v", F.filter("_c", covered))
    made = made.withColumn("_b", medoid_of(F.get("_v", F.lit(0))["members"]))
    top = F.get("_v", F.lit(0))
    tied = F.filter("_v", lambda c: (c["less"] == top["less"]) & (F.abs(c["minus_min"] - top["minus_min"]) < 1e-9))
    lead = F.array_distinct(F.transform(tied, lambda c: F.get(F.array_sort(c["members"], _by_family), F.lit(0))["comparison_text"]))
    best = F.col("_b")
    clean = F.trim(text.clean_control_tags(best["raw_text"]))
    ambiguous = (F.size(tied) > 1) & (F.size(lead) > 1)
    ok = F.coalesce(~ambiguous, F.lit(False)) & top.isNotNull()
    return made.withColumn(
        name,
        F.struct(
            F.coalesce(ambiguous, F.lit(False)).alias("ambiguous"), F.when(ok, -top["less"]).alias("families"), F.when(ok, -top["minus_min"]).alias("min_similarity"), F.when(ok, top["runs"]).alias("runs"),
            F.when(ok, F.coalesce(F.nullif(clean, F.lit("")), best["comparison_text"])).alias("text"), F.when(ok, best["run_id"]).alias("run_id"),
        ),
    ).drop("_c", "_v", "_b")


def _by_family(a: Column, b: Column) -> Column:
    return F.when((a["family"] < b["family"]) | ((a["family"] == b["family"]) & (a["run_id"] < b["run_id"])), -1).otherwise(1)


def full_agreement(routes: Column, short: Column, least: float) -> Column:
    """struct(ok, min_similarity): whether all texts of all routes agree; short samples need equal texts."""
    there = F.filter(routes, lambda r: r["comparison_text"] != "")
    texts = F.transform(there, lambda r: r["comparison_text"])
    low = similarity.pairwise_min(there, SIM)
    equal = F.size(F.array_distinct(texts)) == 1
    return F.struct(F.when(F.size(texts) == 0, False).when(short, equal).otherwise(low >= least).alias("ok"), F.when(short & equal, F.lit(1.0)).otherwise(low).alias("min_similarity"))


def max_cliques(names: list[str], related: dict[tuple[str, str], Column]) -> Column:
    """Sorted array of the largest sets of families in which all pairs are related; sizes are tried from the top.

    There are at most four families, so all subsets are written out.
    """
    from itertools import combinations

    levels = []
    for size in range(len(names), 1, -1):
        hits = []
        for group in combinations(names, size):
            cond = F.lit(True)
            for a, b in combinations(group, 2):
                cond = cond & F.coalesce(related[a, b] if (a, b) in related else related[b, a], F.lit(False))
            hits.append(F.when(cond, F.array(*[F.lit(x) for x in group])))
        levels.append(F.array_compact(F.array(*hits)))
    out = F.array().cast("array<array<string>>")
    for level in reversed(levels):
        out = F.when(F.size(level) > 0, level).otherwise(out)
    return out


def weighted_pick(df: DataFrame, key: str, group: str, order: list[Column], weight: Column, version: str, seed: str) -> DataFrame:
    """The row of each group whose stretch of the summed weights holds the group's draw. Weights of 0 or less are left out."""
    from pyspark.sql import Window

    from corvane.functions.hashing import unit_52

    w = Window.partitionBy(group).orderBy(*order)
    rows = df.withColumn("_w", weight.cast("double")).where("_w > 0")
    rows = rows.withColumn("_end", F.sum("_w").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("_total", F.sum("_w").over(Window.partitionBy(group)))
    at = unit_52(seed, F.col(key).cast("string"), version) * F.col("_total")
    return rows.withColumn("draw", unit_52(seed, F.col(key).cast("string"), version)).where((at >= F.col("_end") - F.col("_w")) & (at < F.col("_end"))).drop("_w", "_end", "_total")
