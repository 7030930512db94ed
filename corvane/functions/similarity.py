"""Edit distances as expressions; the split of edits into kinds and the bit vectors of long texts need Python."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Distances up to which a band of the table is tried before the next wider one.
BANDS = (8, 32, 128, 512)


def edits(a: Column, b: Column) -> Column:
    """Levenshtein distance in code points; equal texts skip it, near ones cost a band of the table only."""
    tries = [F.nullif(F.levenshtein(a, b, t), F.lit(-1)) for t in BANDS]
    return F.when(a == b, F.lit(0)).otherwise(F.coalesce(*tries, F.levenshtein(a, b)))


def text_similarity(a: Column, b: Column, digits: int = 6) -> Column:
    """1 - edits / longer length; both empty 1, one empty 0."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0)).otherwise(F.round(1 - edits(a, b) / longer, digits))


def character_similarity(a: Column, b: Column) -> Column:
    return text_similarity(a, b, 4)


def symmetric_distance(a: Column, b: Column) -> Column:
    """edits / longer length; both empty null, one empty 1."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, F.lit(None).cast("double")).when((a == "") | (b == ""), F.lit(1.0)).otherwise(F.round(edits(a, b) / longer, 6))


def plain_edits(a: str, b: str) -> int:
    """Levenshtein distance by bit vectors: a column of the table is two integers, less equal ends, and nothing but lengths where one text is the other with characters left out."""
    if a == b:
        return 0
    n = min(len(a), len(b))
    lo = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), n)
    hi = next((i for i, (x, y) in enumerate(zip(reversed(a[lo:]), reversed(b[lo:]))) if x != y), n - lo)
    a, b = sorted((a[lo : len(a) - hi], b[lo : len(b) - hi]), key=len, reverse=True)
    left = iter(a)
    if all(c in left for c in b):
        return len(a) - len(b)
    back, at = b[::-1], {}
    for c in set(b):
        at[c] = int("".join(["1" if x == c else "0" for x in back]), 2) if len(b) > 4096 else 0
    if len(b) <= 4096:
        for i, c in enumerate(b):
            at[c] |= 1 << i
    full = (1 << len(b)) - 1
    up, down = full, 0  # places where the column rises or falls by one
    for c in a:
        eq = at.get(c, 0)
        across = (((eq & up) + up) ^ up) | eq
        rise = ((down | ~(across | up)) << 1) | 1
        fall = (up & across) << 1
        eq |= down
        up = (fall | ~(eq | rise)) & full
        down = rise & eq & full
    return len(a) + up.bit_count() - down.bit_count()


def edits_of_all(texts: Column) -> Column:
    """Levenshtein distances between the texts of a short array, row by row end to end; those to a null are null.

    Each two different texts of a row are compared once, in Arrow batches.
    """
    @F.pandas_udf("array<int>")
    def run(rows: pd.Series) -> pd.Series:
        out = []
        for row in rows:
            known: dict[tuple[str, str], int] = {}
            row = [] if row is None else list(row)
            for a, b in ((a, b) for a in row for b in row if a is not None and b is not None and a < b):
                if (a, b) not in known:
                    known[a, b] = plain_edits(a, b)
            out.append([None if a is None or b is None else 0 if a == b else known[min(a, b), max(a, b)] for a in row for b in row])
        return pd.Series(out, dtype=object)

    return run(texts)


def round_binary(c: Column, digits: int) -> Column:
    """A number of at least zero rounded as DuckDB does: the product of doubles, not their decimal form, decides a half."""
    return F.floor(c * 10.0**digits + 0.5) / 10.0**digits


def within(a: Column, b: Column, least: float) -> Column:
    """Whether the similarity is at least ``least``; the widest band tried is that which can still reach it."""
    longer = F.greatest(F.length(a), F.length(b))
    most = F.floor(longer * (1 - least + 1e-6))  # rounding to six digits may lift a similarity to the bound
    near = F.coalesce(*[F.when(F.lit(t) <= most, F.nullif(F.levenshtein(a, b, t), F.lit(-1))) for t in BANDS], F.levenshtein(a, b))
    reach = F.abs(F.length(a) - F.length(b)) <= most
    return F.when(longer == 0, F.lit(True)).when((a == "") | (b == ""), F.lit(least <= 0)).when(a == b, F.lit(least <= 1)).otherwise(reach & (F.round(1 - near / longer, 6) >= least))


Pair = Callable[[Column, Column], Column]


def pairs(values: Column, f: Pair) -> Column:
    """Array of ``f`` over all pairs i < j of a short array (a sample's routes)."""
    return F.flatten(F.transform(values, lambda x, i: F.transform(F.slice(values, i + 2, F.greatest(F.size(values) - i - 1, F.lit(0))), lambda y: f(x, y))))


def pairwise_min(items: Column, sim: Pair = text_similarity) -> Column:
    """Least similarity; one item 1, none null."""
    return F.when(F.size(items) == 0, F.lit(None).cast("double")).when(F.size(items) == 1, F.lit(1.0)).otherwise(F.array_min(pairs(items, sim)))


def pairwise_mean(items: Column, sim: Pair = character_similarity) -> Column:
    p = pairs(items, sim)
    mean = F.aggregate(p, F.lit(0.0), lambda t, x: t + x) / F.size(p)
    return F.when(F.size(items) == 0, F.lit(None).cast("double")).when(F.size(items) == 1, F.lit(1.0)).otherwise(mean)


def with_similarities(df: DataFrame, items: str, by: str, text: str, key: str = "id", name: str = "sims", sim: Pair = text_similarity) -> DataFrame:
    """Adds a map from pairs of items to their similarity, each computed once.

    ``items`` is a short array of structs with ``by`` (unique in it) and ``text``;
    ``sim`` is symmetric. Pairs become rows, so the distances run in compiled
    code, once for each two texts of a row, and array expressions over the items
    only look them up (see ``looked_up``).
    """
    pair = F.flatten(F.transform(items, lambda x, i: F.transform(F.slice(items, i + 2, F.greatest(F.size(items) - i - 1, F.lit(0))), lambda y: F.struct(F.concat_ws("|", F.least(x[by], y[by]), F.greatest(x[by], y[by])).alias("k"), F.least(x[text], y[text]).alias("a"), F.greatest(x[text], y[text]).alias("b")))))
    # dealt by key before the distances are computed, which is where the work is; the aggregate needs no further shuffle
    rows = df.select(key, F.explode(pair).alias("p")).repartition(key).select(key, "p.*").groupBy(key, "a", "b").agg(F.collect_list("k").alias("ks"))
    rows = rows.select(key, "ks", sim(F.col("a"), F.col("b")).alias("s")).select(key, "s", F.explode("ks").alias("k"))
    maps = rows.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("k", "s"))).alias(name))
    return df.join(maps, key, "left")


def looked_up(by: str, name: str = "sims") -> Pair:
    """Similarity of two items from the map of ``with_similarities``."""
    return lambda x, y: F.when(x[by] == y[by], F.lit(1.0)).otherwise(F.try_element_at(F.col(name), F.concat_ws("|", F.least(x[by], y[by]), F.greatest(x[by], y[by]))))


def medoid(items: Column, sim: Pair) -> Column:
    """The struct of a sorted array whose mean similarity to the others is greatest; ties: the first."""

    def score(x, i):
        total = F.aggregate(F.transform(items, lambda y, j: F.when(j == i, F.lit(0.0)).otherwise(sim(x, y))), F.lit(0.0), lambda t, v: t + v)
        return F.struct((total / F.greatest(F.size(items) - 1, F.lit(1))).alias("mean"), (-i).alias("back"), x.alias("item"))

    return F.when(F.size(items) > 0, F.array_max(F.transform(items, score))["item"])


def greedy_cluster(items: Column, key: str, family: str, least: float, sim: Pair) -> Column:
    """From each item in turn, add every item that is similar to all members so far; the best cluster.

    Better: more members, then more families, then the lesser sorted keys.
    ``items`` is sorted by key.
    """

    def grow(seed):
        return F.aggregate(items, F.array(seed), lambda acc, c: F.when((c[key] != seed[key]) & F.forall(acc, lambda m: sim(c, m) >= least), F.array_append(acc, c)).otherwise(acc))

    def rank(c):
        return F.struct((-F.size(c)).alias("n"), (-F.size(F.array_distinct(F.transform(c, lambda m: m[family])))).alias("f"), F.array_sort(F.transform(c, lambda m: m[key])).alias("k"), c.alias("members"))

    return F.array_min(F.transform(F.transform(items, grow), rank))["members"]


def edit_kinds(ref: Column, hyp: Column) -> Column:
    """struct(substitutions, deletions, insertions, reference_length, cer) of one best alignment.

    Of equal alignments that one counts which, read from the end, takes an equal
    pair, then a substitution, then an insertion, then a deletion. Only the
    substitutions are counted in Python; the rest follows from the distance and
    the lengths. Nulls are empty; cer is edits / max(length, 1), 0 if both are empty.
    """
    @F.pandas_udf("int")
    def subs(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([substitutions(x or "", y or "") for x, y in zip(a, b)])

    r, h = F.coalesce(ref, F.lit("")), F.coalesce(hyp, F.lit(""))
    s, d = subs(r, h), edits(r, h)
    gap = F.length(h) - F.length(r)
    ins = ((d - s + gap) / 2).cast("int")
    dele = (d - s - ins).cast("int")
    return F.struct(s.alias("substitutions"), dele.alias("deletions"), ins.alias("insertions"), F.length(r).alias("reference_length"), F.round(d / F.greatest(F.length(r), F.lit(1)), 6).alias("cer"))


def distances(a: str, b: str):
    """The full table of prefix distances, a row at a time over arrays."""
    import numpy as np

    x, y = np.array(list(a), dtype="U1"), np.array(list(b), dtype="U1")
    steps = np.arange(len(y) + 1)
    rows = np.empty((len(x) + 1, len(y) + 1), np.int32)
    rows[0] = steps
    for i, c in enumerate(x, 1):
        best = np.empty(len(y) + 1, np.int32)
        best[0] = i
        best[1:] = np.minimum(rows[i - 1, :-1] + (y != c), rows[i - 1, 1:] + 1)
        rows[i] = np.minimum.accumulate(best - steps) + steps
    return rows


def alignment(a: str, b: str) -> list[tuple[str | None, str | None, str]]:
    """(reference character, hypothesis character, operation) of the alignment that ``edit_kinds`` counts."""
    t, i, j, out = distances(a, b), len(a), len(b), []
    while i or j:
        here = t[i, j]
        if i and j and here == t[i - 1, j - 1] + (a[i - 1] != b[j - 1]):
            out.append((a[i - 1], b[j - 1], "equal" if a[i - 1] == b[j - 1] else "substitution"))
            i, j = i - 1, j - 1
        elif j and here == t[i, j - 1] + 1:
            out.append((None, b[j - 1], "insertion"))
            j -= 1
        else:
            out.append((a[i - 1], None, "deletion"))
            i -= 1
    return out[::-1]


def substitutions(a: str, b: str) -> int:
    if a == b or not a or not b:
        return 0
    return sum(op == "substitution" for *_, op in alignment(a, b))


def aligned_characters(ref: Column, hyp: Column) -> Column:
    """array<struct(reference, hypothesis, operation)> of the alignment."""
    @F.pandas_udf("array<struct<reference:string,hypothesis:string,operation:string>>")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([[{"reference": r, "hypothesis": h, "operation": o} for r, h, o in alignment(x or "", y or "")] for x, y in zip(a, b)])

    return run(ref, hyp)
