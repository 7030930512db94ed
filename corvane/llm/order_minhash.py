"""Order MinHash fingerprints with DataFrame functions only.

A text's words give k-mers, each numbered by its occurrence, so that repeats
count. Every sketch has an order of its own, a rehash of the numbered k-mers,
and takes the two that are least under it, keeps them in text order and hashes
the pair: two texts agree on a sketch only if they share both k-mers and their
order, which follows edit distance and not just shared content. The fingerprint
is the sketches in line; likeness is the share of equal ones.

Everything about one text happens in its own row, so nothing is shuffled but the
neighbours' texts: the k-mers' hashes are sorted with their positions, which
puts equal ones side by side in text order, and a k-mer's number is how far back
its run reaches. Hashes and positions are two fields of full width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.runtime import parts_for

#: Words in a k-mer, and sketches.
WORDS, SKETCHES = 3, 16
#: Expected k-mers among which a sketch's two least are sought first.
FEW = 16
#: Steps back that double up to the length of the longest array.
STEPS = [1 << b for b in range(30, -1, -1)]
#: Bytes of stored input for each task, and buckets of consecutive keys for each task.
TASK_BYTES, BUCKETS = 128 << 20, 4


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is read."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def numbered_kmers(text: Column, words: int = WORDS) -> Column:
    """array<struct(id, p)>: hashes of the occurrence-numbered k-mers and their first words.

    Fewer words than a k-mer has: one k-mer of all of them; no words: an empty array.
    """
    w = F.filter(F.split(text, r"\s+"), lambda x: x != "")

    def kmers(ws):
        n = F.greatest(F.size(ws) - (words - 1), F.least(F.size(ws), F.lit(1)))
        return F.transform(F.slice(ws, F.lit(1), n), lambda x, i: F.xxhash64(x, *(F.get(ws, i + j) for j in range(1, words))))

    def number(h, x, i):
        def back(t, b):
            there = i - t - b
            return F.when((there >= 0) & (F.get(h, F.greatest(there, F.lit(0))) == x), t + b).otherwise(t)

        far = F.aggregate(F.array(*map(F.lit, STEPS)), F.lit(0), back)
        return F.when((i > 0) & (F.get(h, F.greatest(i - 1, F.lit(0))) == x), far).otherwise(F.lit(0))

    def repeated(h):
        s = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return _bound(s, lambda t: _bound(t["h"], lambda g: F.transform(t, lambda x, i: F.struct(F.xxhash64(x["h"], number(g, x["h"], i)).alias("id"), x["p"].alias("p")))))

    def ids(h):  # without repeats all numbers are 0, and nothing need be sorted
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.transform(h, lambda x, i: F.struct(F.xxhash64(x, F.lit(0)).alias("id"), i.alias("p")))).otherwise(repeated(h))

    return _bound(_bound(w, kmers), ids)


def sketch(kmers: Column, sketches: int = SKETCHES) -> Column:
    """array<long>: for each sketch the hash of its two least k-mers in text order; of the only one; 0 without any.

    The least are sought among the k-mers whose rank is so low that about
    ``FEW`` are expected; among all where fewer than two are found.
    """
    low, span = float(-(1 << 63)), float(1 << 64)
    n = F.size(kmers)

    def one(i: int, bound: Column) -> Column:
        rank = lambda x: F.xxhash64(F.lit(i).cast("long"), x["id"])
        ranked = lambda xs: F.transform(xs, lambda x: F.struct(rank(x).alias("r"), x["p"].alias("p")))
        few = F.filter(kmers, lambda x: rank(x) < bound)
        some = _bound(few, lambda f: F.when(F.size(f) >= 2, ranked(f)).otherwise(ranked(kmers)))

        def pair(v):
            a, b = v["a"], v["b"]
            return F.when(b.isNull(), F.xxhash64(a["r"])).when(a["p"] <= b["p"], F.xxhash64(a["r"], b["r"])).otherwise(F.xxhash64(b["r"], a["r"]))

        def of(xs):
            return _bound(F.array_min(xs), lambda m: _bound(F.struct(m.alias("a"), F.array_min(F.filter(xs, lambda x: x["r"] != m["r"])).alias("b")), pair))

        return F.when(n == 0, F.lit(0)).otherwise(_bound(some, of))

    bound = F.when(n <= FEW, F.lit((1 << 63) - 1)).otherwise((F.lit(low) + F.lit(span * FEW) / n).cast("long"))
    return _bound(bound, lambda b: F.array(*(one(i, b) for i in range(sketches))))


def as_text(sketches: Column) -> Column:
    """Fingerprint: eight hex digits of each sketch."""
    return F.array_join(F.transform(sketches, lambda x: F.substring(F.lower(F.lpad(F.hex(x), 16, "0")), 1, 8)), "")


def likeness(a: Column, b: Column) -> Column:
    equal = F.zip_with(a, b, lambda x, y: F.when(x == y, F.lit(1)).otherwise(F.lit(0)))
    return F.aggregate(equal, F.lit(0), lambda t, x: t + x) / F.size(a)


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS, sketches: int = SKETCHES) -> DataFrame:
    """Rows (key, fingerprint), one for each input row; null text: as empty; equal texts have equal fingerprints."""
    made = _bound(numbered_kmers(F.coalesce(F.col(text), F.lit("")), words), lambda k: sketch(k, sketches))
    return docs.select(F.col(key), as_text(made).alias("fingerprint"))


def key_bucket(docs: DataFrame, key: str, n: int) -> Column:
    """Number of a row's bucket of consecutive keys, found by halving; at most ``n`` bounds come to the driver."""
    cuts = docs.select(F.percentile_approx(key, [i / n for i in range(1, n)], 10 * n)).first()[0] if n > 1 else []
    cuts = sorted(set(cuts or []))
    if not cuts:
        return F.lit(0)
    bounds = F.array(*map(F.lit, cuts))
    halves = [1 << b for b in range(len(cuts).bit_length() - 1, -1, -1)]

    def step(at, b):  # the first ``at`` bounds lie below the key
        inside = at + b <= len(cuts)
        return F.when(inside & (F.get(bounds, F.least(at + b, F.lit(len(cuts))) - 1) < F.col(key)), at + b).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, halves)), F.lit(0), step)


def neighbour_likeness(docs: DataFrame, text: str = "text", key: str = "doc_id", share: int = 4, words: int = WORDS, sketches: int = SKETCHES, buckets: int | None = None) -> DataFrame:
    """Rows (key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text replaces the last floor(n_chars / ``share``) code points by
    the first as many (or all) of the next row in ascending order of key, then
    text; null keys come first; after the last row comes the first. Null texts
    are empty. Two texts without words are alike (1). Rows that repeat stay
    rows of their own; all rows of one key share a bucket. An empty table gives
    no rows. Keys are integers; other columns are not read.

    Rows are dealt by buckets of consecutive keys. The first row of each bucket
    is also put at the end of the bucket before it (one row a bucket), so no
    order over all rows is ever made in one task, and nothing is shuffled again
    after the rows are dealt.
    """
    base = docs.select(F.col(key).alias("k"), F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("o"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    tasks = parts_for(docs, TASK_BYTES)
    n = buckets or BUCKETS * tasks
    base = base.withColumn("b", key_bucket(base, "o", n))
    least = base.groupBy("b").agg(F.min("o").alias("o"))
    heads = base.join(F.broadcast(least), ["b", "o"]).groupBy("b", "o", "k").agg(F.min("t").alias("t"))
    ring = Window.orderBy("b")  # over one row for each bucket
    last = F.max("b").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = heads.select(F.coalesce(F.lag("b").over(ring), last).alias("b"), "o", "k", "t", F.lit(1).alias("s"))
    both = base.select("b", "o", "k", "t", F.lit(0).alias("s")).union(ends).repartition(tasks, "b")
    w = Window.partitionBy("b").orderBy("s", "o", "t")
    tail = f"cast(floor(length(t) / {share}) as int)"
    rows = both.select("b", "s", "k", "t", F.row_number().over(w).alias("r"), F.lead("t").over(w).alias("nt"))
    edited = F.expr(f"concat(substring(t, 1, length(t) - {tail}), substring(coalesce(nt, ''), 1, {tail}))")
    rows = rows.select("b", "s", "k", "r", "t", F.length("t").cast("long").alias("n_chars"), edited.alias("e"))
    made = lambda c: _bound(numbered_kmers(F.col(c), words), lambda k: sketch(k, sketches))
    pair = rows.select("b", "s", "k", "r", "n_chars", F.sha2("e", 256).alias("sha"), made("t").alias("own"), F.when(F.col("s") == 0, made("e")).alias("new"))
    pair = pair.withColumn("next", F.lead("own").over(Window.partitionBy("b").orderBy("r"))).where("s = 0")
    return pair.select(
        F.col("k").alias(key), "n_chars", F.col("sha").alias("edited_sha256"), as_text(F.col("own")).alias("fingerprint"), as_text(F.col("new")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("new")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"),
    )
