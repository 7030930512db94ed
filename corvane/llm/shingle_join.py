"""The exact end of the SimHash join: all rows of a Jaccard similarity and above.

A 64-bit fingerprint cannot decide a similarity of 0.8: such pairs lie up to 14
bits apart, and a trie walk of that budget visits nearly all pairs. So the walk
of a few bits (``simhash``) gives the first candidates, and what lies beyond its
budget is found by blocks. Two sets of similarity ``least`` or more share one of
their first shingles under any one order of all shingles (prefix filter), so
every such pair meets in a block of rows that share one. Common shingles come
last in the order, which keeps the blocks small. A block is not paired with
itself: the row that has the block's shingle first is compared with the others,
and what that leaves open between components follows, so a block of many copies
costs one comparison a row. Rows that share a long passage and little else have
its shingles late in their order: where a pair's first common shingle stands,
what follows must hold all that they share (position filter), which two such
rows cannot reach.
Candidates of both kinds pass a second fingerprint, the parities of the shingles
by hash bits, as long as the set: its differing bits never exceed the shingles
that two sets do not share, so pairs beyond that error budget are dropped
without their texts. The rest are compared exactly. No pair is left out.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm import simhash
from corvane.llm._common import release, small_batches
from corvane.operators.components import connected_components
from corvane.runtime import Stored, settle

#: Words in a shingle, and the similarity from which rows are linked.
WORDS, LEAST = 5, 0.8
#: One row in so many is sampled for the order; shingles that are ranked as common. They decide the cost only.
SAMPLE, COMMON = 16, 100_000
#: Open pairs of a round, by each input row and at least. They decide the number of rounds only.
PAIRS_A_ROW, PAIRS = 32, 4_000_000
#: Pairs up to which they are sent to the texts; beyond it the texts are shuffled to the pairs.
SENT_PAIRS = 200_000
#: Bits of the trie walk that gives the first candidates.
BUDGET = 2


def shingles(text: str | None, words: int = WORDS):
    """The sorted distinct 64-bit hashes of a text's shingles; of all its words if they are fewer."""
    import numpy as np
    import xxhash

    w = (text or "").lower().encode("utf-8", "surrogatepass").split()
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, w), dtype=np.uint64, count=len(w))
    k = min(words, len(w))
    n = len(w) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = (out ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def jaccard(a, b) -> float:
    """Similarity of two sorted distinct arrays; two empty ones are alike."""
    import numpy as np

    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def prefix_length(n: int, least: float) -> int:
    return n - math.ceil(least * n - 1e-9) + 1


def parities(h) -> bytes:
    """One bit for each value of the hashes' low bits, set if an odd number of shingles has it; as many bits as shingles or up to twice that, 64 at least."""
    import numpy as np

    size = 1 << max(6, (max(1, len(h)) - 1).bit_length())
    at = (h & np.uint64(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=size) & 1).astype(np.uint8), bitorder="little").tobytes()


def short_parities(h) -> list[int]:
    """The parities of 256 bits, as four signed longs."""
    import numpy as np

    odd = (np.bincount((h & np.uint64(255)).astype(np.int64), minlength=256) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64).tolist()


def may_reach(x: bytes, y: bytes, nx: int, ny: int, least: float) -> bool:
    """Whether two sets with these parities may be alike: each shingle that only one has flips one bit."""
    import numpy as np

    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum()) <= (nx + ny) * (1 - least) / (1 + least) + 1e-6


def majority(h) -> int:
    """SimHash of a set of shingle hashes, signed; 0 for none."""
    import numpy as np

    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 65_536):
        ones += np.unpackbits(h[at : at + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(h)).tobytes(), "big", signed=True)


def _signed(h):
    import numpy as np

    return h.view(np.int64)


def _sets(rows: DataFrame, words: int, least: float) -> DataFrame:
    """Rows (row, sig, n, fp, q, bits, prefix): digest, size, fingerprint, short and long parities of each row's set, and its first shingles."""
    import numpy as np
    import pyarrow as pa

    def flat(batches):
        for b in batches:
            for t in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(_signed(shingles(t, words)))], ["h"])

    some = rows.where(F.pmod(F.xxhash64("row"), F.lit(SAMPLE)) == 0).select("t").mapInArrow(flat, "h long")
    common = some.groupBy("h").agg(F.count("*").alias("c")).where("c > 2").orderBy(F.desc("c"), "h").limit(COMMON).collect()
    listed = sorted((r["h"], r["c"]) for r in common)
    shared = rows.sparkSession.sparkContext.broadcast((np.array([h for h, _ in listed] or [0], np.int64), np.array([c for _, c in listed] or [0], np.int64)))

    def run(batches):
        import xxhash

        release()
        known, count = shared.value
        for b in batches:
            sigs, sizes, fps, short, bits, firsts = [], [], [], [], [], []
            for t in b.column(1).to_pylist():
                s = shingles(t, words)
                sigs.append(xxhash.xxh128_digest(s.tobytes()))
                sizes.append(len(s))
                fps.append(majority(s))
                short.append(short_parities(s))
                bits.append(parities(s))
                h = _signed(s)
                if len(h):
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    h = h[np.lexsort((h, np.where(known[at] == h, count[at], 0)))][: prefix_length(len(h), least)]
                firsts.append(h)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sigs, pa.binary()), pa.array(sizes, pa.int32()), pa.array(fps, pa.int64()), pa.array(short, pa.list_(pa.int64())), pa.array(bits, pa.binary()), pa.array(firsts, pa.list_(pa.int64()))], ["row", "sig", "n", "fp", "q", "bits", "prefix"])

    return rows.select("row", "t").mapInArrow(run, "row long, sig binary, n int, fp long, q array<long>, bits binary, prefix array<long>")


def _may_share(n, p, m, q, least: float):
    """Whether sets of ``n`` and ``m`` shingles whose first common one stands at ``p`` and ``q`` may be alike (columns)."""
    need = (n + m) * F.lit(least / (1 + least)) - 1e-6
    return (F.least(n, m) >= F.lit(least) * F.greatest(n, m) - 1e-6) & (F.least(n - p, m - q) >= need)


def _in_budget(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The distinct pairs (a, b) whose sizes and parities leave the similarity within reach."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            x, y, nx, ny, px, py = (b.column(i).to_pylist() for i in range(6))
            ok = [may_reach(*v, least) for v in zip(px, py, nx, ny)]
            if any(ok):
                yield pa.RecordBatch.from_arrays([pa.array([i for i, k in zip(x, ok) if k], pa.int64()), pa.array([i for i, k in zip(y, ok) if k], pa.int64())], ["a", "b"])

    small, large = F.least("an", "bn"), F.greatest("an", "bn")
    own = sets.select(F.col("row").alias("a"), F.col("n").alias("an"), F.col("q").alias("aq"))
    met = pairs.select("a", "b").distinct().join(own, "a").join(own.toDF("b", "bn", "bq"), "b").where(small >= F.lit(least) * large - 1e-6)
    unlike = sum((F.bit_count(F.get("aq", F.lit(i)).bitwiseXOR(F.get("bq", F.lit(i)))) for i in range(4)), F.lit(0))
    met = met.where(unlike <= (F.col("an") + F.col("bn")) * F.lit((1 - least) / (1 + least)) + 1e-6).drop("aq", "bq")
    bits = sets.select(F.col("row").alias("a"), F.col("bits").alias("abits"))
    met = met.join(bits, "a").join(bits.toDF("b", "bbits"), "b")
    return met.select("a", "b", "an", "bn", "abits", "bbits").mapInArrow(run, "a long, b long")


def _alike(pairs: DataFrame, rows: DataFrame, words: int, least: float) -> DataFrame:
    """Of a stored table of pairs (a, b), those whose sets are alike enough, as (u, v)."""
    import pyarrow as pa

    def run(batches):
        sets: dict = {}

        def of(row, t):
            if row not in sets:
                if len(sets) >= 64:
                    sets.clear()
                sets[row] = shingles(t, words)
            return sets[row]

        for b in batches:
            out = [(x, y) for x, y, s, t in zip(*(b.column(i).to_pylist() for i in range(4))) if jaccard(of(x, s), of(y, t)) >= least]
            if out:
                u, v = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    few = pairs.limit(SENT_PAIRS + 1).count() <= SENT_PAIRS
    sent = F.broadcast if few else lambda x: x
    ends = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    some = rows.join(sent(ends), "row", "left_semi")  # only the texts that are in a pair
    one = some.select(F.col("row").alias("a"), F.col("t").alias("ta")).join(sent(pairs), "a")
    two = some.select(F.col("row").alias("b"), F.col("t").alias("tb")).join(one, "b")
    return two.select("a", "b", "ta", "tb").mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS, least: float = LEAST) -> DataFrame:
    """Rows (key, component_id), one for each input row.

    Two rows are linked when the Jaccard similarity of their shingles is
    ``least`` or more; ``component_id`` is the least key reachable. Keys are
    integers, unique and not null. Texts without words (null, empty, blank) are
    copies of each other. Repeated texts are copies, an empty table gives no
    rows, other columns are not read. Shingles are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(key).cast("long").alias("row"), F.col(text).alias("t"))
    keep = Stored(spark, "near")
    sets = keep(_sets(rows, words, least))
    # equal sets meet before any pair is made
    reps = keep(sets.groupBy("sig").agg(F.min("row").alias("rep"), F.count("*").alias("copies")))
    total = reps.count()
    first = sets.join(reps.where("copies > 1").select("sig", "rep"), "sig", "left").where("rep is null or rep = row").drop("sig", "rep")

    def checked(pairs):
        return _alike(keep(_in_budget(pairs, sets, least)), rows, words, least)

    # candidates by fingerprint: equal ones, then those that the trie walk links
    nodes = keep(first.groupBy("fp").agg(F.min("row").alias("rep"), F.count("*").alias("k")))
    same = first.join(nodes.where("k > 1"), "fp").where("row <> rep").select(F.col("rep").alias("a"), F.col("row").alias("b"))
    walked = simhash.similar_links(nodes.select("fp", "rep"), BUDGET).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"))
    # candidates by block: the row with the block's shingle first against the others
    marks = first.select("row", "n", F.posexplode("prefix").alias("p", "h"))
    heads = marks.groupBy("h").agg(F.min(F.struct("p", "row", "n")).alias("x")).select("h", F.col("x.row").alias("a"), F.col("x.n").alias("an"), F.col("x.p").alias("ap"))
    open_rows = keep(marks.join(heads, "h").where("row <> a").select("h", "row", "n", "p", "a", "an", "ap"))
    links = keep(checked(open_rows.where(_may_share(F.col("n"), F.col("p"), F.col("an"), F.col("ap"), least)).select("a", F.col("row").alias("b")).union(same).union(walked)))
    open_rows = open_rows.select("h", "row", "n", "p")  # without the heads, which have met all others
    while True:
        comp = keep(connected_components(links))
        own = open_rows.join(comp.withColumnRenamed("node", "row"), "row", "left").select("h", "row", "n", "p", F.coalesce("component", "row").alias("c"))
        # the largest partner that a row's position leaves; in each pair one row reaches its own size
        own = own.withColumn("u", F.floor((F.col("n") - F.col("p")) * F.lit((1 + least) / least) + 1e-6) - F.col("n"))
        strong = own.where("u >= n").groupBy("h").agg(F.min("n").alias("least_n"))
        own = keep(own.join(strong, "h").where("u >= least_n").drop("u", "least_n"))
        by = own.groupBy("h", "c").agg(F.count("*").alias("k"))
        groups = by.groupBy("h").agg(F.sum("k").alias("size"), F.max(F.struct("k", "c")).alias("most"), F.count("*").alias("parts")).where("parts > 1")
        groups = keep(groups.select("h", "size", F.col("most.k").alias("k"), F.col("most.c").alias("most")))
        left = F.col("size") - F.col("k")
        work = groups.agg(F.sum(left.cast("double") * F.col("size")).alias("all"), *(F.sum(F.least(left, F.lit(1 << i)).cast("double") * F.col("size")).alias(f"w{i}") for i in range(1, 31))).first()
        if not work["all"]:
            break
        own = keep(own.join(groups.select("h", "most"), "h"))
        rest = own.where("c <> most").select("h", F.col("row").alias("x"), F.col("n").alias("xn"), F.col("p").alias("xp"), F.col("c").alias("xc"))
        most = max(PAIRS, PAIRS_A_ROW * total)
        last = work["all"] <= most
        if not last:  # as many more rows of each block meet all others as the round has room for, one at least
            heads = 1 << max([0, *(i for i in range(1, 31) if work[f"w{i}"] <= most)])
            rest = keep(rest.withColumn("r", F.row_number().over(Window.partitionBy("h").orderBy("x"))).where(F.col("r") <= heads).drop("r"))
        reach = _may_share(F.col("n"), F.col("p"), F.col("xn"), F.col("xp"), least)
        pairs = own.join(rest, "h").where((F.col("c") != F.col("xc")) & reach).select(F.least("x", "row").alias("a"), F.greatest("x", "row").alias("b"))
        links = keep(links.union(checked(pairs)))
        if last:
            comp = keep(connected_components(links))
            break
        open_rows = keep(own.select("h", "row", "n", "p").join(rest.select("h", F.col("x").alias("row")), ["h", "row"], "left_anti"))
    classes = reps.join(comp, reps["rep"] == comp["node"], "left").select("sig", F.coalesce("component", "rep").alias("component_id"))
    out = settle(sets.select("row", "sig").join(classes, "sig").select(F.col("row").alias(key), "component_id"))
    keep.drop()
    return out
