"""SimHash near-duplicates by a binary trie self-join.

Fingerprints are the leaves of a binary trie. The join walks pairs of nodes
together from the root: two children on unlike bits add one to the pair's
errors, and a pair whose errors exceed the budget is dropped with everything
below it. The upper levels are walked as DataFrame joins of node pairs with
the child nodes that exist, four bits a step, until both nodes of a pair are
small enough for one task; there the walk goes on over sorted arrays. A crowded
part of the trie is only walked deeper, so no task holds more fingerprints than
the bound, whatever their distribution.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm._common import small_batches
from corvane.operators.components import connected_components
from corvane.runtime import settle

#: Fingerprints below one node of a pair that goes to a task.
NODE_ROWS = 262_144
#: Bits that a DataFrame step goes down.
STEP = 4
#: Node pairs handled at once inside a task, and leaf products compared directly.
CHUNK, LEAF = 131_072, 64


def text_fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """The 64-bit fingerprint of a text; 0 for a text without words."""
    import numpy as np
    import xxhash

    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    grams = map(b" ".join, zip(*(w[i:] for i in range(words)))) if len(w) >= words else [b" ".join(w)]
    n = max(1, len(w) - words + 1)
    h = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), grams), dtype=np.uint64, count=n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65_536):
        part = h[at : at + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 3) -> DataFrame:
    """Rows (key, fp): the fingerprint as a signed long. Null text: as empty."""
    import pyarrow as pa

    small_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            fps = [text_fingerprint(t, words) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([f - (1 << 64) if f >> 63 else f for f in fps], pa.int64())], ["k", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"k {kind}, fp long").select(F.col("k").alias(key), "fp")


def _halves(arr, lo, hi, depth):
    """Where each node's range splits at the bit below ``depth``."""
    import numpy as np

    shift = np.uint64(63 - depth)
    at = ((arr[lo] >> shift) | np.uint64(1)) << shift
    return np.minimum(np.searchsorted(arr, at), hi)


def walk_pairs(a, b, depth: int, errors: int, budget: int):
    """Index pairs (i, j) with a[i], b[j] at most ``budget`` bits apart.

    ``a`` and ``b`` are sorted distinct uint64 arrays, each below one node at
    ``depth`` with ``errors`` unlike bits so far. If ``b is a``, each pair comes
    once, with i < j. Yields arrays; memory is bounded by the chunk size.
    """
    import numpy as np

    if not len(a) or not len(b):
        return
    same = b is a
    one = lambda x: np.array([x], np.int64)
    stack = [(depth, one(0), one(len(a)), one(0), one(len(b)), one(errors))]
    while stack:
        d, alo, ahi, blo, bhi, err = stack.pop()
        if len(alo) > CHUNK:
            k = len(alo) // 2
            stack += [(d, *(x[k:] for x in (alo, ahi, blo, bhi, err))), (d, *(x[:k] for x in (alo, ahi, blo, bhi, err)))]
            continue
        size = (ahi - alo) * (bhi - blo)
        leaf = (size <= LEAF) | (d >= 64)
        if leaf.any():
            la, lb, nb, s = alo[leaf], blo[leaf], (bhi - blo)[leaf], size[leaf]
            off = np.arange(s.sum()) - np.repeat(np.cumsum(s) - s, s)
            wide = np.repeat(nb, s)
            i, j = np.repeat(la, s) + off // wide, np.repeat(lb, s) + off % wide
            ok = np.bitwise_count(a[i] ^ b[j]) <= budget
            if same:
                ok &= i < j
            if ok.any():
                yield i[ok], j[ok]
        rest = ~leaf
        if not rest.any():
            continue
        alo, ahi, blo, bhi, err = (x[rest] for x in (alo, ahi, blo, bhi, err))
        am, bm = _halves(a, alo, ahi, d), _halves(b, blo, bhi, d)
        own = (alo == blo) if same else np.zeros(len(alo), bool)
        kids = [(alo, am, blo, bm, err, None), (am, ahi, bm, bhi, err, None), (alo, am, bm, bhi, err + 1, None), (am, ahi, blo, bm, err + 1, ~own)]
        parts = []
        for kal, kah, kbl, kbh, ke, only in kids:
            keep = (kah > kal) & (kbh > kbl) & (ke <= budget)
            if only is not None:
                keep &= only
            parts.append([x[keep] for x in (kal, kah, kbl, kbh, ke)])
        joined = [np.concatenate(x) for x in zip(*parts)]
        if len(joined[0]):
            stack.append((d + 1, *joined))


class _Sets:
    """Disjoint sets over array positions; links inside a set are dropped in bulk."""

    def __init__(self, n: int):
        import numpy as np

        self.up = np.arange(n, dtype=np.int64)

    def roots(self):
        import numpy as np

        while True:
            nxt = self.up[self.up]
            if np.array_equal(nxt, self.up):
                return self.up
            self.up = nxt

    def add(self, i, j) -> None:
        import numpy as np

        while len(i):
            r = self.roots()
            x, y = r[i], r[j]
            apart = x != y
            if not apart.any():
                return
            i, j, x, y = i[apart], j[apart], x[apart], y[apart]
            np.minimum.at(self.up, np.maximum(x, y), np.minimum(x, y))


def _links(pdf, budget: int):
    """Star links that join what the walk below one node pair finds. Rows: side, and the arrays of a node."""
    import numpy as np
    import pandas as pd

    first = pdf.iloc[0]
    depth, errors, twin = int(first["depth"]), int(first["err"]), bool(first["twin"])
    sides = {}
    for side, fps, reps in zip(pdf["side"], pdf["fps"], pdf["reps"]):
        fp = np.asarray(fps, np.int64).view(np.uint64)
        order = np.argsort(fp, kind="stable")
        sides[int(side)] = (fp[order], np.asarray(reps, np.int64)[order])
    a = sides[0][0]
    b = a if twin else sides[1][0]
    ids = sides[0][1] if twin else np.concatenate([sides[0][1], sides[1][1]])
    sets, shift = _Sets(len(ids)), 0 if twin else len(a)
    for i, j in walk_pairs(a, b, depth, errors, budget):
        sets.add(i, j + shift)
    r = sets.roots()
    out = r != np.arange(len(r))
    return pd.DataFrame({"u": ids[out], "v": ids[r[out]]})


def _prefix(depth: int):
    return F.lit(0).cast("long") if depth == 0 else F.shiftrightunsigned("fp", 64 - depth)


def similar_links(nodes: DataFrame, budget: int = 2, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links (u, v) between ``rep`` values whose distinct ``fp`` are near.

    ``nodes``: (fp long, distinct; rep long). The links join exactly what all
    pairs within ``budget`` bits would join, with at most one row for each
    fingerprint and node pair instead of all pairs.
    """
    spark = nodes.sparkSession
    total = nodes.count()
    if not total:
        return spark.createDataFrame([], "u long, v long")
    parts = max(8, total // 100_000)  # of the node and pair tables, which are small beside the fingerprints
    # how many fingerprints lie below each node: counted once at a depth where an even trie fits tasks, summed up for the levels above
    even = 0
    while even < 64 and total >> even > node_rows:
        even += STEP
    deep = settle(nodes.groupBy(_prefix(even).alias("p")).agg(F.count("*").alias("n")).coalesce(parts)) if even else None

    def level(depth: int) -> DataFrame:
        if depth > even:
            return nodes.groupBy(_prefix(depth).alias("p")).agg(F.count("*").alias("n"))
        up = F.shiftrightunsigned("p", even - depth) if even - depth < 64 else F.lit(0).cast("long")
        return deep.groupBy(up.alias("p")).agg(F.sum("n").alias("n"))

    top = spark.createDataFrame([(0, 0, total, total, 0, 0)], "pa long, pb long, na long, nb long, err int, depth int")
    small = (F.col("na") <= node_rows) & (F.col("nb") <= node_rows)
    pairs, ready, depth = top, [], 0
    while True:
        ready.append(pairs.where(small | (F.col("depth") >= 64)))
        wide = pairs.where(~small & (F.col("depth") < 64))
        if wide.isEmpty():
            break
        depth += STEP
        kids = settle(level(depth).coalesce(parts))
        a = kids.select(F.shiftright("p", STEP).alias("pa") if depth < 64 else F.shiftrightunsigned("p", STEP).alias("pa"), F.col("p").alias("ca"), F.col("n").alias("ma"))
        b = a.toDF("pb", "cb", "mb")
        unlike = F.bit_count(F.col("ca").bitwiseXOR(F.col("cb")).bitwiseAND(F.lit((1 << STEP) - 1)))
        pairs = settle(
            wide.join(a, "pa").join(b, "pb").where((F.col("pa") != F.col("pb")) | (F.col("ca") <= F.col("cb"))).withColumn("e", (F.col("err") + unlike).cast("int")).where(F.col("e") <= budget)
            .select(F.col("ca").alias("pa"), F.col("cb").alias("pb"), F.col("ma").alias("na"), F.col("mb").alias("nb"), F.col("e").alias("err"), F.lit(depth).alias("depth"))
            .coalesce(parts)
        )
    links = None
    for at, own in enumerate(ready):
        own = own.withColumn("twin", F.col("pa") == F.col("pb"))
        left = own.select(F.col("pa").alias("p"), F.lit(0).alias("side"), "pa", "pb", "err", "depth", "twin")
        right = own.where("not twin").select(F.col("pb").alias("p"), F.lit(1).alias("side"), "pa", "pb", "err", "depth", "twin")
        ends = left.union(right)
        # each node of a pair is packed once, at most ``node_rows`` of 16 bytes, and goes to its pairs as one row
        below = nodes.withColumn("p", _prefix(STEP * at)).join(ends.select("p").distinct(), "p", "left_semi")
        packed = below.groupBy("p").agg(F.array_sort(F.collect_list(F.struct("fp", "rep"))).alias("x")).select("p", F.col("x")["fp"].alias("fps"), F.col("x")["rep"].alias("reps"))
        part = ends.join(packed, "p").drop("p").groupBy("depth", "pa", "pb").applyInPandas(lambda pdf: _links(pdf, budget), "u long, v long")
        links = part if links is None else links.unionByName(part)
    return links


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", budget: int = 2, words: int = 3) -> DataFrame:
    """Rows (key, fingerprint, component_id), one for each input row.

    Two rows are linked when their fingerprints differ in at most ``budget``
    bits; ``component_id`` is the least key reachable. Null and empty texts, and
    texts without words, have fingerprint zero and are linked like any other.
    Repeated keys stay as rows of their own. Rows with a null key are returned
    with their fingerprint and the component of their fingerprint (null if no
    row with a key is reachable). Exact copies meet in one fingerprint class
    before any pair is made. Keys are integers.
    """
    fps = settle(fingerprints(docs, text, key, words))
    nodes = settle(fps.groupBy("fp").agg(F.min(F.col(key).cast("long")).alias("rep")).where("rep is not null"))
    comp = connected_components(similar_links(nodes, budget))
    classes = nodes.join(comp, nodes["rep"] == comp["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(classes, "fp", "left").select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_copies(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 5, least: float = 0.8) -> DataFrame:
    """Rows (key, component_id): rows whose five-word shingles have a Jaccard similarity of ``least`` or more are linked.

    The trie walk of a few bits gives the first candidates; what no such budget
    reaches is found by blocks, and every link is compared exactly
    (``shingle_join``, which states nulls, ties and repeats).
    """
    from corvane.llm import shingle_join

    return shingle_join.near_duplicates(docs, text, key, words, least)
