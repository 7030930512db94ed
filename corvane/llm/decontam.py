"""Benchmark decontamination: rare n-gram seeds and local alignment.

Seeds are word n-grams of the test items. A copy that is scored ``least`` or
more without words put in keeps an intact run of the item's words; its length
follows from the number of words that may differ. In every stretch of that
length the n-gram that is rarest in the corpus is a seed (then: in the items),
so each such copy holds one, wherever its edits are. Training passages that hold
a seed of an item are joined to it, and Smith-Waterman aligns the words around
it with the item, so that edited and paraphrased copies are scored by how much
of the item they cover. Seeds decide candidates only: every place that holds one
is looked at, whatever its frequency. A place whose words, in any order, hold
too little of the item is not aligned.

Items are known by a number of their row. Few items go to every worker; of many,
the n-grams meet the texts' in a shuffled join. Both ways give the same rows.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm._common import release, small_batches
from corvane.runtime import Stored, settle

#: Words in a seed at most.
SEED_WORDS = 3
#: Alignment scores, and the share of an item's words that must align.
MATCH, MISMATCH, GAP, LEAST = 2, -1, -1, 0.8
#: The items go to every worker up to this many n-grams and characters; beyond either, passages and seeds meet in a shuffled join.
BROADCAST_SEEDS, BROADCAST_CHARS = 200_000, 32 << 20
#: Bits of the table of seed hashes that is sent before a shuffled join (16 MB, whatever the items).
TABLE_BITS = 27
#: Bits of a cell for the matched words and for the start.
SHIFT = 21
words_of = re.compile(r"\w+").findall
#: ASCII bytes that are no part of a word become spaces.
_BLANK = bytes(c if c > 127 or chr(c).isalnum() or c == 95 else 32 for c in range(256))


def line_of(text: str) -> str:
    """The words of a text in lower case, with one space before, between and after them."""
    low = text.lower()
    if not low.isascii():
        for c in set(low):
            if c > "\x7f" and not c.isalnum():
                low = low.replace(c, " ")
    return b" ".join([b"", *low.encode("utf-8", "surrogatepass").translate(_BLANK).split(), b""]).decode("utf-8", "surrogatepass")


def seed_size(m: int, least: float = LEAST, n: int = SEED_WORDS) -> tuple[int, int]:
    """(words in a seed, words of an intact run) for an item of ``m`` words of which a share ``least`` must match."""
    lost = int(m * (1 - least) + 1e-9)
    run = -(-(m - lost) // (lost + 1))
    return min(n, run), run


def _item_grams(items: DataFrame, least: float, n: int) -> DataFrame:
    """Rows (i, at, seed, run): all n-grams of the items, with the n-grams in an intact run. Items without words have none."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = words_of((t or "").lower())
                if w:
                    k, intact = seed_size(len(w), least, n)
                    g = [" ".join(w[a : a + k]) for a in range(len(w) - k + 1)]
                    yield pa.RecordBatch.from_arrays([pa.array([i] * len(g), pa.int64()), pa.array(range(len(g)), pa.int32()), pa.array(g), pa.array([intact - k + 1] * len(g), pa.int32())], ["i", "at", "seed", "run"])

    return items.select("i", "t").mapInArrow(run, "i long, at int, seed string, run int")


def rarest(rank: list, run: int) -> list[int]:
    """Positions of the least rank in every stretch of ``run``, of equal ones the last that was taken, else the first."""
    out: list[int] = []
    for a in range(max(1, len(rank) - run + 1)):
        best = min(rank[a : a + run])
        if not out or out[-1] < a or rank[out[-1]] != best:
            out.append(a + rank[a : a + run].index(best))
    return out


def item_seeds(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows (i, seed, at): of each item's n-grams the rarest in every intact run, by ``counts`` (seed, c: places in the corpus)."""
    import pandas as pd

    def pick(pdf):
        pdf = pdf.sort_values("at")
        kept = rarest(list(zip(pdf["c"], pdf["f"], pdf["seed"])), int(pdf["run"].iloc[0]))
        return pd.DataFrame({k: pdf[k].iloc[kept] for k in ("i", "seed", "at")})

    freq = grams.groupBy("seed").agg(F.countDistinct("i").alias("f"))
    known = grams.join(freq, "seed").join(counts, "seed", "left").select("i", "at", "seed", "run", "f", F.coalesce("c", F.lit(0)).alias("c"))
    return known.groupBy("i").applyInPandas(pick, "i long, seed string, at int")


def align(a: list[str], b: list[str]) -> tuple[int, int, int]:
    """Smith-Waterman over words: (matched words, first, last word of ``a`` + 1) of the best local alignment.

    Of equal scores the one with most matched words is best, then that which
    starts last; of those the one that ends first in ``b``, then in ``a``. One
    row of cells is held: a cell carries its score, matched words and start in
    one number.
    """
    import numpy as np

    ids: dict[str, int] = {}
    x = np.array([ids.setdefault(w, len(ids)) for w in a], np.int64)
    kind = np.int64 if len(a) < 1 << 19 and len(b) < 1 << 19 else object  # beyond, a cell does not fit a machine word
    unit = 1 << 2 * SHIFT
    fresh = np.arange(len(a) + 1).astype(kind)
    steps = fresh * (-GAP * unit)
    row, best, end = fresh, 0, 0
    for w in b:
        step = np.where(x == ids.get(w, -1), MATCH * unit + (1 << SHIFT), MISMATCH * unit).astype(kind)
        now = np.maximum(row + GAP * unit, fresh)
        now[0] = 0
        now[1:] = np.maximum(now[1:], row[:-1] + step)
        # a gap in b carries a cell to the right, less GAP a word
        row = np.maximum.accumulate(now + steps) - steps
        j = int(row.argmax())
        if row[j] >> SHIFT > best >> SHIFT or (row[j] > best and best >> SHIFT):
            best, end = int(row[j]), j
    if not best >> SHIFT:
        return 0, 0, 0
    return (best >> SHIFT) & ((1 << SHIFT) - 1), best & ((1 << SHIFT) - 1), end


def score_places(words: list[str], item: list[str], starts, least: float = 0.0) -> tuple[float, int, int]:
    """The best share of the item's words aligned near any of the places where it would start, and the span.

    Places that cannot reach ``least`` are left out. Around a place as much as a
    third of the item's length is looked at on either side.
    """
    m, starts = len(item), sorted(set(starts))
    for s in starts:
        if s >= 0 and words[s : s + m] == item:
            return 1.0, s, s + m
    slack, best = max(4, m // 3), (0.0, 0, 0)
    need, at = Counter(item), 0
    while at < len(starts):
        # places that lie close are aligned together
        lo, hi = starts[at], starts[at]
        while at < len(starts) and starts[at] <= hi + slack and starts[at] - lo <= 2 * m:
            hi = starts[at]
            at += 1
        a, b = max(0, lo - slack), min(len(words), hi + m + slack)
        part = words[a:b]
        have = Counter(part)
        if sum(min(n, have[w]) for w, n in need.items()) < least * m - 1e-9:
            continue
        n, s, e = align(part, item)
        if n / m > best[0]:
            best = (n / m, a + s, a + e)
    return best


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id", least: float = LEAST, n: int = SEED_WORDS) -> DataFrame:
    """Rows (key, item_key, score, start_word, end_word): passages that copy an item.

    ``score`` is the share of the item's words that align in order, at least
    ``least``; one row for each document row and item row, at its best place.
    Words are runs of letters, digits and underscores, compared in lower case.
    Null and empty texts match nothing; repeated rows of documents or items are
    reported each; keys of both may be null or repeat; other columns are not
    read. Items without words are skipped. Texts and items are whole at any
    length; a copy is found if it holds a seed, which words put in between all
    others can prevent.
    """
    spark = docs.sparkSession
    small_batches(spark)
    keep = Stored(spark, "seeds")
    listed = keep(items.select(F.monotonically_increasing_id().alias("i"), F.col(item_key).alias("k"), F.col(item_text).alias("t")))
    grams = keep(_item_grams(listed, least, n))
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    schema = f"k {docs.schema[key].dataType.simpleString()}, item {items.schema[item_key].dataType.simpleString()}, score double, start_word long, end_word long"
    chars = listed.agg(F.sum(F.length("t"))).first()[0] or 0
    few = grams.limit(BROADCAST_SEEDS + 1).count() <= BROADCAST_SEEDS and chars <= BROADCAST_CHARS
    found = (_by_workers if few else _by_shuffle)(rows, listed, grams, least, schema, keep)
    return found.select(F.col("k").alias(key), F.col("item").alias(item_key), "score", "start_word", "end_word")


def _finder(seeds):
    """An automaton over whole-word n-grams."""
    import ahocorasick

    finder = ahocorasick.Automaton()
    for s in seeds:
        finder.add_word(f" {s} ", s)
    finder.make_automaton()
    return finder


def _emit(out: list, kind, item_kind):
    import pyarrow as pa

    c = list(zip(*out))
    return pa.RecordBatch.from_arrays([pa.array(c[0], kind), pa.array(c[1], item_kind), pa.array(c[2], pa.float64()), pa.array(c[3], pa.int64()), pa.array(c[4], pa.int64())], ["k", "item", "score", "start_word", "end_word"])


def _by_workers(rows: DataFrame, listed: DataFrame, grams: DataFrame, least: float, schema: str, keep: Stored) -> DataFrame:
    """Every worker holds the items, whose size was checked."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    spark = rows.sparkSession
    names = spark.sparkContext.broadcast(sorted(r[0] for r in grams.select("seed").distinct().collect()))

    def count(batches):
        release()
        sums: Counter = Counter()
        if names.value:
            finder = _finder(names.value)
            for b in batches:
                for t in b.column(0).to_pylist():
                    if t:
                        sums.update([s for _, s in finder.iter(line_of(t))])
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array(list(sums.values()), pa.int64())], ["seed", "c"])

    counts = rows.select("t").mapInArrow(count, "seed string, c long").groupBy("seed").agg(F.sum("c").alias("c"))
    seeds = [tuple(r) for r in item_seeds(grams, keep(counts)).select("i", "seed", "at").collect()]
    texts = {r["i"]: (r["k"], words_of((r["t"] or "").lower())) for r in listed.collect()}
    keep.drop()
    small = spark.sparkContext.broadcast((sorted(seeds), texts))
    item_kind = to_arrow_type(listed.schema["k"].dataType)

    def run(batches):
        release()
        listed, items = small.value
        places: dict[str, list] = {}
        for i, s, at in listed:
            places.setdefault(s, []).append((i, at))
        if not places:
            return
        finder = _finder(places)
        for b in batches:
            out = []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not t:
                    continue
                line = line_of(t)
                hits = sorted([(e - len(s) - 1, s) for e, s in finder.iter(line)])
                words = line.split(" ")[1:-1] if hits else []
                first, done, at = {}, 0, 0
                for c, s in hits:  # positions of words are counted only up to seeds
                    at += line.count(" ", done, c)
                    done = c
                    for i, off in places[s]:
                        first.setdefault(i, []).append(at - off)
                for i, starts in first.items():
                    name, item = items[i]
                    got = score_places(words, item, starts, least)
                    if got[0] >= least:
                        out.append((k, name, *got))
            if out:
                yield _emit(out, b.schema.field(0).type, item_kind)

    return rows.mapInArrow(run, schema)


def gram_hashes(words: list[str], n: int):
    """64-bit hashes of all n-grams of a list of words, signed."""
    import numpy as np
    import xxhash

    count = len(words) - n + 1
    if count < 1:
        return np.zeros(0, np.int64)
    h = np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), dtype=np.uint64, count=len(words))
    out = np.full(count, n, np.uint64)
    for i in range(n):
        out = (out ^ h[i : i + count]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def _by_shuffle(rows: DataFrame, listed: DataFrame, grams: DataFrame, least: float, schema: str, keep: Stored) -> DataFrame:
    """The texts' n-grams whose hash is in a table of fixed size join those of the items; then texts meet items."""
    import pandas as pd
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    spark = rows.sparkSession
    numbered = keep(rows.withColumn("row", F.monotonically_increasing_id()))

    def hash_of(seeds):
        return pd.Series([int(gram_hashes(s.split(" "), s.count(" ") + 1)[0]) for s in seeds], dtype="int64")

    hash_of.__annotations__ = {"seeds": pd.Series, "return": pd.Series}
    hashed = F.pandas_udf(hash_of, "long")

    own = keep(grams.withColumn("h", hashed("seed")))
    sizes = [r["c"] for r in own.select(F.size(F.split("seed", " ")).alias("c")).distinct().collect()]  # at most SEED_WORDS numbers
    bits = own.select(F.shiftrightunsigned("h", 64 - TABLE_BITS).alias("b")).select(F.shiftright("b", 6).alias("w"), F.expr("shiftleft(1L, cast(b & 63 as int))").alias("m"))
    marks = bits.groupBy("w").agg(F.bit_or("m").alias("m")).toPandas()  # at most 2 ** (TABLE_BITS - 6) rows
    shared = spark.sparkContext.broadcast((marks["w"].to_numpy("int64"), marks["m"].to_numpy("int64")))

    def run(batches):
        import numpy as np

        table = np.zeros(1 << TABLE_BITS - 6, np.uint64)
        table[shared.value[0]] = shared.value[1].view(np.uint64)
        for b in batches:
            for row, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = words_of((t or "").lower())
                for c in sizes:
                    h = gram_hashes(w, c)
                    at = h.view(np.uint64) >> np.uint64(64 - TABLE_BITS)
                    pos = np.flatnonzero(table[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1))
                    for a in range(0, len(pos), 50_000):
                        part = pos[a : a + 50_000]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), row)), pa.array(h[part]), pa.array(part, pa.int64())], ["row", "h", "pos"])

    hits = keep(numbered.select("row", "t").mapInArrow(run, "row long, h long, pos long").join(own.select("h").distinct(), "h", "left_semi"))
    counts = hits.groupBy("h").agg(F.count("*").alias("c")).join(own.select("h", "seed").distinct(), "h").select("seed", "c")
    seeds = keep(item_seeds(own.select("i", "at", "seed", "run"), counts).withColumn("h", hashed("seed")))
    met = hits.join(seeds.select("h", "i", "at"), "h").select("row", "i", (F.col("pos") - F.col("at")).alias("start"))
    places = met.groupBy("row", "i").agg(F.collect_set("start").alias("starts"))
    full = places.join(numbered, "row").join(listed.select("i", F.col("k").alias("item"), F.col("t").alias("it")), "i")
    item_kind = to_arrow_type(listed.schema["k"].dataType)

    def score(batches):
        for b in batches:
            out = []
            for k, t, item, it, starts in zip(*(b.column(i).to_pylist() for i in range(5))):
                got = score_places(words_of(t.lower()), words_of(it.lower()), starts, least)
                if got[0] >= least:
                    out.append((k, item, *got))
            if out:
                yield _emit(out, b.schema.field(0).type, item_kind)

    found = settle(full.select("k", "t", "item", "it", "starts").mapInArrow(score, schema))
    keep.drop()
    return found
