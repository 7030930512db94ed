"""Language identification of mixed-language text.

Model: for each language, smoothed log-probabilities of the character 1- to
3-grams of words, learned here from labelled rows. A word's scripts (ranges of
code points) narrow its candidates to the languages that were seen to use them
all, or else one of them; a word in scripts that no language uses keeps all
candidates. Over a text's words, Viterbi finds the best sequence of languages under
a penalty for each switch; runs of one label are the spans. The text's language
is the one whose spans hold most letters; the score is their share.
"""

from __future__ import annotations

import gc
import json
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.llm._common import MEMO_CHARS, MEMO_ENTRIES, forget_latest, hold, small_batches

#: First code points of script ranges (fixed values, from the Unicode blocks).
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "burmese"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x1900, "other"), (0x1D00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x2E80, "han"), (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"),
    (0x31F0, "kana"), (0x3200, "han"), (0xA000, "other"), (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"),
    (0xFB00, "latin"), (0xFB13, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"), (0x323B0, "other"),
]
#: Words whose characters are all below this are Latin.
FIRST_OTHER = chr(SCRIPTS[1][0])
#: Share of a language's letters from which it counts as using a script.
SCRIPT_SHARE = 0.01
#: Pieces between blanks that a worker remembers at most.
WORDS_KEPT = 300_000
#: Characters in n-grams up to which the places of all n-grams are held in dense arrays.
DENSE = 160
#: Log-score of a language that is no candidate for a word: no switch costs as much.
NEVER = -1e6
#: Penalty for a switch between two words, in nats.
SWITCH = 14.0
#: Labelled rows that the model is learned from (expected number; drawn by a hash of the row).
TRAIN_ROWS = 6_000
#: n-grams kept for each language, the most frequent first; None keeps all that the sample holds.
MODEL_GRAMS = None


def script_of(ch: str) -> str:
    lo, hi, cp = 0, len(SCRIPTS), ord(ch)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if SCRIPTS[mid][0] <= cp else (lo, mid)
    return SCRIPTS[lo][1]


def letters(word: str) -> str:
    return word.lower() if word.isalpha() else "".join(c for c in word if c.isalpha()).lower()


def grams(word: str) -> list[str]:
    w = f" {word} "
    return [*word, *(w[i : i + 2] for i in range(len(w) - 1)), *(w[i : i + 3] for i in range(len(w) - 2))]


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows: int = TRAIN_ROWS, keep: int | None = MODEL_GRAMS) -> str:
    """The model as JSON, learned from at most about ``rows`` labelled rows.

    Rows without text or label are left out. Rows are drawn by a hash of their
    key and text, so the draw does not depend on order or partitions; a row that
    repeats counts once. The counts are
    made where the rows are, over whole words; the driver gets the n-grams, as
    many as the drawn rows hold (``keep`` bounds them for each language).
    Without any labelled row the model is empty.
    """
    import pyarrow as pa

    small_batches(docs.sparkSession)
    known = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    total = known.count()
    drawn = F.pmod(F.xxhash64(F.col(key).cast("string"), text), F.lit(1 << 30)) <= (1 << 30) * min(1.0, rows / max(total, 1))
    part = known.where(drawn).select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l")).distinct()

    def count(batches):
        from collections import Counter

        sums: dict[str, Counter] = {}
        for b in batches:
            for t, l in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                sums.setdefault(l, Counter()).update(w for w in map(letters, t.split()) if w)
            if sum(map(len, sums.values())) > MEMO_ENTRIES:
                yield from emit(sums)
                sums = {}
        yield from emit(sums)

    def emit(sums):
        from collections import Counter

        for l, words in sums.items():
            c: Counter = Counter()
            for w, n in words.items():
                for g in grams(w):
                    c[g] += n
                for ch in w:
                    c["#" + script_of(ch)] += n
            yield pa.RecordBatch.from_arrays([pa.array([l] * len(c)), pa.array(list(c)), pa.array(list(c.values()), pa.int64())], ["lang", "gram", "n"])

    from pyspark.sql import Window

    table = part.select("t", "l").mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    if keep is not None:
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
        table = table.withColumn("r", rank).where((F.col("r") <= keep) | F.col("gram").startswith("#"))
    got = table.select("lang", "gram", "n").toPandas()
    langs = sorted(set(got["lang"]))
    scripts: dict[str, list[str]] = {}
    probs: dict[str, list[float]] = {}
    for i, l in enumerate(langs):
        own = got[got["lang"] == l]
        is_script = own["gram"].str.startswith("#") & (own["gram"].str.len() > 3)
        use = own[is_script]
        for g, n in zip(use["gram"], use["n"]):
            if n >= SCRIPT_SHARE * use["n"].sum():
                scripts.setdefault(g[1:], []).append(l)
        for size in (1, 2, 3):
            rows_ = own[~is_script & (own["gram"].str.len() == size)]
            sum_ = float(rows_["n"].sum())
            for g, n in zip(rows_["gram"], rows_["n"]):
                probs.setdefault(g, [0.0] * len(langs))[i] = math.log((n + 0.5) / (sum_ + 0.5 * (len(rows_) + 1)))
            probs.setdefault(f"?{size}?floor", [0.0] * len(langs))[i] = math.log(0.5 / (sum_ + 0.5 * (len(rows_) + 1)))
    for g, v in probs.items():
        if not g.endswith("?floor"):
            floor = probs[f"?{len(g)}?floor"]
            probs[g] = [x if x else f for x, f in zip(v, floor)]
    return json.dumps({"langs": langs, "scripts": scripts, "probs": probs})


class _Rows(dict):
    """Row of an n-gram in the table; that of unseen ones if it has none."""

    def __init__(self, floor: int, rows):
        super().__init__(rows)
        self.floor = floor

    def __missing__(self, gram: str) -> int:
        return self.floor


class Labeller:
    """Scores of words under a model, and the best labelling of a text."""

    def __init__(self, model: str, switch: float = SWITCH):
        import numpy as np

        spec = json.loads(model)
        self.langs, self.switch = spec["langs"], switch
        at = {g: i for i, g in enumerate(spec["probs"])}
        self.table = np.array(list(spec["probs"].values())).reshape(len(at), len(self.langs))
        floors = [at.pop(f"?{k}?floor", 0) for k in (1, 2, 3)]
        self.gram_rows = [_Rows(f, ((g, i) for g, i in at.items() if len(g) == k)) for k, f in zip((1, 2, 3), floors)]
        self.uses = {s: np.array([l in ls for l in self.langs]) for s, ls in spec["scripts"].items()}
        self.narrowed: dict[frozenset, object] = {}
        self._dense()
        self.reset()

    def reset(self) -> None:
        import numpy as np

        self.at: dict[str, int] = {}
        self.by_letters: dict[str, int] = {"": 0}
        self.rows = np.zeros((1024, len(self.langs)))
        self.size = np.zeros(1024, np.int64)
        self.used = 1

    def forget(self) -> None:
        """Keep the pieces that came first, and the words up to theirs: those that are frequent come early."""
        forget_latest(self.at, kept=WORDS_KEPT // 2)
        self.used = max(self.at.values(), default=0) + 1
        for w in [w for w, i in self.by_letters.items() if i >= self.used]:
            del self.by_letters[w]

    def candidates(self, scripts: frozenset[str]):
        """Which languages a word in these scripts may be in."""
        import numpy as np

        got = self.narrowed.get(scripts)
        if got is None:
            known = [self.uses[s] for s in scripts if s in self.uses]
            got = np.logical_and.reduce(known) if known else np.ones(len(self.langs), bool)
            if not got.any():
                got = np.logical_or.reduce(known)
            self.narrowed[scripts] = got
        return got

    def _dense(self) -> None:
        """Rows of n-grams by numbers of their characters, in arrays; characters of no n-gram have number 0."""
        import numpy as np

        chars = sorted({c for r in self.gram_rows for g in r for c in g} | {" "})
        self.numbers = None
        if len(chars) >= DENSE:
            return
        self.numbers, n = np.zeros(0x110000, np.uint8), len(chars) + 1
        self.numbers[[ord(c) for c in chars]] = range(1, n)
        self.places = []
        for size, rows in enumerate(self.gram_rows, 1):
            place = np.full((n,) * size, rows.floor, np.int32)
            for g, i in rows.items():
                place[tuple(int(self.numbers[ord(c)]) for c in g)] = i
            self.places.append(place.ravel())

    def _sums(self, new: list[str]):
        """For each word, the sum of its n-grams' rows over 3: single characters, then pairs and triples of the word between two blanks."""
        import numpy as np

        if self.numbers is None:
            one, two, three = (r.__getitem__ for r in self.gram_rows)
            flat, starts = [], []
            for w in new:
                starts.append(len(flat))
                x = f" {w} "
                flat += map(one, w)
                flat += map(two, [x[i : i + 2] for i in range(len(x) - 1)])
                flat += map(three, [x[i : i + 3] for i in range(len(x) - 2)])
            return np.add.reduceat(self.table[flat], starts, axis=0) / 3
        n = np.fromiter(map(len, new), np.int64, len(new))
        x = self.numbers[np.frombuffer(f" {'  '.join(new)} ".encode("utf-32-le", "surrogatepass"), "<u4")].astype(np.int32)
        k = self.places[0].size
        # of a word of n characters: n single ones, n + 1 pairs and n triples, in this order
        first = np.cumsum(np.concatenate([[0], n[:-1] + 2]))
        starts = np.cumsum(np.concatenate([[0], 3 * n[:-1] + 1]))
        flat = np.empty(int((3 * n + 1).sum()), np.int32)
        pair = x[:-1] * k + x[1:]
        for place, ids, lead, count, before in ((0, x, 1, n, 0 * n), (1, pair, 0, n + 1, n), (2, pair[:-1] * k + x[2:], 0, n, 2 * n + 1)):
            step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            flat[np.repeat(starts + before, count) + step] = self.places[place][ids[np.repeat(first + lead, count) + step]]
        return np.add.reduceat(self.table[flat], starts, axis=0) / 3

    def learn(self, chunks: set[str]) -> None:
        """Score new words together: their n-grams' rows are added up in one pass."""
        import numpy as np

        own = {c: letters(c) for c in chunks}
        new = list({w for w in own.values() if w not in self.by_letters})
        if new:
            s = self._sums(new)
            latin = self.candidates(frozenset(["latin"]))
            out = np.array([latin if max(w) < FIRST_OTHER else self.candidates(frozenset(map(script_of, w))) for w in new]).reshape(s.shape)
            s -= np.where(out, s, NEVER).max(axis=1, keepdims=True)
            s[~out] = NEVER
            end = self.used + len(new)
            while end > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                self.size = np.concatenate([self.size, np.zeros_like(self.size)])
            self.rows[self.used : end] = s
            self.size[self.used : end] = [len(w) for w in new]
            self.by_letters.update(zip(new, range(self.used, end)))
            self.used = end
        self.at.update((c, self.by_letters[w]) for c, w in own.items())

    def spans(self, words: list[str]):
        """(first words of the spans, their languages, letters of each word), by Viterbi."""
        import numpy as np

        ids = np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))
        s, size = self.rows[ids], self.size[ids]
        if not size.any():
            return [], [], size
        lead = int(s.sum(axis=0).argmax())
        if len(self.langs) > 1:
            # no run of words gains the price of one switch by leaving the lead: then the best path never leaves it
            gain = np.delete(s, lead, axis=1).max(axis=1) - s[:, lead]
            total = np.concatenate([[0.0], np.cumsum(gain)])
            if (total - np.minimum.accumulate(total)).max() > self.switch:
                return (*self._viterbi(s), size)
        return [0], [lead], size

    def _viterbi(self, s):
        # few languages: plain numbers are quicker than arrays
        switch, came = self.switch, []
        rows = s.tolist()
        v = rows[0]
        stay = list(range(len(v)))
        for row in rows[1:]:
            top = max(v)
            jump = top - switch
            if min(v) >= jump:
                came.append(stay)
                v = [x + y for x, y in zip(v, row)]
            else:
                b = v.index(top)
                came.append([i if x >= jump else b for i, x in enumerate(v)])
                v = [(x if x >= jump else jump) + y for x, y in zip(v, row)]
        path = [v.index(max(v))]
        for c in reversed(came):
            path.append(c[path[-1]])
        path.reverse()
        starts = [0, *(i for i in range(1, len(path)) if path[i] != path[i - 1])]
        return starts, [path[i] for i in starts]

    def label(self, texts: list[str | None]):
        """For each text: (language or None, share of the letters, spans as (first word, language))."""
        import numpy as np

        split = [t.split() if t else [] for t in texts]
        if len(self.at) > WORDS_KEPT:
            self.forget()
        if self.langs:
            self.learn({w for s in split for w in s if w not in self.at})
        out = []
        for words in split:
            starts, labels, size = self.spans(words) if words and self.langs else ([], [], None)
            if not starts:
                out.append((None, 0.0, []))
                continue
            by = np.bincount(labels, weights=np.add.reduceat(size, starts), minlength=len(self.langs))
            best = int(by.argmax())
            out.append((self.langs[best], float(by[best] / by.sum()), [(int(a), self.langs[b]) for a, b in zip(starts, labels)]))
        for w in {w for s in split for w in s if len(w) > MEMO_CHARS}:  # long words are not kept
            self.by_letters.pop(letters(w) or None, None)
            self.at.pop(w, None)
        return out


def predict(docs: DataFrame, model: str, text: str = "text", key: str = "doc_id", switch: float = SWITCH, spans: bool = True) -> DataFrame:
    """Rows (key, lang_pred, score, n_spans, spans), one for each input row; without ``spans`` that column is left out.

    ``lang_pred`` is a learned language, or ``und`` (score 0, no spans) if the
    text is null, empty or has no letter, or if nothing was learned. Equal
    scores go to the language that is first by name. Null keys and repeated
    rows are kept; other columns are not read. ``spans`` is an array of (start:
    first word from 0, lang).
    """
    import pyarrow as pa

    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the rows it was learned from
    mark = hash((model, switch))

    def run(batches):
        label = hold("labeller", mark, lambda: Labeller(shared.value, switch)).label
        gc.disable()  # the word tables are large and hold no cycles
        span = pa.list_(pa.struct([("start", pa.int32()), ("lang", pa.string())]))
        for b in batches:
            got = label(b.column(1).to_pylist())
            out = [b.column(0), pa.array([g[0] or "und" for g in got]), pa.array([g[1] for g in got], pa.float64()), pa.array([len(g[2]) for g in got], pa.int32())]
            if spans:
                out.append(pa.array([[{"start": a, "lang": l} for a, l in g[2]] for g in got], span))
            yield pa.RecordBatch.from_arrays(out, names)
        gc.enable()

    own = T.StructField("k", docs.schema[key].dataType)
    made = T.StructType([own, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("n_spans", T.IntegerType())])
    if spans:
        made.add("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("lang", T.StringType())])))
    names = made.names
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, made).withColumnRenamed("k", key)


def held_out(key: str = "doc_id"):
    """Rows that are never learned from: crc32 of the key as text, mod 5, is 0."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0
