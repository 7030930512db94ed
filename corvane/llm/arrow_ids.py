"""Token ids in Arrow files of equal-length sequences.

Documents are dealt by range of their key, so a task holds a contiguous run of
them, sorted. It encodes each, appends the end id, and packs the ids end to end
into sequences of one length. A file is an Arrow IPC file of record batches
with two fixed-size-list columns: ``ids`` (unsigned 16- or 32-bit) and ``mask``
(bits: set for an id, not for the filling of a file's last sequence). Batches lie in the
file uncompressed, so a reader maps it and reaches sequence i by arithmetic
without copying. The second half of the format is an index file beside it (the
same name, ``.index``): an Arrow file of one row per document, (key, start in the
file, ids with the end id), from which starts and counts are read. The offsets of files come from one number for each file.
"""

from __future__ import annotations

import uuid
import zlib
from array import array

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm._common import MEMO_CHARS, forget_latest, hold, opened, publish, small_batches, tokenizer_path
from corvane.runtime import parts_for, scratch, settle

#: Ids in a sequence, and sequences in a record batch.
LENGTH, BATCH = 2048, 64
#: Bytes of stored input for each file.
TASK_BYTES = 64 << 20
#: Words that a worker remembers at most.
WORDS_KEPT = 700_000


#: The vocabulary's word pattern (fixed value, from its published definition).
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: ASCII white space other than the space itself.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"


class Encoder:
    """Ids of whole texts by the tokenizers library, word by word.

    The vocabulary's words never hold a space that stands between two other
    characters anywhere but at their start. So a text is cut at such spaces and
    each part's ids are remembered. A new part is cut by the word pattern, and
    the library encodes the words that are new; a part that holds a special
    string goes to the library whole.
    """

    def __init__(self, path: str):
        import re

        import numpy as np
        import regex
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_padding()
        self.model.no_truncation()
        self.kind = np.dtype("<u2" if self.model.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.beside = tuple(p for c in " " + BLANKS for p in (" " + c, c + " "))
        self.crowded = re.compile(r" \s|\s ").search
        self.cut = re.compile(r"(?<=\S) (?=\S)").split
        self.words = regex.compile(WORD).findall
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def parts(self, text: str) -> list[str]:
        """The text cut at spaces between other characters; all but the first part had a space before them."""
        if text[0] == " " or text[-1] == " " or (any(p in text for p in self.beside) if text.isascii() else self.crowded(text)):
            return self.cut(text)
        return text.split(" ")

    def _library(self, texts: list[str]):
        """(text, ids) of each text. Texts of a space and letters are encoded many at once: the pattern cuts their join at the spaces."""
        plain = [t for t in texts if t[0] == " " and t[1:].isalpha()]
        other = [t for t in texts if not (t[0] == " " and t[1:].isalpha())]
        for at in range(0, len(plain), 4_000):
            part = plain[at : at + 4_000]
            e = self.model.encode("".join(part), add_special_tokens=False)
            ids, starts = array(self.code, e.ids), [0]
            last = 0
            for i, w in enumerate(e.word_ids):
                if w != last:
                    starts.append(i)
                    last = w
            if len(starts) != len(part):  # never seen; a text that the pattern cuts further is encoded alone
                other += part
                continue
            starts.append(len(ids))
            for t, x, y in zip(part, starts, starts[1:]):
                yield t, ids[x:y].tobytes()
        for at in range(0, len(other), 20_000):
            for t, e in zip(other[at : at + 20_000], self.model.encode_batch_fast(other[at : at + 20_000], add_special_tokens=False)):
                yield t, array(self.code, e.ids).tobytes()

    def _learn(self, memo: dict[str, bytes], new: set[str], lead: str, special: bool) -> None:
        whole = {w for w in new if any(s in w for s in self.special)} if special else ()
        memo.update((t[len(lead) :], i) for t, i in self._library([lead + w for w in whole]))
        cut = {w: self.words(lead + w) for w in new if w not in whole}
        known = self.pieces
        missing = list({p for ps in cut.values() for p in ps if p not in known})
        if len(known) + len(missing) > WORDS_KEPT:
            forget_latest(known, kept=WORDS_KEPT // 2)
            missing = list({p for ps in cut.values() for p in ps})
        known.update(self._library(missing))
        memo.update((w, known[ps[0]] if len(ps) == 1 else b"".join([known[p] for p in ps])) for w, ps in cut.items())
        for p in missing:
            if len(p) > MEMO_CHARS:
                del known[p]

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.parts(t) if t else [] for t in texts]
        special = any(s in t for t in texts for s in self.special if t)
        heads, tails = [s[:1] for s in split], [s[1:] for s in split]
        out = []
        for memo, rows, lead in ((self.first, heads, ""), (self.later, tails, " ")):
            new = set().union(*rows).difference(memo)
            if len(memo) + len(new) > WORDS_KEPT:
                forget_latest(memo, kept=WORDS_KEPT // 2)
                new = set().union(*rows)
            self._learn(memo, new, lead, special)
            out.append([b"".join(map(memo.__getitem__, s)) for s in rows])
            for w in new:
                if len(w) > MEMO_CHARS:
                    del memo[w]
        return [a + b for a, b in zip(*out)]


def encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return hold("byte bpe", path, lambda: Encoder(path))


class SequenceWriter:
    """Packs runs of ids into sequences and writes full batches as they come."""

    def __init__(self, sink, kind, length: int = LENGTH, batch: int = BATCH):
        import numpy as np
        import pyarrow as pa

        self.length, self.kind, self.room = length, kind, np.empty(length * batch, kind)
        self.at = self.total = 0
        value = pa.uint16() if kind.itemsize == 2 else pa.uint32()
        self.schema = pa.schema([("ids", pa.list_(pa.field("item", value, nullable=False), length)), ("mask", pa.list_(pa.field("item", pa.bool_(), nullable=False), length))])
        self.file = pa.ipc.new_file(sink, self.schema)

    def add(self, ids) -> None:
        self.total += len(ids)
        while len(ids):
            n = min(len(ids), len(self.room) - self.at)
            self.room[self.at : self.at + n] = ids[:n]
            self.at, ids = self.at + n, ids[n:]
            if self.at == len(self.room):
                self._flush()

    def _flush(self) -> None:
        import numpy as np
        import pyarrow as pa

        rows = -(-self.at // self.length)
        flat = self.room[: rows * self.length].copy()
        flat[self.at :] = 0
        mask = np.zeros(len(flat), bool)
        mask[: self.at] = True
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((flat, mask), self.schema)]
        self.file.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.at = 0

    def close(self) -> None:
        if self.at:
            self._flush()
        self.file.close()


class SequenceFile:
    """Random access to a file's sequences over a memory map (or a read-only buffer of a remote file)."""

    def __init__(self, path: str, first: int | None = None):
        import pyarrow as pa

        at = path.removeprefix("file://")
        if "://" in at:
            with opened(path, "rb") as f:
                source = pa.BufferReader(pa.py_buffer(f.read()))
        else:
            source = pa.memory_map("/" + at.lstrip("/") if path.startswith("file:") else at)
        self.file = pa.ipc.open_file(source)
        self.length = self.file.schema.field("ids").type.list_size
        self.held = (-1, None, None)
        self.rows = self.file.get_batch(0).num_rows if self.file.num_record_batches else 0

    def _flat(self, batch: int):
        """(ids, mask) of a record batch end to end: views of the map."""
        b = self.file.get_batch(batch)
        return b.column(0).flatten().to_numpy(zero_copy_only=True), b.column(1).flatten()

    def sequence(self, i: int):
        """(ids as an array, mask as an Arrow array of bits) of the i-th sequence, without copying."""
        b, r = divmod(i, self.rows)
        ids, mask = self._flat(b)
        return ids[r * self.length : (r + 1) * self.length], mask.slice(r * self.length, self.length)

    def ids(self, start: int, stop: int):
        """The ids at [start, stop) of the file, all under the mask."""
        import numpy as np

        wide, parts = self.rows * self.length, []
        while start < stop:
            b, o = divmod(start, wide)
            if self.held[0] != b:
                self.held = (b, *self._flat(b))
            _, ids, mask = self.held
            n = min(stop - start, wide - o)
            if mask.slice(o, n).true_count != n:
                raise ValueError("masked ids inside a document")
            parts.append(ids[o : o + n])
            start += n
        return np.concatenate(parts) if len(parts) != 1 else parts[0]


def write_sequences(docs: DataFrame, path: str | None = None, text: str = "text", key: str = "doc_id", vocabulary: str | None = None, end_id: int = 0, length: int = LENGTH) -> DataFrame:
    """Write the files; rows (file, part, docs, ids, offset), one for each file.

    Documents stand in ascending order of their key over the files in order of
    ``part`` (null keys first; repeated keys in any order among themselves).
    Null and empty texts are the end id alone. An empty table writes no file.
    A lost task writes its file again, and a file gets its name only when whole.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    vocab = vocabulary or tokenizer_path("byte_bpe_50k.json")
    root = path or scratch(spark, "sequences")
    small_batches(spark)

    def run(batches):
        import gc

        import numpy as np
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        name, mark = f"{root}/part-{part:06d}", uuid.uuid4().hex
        enc, writer, keys, counts, sink = None, None, [], [], None
        for b in batches:
            if not b.num_rows:
                continue
            if writer is None:
                enc = encoder(vocab)
                gc.disable()  # the word tables are large and hold no cycles; passes over them would take a fifth of the time
                sink = opened(f"{name}.arrow.{mark}", "wb")
                writer = SequenceWriter(sink, enc.kind, length)
            for k, raw in zip(b.column(0).to_pylist(), enc.encode([t or "" for t in b.column(1).to_pylist()])):
                ids = np.append(np.frombuffer(raw, enc.kind), enc.kind.type(end_id))
                writer.add(ids)
                keys.append(k)
                counts.append(len(ids))
        gc.enable()
        if writer is None:
            return
        writer.close()
        sink.close()
        starts = np.cumsum([0, *counts])[:-1]
        with opened(f"{name}.index.{mark}", "wb") as sink, pa.ipc.new_file(sink, pa.schema([("key", b.schema.field(0).type), ("start", pa.int64()), ("n", pa.int64())])) as f:
            f.write_table(pa.table([pa.array(keys, b.schema.field(0).type), starts, counts], schema=f_schema(b)))
        publish(f"{name}.arrow.{mark}", f"{name}.arrow")
        publish(f"{name}.index.{mark}", f"{name}.index")
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([part], pa.int32()), pa.array([len(keys)], pa.int64()), pa.array([writer.total], pa.int64())], ["file", "part", "docs", "ids"])

    def f_schema(b):
        return pa.schema([("key", b.schema.field(0).type), ("start", pa.int64()), ("n", pa.int64())])

    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    n = parts_for(docs, TASK_BYTES)
    done = settle(rows.repartitionByRange(n, "k").sortWithinPartitions("k").mapInArrow(run, "file string, part int, docs long, ids long"))
    # one number for each file, as many as partitions
    sums, offset = [], 0
    for r in sorted(done.collect(), key=lambda r: r["part"]):
        sums.append((r["file"], r["part"], r["docs"], r["ids"], offset))
        offset += r["ids"]
    return spark.createDataFrame(sums, "file string, part int, docs long, ids long, offset long")


def read_sequences(files: DataFrame, key_type: str = "long") -> DataFrame:
    """Rows (key, start, n_tokens, ids_crc32), read from the files that ``write_sequences`` named."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            for name, offset in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with opened(f"{name}.index", "rb") as f:
                    index = pa.ipc.open_file(pa.BufferReader(f.read())).read_all()
                seq = SequenceFile(f"{name}.arrow")
                for at in range(0, index.num_rows, 4096):
                    part = index.slice(at, 4096)
                    starts, counts = part.column("start").to_pylist(), part.column("n").to_pylist()
                    crc = [zlib.crc32(seq.ids(s, s + n).astype("<u4").tobytes()) for s, n in zip(starts, counts)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("key").combine_chunks(), pa.array([s + offset for s in starts], pa.int64()), pa.array(counts, pa.int64()), pa.array(crc, pa.int64())],
                        ["key", "start", "n_tokens", "ids_crc32"],
                    )

    n = max(1, files.count())
    return files.select("file", "offset").repartition(n).mapInArrow(run, f"key {key_type}, start long, n_tokens long, ids_crc32 long")


def sequence_index(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """Write all documents and return what the files hold: (key, start, n_tokens, ids_crc32)."""
    return read_sequences(write_sequences(docs, text=text, key=key, **options), docs.schema[key].dataType.simpleString()).withColumnRenamed("key", key)
