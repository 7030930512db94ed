"""Token counts by the whole-token shortcut.

The vocabulary is a sentencepiece BPE model. Before any text is read, three facts
are proved from the model file alone:

0. Its normaliser maps no character, keeps all spaces, writes them as the
   word-boundary mark and puts one before the text; the mark stands before words.
1. No piece holds the word-boundary mark after another character, so no merge
   ever crosses from a word into the mark that starts the next one. A text's
   count is the sum over its pre-tokens (a run of marks and what follows).
2. Which pieces encode alone as exactly one token. A pre-token that is such a
   piece counts one, without any merge.

Only other pre-tokens are merged, by the library, once per worker while they
stay in its bounded table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm._common import MEMO_CHARS, MEMO_ENTRIES, hold, small_batches, tokenizer_path

#: The model's word-boundary mark.
MARK = "▁"


#: Field numbers of the model file (fixed values, from the published message format).
PIECES, TRAINER, NORMALISER = 1, 2, 3
PIECE_KIND, USER_DEFINED, MARK_AFTER_WORDS = 3, 4, 24
CHARACTER_MAP, MARK_BEFORE_TEXT, FEWER_SPACES, SPACES_AS_MARK = 2, 3, 4, 5


def fields(raw: bytes) -> dict[int, list]:
    """A message's fields: number -> values in order (integers, or bytes of strings and messages)."""
    at, out = 0, {}

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(raw):
        tag = number()
        if tag & 7 == 0:
            value = number()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or number()
            value, at = raw[at : at + size], at + size
        out.setdefault(tag >> 3, []).append(value)
    return out


def takes_texts_as_they_are(raw: bytes) -> bool:
    """Whether a model file's settings leave all characters and spaces, put one mark before the text, and cut no word by strings of its own."""
    model = fields(raw)
    last = lambda spec, field, default: spec.get(field, [default])[-1]
    normal, trainer = fields(last(model, NORMALISER, b"")), fields(last(model, TRAINER, b""))
    own = any(last(fields(p), PIECE_KIND, 1) == USER_DEFINED for p in model.get(PIECES, []))
    kept = not last(normal, CHARACTER_MAP, b"") and not last(normal, FEWER_SPACES, 1)
    return kept and bool(last(normal, MARK_BEFORE_TEXT, 1) and last(normal, SPACES_AS_MARK, 1)) and not last(trainer, MARK_AFTER_WORDS, 0) and not own


class PreTokenCounts(dict):
    """Pre-token without its leading mark -> number of tokens."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        plain = [p for i, p in enumerate(pieces) if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))]
        with open(model_path, "rb") as f:
            self.splits = not any(MARK in p.lstrip(MARK) for p in plain) and takes_texts_as_they_are(f.read())
        words = [p[1:] for p in plain if p.startswith(MARK) and len(p) > 1 and MARK not in p[1:]]
        self.single = {w for w, ids in zip(words, self.model.encode(words, num_threads=1), strict=True) if len(ids) == 1}
        super().__init__(dict.fromkeys(self.single, 1))

    def __missing__(self, word: str) -> int:
        n = len(self.model.encode(word)) if word else 1
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES + len(self.single):
                self.clear()
                self.update(dict.fromkeys(self.single, 1))
            self[word] = n
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.splits:
            return len(self.model.encode(text))
        text = text.replace(MARK, " ")
        if text[0] == " " or "  " in text:
            words = [u[1:] for u in re.findall(" +[^ ]*", " " + text)]
        else:
            words = text.split(" ")
        return sum(map(self.__getitem__, words))


def counter(model_path: str) -> PreTokenCounts:
    return hold("pre-tokens", model_path, lambda: PreTokenCounts(model_path))


def count_tokens(docs: DataFrame, text: str = "text", key: str = "doc_id", model_path: str | None = None, limit: int = 4096) -> DataFrame:
    """Rows (key, n_bytes, n_tokens, over_limit), one for each input row.

    Null and empty texts have 0 bytes and 0 tokens; a null key stays null and
    repeated rows are counted each. Other columns are not read. Texts of any
    length are counted whole: memory is one text and the bounded word table.
    """
    import pyarrow as pa

    path = model_path or tokenizer_path("piece_bpe_32k.model")
    small_batches(docs.sparkSession)

    def run(batches):
        count = counter(path).count
        for b in batches:
            n = pa.array([count(t) for t in b.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), n], ["k", "n_bytes", "n_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"))
    out = rows.mapInArrow(run, f"k {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("k").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
