"""Shared pieces of the text operators."""

from __future__ import annotations

import os
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

#: Rows in an Arrow batch at most. Texts may be long; a batch is held whole.
BATCH_ROWS = 256
#: Entries that a worker's word table may hold before it starts afresh.
MEMO_ENTRIES = 700_000
#: Longer words are computed each time instead of being remembered.
MEMO_CHARS = 64


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows that are sent to a Python worker at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))


_held: dict[str, tuple] = {}


def hold(kind: str, mark, make):
    """What ``make`` loads, kept by a worker until another kind or mark is asked for: workers serve all operators in turn."""
    if _held.get(kind, (None,))[0] != mark:
        release()
        _held[kind] = (mark, make())
    return _held[kind][1]


def release() -> None:
    """Drop what a worker holds for another operator, and give the memory back."""
    import ctypes
    import gc

    gc.enable()
    if _held:
        _held.clear()
        gc.collect()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # only some C libraries have it
            pass


def forget_latest(*memos: dict, kept: int) -> None:
    """Keep the entries that came first: words that are frequent come early, those that came late may never come again."""
    for memo in memos:
        for w in list(memo)[kept:]:
            del memo[w]


def need(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns that an operator reads; others cannot clash."""
    return df.select(*names)


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def opened(path: str, mode: str):
    """Open a file in the shared folder: a plain path, file:// or any store that Arrow knows."""
    at = urlparse(path)
    if at.scheme in ("", "file"):
        if "w" in mode:
            os.makedirs(os.path.dirname(at.path), exist_ok=True)
        return open(at.path, mode)
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    if "w" in mode:
        store.create_dir(inner.rsplit("/", 1)[0])
        return store.open_output_stream(inner)
    return store.open_input_file(inner)


def publish(tmp: str, final: str) -> None:
    """Move a finished file to its name; a repeated task replaces it by the same bytes."""
    at = urlparse(tmp)
    if at.scheme in ("", "file"):
        os.replace(at.path, urlparse(final).path)
        return
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(tmp)
    store.move(inner, fs.FileSystem.from_uri(final)[1])
