import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.llm import arrow_ids, bpe_trie, token_counts
from corvane.llm._common import tokenizer_path


def rows(df, *cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


def test_counts_equal_the_library(odd, texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    want = Counter((k, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 4096) for k, t in texts)
    assert rows(token_counts.count_tokens(odd), "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert token_counts.count_tokens(odd.limit(0)).count() == 0


def test_counts_of_odd_spacing():
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    sp, own = sentencepiece.SentencePieceProcessor(model_file=path), token_counts.counter(path)
    assert own.splits and len(own.single) > 10_000
    rnd = random.Random(1)
    for _ in range(3000):
        t = "".join(rnd.choice(["a", "the", " ", "  ", "\n", "▁", "é", "日", "1", "<s>", "\0", "<0x0A>", "."]) for _ in range(rnd.randint(0, 9)))
        assert own.count(t) == len(sp.encode(t)), repr(t)


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(name))


def test_trie_bpe_equals_the_library(odd, texts):
    lib = library("word_bpe_49k.json")
    sha = lambda b: hashlib.sha256(b).hexdigest()

    def one(k, t):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        return k, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(lib.decode(ids, skip_special_tokens=False).encode())

    assert rows(bpe_trie.encode_decode(odd, digests=True), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == Counter(one(k, t) for k, t in texts)
    full = bpe_trie.encode_decode(odd).where("doc_id = 1").first()
    assert full["ids"] == lib.encode(texts[0][1], add_special_tokens=False).ids and full["decoded"].startswith("the</w> quick</w>")
    assert bpe_trie.encode_decode(odd.limit(0)).count() == 0


def test_trie_bpe_on_random_words():
    lib, own = library("word_bpe_49k.json"), bpe_trie.codec(tokenizer_path("word_bpe_49k.json"))
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdefgeinotrsthéüñ") for _ in range(rnd.randint(1, 14))) for _ in range(4000)] + ["a" * 40, "ha" * 30, "'s't", "x'll"]
    for w, (ids, decoded) in zip(words, own.encode(words)):
        want = lib.encode(w, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want and decoded.decode() == lib.decode(want, skip_special_tokens=False), w


def test_trie_shares_prefixes():
    bpe = bpe_trie.TrieBpe({"a": 0, "b": 1, "a</w>": 2, "b</w>": 3, "ab": 4, "ab</w>": 5, "abab</w>": 6}, [["a", "b"], ["a", "b</w>"], ["ab", "ab</w>"]])
    assert bpe.encode_words({"abab", "aba", "ab", "b", "bb"}) == {"abab": [6], "aba": [4, 2], "ab": [5], "b": [3], "bb": [1, 3]}


def test_sequences_round_trip(spark, tmp_path, texts):
    keyed = [(k, t) for k, t in dict(texts).items() if k is not None]
    docs = spark.createDataFrame([(k, t, 1) for k, t in keyed], "doc_id long, text string, start long").repartition(5)
    lib, root = library("byte_bpe_50k.json"), str(tmp_path / "seq")
    files = arrow_ids.write_sequences(docs, root, length=64)
    got = {r["key"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in arrow_ids.read_sequences(files).collect()}
    start, want = 0, {}
    for k, t in sorted(keyed):
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want[k] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert got == want
    f = max(files.collect(), key=lambda r: r["ids"])
    seq = arrow_ids.SequenceFile(f["file"] + ".arrow")
    ids, mask = seq.sequence(0)
    assert len(ids) == len(mask) == 64 and not ids.flags.owndata and mask.true_count == 64
    assert arrow_ids.sequence_index(docs.limit(0)).count() == 0


def test_sequences_of_odd_rows(odd, texts):
    got = arrow_ids.sequence_index(odd).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(k for k, _ in texts)
    ends = sorted((r["start"], r["start"] + r["n_tokens"]) for r in got)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


def test_word_cutting_equals_the_library():
    lib, own = library("byte_bpe_50k.json"), arrow_ids.encoder(tokenizer_path("byte_bpe_50k.json"))
    rnd = random.Random(4)
    parts = ["a", "b", "'s", " ", "  ", "   ", "\n", " \n", "\n ", "\t", ".", "é", "<|endoftext|>", "12", "\x1c", "🙂"]
    made = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 12))) for _ in range(4000)]
    for t, ids in zip(made, own.encode(made)):
        assert np.frombuffer(ids, own.kind).tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_letters_are_the_librarys_own():
    lib, own = library("word_bpe_49k.json"), bpe_trie.codec(tokenizer_path("word_bpe_49k.json"))
    points = [c for c in [*range(0x20000), *range(0x20000, 0x110000, 97)] if not 0xD800 <= c < 0xE000]
    unlike = []
    for at in range(0, len(points), 2000):
        part = [f"a{chr(c)}b {chr(c)}1{chr(c)} x" for c in points[at : at + 2000]]
        got = [np.frombuffer(i, "<u4").tolist() for i, _ in own.encode(part)]
        unlike += [t for t, ids, e in zip(part, got, lib.encode_batch(part, add_special_tokens=False)) if ids != e.ids]
    assert not unlike, unlike[:5]


def test_mixed_texts_with_new_letters():
    lib, own = library("word_bpe_49k.json"), bpe_trie.codec(tokenizer_path("word_bpe_49k.json"))
    rnd = random.Random(7)
    parts = ["a", "Z", "é", "\u0301", "\u1c89", "\ua7cb", "\U000105c0", "\U00010d50", "ΑΣ", "ς", "İ", "ﬁ", "½", "\x1c", "\u00a0", "\u2028", " ", "1", "٣", "'s", "<|endoftext|>", "🙂", "\u0378", "\u212b", "가", "\u1100\u1161"]
    made = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14))) for _ in range(3000)]
    for t, (ids, decoded) in zip(made, own.encode(made)):
        want = lib.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want and decoded.decode() == lib.decode(want, skip_special_tokens=False), repr(t)


def test_normaliser_is_read_from_the_model_file():
    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as f:
        raw = f.read()
    assert token_counts.takes_texts_as_they_are(raw)
    model = token_counts.fields(raw)
    assert len(model[token_counts.PIECES]) == 32_000
    field = lambda n, b: bytes([n << 3 | 2, len(b)]) + b
    kept, piece = bytes([4 << 3, 0]), field(1, b"x")
    assert token_counts.takes_texts_as_they_are(field(3, kept))
    for bad in (b"", kept + field(2, b"map"), kept + bytes([3 << 3, 0]), kept + bytes([5 << 3, 0])):
        assert not token_counts.takes_texts_as_they_are(field(3, bad))
    assert not token_counts.takes_texts_as_they_are(field(3, kept) + field(1, piece + bytes([3 << 3, 4])))
    assert not token_counts.takes_texts_as_they_are(field(3, kept) + field(2, bytes([0xC0, 0x01, 1])))


def test_sequences_of_repeated_and_null_keys(odd, texts):
    lib = library("byte_bpe_50k.json")
    got = Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in arrow_ids.sequence_index(odd).collect())
    ids = [np.array(lib.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for _, t in texts]
    assert got == Counter((k, len(i), zlib.crc32(i.tobytes())) for (k, _), i in zip(texts, ids))
