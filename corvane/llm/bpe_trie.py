"""BPE encoding and decoding over a trie of distinct words.

Every prefix of a symbol sequence has one BPE encoding, and that encoding is
fixed by its last token and the encoding of what stands before it. So a trie of
distinct words needs one state for each node, the last token of its prefix: of
the tokens that end at the node, it is the one whose junction with the state of
the node before it would be left alone by the merges. Depth-first propagation
fills the states once for a shared prefix; a word's ids are read back along its
path. Junctions are decided by running the merges over the two tokens alone and
are remembered.

The word end is part of a word's last symbol, so each word adds one end state
to the node of its symbols before the last.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm._common import MEMO_CHARS, forget_latest, hold, small_batches, tokenizer_path

#: Words that a worker remembers at most.
WORDS_KEPT = 250_000
#: Junctions of two tokens that a worker remembers at most.
JOINS_KEPT = 250_000
#: The word pattern that the quicker engine can stand in for.
PLAIN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself if it is printable Latin-1, else the next from U+0100."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    own = set(kept)
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class TrieBpe:
    """BPE with a word-end suffix: ``vocab`` (token -> id), ``merges`` in rank order."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str = "</w>", reached: frozenset[int] | None = None):
        """``reached``: ids of the tokens that the merges make of their own symbols, if they are known already."""
        self.vocab, self.suffix = vocab, suffix
        self.rank = {(m.split(" ") if isinstance(m, str) else m)[0] + "\0" + (m.split(" ") if isinstance(m, str) else m)[1]: i for i, m in enumerate(merges)}
        self.name = {i: t for t, i in vocab.items()}
        self.size = {i: len(t) for t, i in vocab.items()}
        self.made = {x + y: (x, y) for x, y in (k.split("\0") for k in self.rank)}
        k = len(suffix)
        # what tokens end with -> id of the token that is just that, or -1; tokens that the merges never make are left out
        self.final, self.inner = {}, {}
        for t, i in vocab.items():
            at_end = t.endswith(suffix) and len(t) > k
            tails, body = (self.final, t[:-k]) if at_end else (self.inner, t)
            for j in range(1, len(body)):
                tails.setdefault(body[j:], -1)
            if (i in reached) if reached is not None else self.merged(self.symbols(t)) == [t]:
                tails[body] = i
            else:
                tails.setdefault(body, -1)
        self.reached = frozenset(i for tails in (self.final, self.inner) for i in tails.values() if i >= 0)
        self._right: dict[int, list] = {}
        self._left: dict[int, list] = {}
        self._join: dict[int, bool] = {}

    def symbols(self, token: str) -> list[str]:
        if token.endswith(self.suffix) and len(token) > len(self.suffix):
            body = token[: -len(self.suffix)]
            return [*body[:-1], body[-1] + self.suffix]
        return list(token)

    def merged(self, parts: list[str]) -> list[str]:
        """Apply the merges, lowest rank first and leftmost first."""
        get, none = self.rank.get, 1 << 60
        parts = list(parts)
        ranks = [get(x + "\0" + y, none) for x, y in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) < none:
            i = ranks.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] + "\0" + parts[i], none)
            if i < len(ranks):
                ranks[i] = get(parts[i] + "\0" + parts[i + 1], none)
        return parts

    def _edge(self, t: int, right: bool) -> list:
        """The parts that stand at a token's edge while it is made, each with the rank at which it goes into the next."""
        part, until, out = self.name[t], 1 << 60, []
        while True:
            out.append((part, until))
            two = self.made.get(part)
            if two is None:
                return out
            until = self.rank[two[0] + "\0" + two[1]]
            part = two[1] if right else two[0]

    def holds(self, p: int, t: int) -> bool:
        """Whether the merges leave the junction of two tokens alone.

        They break it if the parts that meet there at some time would be merged
        before either goes into a larger part of its own token; at equal ranks
        the merge further left comes first.
        """
        key = p << 32 | t
        got = self._join.get(key)
        if got is not None:
            return got
        if len(self._join) > JOINS_KEPT:
            self._join.clear()
        a = self._right.get(p) or self._right.setdefault(p, self._edge(p, True))
        b = self._left.get(t) or self._left.setdefault(t, self._edge(t, False))
        i, j, good, rank = len(a) - 1, len(b) - 1, True, self.rank
        while True:
            (x, gone), (y, lost) = a[i], b[j]
            m = rank.get(x + "\0" + y)
            if m is not None and m < gone and m <= lost:
                good = False
                break
            if i == 0 and j == 0:
                break
            if j == 0 or (i and gone <= lost):
                i -= 1
            else:
                j -= 1
        self._join[key] = good
        return good

    def _last(self, path: str, tails: dict[str, int], states: list[int]) -> int:
        """The last token of ``path``, given the states of its prefixes."""
        n, found = len(path), []
        for at in range(n - 1, -1, -1):
            t = tails.get(path[at:])
            if t is None:
                break
            if t >= 0:
                found.append((t, at))
        for t, at in reversed(found):
            if at == 0 or self.holds(states[at], t):
                return t
        raise KeyError(path)

    def encode_words(self, words) -> dict[str, list[int]]:
        """Ids of distinct non-empty words, given as strings of byte symbols."""
        # insert: a node's children by symbol; "ends" are the last symbols of words
        kids: list[dict[str, int]] = [{}]
        ends: list[str] = [""]
        for w in words:
            node = 0
            for s in w[:-1]:
                nxt = kids[node].get(s)
                if nxt is None:
                    nxt = kids[node][s] = len(kids)
                    kids.append({})
                    ends.append("")
                node = nxt
            ends[node] += w[-1]
        out: dict[str, list[int]] = {}
        states: list[int] = [-1]
        inner, final, size, cut = self.inner, self.final, self.size, len(self.suffix)
        path = ""
        todo = [(0, 0, "")]
        while todo:
            node, depth, s = todo.pop()
            if depth:
                path = path[: depth - 1] + s
                del states[depth:]
                states.append(self._last(path, inner, states))
            for e in ends[node]:
                word = path + e
                t = self._last(word, final, states)
                ids, at = [t], len(word) - size[t] + cut
                while at:
                    t = states[at]
                    ids.append(t)
                    at -= size[t]
                out[word] = ids[::-1]
            todo += [(k, depth + 1, c) for c, k in kids[node].items()]
        return out


class WordBpe:
    """The text side of the vocabulary: normal form, words, ids and decoded text."""

    def __init__(self, path: str, reached: frozenset[int] | None = None):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.bpe = TrieBpe(spec["model"]["vocab"], spec["model"]["merges"], spec["model"]["end_of_word_suffix"], reached)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # the library's own normal form and word cutting, for characters on which the quicker engine differs
        bare = Tokenizer.from_str(json.dumps(spec | {"added_tokens": [], "model": spec["model"] | {"vocab": {}, "merges": []}}))
        self.normal, self.pre = bare.normalizer.normalize_str, bare.pre_tokenizer.pre_tokenize_str
        self.quick_words = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_]+|\d|(?:[^\w\s]|_)+").findall if pattern == PLAIN else None
        self.same: set[str] = set()
        self.unlike: set[str] = set()
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split
        self.bytes = byte_symbols()
        self.names = {i: t.encode() for t, i in [*self.bpe.vocab.items(), *self.special.items()]}
        self.ids = {s: array("I", [i]).tobytes() for s, i in self.special.items()}

    def _library(self, part: str) -> list[str]:
        low = self.normal(part)
        return [low[a:b] for _, (a, b) in self.pre(low)]

    def _quick(self, part: str) -> list[str]:
        low = unicodedata.normalize("NFC", part)
        return self.quick_words("".join(c.lower() for c in low) if "\u03a3" in low else low.lower())

    def _all_same(self, chars: set[str]) -> bool:
        """Whether both ways treat all these characters alike; each new one is tried once beside letters, digits and spaces."""
        if not chars <= self.same:
            for c in chars - self.same:
                if c in self.unlike:
                    return False
                probe = f"a{c}b {c}1{c} x{c}{c}"
                if self.quick_words is None or unicodedata.category(c) in ("Cn", "Cs") or self._quick(probe) != self._library(probe):
                    self.unlike.add(c)
                    return False
                self.same.add(c)
        return True

    def pieces(self, text: str) -> list[str]:
        """Words in normal form and special tokens, in order."""
        out: list[str] = []
        for part in self.cut(text) if "<|" in text else (text,):
            if part in self.special:
                out.append(part)
            elif part:
                out += self._quick(part) if self._all_same(set(part)) else self._library(part)
        return out

    def learn(self, words) -> None:
        """Encode distinct words through one trie and remember their ids."""
        spelt = {"".join(map(self.bytes.__getitem__, w.encode("utf-8", "surrogatepass"))): w for w in words}
        for k, ids in self.bpe.encode_words(spelt).items():
            self.ids[spelt[k]] = array("I", ids).tobytes()

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids as little-endian 32-bit, decoded) of whole texts; the new words of the batch share one trie."""
        split = [self.pieces(t) for t in texts]
        known = self.ids
        new = {w for s in split for w in s if w not in known}
        if len(known) + len(new) > WORDS_KEPT:
            forget_latest(known, kept=WORDS_KEPT // 2)
            new = {w for s in split for w in s if w not in known}
        self.learn(new)
        out = []
        for s in split:
            ids = array("I", b"".join(map(known.__getitem__, s)))
            out.append((ids.tobytes(), b" ".join(map(self.names.__getitem__, ids))))
        for w in new:
            if len(w) > MEMO_CHARS:
                del known[w]
        return out


def codec(path: str, reached: frozenset[int] | None = None) -> WordBpe:
    return hold("word bpe", path, lambda: WordBpe(path, reached))


def encode_decode(docs: DataFrame, text: str = "text", key: str = "doc_id", vocabulary: str | None = None, digests: bool = False) -> DataFrame:
    """Rows (key, n_tokens, ids array<int>, decoded string), one for each input row.

    Null and empty texts, and texts of white space only, have no ids and decode
    to the empty string. Repeated rows are encoded each, null keys stay null and
    other columns are not read. Texts are whole at any length. With ``digests``
    the two outputs are replaced by their SHA-256 (ids_sha256 over little-endian
    32-bit ids, decoded_sha256 over UTF-8), taken where they are made.
    """
    import pyarrow as pa

    path = vocabulary or tokenizer_path("word_bpe_49k.json")
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(codec(path).bpe.reached)  # at most the vocabulary's ids; tried once here, not by each worker

    def run(batches):
        import numpy as np

        sha = lambda b: hashlib.sha256(b).hexdigest()
        for b in batches:
            rows = codec(path, shared.value).encode([t or "" for t in b.column(1).to_pylist()])
            n = pa.array([len(r[0]) // 4 for r in rows], pa.int64())
            if digests:
                yield pa.RecordBatch.from_arrays([b.column(0), n, pa.array([sha(r[0]) for r in rows]), pa.array([sha(r[1]) for r in rows])], ["k", "n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                ids = pa.array([np.frombuffer(r[0], "<u4").astype("i4") for r in rows], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0), n, ids, pa.array([r[1].decode("utf-8", "replace") for r in rows])], ["k", "n_tokens", "ids", "decoded"])

    kind = docs.schema[key].dataType.simpleString()
    tail = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"k {kind}, n_tokens long, {tail}").withColumnRenamed("k", key)
