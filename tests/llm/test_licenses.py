"""License scan against a plain program: places, merged diagonals, chains."""

import random
import re

import pytest

from corvane.llm import license_scan as S
from corvane.llm import queries


def plain_words(t):
    return re.findall(S.WORD, re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def plain_scan(t):
    ws = plain_words(t)
    starts, base, own, score = [], set(), set(), 0.0
    for phrase, label in S.BASE:
        ps = phrase.split()
        at = [i for i in range(len(ws) - len(ps) + 1) if ws[i : i + len(ps)] == ps]
        if at:
            base.add(label)
            score = 1.0
            starts += at
    for notice, label in S.NOTICES:
        ps = plain_words(notice)
        grams = [tuple(ps[i : i + S.K]) for i in range(len(ps) - S.K + 1)]
        lines = {}
        for p in range(len(ws) - S.K + 1):
            for q, g in enumerate(grams):
                if tuple(ws[p : p + S.K]) == g:
                    lines.setdefault(p - q, []).append((q, p))
        runs, last, hi = [], None, None
        for d in sorted(lines):
            lo = min(p for _, p in lines[d])
            if last is None or d - last > S.DRIFT or abs(lo - hi) > len(grams):
                runs.append([])
            runs[-1] += lines[d]
            last, hi = d, max(p for _, p in lines[d])
        for votes in runs:
            best = {}  # longest chain that ends at a vote, by trying all
            for q, p in sorted(votes):
                best[q, p] = 1 + max((n for (a, b), n in best.items() if a < q and b < p), default=0)
            share = max(best.values()) / len(grams)
            if share >= S.COVER:
                own.add(label)
                score = max(score, share)
    return len(ws), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | own)), score


def check(got, rows):
    cols = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    key = lambda r: (r[0] is not None, r[0] or 0, str(r))
    have = sorted(((r["doc_id"], *(r[c] for c in cols)) for r in got), key=key)
    want = sorted(((k, *plain_scan(t)) for k, t in rows), key=key)
    assert [r[:-1] for r in have] == [r[:-1] for r in want]
    assert [r[-1] for r in have] == pytest.approx([r[-1] for r in want])


def made(seed=3):
    rnd = random.Random(seed)
    phrases = [p for p, _ in S.BASE] + [p for p, _ in S.NOTICES]
    out = ["free and unencumbered " * 4, "mit license mit license", "MIT License, Apache\nLICENSE", None, "", "general public general public license"]
    for _ in range(120):
        words = []
        for _ in range(rnd.randint(1, 4)):
            words += [rnd.choice(["of", "the", "software", "license", "x", "y"]) for _ in range(rnd.randint(0, 8))]
            ps = rnd.choice(phrases).split()
            for _ in range(rnd.randint(0, 3)):
                at = rnd.randrange(len(ps))
                kind = rnd.randrange(3)
                ps = ps[:at] + ([] if kind == 0 else ["new"] if kind == 1 else ["new", ps[at]]) + ps[at + 1 :]
                ps = ps or ["x"]
            words += ps * rnd.choice([1, 1, 1, 2, 5])
        out.append(" ".join(words))
    return list(enumerate(out))


def test_scan_equals_a_plain_program(spark):
    rows = made()
    got = S.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    check(got, rows)
    assert len({r["labels"] for r in got}) > 8


def test_repeated_grams_are_no_license(spark):
    got = S.scan(spark.createDataFrame([(1, "free and unencumbered " * 4), (2, S.NOTICES[7][0] + " " + S.NOTICES[7][0])], "doc_id long, text string"))
    assert {r["doc_id"]: (r["labels"], r["score"]) for r in got.collect()} == {1: ("", 0.0), 2: ("unlicense-text", 1.0)}


def test_odd_rows(odd, texts):
    check(S.scan(odd).collect(), texts)
    assert S.scan(odd.limit(0)).count() == 0


def test_registered_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    check(queries.QUERIES["op10_licenses"](spark, "/root/testdata/sf0.01").collect(), rows)
