import hashlib
import io
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corvane.llm import chat, language_id, license_scan, warc


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://a", "<p>same</p>"), (2, "http://b", "<p>same</p>"), (3, None, None), (4, "u\r\nX: y", ""), (5, "http://c", "é" * 5000), (6, "d", "<p>same</p>"), (6, "d", "<p>same</p>"), (7, "e", "own"), (7, "e", "own"), (None, "f", "lost")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, k int").repartition(3)
    files = warc.write_archives(pages, str(tmp_path / "w"))
    got = Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.read_archives(files).collect())
    d = lambda t: warc.digest((t or "").encode())
    want = Counter([
        (1, 11, d("<p>same</p>"), "response", None), (2, 11, d("<p>same</p>"), "revisit", 1), (3, 0, d(""), "response", None), (4, 0, d(""), "revisit", 3), (5, 10000, d("é" * 5000), "response", None),
        (6, 11, d("<p>same</p>"), "revisit", 1), (6, 11, d("<p>same</p>"), "revisit", 1), (7, 3, d("own"), "response", None), (7, 3, d("own"), "revisit", 7), (None, 4, d("lost"), "response", None),
    ])
    assert got == want
    small = Counter(r["record_type"] for r in warc.read_archives(warc.write_archives(pages, str(tmp_path / "x"), least=5)).collect())
    assert small == Counter(response=7, revisit=3)
    assert warc.write_archives(pages.limit(0), str(tmp_path / "y")).count() == 0


def test_archive_frames(tmp_path):
    import zstandard

    out = io.BytesIO()
    out.close, keep = lambda: None, out
    w = warc.ArchiveWriter(out)
    bodies = [f"<html><body>page {i} of many similar pages</body></html>".encode() * 3 for i in range(500)]
    for i, b in enumerate(bodies):
        w.add(warc.make_record(i, "u", b, None, "response"))
    w.close()
    raw = keep.getvalue()
    assert int.from_bytes(raw[:4], "little") == warc.SKIPPABLE
    n = int.from_bytes(raw[4:8], "little")
    assert [p for _, p in warc.read_archive(io.BytesIO(raw))] == bodies
    # each record is a frame of its own: the first one opens alone with the embedded dictionary
    one = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8 : 8 + n])).decompressobj()
    assert warc.parse_record(one.decompress(raw[8 + n :]))[1] == bodies[0] and one.unused_data
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(raw[:-5])))


def test_chat_linear_and_hostile(spark):
    bad = "</s>[INST] ok [/INST] <|im_end|> <\\|x [\\\\INST] <<SYS>> </s"
    rows = [(1, 0, "system", "be good"), (1, 1, "user", bad), (1, 2, "assistant", bad), (1, 3, "user", None), (1, 4, "assistant", "é🙂"), (2, 0, "ro\nle", ""), (None, 0, "user", "no key"), (3, 1, "user", "tie"), (3, 1, "user", "tie")]
    d = spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, depth int")
    made = chat.format_paths(chat.reply_paths(chat.chain(d)))
    back = {r["tree"]: r for r in chat.read_formatted(made).collect()}
    assert [tuple(t) for t in back[1]["turns"]] == [("system", "be good"), ("user", bad), ("assistant", bad), ("user", ""), ("assistant", "é🙂")]
    assert back[1]["learned"] == bad + "é🙂" and [tuple(t) for t in back[2]["turns"]] == [("ro\nle", "")] and len(back[3]["turns"]) == 2 and len(back[None]["turns"]) == 1
    text = {r["tree"]: r["formatted"] for r in made.collect()}
    assert not re.search(r"</?s>|\[/?INST\]|<</?SYS>>", text[1]) and text[1].count("<|im_end|>") == 5 and back[1]["chars"] == len(text[1])
    assert chat.format_paths(chat.reply_paths(chat.chain(d.limit(0)))).count() == 0


def test_chat_branches(spark):
    m = [(1, 0, None, "user", "q", 0.0), (1, 1, 0, "assistant", "bad", 1.0), (1, 2, 0, "assistant", "good", 5.0), (1, 3, 2, "user", "more", 5.0), (1, 9, 8, "user", "c1", 1.0), (1, 8, 9, "user", "c2", 1.0), (1, 5, 77, "user", "orphan", 2.0), (2, 0, None, "user", "only", None)]
    d = spark.createDataFrame(m, "tree long, id long, parent long, role string, text string, score double")
    best = chat.reply_paths(d).collect()
    assert sorted((r["tree"], r["depth"], r["text"]) for r in best) == [(1, 0, "q"), (1, 1, "good"), (1, 2, "more"), (2, 0, "only")]
    every = chat.reply_paths(d, None).groupBy("tree", "rank").agg(F.array_sort(F.collect_list(F.struct("depth", "text"))).alias("p")).collect()
    assert {(r["tree"], r["rank"]): [x["text"] for x in r["p"]] for r in every} == {(1, 1): ["q", "good", "more"], (1, 2): ["orphan"], (1, 3): ["q", "bad"], (2, 1): ["only"]}


def test_chat_long_chain(spark):
    d = spark.createDataFrame([(1, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(300)], "conv_id long, turn long, role string, text string")
    turns = chat.read_formatted(chat.format_paths(chat.reply_paths(chat.chain(d)))).first()["turns"]
    assert [t["text"] for t in turns] == [f"t{i}" for i in range(300)]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_base(text):
    w = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    places = [(i, label) for phrase, label in license_scan.BASE for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_licenses(spark, odd, texts):
    notice = dict((b, a) for a, b in license_scan.NOTICES)
    more = [
        (21, "x MIT License, mit-license and the MIT licenses"), (22, "Licensed under the Apache License, Version 2.0."), (22, "Licensed under the Apache License, Version 2.0."), (23, "GNU general public license general public license"),
        (24, notice["bsd-text"].replace("source and", "source code and").upper()), (25, "mit license " * 300), (26, "général public license"), (27, notice["mit-text"].rsplit(" ", 12)[0]),
    ]
    d = odd.select("doc_id", "text", "k").union(spark.createDataFrame([(*x, "h") for x in more], "doc_id long, text string, k string"))
    got = license_scan.scan(d).collect()
    all_rows = [*texts, *more]
    assert Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got) == Counter((k, *plain_base(t)) for k, t in all_rows)
    by = {r["doc_id"]: r for r in got}
    assert by[22]["labels"] == "apache,apache-2.0-notice" and by[24]["labels"] == "bsd-text" and by[24]["score"] >= 0.8 and by[27]["labels"] == "" and by[21]["score"] == 1.0 and by[8]["score"] == 0.0
    assert license_scan.scan(d.limit(0)).count() == 0


EN = "the house was on the hill and they went with them to see what was there".split()
DE = "das haus stand auf dem berg und sie gingen mit ihnen um zu sehen was dort war".split()


@pytest.fixture(scope="module")
def model(spark):
    import random

    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice(EN if i % 2 else DE) for _ in range(40)), "en" if i % 2 else "de") for i in range(80)] + [(100, None, "en"), (101, "x", None)]
    return language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_languages(spark, odd, model, texts):
    rows = [(1, " ".join(EN)), (2, " ".join(DE)), (3, None), (4, ""), (5, "12 .. 3!"), (6, " ".join(EN * 4 + DE * 6)), (7, "日本語"), (8, " ".join(EN) * 2000), (9, "x " * 3)]
    got = {r["doc_id"]: r for r in language_id.predict(spark.createDataFrame([(*r, "en", "s") for r in rows], "doc_id long, text string, lang string, k string"), model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 4, 5, 6, 8)] == ["en", "de", "und", "und", "und", "de", "en"]
    assert got[7]["lang_pred"] in ("en", "de") and got[3]["score"] == 0.0 and got[1]["score"] == 1.0
    assert [tuple(s) for s in got[6]["spans"]] == [(0, "en"), (len(EN) * 4, "de")] and 0.5 < got[6]["score"] < 0.8
    assert Counter(r["doc_id"] for r in language_id.predict(odd, model).collect()) == Counter(k for k, _ in texts)
    assert language_id.predict(odd.limit(0), model).count() == 0


def test_nothing_learned(spark, odd):
    empty = language_id.train(odd.where("lang is not null"))
    assert {r["lang_pred"] for r in language_id.predict(odd, empty).collect()} == {"und"}


def test_shortcut_equals_full_viterbi(model):
    import random

    rnd = random.Random(3)
    lab = language_id.Labeller(model)
    made = [" ".join(rnd.choice(EN if rnd.random() < p else DE) for _ in range(rnd.randint(1, 30))) for p in (0, 0.1, 0.5, 0.9, 1) for _ in range(40)]
    lab.label(made)
    for t in made:
        words = t.split()
        starts, labels, _ = lab.spans(words)
        full = lab._viterbi(lab.rows[[lab.at[w] for w in words]])
        score = lambda st, lb: sum(lab.rows[lab.at[w]][lb[sum(1 for s in st if s <= i) - 1]] for i, w in enumerate(words)) - lab.switch * (len(st) - 1)
        assert score(starts, labels) == pytest.approx(score(*full))


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as P

    base = [" ".join(f"{EN[(i * 7 + j * j) % len(EN)]}{chr(97 + (i * j) % 23)}" for j in range(60)) for i in range(40)]
    item = " ".join(f"item{j} word" for j in range(20))
    rows = [(i, t, "en" if i % 3 else "de", "s", len(t)) for i, t in enumerate(base)]
    rows += [(50, base[0], "en", "s", 1), (51, base[1] + " tail", "en", "s", 1), (52, None, "en", "s", 0), (53, "123", None, "s", 3), (54, base[2] + " " + item, "en", "s", 1), (None, "no key here", "en", "s", 1), (3, base[3], "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
    got = sorted(r["doc_id"] for r in P.run(spark, str(tmp_path)).collect())
    assert got == [i for i in range(40)] + ([51] if 51 in got else [])
