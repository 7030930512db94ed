"""Language ID against plain programs: counts, scores, the best path, and held-out accuracy."""

import json
import math
import random
import zlib
from collections import Counter

import pytest

from corvane.llm import language_id as L
from corvane.llm import queries

WORDS = {"en": "the house stands on a hill near water".split(), "de": "das haus steht auf einem hügel am wasser".split(), "ru": "дом стоит на холме у самой воды".split(), "el": "το σπίτι στέκει στον λόφο".split()}
LONG = "x" * 40 + "qwjk" * 30


def rows(seed=1, n=120):
    rnd = random.Random(seed)
    out = [(i, " ".join(rnd.choice(WORDS[l]) for _ in range(25)), l) for i, l in enumerate(rnd.choices(list(WORDS), k=n))]
    return out + [(n, f"the {LONG} hill", "en"), (n, f"the {LONG} hill", "en"), (n + 1, None, "en"), (n + 2, "text", None), (None, "no key", "en")]


def plain_model(made):
    """(languages, scripts -> languages, score of (gram, language)) by plain counting over whole words."""
    count = {}
    for _, t, l in set(made):
        if t is not None and l is not None:
            for w in t.split():
                w = "".join(c for c in w if c.isalpha()).lower()
                if w:
                    count.setdefault(l, []).append(w)
    langs = sorted(count)
    scripts, score = {}, {}
    for l in langs:
        used = Counter(L.script_of(c) for w in count[l] for c in w)
        for s, n in used.items():
            if n >= 0.01 * sum(used.values()):
                scripts.setdefault(s, set()).add(l)
        for k in (1, 2, 3):
            grams = Counter()
            for w in count[l]:
                x = w if k == 1 else f" {w} "
                grams.update(x[i : i + k] for i in range(len(x) - k + 1))
            below = sum(grams.values()) + 0.5 * (len(grams) + 1)
            score[l, k] = (grams, below)
    return langs, scripts, lambda g, l: math.log((score[l, len(g)][0][g] + 0.5) / score[l, len(g)][1])


def plain_spans(text, model, switch):
    langs, scripts, score = model
    table, sizes = [], []
    for w in text.split():
        w = "".join(c for c in w if c.isalpha()).lower()
        sizes.append(len(w))
        if not w:
            table.append([0.0] * len(langs))
            continue
        x = f" {w} "
        grams = [*w, *(x[i : i + 2] for i in range(len(x) - 1)), *(x[i : i + 3] for i in range(len(x) - 2))]
        known = [scripts[s] for s in {L.script_of(c) for c in w} if s in scripts]
        may = set.intersection(*known) or set.union(*known) if known else set(langs)
        raw = {l: sum(score(g, l) for g in grams) / 3 for l in may}
        table.append([raw[l] - max(raw.values()) if l in may else -1e6 for l in langs])
    best = [(table[0][i], (i,)) for i in range(len(langs))]
    for row in table[1:]:
        best = [max((v + row[j] - (switch if p[-1] != j else 0), (*p, j)) for v, p in best) for j in range(len(langs))]
    return max(best), sizes


@pytest.fixture(scope="module")
def model(spark):
    return L.train(spark.createDataFrame(rows(), "doc_id long, text string, lang string"))


def test_model_equals_plain_counts(model):
    langs, scripts, score = plain_model(rows())
    spec = json.loads(model)
    assert spec["langs"] == langs and {s: set(l) for s, l in spec["scripts"].items()} == scripts
    grams = [g for g in spec["probs"] if not g.endswith("?floor")]
    assert len(grams) > 100 and any("jkq" in g for g in grams)  # from beyond the 64th character of a word
    for g in grams:
        for l, v in zip(langs, spec["probs"][g]):
            assert v == pytest.approx(score(g, l)), (g, l)


def test_paths_equal_a_plain_search(model):
    plain, lab, rnd = plain_model(rows()), L.Labeller(model), random.Random(5)
    for _ in range(150):
        a, b = rnd.choice(list(WORDS)), rnd.choice(list(WORDS))
        words = [rnd.choice(WORDS[a if rnd.random() < 0.5 else b]) for _ in range(rnd.randint(1, 12))] + ["12", "日本", "hausдом"][: rnd.randint(0, 3)]
        text = " ".join(words)
        (value, path), sizes = plain_spans(text, plain, lab.switch)
        if not sum(sizes):
            continue
        lang, share, spans = lab.label([text])[0]
        own = []
        for i, (s, l) in enumerate(spans):
            own += [lab.langs.index(l)] * ((spans[i + 1][0] if i + 1 < len(spans) else len(words)) - s)
        table = [lab.rows[lab.at[w]] for w in words]
        got = sum(r[i] for r, i in zip(table, own)) - lab.switch * (len(spans) - 1)
        assert got == pytest.approx(value), text
        held = Counter()
        for i, n in zip(own, sizes):
            held[lab.langs[i]] += n
        assert share == pytest.approx(max(held.values()) / sum(sizes)) and held[lang] == max(held.values())


def test_scripts_narrow_and_long_words_are_not_kept(model):
    lab = L.Labeller(model)
    assert lab.label(["дом the"])[0][2] == [(0, "ru"), (1, "en")]  # no switch is dear enough to leave a word in a script that its language lacks
    lab.label([LONG * 3 + " the"])
    assert not any(len(w) > 64 for w in [*lab.at, *lab.by_letters]) and "the" in lab.at


def test_kept_grams_are_a_parameter(spark):
    d = spark.createDataFrame(rows(), "doc_id long, text string, lang string")
    few = json.loads(L.train(d, keep=5))
    assert len([g for g in few["probs"] if not g.endswith("?floor")]) <= 5 * 4


def test_registered_query_on_held_out_rows(spark):
    got = queries.QUERIES["op2_language_id"](spark, "/root/testdata/sf0.01").collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in got)
    known = [r for r in got if r["held_out"] and docs[r["doc_id"]]["lang"] is not None and any(c.isalpha() for c in docs[r["doc_id"]]["text"] or "")]
    right = sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in known)
    assert len(known) > 100 and right / len(known) >= 0.95


def test_full_word_table_is_really_emptied(monkeypatch):
    """Many forms of few words: the table stayed over its bound, so every batch emptied what it had just learned."""
    rnd = random.Random(2)
    chars = "abcdeé"
    one = list(chars)
    all_ = one + [a + b for a in one + [" "] for b in one + [" "]] + [a + b + c for a in one + [" "] for b in one for c in one + [" "]]
    probs = {g: [-rnd.random() * 9, -rnd.random() * 9] for g in rnd.sample(all_, 200)} | {f"?{k}?floor": [-9.0 - k, -9.5 - k] for k in (1, 2, 3)}
    model = json.dumps({"langs": ["x", "y"], "scripts": {"latin": ["x", "y"]}, "probs": probs})
    word = lambda: "".join(rnd.choice(chars + "zй日") for _ in range(rnd.randint(1, 4)))
    words = [word() for _ in range(40)]
    texts = [" ".join(rnd.choice(["", "(", "-"]) + rnd.choice(words) + rnd.choice(["", ",", ".", "!", "?"]) for _ in range(60)) for _ in range(40)] + ["", None, "12 34"]
    plain = L.Labeller(model)
    plain.numbers = None  # n-gram by n-gram
    want = [plain.label([t])[0] for t in texts]
    assert [L.Labeller(model).label([t])[0] for t in texts] == want
    monkeypatch.setattr(L, "WORDS_KEPT", 100)
    small = L.Labeller(model)
    got = []
    for t in texts:
        got += small.label([t])
        small.forget()
        assert len(small.at) <= 50 and len(small.by_letters) <= 51
        assert set(small.at.values()) <= set(small.by_letters.values()) and small.used == max(small.by_letters.values()) + 1
    assert got == want
