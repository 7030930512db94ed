"""Archives and conversations with very long records."""

import hashlib
import random

from corvane.llm import chat, warc


def test_payloads_beyond_the_read_buffer(spark, tmp_path):
    rnd = random.Random(1)
    big = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyzäöü ") for _ in range(3_000_000))
    rows = [(1, None, big), (2, "http://x", "small"), (3, None, big), (4, "http://y", big + "!"), (5, None, None), (6, None, "é" * 1_200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    got = {r["page_id"]: r for r in warc.read_archives(warc.write_archives(pages, str(tmp_path / "w"))).collect()}
    for k, url, html in rows:
        raw = (html or "").encode()
        assert (got[k]["payload_bytes"], got[k]["payload_digest"], got[k]["url"]) == (len(raw), warc.digest(raw), url or ""), k
    assert got[3]["refers_to"] == 1 and [got[k]["record_type"] for k in (1, 3, 4)] == ["response", "revisit", "response"]


def test_long_texts_in_conversations(spark):
    rnd = random.Random(2)
    long = "".join(rnd.choice(["word ", "</s>", "[INST]", "<|im_end|>\n", "é🙂", "\\"]) for _ in range(200_000))
    rows = [(1, 0, "user", long), (1, 1, "assistant", long[::-1]), (1, 2, "assistant", None), (2, 0, None, "")]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_paths(chat.reply_paths(chat.chain(d)))
    back = {r["tree"]: r for r in chat.read_formatted(made).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert [(t["role"], sha(t["text"])) for t in back[1]["turns"]] == [("user", sha(long)), ("assistant", sha(long[::-1])), ("assistant", sha(""))]
    assert back[1]["learned"] == long[::-1] and [tuple(t) for t in back[2]["turns"]] == [("", "")]
    assert chat.read_formatted(made.limit(0)).count() == 0
