import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lexrev.llm.asof import last_before
from lexrev.llm.quotes import blocks, conversations, link, parse, quoting_messages
from lexrev.llm.revisits import canonical_url, captures, resolve_revisits

sys.path.insert(0, str(Path(__file__).parents[2]))
RECORD = "record_id long, url string, time long, kind string, digest string, headers map<string,string>, response string"


def test_canonical_urls(spark):
    want = {"HTTP://www.Ex.com:80/a/b/?b=2&utm_source=x&a=1#f": "https://ex.com/a/b?a=1&b=2", "https://ex.com": "https://ex.com",
            "https://ex.com/?ref=q": "https://ex.com", "https://ex.com/A//": "https://ex.com/A", "nonsense": None, "": None, None: None}
    df = spark.createDataFrame([(u,) for u in want], "u string").select("u", canonical_url(F.col("u")).alias("c"))
    assert {r.u: r.c for r in df.collect()} == want


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_last_before_against_brute_force(spark, width):
    rng = random.Random(width)
    rows = [(i, rng.choice(["a", "b", None, "a", "a"]), rng.choice([None, *range(40)]), rng.choice([None, i])) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, k string, t long, v long")
    got = {r.id: r.p for r in last_before(df, "k", "t", "id", F.col("v"), width, "p").collect()}
    for i, k, t, _ in rows:
        before = [(u, j, w) for j, kk, u, w in rows if kk == k and None not in (k, t, u, w) and (u, j) < (t, i)]
        assert got[i] == (max(before)[2] if before else None)


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_equal_events_do_not_see_each_other(spark, width):
    rng = random.Random(width)
    rows = [(i, rng.choice("ab"), rng.randrange(12), rng.randrange(3), rng.random() < 0.6) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, k string, t long, tie long, has boolean")
    value = F.expr("IF(has, t * 10 + tie, NULL)")
    got = {r.id: r.p for r in last_before(df, "k", "t", "tie", value, width, "p").collect()}
    for i, k, t, tie, _ in rows:
        assert got[i] == max((u * 10 + e for _, kk, u, e, has in rows if kk == k and has and (u, e) < (t, tie)), default=None)


def test_revisits(spark):
    h = {"etag": '"1"', "last-modified": "m", "server": "o", "date": "0"}
    rows = [(1, "http://a.com/x", 10, "response", "d1", h, "z"), (2, "https://a.com/x/", 20, "response", "d2", {**h, "etag": '"2"'}, "z"),
            (3, "https://www.a.com/x", 15, "revisit", None, {"etag": 'W/"1"', "date": "15", "server": "no"}, None),
            (4, "https://a.com/x", 20, "revisit", None, {"etag": '"1"'}, None), (5, "https://a.com/x", 99, "revisit", None, {"last-modified": "m"}, None),
            (6, "https://a.com/x", 99, "revisit", None, None, None), (7, "https://b.com", 9, "revisit", None, h, None),
            (8, None, 9, "revisit", None, h, None), (9, "https://a.com/x", None, "revisit", None, h, None), (9, "https://a.com/x", None, "revisit", None, h, None)]
    got = resolve_revisits(spark.createDataFrame(rows, RECORD)).collect()
    assert sorted((r.record_id, r.status, r.refers_to, r.digest) for r in got if r.refers_to) == [(3, "resolved", 1, "d1"), (5, "resolved", 2, "d2")]
    assert {r.record_id: r.status for r in got} == {3: "resolved", 4: "mismatch", 5: "resolved", 6: "no_validator", 7: "orphan", 8: "orphan", 9: "orphan"} and len(got) == 8
    assert next(r.headers for r in got if r.record_id == 3) == {"etag": 'W/"1"', "last-modified": "m", "server": "o", "date": "15"}
    assert resolve_revisits(spark.createDataFrame([], RECORD)).count() == 0
    pages = spark.createDataFrame([(i, f"https://x.com/{i % 4}", f"h{i // 4}") for i in range(40)] + [(None, None, None)], "page_id long, url string, html string")
    out = resolve_revisits(captures(pages))
    assert out.count() == 41 and {r.status for r in out.collect()} >= {"resolved", "mismatch", "no_validator"}


def test_quotes(spark):
    assert blocks("a\n> b\n>> c\n> > d\n>\ne") == [(0, ["a"]), (1, [" b"]), (2, [" c", " d"]), (1, [""]), (0, ["e"])]
    assert parse("x", 1)[0] == "x" and parse("> only a quote here", 3)[0] == ""
    a = "Hello all, this is  the first message\nwith two lines"
    b = "I reply to that with some words"
    rows = [(1, 1, a, 0), (2, 2, f"{b}\n> hello ALL, this is the first message\n> with two lines", 0),
            (3, 3, f"third one speaks here now\n> {b}\n> > Hello all, this is the first message with\n> > two lines\n", 0),
            (4, 4, "nested only, what about it\n>> " + a.replace("\n", "\n>> "), 0), (5, 0, "> " + b, 0), (6, 9, None, 0), (7, 9, "", 0),
            (2, 2, f"{b}\n> hello ALL, this is the first message\n> with two lines", 1), (None, 5, "> third one speaks here now", 0)]
    df = spark.createDataFrame(rows, "msg_id long, time long, text string, level int")
    got = {r.msg_id: r for r in link(df).collect()}
    assert {i: (r.parent_id, r.root_id, r.depth) for i, r in got.items()} == {
        1: (None, 1, 0), 2: (1, 1, 1), 3: (2, 1, 2), 4: (1, 1, 1), 5: (None, 5, 0), 6: (None, 6, 0), 7: (None, 7, 0), None: (None, None, 0)}
    assert got[3].own_text == "third one speaks here now" and got[3].n_quotes == 2 and got[3].n_linked == 2
    order = [r.msg_id for r in conversations(link(df)).collect() if r.root_id == 1]
    assert order == [1, 2, 3, 4]
    assert link(df.limit(0)).count() == 0


def test_replies_that_repeat_their_quote_and_shared_passages(spark):
    first, sign, asks = "first message of some words", "kind regards from the whole team", "a question about the old house"
    rows = [(1, 1, first), (2, 2, f"{first}\n\nyes I repeat it\n> {first}"), (3, 3, f"{asks}\n\n{sign}"), (4, 4, f"another thing in a new talk\n\n{sign}"),
            (5, 5, f"an answer to that question\n\n{sign}\n> {asks}\n>\n> {sign}")]
    rows += [(i, i, f"{first}\n> {first}") for i in range(6, 20)]
    got = {r.msg_id: (r.parent_id, r.root_id, r.depth) for r in link(spark.createDataFrame(rows, "msg_id long, time long, text string")).collect()}
    assert {i: got[i] for i in range(1, 6)} == {1: (None, 1, 0), 2: (1, 1, 1), 3: (None, 3, 0), 4: (None, 4, 0), 5: (3, 3, 1)}
    # Message 2's own words as a whole differ from the passage, but the passage is its own too: the latest earlier message with these words.
    assert [got[i][:2] for i in range(6, 20)] == [(2, 1)] + [(i - 1, 1) for i in range(7, 20)]


def test_conversations_are_rebuilt(spark):
    rng = random.Random(1)
    turns = [(c, t, " ".join(rng.choice("abcdefghijklmnop") for _ in range(30)), "user") for c in range(12) for t in range(9)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, text string, role string")
    got = {r.msg_id: r for r in link(quoting_messages(df)).collect()}
    for c, t, text, _ in turns:
        r = got[c * 1_000_000 + t]
        assert (r.root_id, r.depth, r.own_text) == (c * 1_000_000, t, text)


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as cp

    rng = random.Random(7)
    words = [f"word{i}" for i in range(400)]
    item = " ".join(rng.choice(words) for _ in range(30))
    texts = [" ".join(rng.choice(words) for _ in range(120)) for _ in range(150)]
    texts += [texts[3], texts[3], texts[5].replace("word7 ", "word8 ", 1), texts[9] + " " + item, texts[11] + " mail jo@ex.org"] + ["trash idiot " * 30 + t for t in texts[20:60]]
    docs = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int("trash" in t)) for i, t in enumerate(texts) if i % 3], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, table, str(tmp_path))
        if k < 4:
            assert out.columns == table.columns
        out.write.parquet(f"{tmp_path}/out{k}")
        table = spark.read.parquet(f"{tmp_path}/out{k}")
        kept.append({r.doc_id for r in table.select("doc_id").collect()})
    assert len([i for i in kept[0] if i < 150]) > 140 and len([i for i in kept[0] if i >= 155]) < 4
    assert 3 in kept[1] and not {150, 151} & kept[1]
    assert kept[1] - kept[2] == {153} & kept[1]
    masked = {r.doc_id: r for r in spark.read.parquet(f"{tmp_path}/out3").collect()}
    assert all("@" not in r.text and r.n_chars == len(r.text) for r in masked.values())
    assert kept[4] == kept[3] == kept[2]
    assert cp.run(spark, str(tmp_path)).count() == table.count()
