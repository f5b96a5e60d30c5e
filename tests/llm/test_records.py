import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexrev.llm import records
from lexrev.llm.common import WordCache
from lexrev.llm.records import (WordEncoder, default_tokenizer, file_order, frame, frames_of, letters_model, load_tokenizer,
                                read_records, record_digests, shuffled, write_records)

TEXTS = ["Hello  world's 3rd\ttest\n\n", "", None, "<|endoftext|> x<|startoftext|>y", "É é café ño ǅ İ ß Σίσυφος ΟΔΟΣ",
         "a b c\x1cd\x85e ̈f", "日本語 テキスト 😀👍🏽 end", "don't I'll we've 'S", "word " * 3000, "x" * 5000,
         "tab\x0bvt\x0cff\r\nend", "1234567890 12 3.4", "…---!!! ???", "مرحبا بالعالم",
         "it's. it'S, end!'s a.…b.… x.' WORD.,; É. 5%*** <|ENDOFTEXT|>. <|endoftext|>. A\u0301. K. &&&& .. a|. b.> c.̈"]


def whole(texts):
    t = load_tokenizer(default_tokenizer())
    return [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in texts]


def test_round_trip_equals_encoding_whole_texts(spark):
    rng = random.Random(2)
    texts = TEXTS + [" ".join(rng.choice(TEXTS) or "" for _ in range(3)) for _ in range(30)]
    ids = list(range(0, 5 * len(texts), 5))
    order = list(zip(ids, texts, strict=True))
    rng.shuffle(order)
    df = spark.createDataFrame([(i, t, 1) for i, t in order], "doc_id long, text string, n_tokens int").repartition(7)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in record_digests(df, default_tokenizer()).collect()}
    at, want = 0, {}
    for i, e in zip(ids, whole(texts), strict=True):
        want[i] = (at, len(e), zlib.crc32(np.array(e, "<u4").tobytes()))
        at += len(e)
    assert got == want


@pytest.mark.parametrize("cache_bytes", [0, 2000, 1 << 20])
def test_cache_that_overflows(cache_bytes):
    enc = WordEncoder(default_tokenizer(), cache_bytes)
    for t, want in zip(TEXTS + TEXTS, whole(TEXTS + TEXTS), strict=True):
        assert np.frombuffer(enc.encode((t or "").encode()), "<u2").tolist() == want[:-1]
        assert len(enc.cache.young) <= len((t or "").split()) * 3 + 2 + cache_bytes // enc.cache.WORD_BYTES


def test_words_of_letters_skip_the_splitter_alone():
    rng = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz\u00df\u00e0\u00e9\u00f1\u00f6\u00f8\u00fc\u00ff"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) + rng.choice(["", ".", ",", "&&&", "!?", "s's"]) for _ in range(5000)]
    words += [w.upper() for w in words[:500]] + ["e\u0301a", "\u00f7a", "\u00b5m", "\u0149", "\u00aa", "\ufb01n"]
    assert letters_model(default_tokenizer()) is not None
    enc = WordEncoder(default_tokenizer())
    enc._any = None  # not for these words
    for w in words[:4000]:
        enc.encode(w.rstrip(".,&!?").removesuffix("s's").encode())
    enc = WordEncoder(default_tokenizer())
    for w, want in zip(words, whole(words), strict=True):
        assert np.frombuffer(enc.encode(w.encode()), "<u2").tolist() == want[:-1], w


def test_cache_keeps_words_in_use():
    cache = WordCache(4 * WordCache.WORD_BYTES * 10)
    for i in range(100):
        words = [b"w%d" % i, b"hot"]
        values, without = cache.values(words)
        assert without == ([0, 1] if i == 0 else [0]) and values == [None, None if i == 0 else 1]
        cache.add([words[k] for k in without], [1] * len(without))
        assert set(words) <= set(cache.young) and len(cache.young) + len(cache.old) <= 50


def test_files_are_ordered_by_number(spark):
    names = ["part-99999-a-c000.txt", "part-100000-a-c000.txt", "part-100000-a-c001.txt", "part-00002-a-c1000.txt", "part-00002-a-c999.txt"]
    df = spark.createDataFrame([(n,) for n in names], "file string")
    assert [r.file for r in df.orderBy(*file_order()).collect()] == [names[4], names[3], names[0], names[1], names[2]]


def test_small_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "FILE_BYTES", 300)
    df = spark.createDataFrame([(i, f"text number {i} " * (i % 7)) for i in range(60)], "doc_id long, text string")
    want = sorted(map(tuple, record_digests(df, default_tokenizer(), str(tmp_path / "a")).collect()))
    assert spark.read.parquet(str(tmp_path / "a/index")).select("file").distinct().count() > 10
    monkeypatch.undo()
    assert want == sorted(map(tuple, record_digests(df, default_tokenizer(), str(tmp_path / "b")).collect()))


def test_shuffled_reads_and_picked_frames(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text number {i}") for i in range(50)], "doc_id long, text string")
    path = str(tmp_path / "r")
    write_records(df, path, default_tokenizer())
    mixed = shuffled(spark, path, 3)
    order = [r.doc_id for r in mixed.collect()]
    assert sorted(order) == list(range(50)) and order != sorted(order)
    some = read_records(spark, path, default_tokenizer(), mixed.where("doc_id % 7 = 0").select("file", "offset"))
    full = {r.doc_id: r for r in read_records(spark, path, default_tokenizer()).collect()}
    assert {r.doc_id: r for r in some.collect()} == {i: full[i] for i in range(0, 50, 7)}


def test_damage_is_noticed():
    good = b"".join(frame(p) + b"\n" for p in (b"abc", b"", b"x" * 70))
    assert [bytes(p) for _, _, p in frames_of(memoryview(good))] == [b"abc", b"", b"x" * 70]
    for i in range(len(good)):
        bad = bytearray(good)
        bad[i] ^= 4
        with pytest.raises(ValueError):
            list(frames_of(memoryview(bytes(bad))))
    with pytest.raises(ValueError):
        list(frames_of(memoryview(good[:-3])))


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert record_digests(empty, default_tokenizer()).count() == 0
    df = spark.createDataFrame([(None, "a"), (2, "a"), (2, "a"), (2, None)], "doc_id long, text string")
    rows = record_digests(df, default_tokenizer()).orderBy("start", F.col("doc_id").desc()).collect()
    assert [(r.doc_id, r.n_tokens) for r in rows[:1]] == [(None, 2)]
    assert sorted(r.n_tokens for r in rows) == [1, 2, 2, 2]
