"""Token ids as length-delimited binary records with an offset index.

A record file is a row of frames. A frame is, little-endian:

    length of the payload         8 bytes
    masked crc32 of these bytes   4 bytes
    payload                       ``length`` bytes
    masked crc32 of the payload   4 bytes
    line feed                     1 byte

The mask rotates the checksum by 15 bits and adds a constant, so that checksums stored inside data
don't look like those of the data. A payload is a flag (1: the document has an id), the doc_id as a
signed 64-bit integer, and the ids as unsigned 16-bit integers, or 32-bit ones where the tokenizer has more
than 65,536 ids. The line feed ends each frame because Spark's text writer, which commits the files, ends rows
so; readers go by the lengths alone.

Files of about ``FILE_BYTES`` are written by Spark in ascending doc_id order (the numbers in their names give that order), so any store that
Spark writes will do and a lost task is simply run again. The index is a table beside the files with one
row per frame: file, place in the file, offset, length, doc_id, token count and the ids before it in the
file. Reads in any order fetch frames by the index.

Null texts are encoded as empty ones: the end id alone. A null doc_id sorts first. Repeated rows are written
once each. An empty table gives no frames. Other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexrev.llm.common import WordCache, map_batches, slices
from lexrev.session import broadcast_if_small, scratch_path

END_ID = 1
_MASK = 0xA282EAD8
_HEAD = "<QI"
_KEY = "<Bq"
_KEY_SIZE = struct.calcsize(_KEY)
#: Bytes of words and their ids that a task keeps.
CACHE_BYTES = 96 << 20
#: About the bytes of a record file.
FILE_BYTES = 16 << 20
#: Words that no normaliser changes and no splitter cuts.
_LETTERS = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
_MARKS = b".,!?;:*%&$#"
_ALNUM = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")


@lru_cache(maxsize=2)
def load_tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: How byte-level tokenizers write bytes: printable ones of Latin-1 as themselves, the rest in order from U+0100 on.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LETTERS = {x: 256 + i for i, x in enumerate(x for x in range(256) if x not in _PRINTABLE)}


@lru_cache(maxsize=2)
def letters_model(path: str) -> tuple | None:
    """For single words of lower-case Latin letters: a tokenizer without normaliser and splitter, and which ids end a word.

    Such words pass normalising unchanged and are one piece, wherever the normaliser composes and folds case and the splitter keeps letters
    together; what is left then is the writing of bytes and the merges. ``None`` for tokenizers of other kinds.
    """
    from tokenizers import Tokenizer

    whole = load_tokenizer(path)
    described = json.loads(whole.to_str())
    steps = (described.get("pre_tokenizer") or {}).get("pretokenizers") or []
    kinds = [n["type"] for n in (described.get("normalizer") or {}).get("normalizers") or []]
    model = described["model"]
    suffix = model.get("end_of_word_suffix")
    plain = (model["type"] == "BPE" and suffix and [s["type"] for s in steps] == ["Split", "ByteLevel"]
             and "[\\p{L}]+" in steps[0]["pattern"].get("Regex", "") and not steps[1]["add_prefix_space"]
             and set(kinds) <= {"NFC", "Replace", "Lowercase"})
    if not plain:
        return None
    ends = np.zeros(whole.get_vocab_size(), bool)
    ends[[i for t, i in model["vocab"].items() if t.endswith(suffix)]] = True
    return Tokenizer(whole.model), ends


class WordEncoder:
    """Encodes texts by their white-space-separated words, each distinct word once while it is in the cache.

    Exact for tokenizers that fold case, drop white space, never join across it and part marks from letters, as the default one
    (its normalizer and splitter look at no character beyond white space). Only space and \x09-\x0D split here, which every such tokenizer
    takes for white space. Of a batch, Arrow splits the texts and finds the distinct words, and numpy puts their ids together.
    """

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        self.tokenizer = load_tokenizer(path)
        self.letters = letters_model(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 65_536 else "<u4")
        self.cache = WordCache(cache_bytes)

    def encode(self, raw: bytes) -> bytes:
        """Ids of a UTF-8 text, as packed integers of ``dtype``."""
        return self.encode_all(pa.array([raw], pa.binary()).cast(pa.string()))[0]

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """``encode`` for every row of a string column."""
        ends, word, distinct = self._words(texts)
        packed = self._known(distinct)
        ids = np.frombuffer(b"".join(packed), self.dtype)
        n = np.fromiter(map(len, packed), np.int64, len(packed)) // self.dtype.itemsize
        first = np.cumsum(n) - n
        size = n[word]
        stop = np.cumsum(size)
        flat = ids[np.repeat(first[word] - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)].tobytes()
        cuts = np.append(0, stop)[ends] * self.dtype.itemsize
        return [flat[x:y] for x, y in zip(np.append(0, cuts).tolist(), cuts.tolist(), strict=False)]

    def count_all(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of every row of a string column."""
        ends, word, distinct = self._words(texts)
        n = np.fromiter(map(len, self._known(distinct)), np.int64, len(distinct)) // self.dtype.itemsize
        return np.diff(np.append(0, np.cumsum(n[word]))[ends], prepend=0)

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Where each row's words end, the words as numbers, and the distinct words."""
        texts = pc.fill_null(texts, "")
        # Folded, as the tokenizer folds case; texts that may spell special tokens stay as they are.
        folded = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(folded)
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.cast(pa.binary()).to_pylist()
        ends = split.offsets.to_numpy()[1:].astype(np.int64) - split.offsets[0].as_py()
        return ends, words.indices.to_numpy(), distinct

    def _known(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of distinct words."""
        out, without = self.cache.values(words)
        pieces, parts = set(), []
        for i in without:
            core, tail = self._parts(words[i])
            pieces.add(core)
            if tail:
                pieces.add(tail)
                parts.append((i, core, tail))
        known = self.cache.young
        self._learn([p for p in pieces if p not in known])
        self.cache.add([words[i] for i, _, _ in parts], [known[core] + known[tail] for _, core, tail in parts])
        for i in without:
            out[i] = known[words[i]]
        return out

    @staticmethod
    def _parts(word: bytes) -> tuple[bytes, bytes]:
        """A word as two that many words share: without the marks at its end, and these.

        Only marks after an ASCII letter or digit or a Latin letter part, as others may join a mark before them; words that may spell
        special tokens stay whole.
        """
        core = word.rstrip(_MARKS)
        if len(core) == len(word):
            return word, b""
        apart = core and b"<|" not in word and (core[-1] in _ALNUM or _LETTERS.fullmatch(core.decode("utf-8", "replace")))
        return (core, word[len(core):]) if apart else (word, b"")

    def _learn(self, new: list[bytes]) -> None:
        letters, texts, rest = [], [], []
        for w in new:
            t = w.decode("utf-8", "replace")
            if self.letters is not None and _LETTERS.fullmatch(t):
                letters.append(w)
                texts.append(t if w.isascii() else w.decode("latin-1").translate(_BYTE_LETTERS))
            else:
                rest.append(w)
        # Words in lists of 512: one encoding object a list instead of one a word.
        for at in range(0, len(letters), 512):
            own = letters[at:at + 512]
            self.cache.add(own, self._letters(own, texts[at:at + 512]))
        for at in range(0, len(rest), 512):
            own = rest[at:at + 512]
            self.cache.add(own, self._any(own))

    def _letters(self, words: list[bytes], written: list[str]) -> list[bytes]:
        """Packed ids of words of letters; each ends with its only id that ends a word."""
        tokenizer, ends = self.letters
        e, = tokenizer.encode_batch_fast([written], is_pretokenized=True, add_special_tokens=False)
        ids = np.array(e.ids, np.int64)
        cuts = np.flatnonzero(ends[ids]) + 1
        return self._packed(ids, np.append(0, cuts)) if len(cuts) == len(words) else self._any(words)

    def _any(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of words of any kind."""
        texts = [w.decode("utf-8", "replace") for w in words]
        e, = self.tokenizer.encode_batch([texts], is_pretokenized=True, add_special_tokens=False)
        of = e.word_ids
        if None in of:  # special tokens written out in the text belong to no word
            return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, self.dtype).tobytes() for t in texts]
        return self._packed(np.array(e.ids, np.int64), np.searchsorted(np.array(of, np.int64), np.arange(len(words) + 1)))

    def _packed(self, ids: np.ndarray, cuts: np.ndarray) -> list[bytes]:
        """Each stretch of ``ids`` between two cuts."""
        packed = ids.astype(self.dtype).tobytes()
        at = (cuts * self.dtype.itemsize).tolist()
        return [packed[x:y] for x, y in zip(at, at[1:], strict=False)]


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """One frame without its line feed."""
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload))))


def unframe(data: memoryview, at: int) -> tuple[memoryview, int]:
    """The payload of the frame at ``at`` and the place of the next one; raises ValueError on any damage."""
    if at + struct.calcsize(_HEAD) > len(data):
        raise ValueError(f"frame at {at}: cut short")
    length, check = struct.unpack_from(_HEAD, data, at)
    if masked_crc(bytes(data[at:at + 8])) != check:
        raise ValueError(f"frame at {at}: wrong length checksum")
    end = at + struct.calcsize(_HEAD) + length
    if end + 5 > len(data):
        raise ValueError(f"frame at {at}: cut short")
    payload = data[at + struct.calcsize(_HEAD):end]
    if masked_crc(bytes(payload)) != int.from_bytes(data[end:end + 4], "little") or data[end + 4] != 10:
        raise ValueError(f"frame at {at}: wrong payload checksum")
    return payload, end + 5


def frames_of(data: memoryview) -> Iterator[tuple[int, int, memoryview]]:
    """Offset, length and payload of every frame of a file."""
    at = 0
    while at < len(data):
        payload, after = unframe(data, at)
        yield at, after - at, payload
        at = after


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode every whole text of ``docs(doc_id, text)`` and write the record files to ``path``/data and their
    index to ``path``/index."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # The hash only parts repeated ids; rows equal in both are interchangeable.
    ordered = (text.withColumn("h", F.xxhash64("text")).repartitionByRange(F.asc_nulls_first("doc_id"), "h")
               .sortWithinPartitions(F.asc_nulls_first("doc_id"), "h", "text").select("doc_id", "text"))

    # Half of a text's bytes or less become ids; a file holds so many rows that it takes about FILE_BYTES.
    rows, size = text.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    per_file = max(1, rows * FILE_BYTES // max(1, (size or 0) // 2 + 32 * rows))

    def encode(batches):
        enc = WordEncoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        for b in slices(batches):
            out = [frame(struct.pack(_KEY, i is not None, i or 0) + ids + end)
                   for i, ids in zip(b.column(0).to_pylist(), enc.encode_all(b.column(1)), strict=True)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
            del out

    # cast() keeps the bytes as they are; the text writer writes them as they are.
    ordered.mapInArrow(encode, "value binary").select(F.col("value").cast("string")).write.option("maxRecordsPerFile", per_file).text(f"{path}/data")
    spark = docs.sparkSession
    width = WordEncoder(tokenizer).dtype.itemsize

    def index(b: pa.RecordBatch):
        rows = []
        for i, name in enumerate(b.column(0).to_pylist()):
            before = 0
            for k, (at, length, payload) in enumerate(frames_of(memoryview(b.column(1)[i].as_buffer()))):
                has, doc = struct.unpack_from(_KEY, payload, 0)
                n = (len(payload) - _KEY_SIZE) // width
                rows.append((name, k, at, length, doc if has else None, n, before))
                before += n
        cols = list(zip(*rows, strict=True)) or [()] * 7
        kinds = [pa.string()] + [pa.int64()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                          names=["file", "place", "offset", "length", "doc_id", "n_tokens", "before"])

    map_batches(_files(spark, path), index, INDEX_SCHEMA).write.parquet(f"{path}/index")


INDEX_SCHEMA = "file string, place long, offset long, length long, doc_id long, n_tokens long, before long"


def file_order() -> list[Column]:
    """The order in which the files were written, from their names: the task's number, then the file's in the task."""
    return [F.regexp_extract("file", pattern, 1).cast("long") for pattern in ("^part-(\\d+)", "-c(\\d+)[^-]*$")]


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Record files, of about ``FILE_BYTES`` each, as rows (file name, content)."""
    return (spark.read.format("binaryFile").load(f"{path}/data")
            .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content"))


def read_records(spark: SparkSession, path: str, tokenizer: str, wanted: DataFrame | None = None) -> DataFrame:
    """Read frames by the index: doc_id, start (ids of all documents before it), n_tokens, ids (packed u32).

    ``wanted(file, offset)`` picks frames (all by default). Checksums are verified; damage raises an error.
    """
    index = spark.read.parquet(f"{path}/index")
    # One row per file from here on; the running total over files is over file names, not documents.
    totals = index.groupBy("file").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("frames"))
    base = totals.select("file", (F.sum("n").over(Window.orderBy(*file_order())) - F.col("n")).alias("base"), "frames")
    dtype = WordEncoder(tokenizer).dtype
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                          names=["doc_id", "start", "n_tokens", "ids"])

    def ids_of(payload: memoryview) -> tuple[int | None, np.ndarray]:
        has, doc = struct.unpack_from(_KEY, payload, 0)
        return doc if has else None, np.frombuffer(payload, dtype, offset=_KEY_SIZE).astype("<u4")

    def every(b: pa.RecordBatch):
        rows = []
        for i, at, frames in zip(range(b.num_rows), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            for _, _, payload in frames_of(memoryview(b.column(1)[i].as_buffer())):
                doc, ids = ids_of(payload)
                rows.append((doc, at, len(ids), ids.tobytes()))
                at += len(ids)
                frames -= 1
            if frames:
                raise ValueError("the index doesn't belong to these files")
        return batch(rows)

    def picked(b: pa.RecordBatch):
        rows = []
        for i, first, frames in zip(range(b.num_rows), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            data = memoryview(b.column(1)[i].as_buffer())
            for f in frames:
                doc, ids = ids_of(unframe(data, f["offset"])[0])
                if len(ids) != f["n_tokens"]:
                    raise ValueError("the index doesn't belong to these files")
                rows.append((doc, first + f["before"], len(ids), ids.tobytes()))
        return batch(rows)

    if wanted is None:
        # A row a file: sent to the files if it is small, so that their contents stay where they were read.
        return map_batches(_files(spark, path).join(broadcast_if_small(base), "file").select("file", "content", "base", "frames"),
                           every, "doc_id long, start long, n_tokens long, ids binary")
    lists = index.join(wanted, ["file", "offset"], "left_semi").groupBy("file").agg(
        F.collect_list(F.struct("offset", "n_tokens", "before")).alias("frames"))
    joined = _files(spark, path).join(lists.join(base.drop("frames"), "file"), "file").select("file", "content", "base", "frames")
    return map_batches(joined, picked, "doc_id long, start long, n_tokens long, ids binary")


def shuffled(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """The index in a random order that the seed fixes: file, offset, length, doc_id, position."""
    return (spark.read.parquet(f"{path}/index")
            .withColumn("position", F.xxhash64("file", "offset", F.lit(seed)))
            .repartitionByRange("position").sortWithinPartitions("position", "file", "offset")
            .select("file", "offset", "length", "doc_id", "position"))


def record_digests(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Write ``docs``, read the files back and digest them: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "records")
    write_records(docs, path, tokenizer)
    read = read_records(spark, path, tokenizer)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def default_tokenizer() -> str:
    """The word-level BPE file of the installed public tokenizers."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))
