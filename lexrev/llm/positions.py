"""Benchmark decontamination with a distributed positional inverted index.

The index is a written table, sharded by documents: a row holds the postings of a shard's documents, that is
every token's position, in lists by term and ascending within a list (``terms`` 64-bit hashes, ``ends`` where
each list ends, ``places``). Places number a shard's tokens through; documents are parted by a gap. Sharding by
documents leaves the lists of frequent words evenly dealt, however often they occur, and lets all lists of a
phrase meet in one task without a shuffle.

A search takes the distinct words of all phrases and adds up their list lengths over the index. Each
shard then intersects, for all phrases at once, from the globally rarest word's list on: places are shifted by the
word's offset in its phrase, so that a match is one number in all lists; each further list halves the candidates
by binary search. What is left are the exact matches. Proximity matches are the occurrences of the rarest word around
which every other word of the phrase occurs within a number of words.

The phrases are the stated query set. They go to the tasks in blocks of at most ``BLOCK_BYTES`` bytes of phrases,
one pass over the index a block; the index is never sent.

Terms are compared by 64-bit hashes; ``phrases`` checks that the hashes of different query words differ. Texts that
are null or hold no words have no postings; items of no words match nothing; equal items are searched once each;
repeated rows get equal results, as do rows of one null doc_id; other columns are ignored; empty tables give
documents without matches or no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexrev.llm.common import LOWER_TABLE, doc_key, map_batches, utf8_rows
from lexrev.session import cut_lineage

WINDOW = 10
NEAR = 30
SHARD_BYTES = 2 << 20
BLOCK_BYTES = 16 << 20
#: ASCII characters that part words: all but letters and digits.
_BREAKS = bytes(c for c in range(128) if not chr(c).isalnum())
_FOLD = bytes(32 if c in _BREAKS else LOWER_TABLE[c] for c in range(256))


def words_of(raw: bytes) -> list[bytes]:
    """Words of a UTF-8 text: runs of ASCII letters and digits (A-Z folded) and of all other characters."""
    return raw.translate(_FOLD).split()


def term(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def terms_of(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """Hashes of words; ``known`` keeps those of the words seen so far."""
    for w in set(words).difference(known):
        known[w] = term(w)
    return np.array([known[w] for w in words], np.uint64)


INDEX_SCHEMA = "ids array<long>, hashes array<long>, starts array<long>, counts array<long>, terms binary, ends binary, places binary"


def _shard(ids: list, hashes: list, texts: list[np.ndarray], gap: int) -> tuple:
    counts = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(counts + gap) - counts - gap
    flat = np.concatenate(texts) if texts else np.zeros(0, np.uint64)
    place = np.arange(len(flat)) + np.repeat(starts - (np.cumsum(counts) - counts), counts)
    order = np.argsort(flat, kind="stable")
    terms, first = np.unique(flat[order], return_index=True)
    ends = np.append(first[1:], len(flat))[:len(terms)]
    return (ids, hashes, starts.tolist(), counts.tolist(), terms.astype("<u8").tobytes(), ends.astype("<u4").tobytes(),
            place[order].astype("<u4").tobytes())


def build_index(docs: DataFrame, gap: int, name: str = "postings") -> DataFrame:
    """Write the index of ``docs(doc_id, text)`` and return it. ``gap`` is the least distance of two documents."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}

        def flush():
            rows = [[x] for x in _shard(ids, hashes, texts, gap)]
            kinds = [pa.list_(pa.int64())] * 4 + [pa.binary()] * 3
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, kinds, strict=True)],
                                              names=["ids", "hashes", "starts", "counts", "terms", "ends", "places"])

        ids, hashes, texts, size = [], [], [], 0
        for b in batches:
            keys = zip(b.column(0).to_pylist(), b.column(1).to_pylist(), utf8_rows(b.column(2)), strict=True)
            for i, h, raw in keys:
                ids.append(i)
                hashes.append(h)
                texts.append(terms_of(words_of(raw), known))
                size += len(raw) + 64
                if size >= SHARD_BYTES:
                    yield flush()
                    ids, hashes, texts, size = [], [], [], 0
                    if len(known) > 1 << 18:
                        known.clear()
        if ids:
            yield flush()

    keyed = docs.select(*doc_key(), "text")
    return cut_lineage(keyed.mapInArrow(run, INDEX_SCHEMA), name)


@dataclass
class Phrases:
    """A block of query phrases: item, words (hashes) by rising frequency and their offsets, for each length."""

    items: np.ndarray
    lengths: np.ndarray
    terms: list[np.ndarray]  # one array a rank: the rank-th rarest word of each phrase that has so many
    offsets: list[np.ndarray]


def item_windows(words: list[bytes], window: int) -> list[list[bytes]]:
    """All runs of ``window`` words; of fewer words, all of them."""
    return [words[i:i + window] for i in range(max(1, len(words) - window + 1))] if words else []


def phrase_blocks(items: DataFrame, window: int, id_col: str, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The query phrases (item position, words) in blocks, read from ``items(id, text)`` row by row."""
    block, size = [], 0
    for row in items.select(id_col, "text").toLocalIterator():
        for w in dict.fromkeys(map(tuple, item_windows(words_of((row[1] or "").encode()), window))):
            block.append((row[0], w))
            size += sum(map(len, w)) + 16 * window
            if size >= block_bytes:
                yield block
                block, size = [], 0
    if block:
        yield block


def lists_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    terms, ends, places = (np.frombuffer(row[k], t) for k, t in (("terms", "<u8"), ("ends", "<u4"), ("places", "<u4")))
    return terms, ends.astype(np.int64), places.astype(np.int64)


def _frequencies(index: DataFrame, terms: np.ndarray) -> dict[int, int]:
    """List lengths of the query's words over the whole index. The result is no longer than the query block."""
    wanted = np.sort(terms)

    def fn(b: pa.RecordBatch):
        total = np.zeros(len(wanted), np.int64)
        for i in range(b.num_rows):
            own = np.frombuffer(b.column(0)[i].as_py(), "<u8")
            n = np.diff(np.frombuffer(b.column(1)[i].as_py(), "<u4").astype(np.int64), prepend=0)
            at = np.searchsorted(own, wanted)
            hit = at < len(own)
            hit[hit] = own[at[hit]] == wanted[hit]
            total[hit] += n[at[hit]]
        some = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(wanted[some].view(np.int64)), pa.array(total[some])], names=["term", "n"])

    rows = map_batches(index.select("terms", "ends"), fn, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {int(np.int64(r["term"]).view(np.uint64)): r["n"] for r in rows.toLocalIterator()}


def plan(block: list[tuple], counts: dict[bytes, int], known: dict[bytes, int]) -> Phrases:
    ranked = []
    for _, words in block:
        seen = sorted(range(len(words)), key=lambda k: (counts.get(words[k], 0), words[k], k))
        ranked.append([(known[words[k]], k) for k in seen])
    lengths = np.array([len(r) for r in ranked], np.int64)
    most = int(lengths.max(initial=0))
    terms = [np.array([r[k][0] if k < len(r) else 0 for r in ranked], np.uint64) for k in range(most)]
    offsets = [np.array([r[k][1] if k < len(r) else 0 for r in ranked], np.int64) for k in range(most)]
    return Phrases(np.arange(len(block)), lengths, terms, offsets)


def _list_bounds(terms: np.ndarray, ends: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(terms):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
    found = terms[at] == wanted
    lo = np.where(at > 0, ends[at - 1], 0)
    return np.where(found, lo, 0), np.where(found, ends[at], 0)


def _occurrences(p: Phrases, lists: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Each phrase with each place of its rarest word."""
    terms, ends, places = lists
    lo, hi = _list_bounds(terms, ends, p.terms[0])
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    return which, places[np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]


def intersect(p: Phrases, lists: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Exact matches in a shard: phrase, place of its first word."""
    terms, ends, places = lists
    which, place = _occurrences(p, lists)
    start = place - p.offsets[0][which]
    # One ascending array for binary search in any list: the list's number above the place.
    number = np.repeat(np.arange(len(terms)), np.diff(ends, prepend=0))
    flat = (number << 34) + places
    for k in range(1, len(p.terms)):
        long = p.lengths[which] > k
        if not len(which) or not long.any():
            break
        t = p.terms[k][which]
        at = np.minimum(np.searchsorted(terms, t), len(terms) - 1)
        key = (at << 34) + start + p.offsets[k][which]
        pos = np.minimum(np.searchsorted(flat, key), len(flat) - 1)
        keep = ~long | ((terms[at] == t) & (flat[pos] == key))
        which, start = which[keep], start[keep]
    return which, start


def near_matches(p: Phrases, lists: tuple, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Phrases and places of their rarest word with every other word at most ``distance`` words away."""
    terms, ends, places = lists
    which, place = _occurrences(p, lists)
    number = np.repeat(np.arange(len(terms)), np.diff(ends, prepend=0))
    flat = (number << 34) + places
    for k in range(1, len(p.terms)):
        if not len(which):
            break
        t = p.terms[k][which]
        at = np.minimum(np.searchsorted(terms, t), len(terms) - 1)
        low = (at << 34) + np.maximum(place - distance, 0)
        pos = np.minimum(np.searchsorted(flat, low), len(flat) - 1)
        keep = (p.lengths[which] <= k) | ((terms[at] == t) & (flat[pos] >= low) & (flat[pos] <= (at << 34) + place + distance))
        which, place = which[keep], place[keep]
    return which, place


def search(index: DataFrame, block: list[tuple], near: int) -> DataFrame:
    """Matches of a block of phrases: k_id, k_hash, query (place in the block), first, words (0: a proximity match)."""
    known = {w: term(w) for _, words in block for w in words}
    if len(set(known.values())) < len(known):
        raise ValueError("two query words share a hash")
    seen = _frequencies(index, np.array(list(known.values()), np.uint64))
    p = plan(block, {w: seen.get(t, 0) for w, t in known.items()}, known)
    sent = index.sparkSession.sparkContext.broadcast(p)  # at most BLOCK_BYTES of phrases

    def fn(b: pa.RecordBatch):
        parts = []
        for row in b.to_pylist():
            lists = lists_of(row)
            starts, counts = np.array(row["starts"], np.int64), np.array(row["counts"], np.int64)
            ids, hashes = np.array(row["ids"], np.int64), np.array(row["hashes"], np.int64)
            q = sent.value
            for (which, at), exact in ((intersect(q, lists), True), (near_matches(q, lists, near), False)):
                if len(which):
                    d = np.searchsorted(starts, at, "right") - 1
                    parts.append((ids[d], hashes[d], which, at - starts[d], q.lengths[which] * exact))
        if not parts:
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)],
                                          names=["k_id", "k_hash", "query", "first", "words"])

    return map_batches(index, fn, "k_id long, k_hash long, query long, first long, words long")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, near: int = NEAR, id_col: str = "item_id") -> DataFrame:
    """Matches of ``items(item_id, text)`` in every row of ``docs(doc_id, text)``.

    Returns k_id, k_hash, doc_id, n_words, n_hit (words inside an exact match of any window), items (ids of
    items with an exact match, as strings, sorted), spans (exact matches merged: first word, one after the last), near_items (ids
    of items with a proximity match, likewise).
    """
    index = build_index(docs, gap=window + 2 * near + 2)
    found = []
    for block in phrase_blocks(items, window, id_col):
        spark = docs.sparkSession
        names = spark.createDataFrame([(i, None if x[0] is None else str(x[0])) for i, x in enumerate(block)],
                                      "query long, item string")
        found.append(search(index, block, near).groupBy("k_id", "k_hash", "query")
                     .agg(F.collect_set(F.when(F.col("words") > 0, F.struct("first", "words"))).alias("at"), F.count("*").alias("n"))
                     .join(names, "query"))
    all_docs = index.select(F.explode(F.arrays_zip("ids", "hashes", "counts")).alias("d")).select(
        F.col("d.ids").alias("k_id"), F.col("d.hashes").alias("k_hash"), F.col("d.counts").alias("n_words"))
    if found:
        hits = cut_lineage(_union(found), "matches")
        per_doc = hits.groupBy("k_id", "k_hash").agg(
            F.array_sort(F.flatten(F.collect_list("at"))).alias("at"),
            F.array_sort(F.collect_set(F.when(F.size("at") > 0, F.col("item")))).alias("items"),
            F.array_sort(F.collect_set("item")).alias("near_items"))
    else:
        per_doc = docs.sparkSession.createDataFrame(
            [], "k_id long, k_hash long, at array<struct<first:long,words:long>>, items array<string>, near_items array<string>")
    joined = all_docs.join(per_doc, ["k_id", "k_hash"], "left")
    merged = F.aggregate(
        F.coalesce("at", F.array().cast("array<struct<first:long,words:long>>")),
        F.array().cast("array<struct<lo:long,hi:long>>"),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["hi"] >= x["first"]),
                              F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                                  F.element_at(acc, -1)["lo"].alias("lo"),
                                  F.greatest(F.element_at(acc, -1)["hi"], x["first"] + x["words"]).alias("hi")))))
        .otherwise(F.concat(acc, F.array(F.struct(x["first"].alias("lo"), (x["first"] + x["words"]).alias("hi"))))))
    none = F.array().cast("array<string>")
    return (joined.withColumn("spans", merged).select(
        "k_id", "k_hash", F.when(F.col("k_id") != -(2**63), F.col("k_id")).alias("doc_id"), "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["hi"] - s["lo"]).alias("n_hit"),
        F.coalesce("items", none).alias("items"), "spans", F.coalesce("near_items", none).alias("near_items")))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a window of any item; all columns as they came."""
    hit = contamination(docs, items, window).where("n_hit > 0").select("k_id", "k_hash").distinct()
    names = [f"_c{i}" for i in range(len(docs.columns))]
    inner = docs.select(*doc_key(), *[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)])
    clean = inner.join(hit, ["k_id", "k_hash"], "left_anti")
    return clean.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
