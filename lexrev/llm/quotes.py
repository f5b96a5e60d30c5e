"""Quotation linking: conversations rebuilt from what messages quote.

A message's lines are parsed into nested quote levels (leading ``>`` marks). Runs of lines of one level are blocks, and
blank lines part blocks into passages. A passage is normalised (case, white space) and hashed, as are every
message's own words (level 0), as a whole and by passage. Quotes are joined on the hash, as of the message's time, to the latest
earlier message with these own words. The parent of a message is the message linked by its shallowest linked quote (there a block
as a whole before a single passage, then the latest); following parents gives the conversation (its first message), by pointer doubling.

Passages shorter than ``min_words`` words link nothing. A message is never its own parent, as parents are earlier (by time, then
id), so conversations are trees. Messages without a linked quote start a conversation. Nulls are empty texts; a null time counts as the first;
repeated rows of an id are one message (the smallest text); other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexrev.llm.asof import last_before
from lexrev.llm.common import map_batches
from lexrev.session import cut_lineage

MIN_WORDS = 4
#: The as-of join cuts time into stretches that hold about so many events each, over all hashes.
STRETCH_ROWS = 1000
_MARKS = re.compile(r"(?: ?>)*")
MAX_ROUNDS = 64
_NO_TIME = -(2**62)


def blocks(text: str) -> list[tuple[int, list[str]]]:
    """Runs of lines of one quote level: (level, lines without the marks)."""
    out: list[tuple[int, list[str]]] = []
    for line in text.split("\n"):
        m = _MARKS.match(line)
        level = m.group().count(">")
        if not out or out[-1][0] != level:
            out.append((level, []))
        out[-1][1].append(line[m.end():] if level else line)
    return out


def normalised(lines: list[str]) -> list[str]:
    return " ".join(lines).lower().split()


def passages(lines: list[str]) -> list[list[str]]:
    """Words of a block as a whole and of each of its passages."""
    parts: list[list[str]] = [[]]
    for line in lines:
        if line.strip():
            parts[-1].append(line)
        elif parts[-1]:
            parts.append([])
    own = [normalised(p) for p in parts if p]
    return [normalised(lines), *own] if len(own) > 1 else own


def digest(words: list[str]) -> int:
    return xxhash.xxh3_64_intdigest(" ".join(words).encode("utf-8", "surrogatepass")) - 2**63


def parse(text: str, min_words: int) -> tuple[str, list[tuple[int, int, bool]]]:
    """Own text, and (level, hash, whether it is a whole block) of every own and quoted passage."""
    own: list[str] = []
    found: dict[tuple[int, int], bool] = {}

    def add(level: int, lines: list[str]) -> None:
        for k, words in enumerate(passages(lines)):
            if len(words) >= min_words:
                at = (level, digest(words))
                found[at] = found.get(at, False) or k == 0

    for level, lines in blocks(text):
        if level == 0:
            own += lines
        else:
            add(level, lines)
    add(0, own)
    return "\n".join(own).strip(), sorted((*at, whole) for at, whole in found.items())


PARSED = "msg_id long, time long, own_text string, found array<struct<level:int,hash:long,whole:boolean>>"


def stretch_of(events: DataFrame, rows: int = STRETCH_ROWS) -> int:
    """Time units of a stretch: the range of the events' times cut into equal parts, one for every ``rows`` events."""
    first, last, n = events.where(F.col("time") > _NO_TIME).agg(F.min("time"), F.max("time"), F.count("*")).first()
    return max(1, -(-(last - first + 1) * rows // n)) if n else 1


def link(messages: DataFrame, min_words: int = MIN_WORDS, stretch: int | None = None) -> DataFrame:
    """Link ``messages(msg_id long, time long, text)``.

    Returns one row per message: msg_id, time, own_text (without quotes), n_quotes (quoted passages), n_linked, parent_id, root_id (the
    conversation), depth. Ordered by root_id, time and msg_id, the rows are the conversations in reply order.
    """
    one = messages.groupBy("msg_id").agg(F.min(F.struct(F.coalesce("time", F.lit(_NO_TIME)).alias("time"), F.coalesce("text", F.lit("")).alias("text"))).alias("m"))

    def fn(b: pa.RecordBatch):
        rows = []
        for i, t, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            own, found = parse(text, min_words)
            rows.append((i, t, own, [{"level": a, "hash": h, "whole": w} for a, h, w in found]))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.int64()), ("whole", pa.bool_())]))]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                          names=["msg_id", "time", "own_text", "found"])

    parsed = cut_lineage(map_batches(one.select("msg_id", "m.time", "m.text"), fn, PARSED), "quotes-parsed")
    events = parsed.select("msg_id", "time", F.explode("found").alias("f")).select("msg_id", "time", "f.level", "f.hash", "f.whole")
    source = F.when(F.col("level") == 0, F.struct(F.col("time").alias("time"), F.col("msg_id").alias("msg_id")))
    # A null id can't be told from others: it quotes, but is not quoted.
    known = events.where("msg_id IS NOT NULL OR level > 0")
    linked = last_before(known, "hash", "time", "msg_id", source, stretch or stretch_of(events), "original").where("level > 0")
    met = F.when(F.col("original").isNotNull(), F.struct((-F.col("level")).alias("near"), "whole", "original"))
    quoted = linked.groupBy("msg_id").agg(F.count("*").alias("n_quotes"), F.count("original").alias("n_linked"), F.max(met)["original"]["msg_id"].alias("parent_id"))
    parents = cut_lineage(quoted.where("msg_id IS NOT NULL"), "quotes-parents")
    # Pointer doubling: each round doubles the distance that (up, depth) spans.
    jump = cut_lineage(parents.where("parent_id IS NOT NULL").select("msg_id", F.col("parent_id").alias("up"), F.lit(1).cast("long").alias("depth")), "quotes-up")
    done = jump.limit(0)
    for _ in range(MAX_ROUNDS):
        # Only rows that still move are joined; those that have reached a first message serve as steps for them.
        further = jump.unionByName(done).select(F.col("msg_id").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("more"))
        step = cut_lineage(jump.join(further, "up", "left").select(
            "msg_id", F.coalesce("up2", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("up2").isNotNull().alias("moved")), "quotes-up")
        done = done.unionByName(step.where("NOT moved").drop("moved"))
        jump = step.where("moved").drop("moved")
        if jump.isEmpty():
            break
    else:
        raise RuntimeError(f"parents lead over more than 2^{MAX_ROUNDS} messages")
    jump = done
    return (parsed.join(parents, "msg_id", "left").join(jump, "msg_id", "left").select(
        "msg_id", "time", "own_text", F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "parent_id",
        F.coalesce("up", "msg_id").alias("root_id"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth")))


def conversations(linked: DataFrame) -> DataFrame:
    """The rows of ``link`` in reply order: sorted over partitions, so that no conversation has to fit one task."""
    return (linked.repartitionByRange("root_id", "time", "msg_id").sortWithinPartitions("root_id", "time", "msg_id"))


def quoting_messages(turns: DataFrame) -> DataFrame:
    """Messages derived from ``conversations(conv_id, turn, text)``: every turn with the two turns before it quoted below.

    msg_id is conv_id * 1000000 + turn; time is 1000 * turn plus a part of conv_id, so that conversations interleave. Turns are joined by
    key, not by a window; repeated turns are one (the smallest text).
    """
    one = cut_lineage(turns.groupBy("conv_id", "turn").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")), "quotes-turns")

    def shifted(k: int, name: str) -> DataFrame:
        return one.select("conv_id", (F.col("turn") + k).alias("turn"), F.col("text").alias(name))

    def quoted(c: str, mark: str):
        return F.coalesce(F.concat(F.lit(f"\n{mark} "), F.regexp_replace(F.col(c), "\n", f"\n{mark} ")), F.lit(""))

    both = one.join(shifted(1, "t1"), ["conv_id", "turn"], "left").join(shifted(2, "t2"), ["conv_id", "turn"], "left")
    return both.select((F.col("conv_id") * 1_000_000 + F.col("turn")).alias("msg_id"),
                       (F.col("turn") * 1000 + F.pmod("conv_id", F.lit(1000))).alias("time"),
                       F.concat("text", quoted("t1", ">"), quoted("t2", "> >")).alias("text"))
