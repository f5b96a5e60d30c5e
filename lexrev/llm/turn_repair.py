"""Conversation structure repair by weighted interval parsing.

A conversation is right if the first letters of its roles read ``(s?(ua)+)?``: at most one system message, then pairs of user
and assistant. Repairs are edits of single rows, in order: Keep (cost 0), Rerole to user or assistant (3), Delete (4; the only edit of
blank and duplicate rows), and Insert of a user or assistant message without text anywhere (3). A truncated row that
is not deleted costs 3 more. Among the repairs of least cost the one whose initials (the audit) are least in ASCII order is taken.

The repair grammar is in Chomsky normal form. Its symbols ``(p, q)`` derive the repairs that lead from a state p of the pattern
to a state q (start, after system, after user, after assistant), its rules are ``(p, q) -> (p, r) (r, q)``, and a single row derives symbols by its
edits, closed under insertions on both sides. A cell of the chart holds, for a span of rows, the least (cost, audit) of every symbol.
Cells are combined bottom-up by span length: rows, pairs of rows, and so on. Every symbol has a rule for every state in the
middle, so any split of a span gives the same minimum, and one split of each span is enough (tests compare with the chart
over all spans and splits). Audits of one span and cost are never each other's prefixes (a longer one has more insertions, so costs more), which makes
least audits of parts add up to the least audit of the whole.

So a conversation of any length parses as a tree: rows are sorted by ranges over all conversations and numbered through,
blocks of at most ``BLOCK`` rows of a conversation are parsed each for itself, and blocks are combined in groups of ``FAN`` until each conversation
has one cell. The edits then go back to the blocks. No task holds all rows of a conversation; only its audit, a letter an edit, and its checksum,
which a text must be read through for, meet in one row, the latter as a stream.

Rows are taken by turn (nulls first), ties by role, then by a hash of the text. A null role or text is one space. Repeated rows
are duplicates of each other; blank rows come before duplicates and truncated rows. Roles other than system, user and assistant go by their first
letter; a null id is a conversation of its own; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexrev.functions.joins import join_keys
from lexrev.llm.common import map_batches
from lexrev.session import cut_lineage

BLOCK = 256
FAN = 64
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: White space by the byte, and the marks that end a sentence.
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
ROLES = {"s": "system", "u": "user", "a": "assistant"}
#: States of the pattern: start, after system, after user, after assistant; where a role's initial leads.
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FINAL = (0, 3)
#: Symbols (from, to) that derive anything.
SYMBOLS = [(p, q) for p, qs in ((0, (0, 1, 2, 3)), (1, (1, 2, 3)), (2, (2, 3)), (3, (2, 3))) for q in qs]
RULES = [((p, q), (p, r), (r, q)) for p, r in SYMBOLS for r2, q in SYMBOLS if r == r2]
LEGAL = frozenset(("su", "ua", "au"))
Cell = dict[tuple[int, int], tuple[int, str]]


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of a span from those of its two parts."""
    out: Cell = {}
    for symbol, a, b in RULES:
        if a in left and b in right:
            both = left[a][0] + right[b][0], left[a][1] + right[b][1]
            if symbol not in out or both < out[symbol]:
                out[symbol] = both
    return out


def _closure() -> Cell:
    """The cell of no rows: insertions alone."""
    nothing: Cell = {(p, p): (0, "") for p in range(4)}
    one: Cell = {(p, q): (INSERT, "I") for (p, r), q in STEPS.items() if r in "ua"}
    out = nothing
    for _ in range(4):  # a pair of insertions leads to any state that insertions reach
        more = combine(out, one)
        out = {s: min(x[s] for x in (out, more) if s in x) for s in SYMBOLS if s in out or s in more}
    return out


EMPTY = _closure()


@lru_cache(maxsize=64)
def leaf(code: str) -> Cell:
    """The cell of a row: its initial (``-`` for other roles) and its fault (b, d, t or ``.``)."""
    initial, fault = code
    row: Cell = {(p, p): (DELETE, "D") for p in range(4)}
    if fault not in "bd":
        extra = TRUNCATED if fault == "t" else 0
        for (p, r), q in STEPS.items():
            edits = [(extra, "K")] * (r == initial) + [(REROLE + extra, "R")] * (r in "ua")
            if edits:
                row[p, q] = min([*edits, *([row[p, q]] if (p, q) in row else [])])
    return combine(combine(EMPTY, row), EMPTY)


def reduced(cells: list[Cell]) -> Cell:
    """One cell from those of adjacent spans, bottom-up by span length."""
    while len(cells) > 1:
        pairs = [combine(cells[i], cells[i + 1]) for i in range(0, len(cells) - 1, 2)]
        cells = pairs + cells[len(cells) & ~1:]
    return cells[0] if cells else EMPTY


def cheapest(cell: Cell) -> tuple[int, str]:
    """Cost and audit of the best whole repair."""
    return min(cell[0, q] for q in FINAL if (0, q) in cell)


@lru_cache(maxsize=4096)
def parse_codes(codes: str) -> dict:
    """The span of a block's rows, given by two letters a row: its cell and counts."""
    rows = [codes[i:i + 2] for i in range(0, len(codes), 2)]
    initials = codes[::2]
    return {"cell": reduced([leaf(r) for r in rows]), "first": initials[:1], "last": initials[-1:],
            "counts": [codes[1::2].count(f) for f in "bdt"],
            "illegal": sum(initials[i:i + 2] not in LEGAL for i in range(len(rows) - 1))}


def split_audit(audit: str, rows: list[int]) -> list[str]:
    """An audit dealt to blocks of so many rows; insertions go with the row after them, the last ones to the last block."""
    out, at = [], 0
    for n in rows:
        end = at
        while n:
            n -= audit[end] != "I"
            end += 1
        out.append(audit[at:end])
        at = end
    out[-1] += audit[at:]
    return out


def role_at(place: int, total: int) -> str:
    """Initial of the role at a place of a right conversation of ``total`` messages."""
    return "s" if total % 2 and place == 0 else "ua"[(place + total) % 2]


def apply_edits(audit: str, rows: list[tuple[str, str]], place: int, total: int) -> Iterator[tuple[int, str, str, str]]:
    """Messages (place, edit, role, text) that the edits make of the rows (role, text)."""
    rest = iter(rows)
    for edit in audit:
        if edit == "I":
            role, text = ROLES[role_at(place, total)], ""
        else:
            role, text = next(rest)
            if edit == "D":
                continue
            if edit == "R":
                role = ROLES[role_at(place, total)]
        yield place, edit, role, text
        place += 1


def numbered(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """A written table of the rows in order: conv, turn, role, text, pos (rising; a partition's number in its upper bits)."""
    space = F.lit(" ")
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), space).alias("role"),
                        F.coalesce(F.col(text), space).alias("text"))
    # Equal rows are parted by where they were read, so that even many of them go to several tasks.
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), "role", F.xxhash64("text"), "salt"]
    ranged = rows.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    return cut_lineage(ranged.select("conv", "turn", "role", "text", F.monotonically_increasing_id().alias("pos")), "turns")


def _last_character(text: Column) -> Column:
    return F.right(F.rtrim(text, F.lit(BLANKS)), F.lit(1))


def _codes(rows: DataFrame) -> DataFrame:
    """(conv, block, codes, n) of every block of ``rows`` with block numbers: two letters a row, in order."""
    initial = F.substring("role", 1, 1)
    last = _last_character(F.col("text"))
    light = rows.select(
        "conv", "block", "pos", F.when(initial.isin(*ROLES), initial).otherwise(F.lit("-")).alias("initial"),
        F.when(last == "", F.lit("b")).when(~last.isin(*ENDS), F.lit("t")).otherwise(F.lit(".")).alias("fault"),
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("content"))
    # Of equal rows of a conversation all but the first are duplicates. Joined by place, which no two rows share.
    firsts = light.groupBy("conv", "content").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    fault = F.when(F.col("first").isNull() & (F.col("fault") != "b"), F.lit("d")).otherwise(F.col("fault"))
    coded = light.join(firsts, "pos", "left").select("conv", "block", "pos", F.concat("initial", fault).alias("code"))
    in_order = F.array_sort(F.collect_list(F.struct("pos", "code")))
    return coded.groupBy("conv", "block").agg(F.array_join(F.transform(in_order, lambda s: s["code"]), "").alias("codes"),
                                              F.count("*").alias("n"))


def _span_type(conv: T.DataType) -> T.StructType:
    part = T.StructType([T.StructField("block", T.LongType()), T.StructField("n", T.LongType())])
    return T.StructType([
        T.StructField("conv", conv), T.StructField("block", T.LongType()), T.StructField("costs", T.ArrayType(T.LongType())),
        T.StructField("audits", T.ArrayType(T.StringType())), T.StructField("counts", T.ArrayType(T.LongType())),
        T.StructField("illegal", T.LongType()), T.StructField("first", T.StringType()), T.StructField("last", T.StringType()),
        T.StructField("parts", T.ArrayType(part))])


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _spans(conv: pa.Array, spans: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    rows = [{**s, "costs": [s["cell"].get(x, (None,))[0] for x in SYMBOLS],
             "audits": [s["cell"].get(x, (None, None))[1] for x in SYMBOLS]} for s in spans]
    cols = [pa.array([r[f.name] for r in rows], f.type) for f in list(schema)[1:]]
    return pa.RecordBatch.from_arrays([conv, *cols], schema=schema)


def _joined(spans: list[dict]) -> dict:
    """One span from adjacent ones, given as rows of the span table in order."""
    cells = [{x: (c, a) for x, c, a in zip(SYMBOLS, s["costs"], s["audits"], strict=True) if c is not None} for s in spans]
    seams = sum(a["last"] + b["first"] not in LEGAL for a, b in zip(spans, spans[1:], strict=False))
    return {"cell": reduced(cells), "counts": [sum(x) for x in zip(*(s["counts"] for s in spans), strict=True)],
            "illegal": sum(s["illegal"] for s in spans) + seams, "first": spans[0]["first"], "last": spans[-1]["last"],
            "parts": [p for s in spans for p in s["parts"]]}


def parsed(codes: DataFrame, blocks: int, fan: int = FAN) -> DataFrame:
    """One span of every conversation from its blocks, whose numbers are below ``blocks``: a written table."""
    schema = _span_type(codes.schema["conv"].dataType)
    arrow = _arrow(schema)

    def leaves(b: pa.RecordBatch) -> pa.RecordBatch:
        no, n = b.column(1).to_pylist(), b.column(3).to_pylist()
        return _spans(b.column(0), [{**parse_codes(c), "block": i, "parts": [{"block": i, "n": m}]}
                                    for c, i, m in zip(b.column(2).to_pylist(), no, n, strict=True)], arrow)

    def merge(b: pa.RecordBatch) -> pa.RecordBatch:
        groups = [[s["span"] for s in sorted(g, key=lambda s: s["block"])] for g in b.column(2).to_pylist()]
        return _spans(b.column(0), [{**_joined(g), "block": i} for g, i in zip(groups, b.column(1).to_pylist(), strict=True)], arrow)

    fields = [f.name for f in schema if f.name not in ("conv", "block")]
    spans = map_batches(codes.select("conv", "block", "codes", "n"), leaves, schema)
    while blocks > 1:
        blocks = -(-blocks // fan)
        grouped = spans.groupBy("conv", F.floor(F.col("block") / fan).alias("block")).agg(
            F.collect_list(F.struct("block", F.struct(*fields).alias("span"))).alias("spans"))
        spans = map_batches(grouped, merge, schema)
    return cut_lineage(spans, "spans")


def _finished(spans: DataFrame) -> DataFrame:
    """conv, blank, duplicate, truncated, illegal, cost, audit, parts (block, edits, place of its first message, messages of all)."""
    conv = spans.schema["conv"].dataType
    part = T.StructType([T.StructField("block", T.LongType()), T.StructField("edits", T.StringType()),
                         T.StructField("place", T.LongType()), T.StructField("total", T.LongType())])
    names = ["blank", "duplicate", "truncated", "illegal", "cost"]
    schema = T.StructType([T.StructField("conv", conv), *[T.StructField(n, T.LongType()) for n in names],
                           T.StructField("audit", T.StringType()), T.StructField("parts", T.ArrayType(part))])
    arrow = _arrow(schema)

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for r in b.to_pylist():
            cost, audit = cheapest({x: (c, a) for x, c, a in zip(SYMBOLS, r["costs"], r["audits"], strict=True) if c is not None})
            total, place, parts = len(audit) - audit.count("D"), 0, []
            for p, edits in zip(r["parts"], split_audit(audit, [p["n"] for p in r["parts"]]), strict=True):
                parts.append({"block": p["block"], "edits": edits, "place": place, "total": total})
                place += len(edits) - edits.count("D")
            rows.append([*r["counts"], r["illegal"], cost, audit, parts])
        cols = list(zip(*rows, strict=True)) or [()] * (len(names) + 2)
        return pa.RecordBatch.from_arrays(
            [b.column(0), *(pa.array(c, f.type) for c, f in zip(cols, list(arrow)[1:], strict=True))], schema=arrow)

    return map_batches(spans, fn, schema)


MESSAGES = "array<struct<place:long,edit:string,role:string,text:string>>"


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           block: int = BLOCK, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """Repair the conversations of ``turns``.

    Returns (a row per conversation: its id, gaps (turn numbers missing between the least and the greatest), blank, duplicate, truncated
    (rows by first fault), illegal (adjacent roles that may not follow each other), cost, audit; a row per block of a
    conversation: its id, block (rising in the conversation) and messages (place in the conversation, edit, role, text) of the repaired conversation).
    """
    rows = numbered(turns, conv, turn, role, text)
    # Dense enough block numbers: a partition's number times the most blocks of a partition, plus the block in it.
    part, place = F.shiftrightunsigned("pos", 33), F.col("pos").bitwiseAND(F.lit((1 << 33) - 1))
    last, parts = rows.agg(F.max(place), F.max(part)).first()
    per_part = (last or 0) // block + 1
    rows = rows.withColumn("block", part * F.lit(per_part) + F.floor(place / block))
    spans = parsed(_codes(rows), ((parts or 0) + 1) * per_part, fan)
    done = _finished(spans)
    turn_no = F.col("turn")
    gaps = rows.groupBy("conv").agg(F.coalesce(F.max(turn_no) - F.min(turn_no) + 1 - F.count_distinct(turn_no), F.lit(0))
                                    .cast("long").alias("gaps"))
    summary = join_keys(done.drop("parts"), gaps, "conv").select(
        F.col("conv").alias(conv), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    edits = done.select("conv", F.inline("parts"))
    texts = rows.groupBy("conv", "block").agg(F.array_sort(F.collect_list(F.struct("pos", "role", "text"))).alias("rows"))
    joined = join_keys(texts, edits, ["conv", "block"]).select("conv", "block", "rows", "edits", "place", "total")
    schema = T.StructType([joined.schema["conv"], T.StructField("block", T.LongType()),
                           T.StructField("messages", T._parse_datatype_string(MESSAGES))])
    arrow = _arrow(schema)

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        rows, edits, place, total = (b.column(i).to_pylist() for i in range(2, 6))
        out = [[dict(zip(("place", "edit", "role", "text"), m, strict=True)) for m in
                apply_edits(e, [(r["role"], r["text"]) for r in rs], p, n)]
               for rs, e, p, n in zip(rows, edits, place, total, strict=True)]
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, arrow.field("messages").type)], schema=arrow)

    messages = map_batches(joined, fn, schema).withColumnRenamed("conv", conv)
    return summary, messages


def digests(messages: DataFrame, conv: str = "conv_id") -> DataFrame:
    """repaired_sha256 of every conversation: its messages as ``role:text``, joined by line feeds, read as a stream of blocks."""
    line = F.transform("messages", lambda m: F.concat(F.when(m["place"] > 0, F.lit("\n")).otherwise(F.lit("")), m["role"], F.lit(":"), m["text"]))
    pieces = (messages.select(F.col(conv).alias("conv"), "block", F.array_join(line, "").alias("piece"))
              .repartition("conv").sortWithinPartitions("conv", "block"))
    schema = T.StructType([T.StructField("conv", messages.schema[conv].dataType), T.StructField("repaired_sha256", T.StringType())])
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, current, ids, sums = False, None, [], []
        state = hashlib.sha256()
        for b in batches:
            for c, piece in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if open_ and c != current:
                    ids.append(current)
                    sums.append(state.hexdigest())
                    state = hashlib.sha256()
                open_, current = True, c
                state.update(piece.encode("utf-8", "surrogatepass"))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, arrow[0].type), pa.array(sums)], schema=arrow)
                ids, sums = [], []
        if open_:
            yield pa.RecordBatch.from_arrays([pa.array([current], arrow[0].type), pa.array([state.hexdigest()])], schema=arrow)

    return pieces.mapInArrow(run, schema).withColumnRenamed("conv", conv)


def damaged(turns: DataFrame) -> DataFrame:
    """The damage that the query repairs, by ``crc32("conv_id:turn") % 20``: 0 drops a row, 1 empties its text, 2 removes the
    marks that end sentences, 3 repeats it, 4 sets its role to user. Nulls are one space there."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    text = F.coalesce("text", space)
    return turns.withColumn("_kind", F.crc32(F.encode(key, "UTF-8")) % 20).where("_kind != 0").select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.coalesce("role", space)).alias("role"),
        F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("_kind") == 3, F.lit(2)).otherwise(F.lit(1)))).alias("copy"))
