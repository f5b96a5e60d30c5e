import hashlib
import random
import zlib
from collections import Counter

import pytest

from lexrev.llm import turn_repair as R
from lexrev.llm.queries import op12_turn_repair

WS = " \t\n\x0b\x0c\r"


def all_spans(codes):
    """The whole chart: every span, every split."""
    if not codes:
        return R.cheapest(R.EMPTY)
    n = len(codes)
    chart = {(i, i + 1): R.leaf(c) for i, c in enumerate(codes)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cell = {}
            for m in range(i + 1, i + length):
                for s, v in R.combine(chart[i, m], chart[m, i + length]).items():
                    cell[s] = min(v, cell.get(s, v))
            chart[i, i + length] = cell
    return R.cheapest(chart[0, n])


def exhaustive(codes, state="", inserted=0):
    """Least (cost, audit) by trying every edit in turn; the state is the output's initials so far, cut to what matters."""
    found = [(0, "")] if not codes and state in ("", "a") else []
    if inserted < 3:
        for r in "ua":
            if (state, r) in (("", "u"), ("s", "u"), ("u", "a"), ("a", "u")):
                found += [(c + 3, "I" + a) for c, a in exhaustive(codes, r, inserted + 1)]
    if codes:
        (initial, fault), rest = codes[0], codes[1:]
        found += [(c + 4, "D" + a) for c, a in exhaustive(rest, state)]
        if fault not in "bd":
            extra = 3 if fault == "t" else 0
            for r, cost, letter in [(initial, 0, "K"), ("u", 3, "R"), ("a", 3, "R")]:
                if (state, r) in (("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")):
                    found += [(c + cost + extra, letter + a) for c, a in exhaustive(rest, r)]
    return [min(found)] if found else []


def test_parser_against_the_whole_chart_and_every_edit():
    rnd = random.Random(2)
    for k in range(400):
        codes = [rnd.choice("suuaa-") + rnd.choice(".....ttbd") for _ in range(rnd.randint(0, 6))]
        best = R.cheapest(R.reduced([R.leaf(c) for c in codes]))
        assert best == all_spans(codes), codes
        if k < 150:
            assert best == exhaustive(codes)[0], codes


def brute(rows, originals):
    """The contract in plain Python; rows (conv, turn, role, text) after damage."""
    out = {}
    for conv in originals:
        own = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        seen, faults = set(), []
        for _, role, text in own:
            core = text.strip(WS)
            faults.append("b" if not core else "d" if (role, text) in seen else "t" if core[-1] not in ".!?" else ".")
            seen.add((role, text))
        initials = "".join(r[1][:1] if r[1][:1] in set("sua") else "-" for r in own)
        cost, audit = all_spans([i + f for i, f in zip(initials, faults, strict=True)])
        turns = [t for t, _, _ in own if t is not None]
        n, it, lines = len(audit) - audit.count("D"), iter(own), []
        for e in audit:
            row = next(it) if e != "I" else None
            if e != "D":
                i = len(lines)
                role = ["user", "assistant"][(i - n % 2) % 2] if e in "IR" else row[1]
                lines.append(f"{role}:{'' if e == 'I' else row[2]}")
        c = Counter(faults)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, c["b"], c["d"], c["t"],
                     sum(initials[i:i + 2] not in ("su", "ua", "au") for i in range(len(own) - 1)) if own else 0, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def damage(rows):
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)


@pytest.mark.parametrize("block,fan", [(R.BLOCK, R.FAN), (3, 2)])
def test_query_against_brute_force(spark, tmp_path, monkeypatch, block, fan):
    rnd = random.Random(4)
    words = ["Yes.", "No", "Hm? ", " \t", "", "ok.\n", "Long one! ", "ä…", "x" * 5000]
    rows = [(c, t, rnd.choice(["system", "user", "assistant", "tool", "", None]) if rnd.random() < 0.3 else "user" if t % 2 else "assistant",
             rnd.choice(words) if rnd.random() < 0.5 else f"text {rnd.random()}.") for c in range(150) for t in range(rnd.randint(1, 7))]
    rows += [(500, t, "user" if t % 2 == 0 else "assistant", f"m {t % 90}.") for t in range(400)]  # a long conversation
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", None), (None, 3, None, "x"), (7, None, "user", "null turn."), (501, None, "user", "?")]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, "y") for r in rows], "conv_id long, turn long, role string, text string, pos int, block string")
    df.repartition(4).write.parquet(str(tmp_path / "conversations.parquet"))
    monkeypatch.setattr(R.repair, "__defaults__", (*R.repair.__defaults__[:4], block, fan))
    got = {r[0]: tuple(r)[1:] for r in op12_turn_repair(spark, str(tmp_path)).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}
    assert got == brute(list(damage(rows)), {r[0] for r in rows})


def test_repeated_rows_are_duplicates(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi.")] * 3 + [(1, 1, "assistant", "Yes.")], "conv_id int, turn long, role string, text string")
    summary, messages = R.repair(df)
    row = summary.first()
    assert (row.duplicate, row.cost, row.audit, row.gaps, row.illegal) == (2, 8, "KDDK", 0, 2)
    assert [(m.place, m.edit, m.role, m.text) for m in messages.first().messages] == [(0, "K", "user", "Hi."), (1, "K", "assistant", "Yes.")]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert op12_turn_repair(spark, str(tmp_path)).count() == 0


def test_conversation_without_rows_left(spark, tmp_path):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "x")], "conv_id long, turn long, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet"))
    assert tuple(op12_turn_repair(spark, str(tmp_path)).first()) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_audit_is_dealt_to_blocks():
    assert R.split_audit("IKDIIRKII", [2, 2]) == ["IKD", "IIRKII"]
    assert R.split_audit("DDD", [1, 1, 1]) == ["D", "D", "D"]
