"""Personal data with offset-preserving deobfuscation.

Identifiers are found twice: in the text as it is (the base spans), and in a normalised text that a
chain of transducers makes. Each transducer replaces stretches and keeps, for every character it writes, the
stretch of the source it came from; spans found in the normalised text are mapped back through the chain, so that they
cover the disguise in the source. The transducers, in order:

1. characters: look-alike letters, full-width and other compatibility forms of ASCII, decimal digits of all scripts; invisible
   characters go;
2. separators: ``[at]``, ``(at)``, `` at ``, ``[dot]``, `` dot `` (and ``arroba``, ``arobase``, ``punto``, ``punkt``) between the parts of an
   address, in any white space; `` at `` and a plain ``@`` count only before a host whose dots are spelled too, as the word is common and the
   sign needs no change: ``john at example.com`` stays. Spelled dots before the sign count with it. Four numbers between spelled dots,
   spelled digit by digit or not, are an IP address;
3. digits: runs of spelled digits (four languages), round brackets in them, ``plus`` before them becomes ``+``.

A mapped span is added if it touches a replaced stretch and no base span of its kind holds it; base spans, which may
be fragments of added ones, stay. Every pattern is matched in time linear in the text: mail addresses are searched from their at signs, digit runs are taken whole.

Nulls are empty texts; repeated rows give equal results; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexrev.llm.common import map_batches, sha256_hex

KINDS = ("email", "ip", "card", "phone")

# --- detection -----------------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_IP_HINT = re.compile(r"\.[0-9]++\.[0-9]++\.[0-9]")  # starts with a fixed character, so most texts are passed over fast
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(t: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, t.find("@")
    while at >= 0:
        m = _DOMAIN.match(t, at + 1)
        nxt = at + 1
        if m:
            lo = at
            while lo > done and t[lo - 1] in _LOCAL:
                lo -= 1
            if lo < at:
                out.append((lo, m.end()))
                done = nxt = m.end()
        at = t.find("@", nxt)
    return out


def ips(t: str) -> list[tuple[int, int]]:
    if not _IP_HINT.search(t):
        return []

    def small(part: str) -> bool:
        part = part.lstrip("0")
        return len(part) < 3 or len(part) == 3 and part <= "255"

    return [m.span() for m in _IP.finditer(t) if all(map(small, m.group().split(".")))]


def luhn(digits: str) -> bool:
    total = sum(int(c) for c in digits[::-2]) + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join([c for c in s if "0" <= c <= "9"])


def cards(t: str) -> list[tuple[int, int]]:
    return [m.span() for m in _CARD.finditer(t)
            if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d)]


def phones(t: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(t) if 9 <= len(_digits(m.group())) <= 15]


FINDERS: tuple[Callable[[str], list[tuple[int, int]]], ...] = (emails, ips, cards, phones)

# --- transducers -----------------------------------------------------------------------------------

# Cyrillic and Greek letters that look like Latin ones.
LOOKALIKES = dict(zip(
    "АВЕКМНОРСТХУІЈЅаеорсухіјѕԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧονυ",
    "ABEKMHOPCTXYIJSaeopcyxijsdqwABEZHIKMNOPTYXovu", strict=True))
# Characters that show nothing.
INVISIBLE = "­​‌‍⁠﻿"
# Digits spelled in English, German, French and Spanish.
SPELLED = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "null": 0, "eins": 1, "zwei": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}


def _character_table() -> dict[int, str]:
    """Compatibility forms of printable ASCII (full width, mathematical, circled digits) and the look-alikes."""
    table = {ord(c): "" for c in INVISIBLE} | {ord(k): v for k, v in LOOKALIKES.items()}
    for lo, hi in ((0x2460, 0x2468), (0x2024, 0x2024), (0xFE52, 0xFE6B), (0xFF01, 0xFF5E), (0x1D400, 0x1D7FF)):
        for cp in range(lo, hi + 1):
            form = unicodedata.normalize("NFKC", chr(cp))
            if len(form) == 1 and "!" <= form <= "~":
                table[cp] = form
    digits = {cp: str(unicodedata.decimal(chr(cp))) for cp in range(0x80, 0x20000) if unicodedata.category(chr(cp)) == "Nd"}
    return digits | table


_TABLE = _character_table()
_ODD = frozenset(map(chr, _TABLE))
_BEYOND_ASCII = re.compile(r"[^\x00-\x7f]")
# Runs of white space are taken whole, from their first character on: linear however long they are.
_OPEN, _CLOSE = r"(?<!\s)\s*+[\[({<]\s*+", r"\s*+[\])}>]\s*+"
_AT_WORD, _DOT_WORD = "(?:at|arroba|arobase)", "(?:dot|punto|punkt)"
_AT = re.compile(rf"{_OPEN}(?:{_AT_WORD}|@){_CLOSE}|(?<!\s)\s++{_AT_WORD}\s++|@", re.IGNORECASE)
_DOT = rf"(?:{_OPEN}(?:{_DOT_WORD}|\.){_CLOSE}|(?<!\s)\s++{_DOT_WORD}\s++|\.)"
_HOST = re.compile(rf"[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)+", re.IGNORECASE)
_DOTS = re.compile(_DOT, re.IGNORECASE)
_SPELT_IP = re.compile(rf"(?<![0-9])[0-9]++(?:{_DOT}[0-9]++){{3}}(?![0-9])", re.IGNORECASE)
_SPELLED_DOT = re.compile(rf"\s{_DOT_WORD}\s", re.IGNORECASE)
_NUMBER = "(?:" + "|".join(sorted(SPELLED, key=lambda w: (-len(w), w))) + r"|[0-9])"
_RUN = re.compile(rf"(?:(?<!\w)plus[ -]{{1,2}}|\+ ?)?(?<!\w)\(?{_NUMBER}(?:[ ()-]{{0,3}}{_NUMBER}){{6,}}(?!\w)", re.IGNORECASE)
_ONE = re.compile(rf"{_NUMBER}|plus[ -]{{1,2}}|[+()]|[ -]+", re.IGNORECASE)
_BRACKETED = re.compile(rf"[\[({{<]\s*+(?:{_AT_WORD}|@|{_DOT_WORD}|\.)\s*+[\])}}>]", re.IGNORECASE)
_WORD_PART = rf"(?:(?<!\w){_NUMBER}(?:[ -]?{_NUMBER}){{0,2}}(?!\w))"
_WORD_IP = re.compile(rf"{_WORD_PART}(?:{_DOT}{_WORD_PART}){{3}}", re.IGNORECASE)
#: A run must hold one of these ("un" alone is too common a word).
_TELLING = frozenset(SPELLED) - {"un"}


def _rests(words: frozenset[str]) -> dict[str, str]:
    """What follows each first letter of the words."""
    return {c: "|".join(sorted((w[1:] for w in words if w[0] == c), key=lambda w: (-len(w), w))) for c in sorted({w[0] for w in words})}


def _by_first(words: frozenset[str]) -> str:
    return "(?:" + "|".join(f"{c}(?:{r})" for c, r in _rests(words).items()) + ")"


# Cheap searches in the folded text: without both there is no run. The class in front lets the search pass over other letters.
_WORD = re.compile(_by_first(_TELLING))
_SEVEN = re.compile(
    "[0-9" + "".join(_rests(frozenset(SPELLED))) + r"](?<!\w.)(?:(?<=[0-9])|"
    + "|".join(f"(?<={c})(?:{r})" for c, r in _rests(frozenset(SPELLED)).items())
    + rf")(?:[ ()-]{{0,3}}(?:[0-9]|{_by_first(frozenset(SPELLED))})){{6}}", re.DOTALL)

Edits = list[tuple[int, int, str]]


def odd_characters(t: str) -> Edits:
    if t.isascii():
        return []
    if _ODD.isdisjoint(t):  # a set of characters is tested much faster than a class of the whole table
        return []
    return [(m.start(), m.end(), _TABLE[c]) for m in _BEYOND_ASCII.finditer(t) if (c := ord(m.group())) in _TABLE]


def separators(t: str) -> Edits:
    if not _SPELLED_DOT.search(t) and not (any(c in t for c in "[({<") and _BRACKETED.search(t)):
        return []
    out: Edits = []
    ends = {d.end(): d for d in _DOTS.finditer(t) if d.end() - d.start() > 1}  # spelled dots by where they end
    for m in _AT.finditer(t):
        host = _HOST.match(t, m.end())
        if not host or m.start() == 0 or t[m.start() - 1] not in _LOCAL:
            continue
        spelled = [(d.start(), d.end(), ".") for d in _DOTS.finditer(t, host.start(), host.end()) if d.end() - d.start() > 1]
        if spelled or m.group().strip()[0] in "[({<":
            if m.group() != "@":
                out.append((m.start(), m.end(), "@"))
            out += spelled
            at = m.start()
            while at > 0 and t[at - 1] in _LOCAL:
                at -= 1
                if at in ends and ends[at].start() > 0 and t[ends[at].start() - 1] in _LOCAL:
                    d = ends.pop(at)  # once: the walks of many signs do not meet
                    out.append((d.start(), d.end(), "."))
                    at = d.start()
    for m in _SPELT_IP.finditer(t):
        out += [(d.start(), d.end(), ".") for d in _DOTS.finditer(t, m.start(), m.end()) if d.end() - d.start() > 1]
    if ends and _WORD.search(t.casefold()):
        for m in _WORD_IP.finditer(t):
            at, dots = m.start(), [*_DOTS.finditer(t, m.start(), m.end()), None]
            for d in dots:
                stop = d.start() if d else m.end()
                digits = "".join(str(SPELLED.get(p, p)) for p in (x.group().lower() for x in _ONE.finditer(t, at, stop)) if p.strip(" -"))
                out.append((at, stop, digits))
                if d:
                    out.append((d.start(), d.end(), "."))
                    at = d.end()
    return out


def spelled_digits(t: str) -> Edits:
    low = t.casefold()
    if not _SEVEN.search(low) or not _WORD.search(low):
        return []
    out: Edits = []
    for m in _RUN.finditer(t):
        parts = [(p, p.group().lower()) for p in _ONE.finditer(t, m.start(), m.end())]
        if _TELLING.isdisjoint(w for _, w in parts):
            continue
        for p, w in parts:
            if w in SPELLED:
                out.append((p.start(), p.end(), str(SPELLED[w])))
            elif w.startswith("plus"):
                out.append((p.start(), p.end(), "+"))
            elif w in "()":
                out.append((p.start(), p.end(), ""))
            elif w[0] in " -" and len(w) > 1:
                out.append((p.start(), p.end(), " "))
            elif w == "+" and t[p.end():p.end() + 1] == " ":
                out.append((p.start(), p.end() + 1, "+"))
    return out


class Transduced:
    """A text and, for each of its characters, the source stretch it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.lo = np.arange(len(text))
        self.hi = self.lo + 1
        self.new = np.zeros(len(text), bool)

    def apply(self, edits: Edits) -> None:
        parts, lo, hi, new, at = [], [], [], [], 0
        for a, b, to in sorted(edits):
            if a < at:  # overlaps the edit before
                continue
            parts += [self.text[at:a], to]
            lo += [self.lo[at:a], np.full(len(to), self.lo[a])]
            hi += [self.hi[at:a], np.full(len(to), self.hi[b - 1])]
            new += [self.new[at:a], np.ones(len(to), bool)]
            at = b
        self.text = "".join([*parts, self.text[at:]])
        self.lo, self.hi, self.new = (np.concatenate([*x, y[at:]]) for x, y in ((lo, self.lo), (hi, self.hi), (new, self.new)))


TRANSDUCERS = (odd_characters, separators, spelled_digits)


def find(t: str) -> tuple[list[list[tuple[int, int]]], list[list[tuple[int, int]]]]:
    """Base spans and added spans of a text, each by kind."""
    base = [f(t) for f in FINDERS]
    added: list[list[tuple[int, int]]] = [[] for _ in KINDS]
    way = None
    for transducer in TRANSDUCERS:
        if edits := transducer(way.text if way else t):
            way = way or Transduced(t)
            way.apply(edits)
    if way:
        cuts = np.cumsum(np.concatenate([[0], way.new | (np.diff(way.lo, prepend=-1) > 1)]))
        for k, f in enumerate(FINDERS):
            starts = [a for a, _ in base[k]]
            for a, b in f(way.text):
                lo, hi = int(way.lo[a]), int(way.hi[b - 1])
                i = bisect_right(starts, lo)
                if cuts[b] > cuts[a] and (i == 0 or base[k][i - 1][1] < hi):
                    added[k].append((lo, hi))
    return base, added


def _line(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join([f"{kind}:{a}:{b}" for kind, own in zip(KINDS, spans, strict=True) for a, b in sorted(own)])


def personal_data(docs: DataFrame) -> DataFrame:
    """Spans of every row of ``docs(doc_id, text)``, in code points, ends exclusive.

    Returns doc_id, n_email, n_ip, n_card, n_phone (base spans), n_added (spans that the transducers add), base (kind:start:end
    by kind, then start, joined with commas), base_sha256, spans (base and added, joined likewise).
    """
    def fn(b: pa.RecordBatch):
        rows = []
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            base, added = find(t or "")
            line = _line(base)
            both = _line([x + y for x, y in zip(base, added, strict=True)])
            rows.append((i, *map(len, base), sum(map(len, added)), line, sha256_hex(line.encode()), both))
        kinds = [pa.int64()] * 6 + [pa.string()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "n_added", "base", "base_sha256", "spans"]
    schema = ", ".join(f"{n} {'string' if n in names[6:] else 'long'}" for n in names)
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), fn, schema)


def mask_text(t: str) -> str:
    """The text with every span (overlapping ones merged) replaced by its kind in brackets."""
    base, added = find(t)
    spans = sorted((a, b, k) for k, kind in enumerate(KINDS) for a, b in base[k] + added[k])
    parts, at = [], 0
    for n, (a, b, k) in enumerate(spans):
        if a >= at or n == 0:
            parts += [t[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*parts, t[at:]])


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked in ``text`` and ``n_chars`` (where there is one) counted anew; null stays null."""
    @F.pandas_udf("string")
    def masked(s):
        return s.map(lambda t: None if t is None else mask_text(t))

    out = docs.withColumn("text", masked("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
