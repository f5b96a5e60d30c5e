"""Column-level text helpers (all JVM-side built-ins, no Python UDFs).

Semantics follow Python's ``str`` methods and ``re`` module as used by the
reviewed application: Unicode whitespace for ``split``/``strip``, Unicode
``\\w \\d \\s \\b`` classes, code-point lengths and offsets.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.isspace() accepts (str.split()/str.strip() use them).
PY_WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + \
    "\u2028\u2029\u202f\u205f\u3000"
# ... of which Java's ASCII \s does not know these; a text holding one takes the slower, exact path.
EXOTIC_WS_CHARS = "".join(ch for ch in PY_WS_CHARS if ch not in " \t\n\x0b\x0c\r")
EXOTIC_WS = "[\\x1C-\\x1F\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]"
# A word of str.split(): printable ASCII is tested first, being what most characters are.
WORD_REGEX = "[!-~[^\\t\\n\\x0B\\f\\r\\x1C\\x1D\\x1E\\x1F\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]]+"
# The characters beyond ASCII that match an ASCII letter when case is ignored.
FOLDED_CHARS = "\u0130\u0131\u017f\u212a"


def _ascii_ws(c: Column) -> Column:
    """Map the whitespace Java's \\s lacks to a space, only for texts that hold some."""
    return F.when(c.rlike(EXOTIC_WS), F.translate(c, EXOTIC_WS_CHARS, " " * len(EXOTIC_WS_CHARS))).otherwise(c)


# Python's cased-character tests use Unicode's derived Uppercase/Lowercase properties
# (categories Lu/Ll plus Other_Uppercase/Other_Lowercase) and Titlecase (Lt).
CASED_UPPER = "[\\p{IsUppercase}\\p{IsTitlecase}]"
CASED_LOWER = "\\p{IsLowercase}"
UNCASED_NON_WS = "[^\\p{IsUppercase}\\p{IsLowercase}\\p{IsTitlecase}\\s]"


def py_regex(pattern: str, ignore_case: bool = False) -> str:
    """Python ``re`` pattern -> Java pattern with Python's semantics.

    Unicode classes, ``.`` and ``$`` that take only line feed for a line end (Java also takes carriage return, U+0085, U+2028
    and U+2029), and Python's spelling of named groups.
    """
    pattern = re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", pattern.replace("(?P<", "(?<"))
    return ("(?idU)" if ignore_case else "(?dU)") + pattern


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """``str.strip()``: remove leading/trailing Unicode whitespace (a character-set trim)."""
    return F.btrim(col_of(c), F.lit(PY_WS_CHARS))


def word_count(c: Column | str) -> Column:
    """``len(s.split())`` as BIGINT; 0 for null or blank."""
    c = col_of(c)
    # most texts hold nothing but printable ASCII and white space: their words are runs of one range
    n = F.when(c.rlike("[^\\t-\\r -~]"), F.regexp_count(c, F.lit(WORD_REGEX))).otherwise(F.regexp_count(c, F.lit("[!-~]+")))
    return F.coalesce(n, F.lit(0)).cast("long")


def words(c: Column | str) -> Column:
    """``s.split()`` as an array (empty for blank text)."""
    return F.filter(F.split(_ascii_ws(F.coalesce(col_of(c), F.lit(""))), "\\s+"), lambda w: w != "")


def sentence_count(c: Column | str) -> Column:
    """Number of runs of ``.``, ``!`` or ``?``."""
    return F.coalesce(F.regexp_count(col_of(c), F.lit("[.!?]+")), F.lit(0)).cast("long")


def non_ws_chars(c: Column | str) -> Column:
    """Sum of the lengths of the whitespace-separated words."""
    return F.length(F.translate(col_of(c), PY_WS_CHARS, "")).cast("long")


def round_half_up(c: Column, n: int) -> Column:
    """Round to ``n`` decimals: floor(x*10^n + 0.5) / 10^n in DOUBLE (same in DuckDB)."""
    scale = float(10 ** n)
    return F.floor(c.cast("double") * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def contains_count(lower_text: Column, terms: Iterable[str]) -> Column:
    """How many distinct ``terms`` occur as substrings (text already lower-cased)."""
    terms = list(dict.fromkeys(terms))
    expr = F.lit(0)
    for t in terms:
        expr = expr + F.when(lower_text.contains(t.lower()), 1).otherwise(0)
    return expr.cast("long")


def contains_any(lower_text: Column, terms: Iterable[str]) -> Column:
    cond = F.lit(False)
    for t in terms:
        cond = cond | lower_text.contains(t.lower())
    return cond


def terms_present(lower_text: Column, terms: Iterable[str]) -> Column:
    """The terms that occur as substrings, in list order."""
    return F.filter(F.array(*[F.lit(t) for t in terms]), lambda x: lower_text.contains(x))


def is_upper(c: Column | str) -> Column:
    """``str.isupper()``: some cased character and no lower/title-case one."""
    c = col_of(c)
    return F.coalesce(
        c.rlike("\\p{IsUppercase}") & ~c.rlike("[\\p{IsLowercase}\\p{IsTitlecase}]"), F.lit(False)
    )


# A whitespace-free word passes str.istitle(): upper/title-case letters only after
# uncased characters, lower-case letters only after cased ones, at least one cased.
_TITLE_WORD = (
    f"{UNCASED_NON_WS}*{CASED_UPPER}{CASED_LOWER}*(?:{UNCASED_NON_WS}+{CASED_UPPER}{CASED_LOWER}*)*{UNCASED_NON_WS}*"
)
TITLE_WORD_IN_TEXT = f"(?U)(?:^|\\s){_TITLE_WORD}(?=\\s|$)"


def has_title_word(c: Column | str) -> Column:
    """``any(w.istitle() for w in s.split())``."""
    return F.coalesce(col_of(c).rlike(TITLE_WORD_IN_TEXT), F.lit(False))


def title_words(c: Column) -> Column:
    """``s.replace('_', ' ').title()`` for identifier-like strings."""
    return F.initcap(F.regexp_replace(c, "_", " "))


def percent1(c: Column) -> Column:
    """Python ``f'{x:.1%}'`` with half-up rounding."""
    return F.concat(F.format_string("%.1f", round_half_up(c * F.lit(100.0), 1)), F.lit("%"))


# Generators over computed arrays.  An inner explode/inline makes Catalyst infer
# ``size(array) > 0`` and push that filter below the projection that builds the array,
# where it is inlined and the array is computed twice.  The outer generators infer
# nothing; the empty-array row they emit is dropped right after the generator.
def inline_rows(df, keep: list, arr: Column, present: str):
    """``inline`` of an array of structs; ``present`` is a field that is never null in an element."""
    return df.select(*keep, F.inline_outer(arr)).where(F.col(present).isNotNull())


def explode_rows(df, keep: list, arr: Column, name: str, pos: str | None = None):
    """``explode`` (or ``posexplode`` when ``pos`` is given) of an array without null elements."""
    if pos:
        return df.select(*keep, F.posexplode_outer(arr).alias(pos, name)).where(F.col(name).isNotNull())
    return df.select(*keep, F.explode_outer(arr).alias(name)).where(F.col(name).isNotNull())


def pinned(*arrays: Column) -> Column:
    """Always true for non-null arrays; a second reference that keeps each array materialised.

    Catalyst's CollapseProject inlines a producer that its consumer references only once --
    also into a lambda, where it would then be recomputed for every element.  Guarding an
    expression with ``F.when(pinned(a, b), ...)`` makes the arrays it reads inside lambdas
    referenced twice, so they stay columns of the previous projection.
    """
    cond = F.lit(True)
    for a in arrays:
        cond = cond & (F.size(a) >= 0)
    return cond


def seq0(n: Column) -> Column:
    """0 .. n-1 as an int array (empty when n <= 0)."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def literal_prefix(pattern: str) -> str:
    """The literal text every match of ``pattern`` starts with ('' when there is none).

    Read from Python's own regex parse tree: the leading LITERAL nodes of a pattern without
    a top-level alternation.  Only ASCII letters, digits and spaces are kept.
    """
    import re._parser as sre_parse  # stdlib regex parser

    try:
        tree = sre_parse.parse(pattern)
    except re.error:
        return ""
    out = []
    for op, arg in tree:
        if op is not sre_parse.LITERAL:
            break
        ch = chr(arg)
        if not (ch.isascii() and (ch.isalnum() or ch == " ")):
            break
        out.append(ch)
    return "".join(out)


def pattern_fault(spark, pattern: str, find_all: bool = False) -> str | None:
    """Why a rule pattern cannot be used (``None``: it can).

    It must compile in Python's syntax and, translated, in Java's. With ``find_all`` it must not match the
    empty text: engines differ in where such matches start, so their offsets would be wrong.
    """
    import re._parser as sre_parse  # stdlib regex parser

    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException

    try:
        least = sre_parse.parse(pattern, re.IGNORECASE).getwidth()[0]
    except (re.error, OverflowError) as e:
        return f"invalid pattern: {e}"
    if find_all and least == 0:
        return "the pattern can match the empty text"
    try:
        spark._jvm.java.util.regex.Pattern.compile(py_regex(pattern, ignore_case=True))
    except (Py4JJavaError, PySparkException) as e:
        return f"unsupported pattern: {str(e).splitlines()[0]}"
    return None


def is_ascii(c: Column) -> Column:
    """True when every character is ASCII (bytes = characters)."""
    return F.octet_length(c) == F.length(c)


def is_plain(c: Column) -> Column:
    """True when no character beyond ASCII matches an ASCII letter, case ignored: a literal of ASCII letters that
    a pattern requires is then in the lower-cased text."""
    folded = F.lit(False)
    for ch in FOLDED_CHARS:
        folded = folded | c.contains(ch)
    return is_ascii(c) | ~folded


def shared_parts(terms: Iterable[str], least: int = 3) -> dict[str, str]:
    """Of each lower-case term that has one, the part that most terms hold: a word of some term, of ``least`` letters or more.

    A term that is used twice counts twice.  Parts that only one use of a term would take are left out.
    """
    terms = list(terms)
    words = {w for t in terms for w in t.split() if len(w) >= least}
    held = {t: {w[i:j] for w in t.split() for i in range(len(w)) for j in range(i + least, len(w) + 1)} & words
            for t in set(terms)}
    uses = Counter(w for t in terms for w in held[t])
    part = {t: max(ws, key=lambda w: (uses[w], len(w), w)) for t, ws in held.items() if ws}
    taken = Counter(part[t] for t in terms if t in part)
    return {t: w for t, w in part.items() if taken[w] > 1}


def with_parts(d, lower: str, terms: Iterable[str], out: str):
    """(``d`` with ``out``, a function): ``out`` tells which shared parts of the lower-case ``terms`` are in the text ``lower``;
    the function of a term gives whether the text contains it, which is looked up only where its part is there."""
    part = shared_parts(terms)
    parts = sorted(set(part.values()))
    at = {w: i for i, w in enumerate(parts)}
    text = F.col(lower)
    # the guard keeps the array a column: CollapseProject would inline the lookups of a bare one
    d = d.select("*", F.when(F.octet_length(text) >= 0, F.array(*[text.contains(w) for w in parts]).cast("array<boolean>")).alias(out))

    def contains(term: str) -> Column:
        if term not in part:
            return text.contains(term)
        found = F.col(out)[at[part[term]]]
        return found if part[term] == term else found & text.contains(term)

    return d, contains


def holds(required: Iterable[Iterable[str]], contains) -> Column:
    """Whether a text holds one literal of each set, by a function of a literal (see ``with_parts``)."""
    every = F.lit(True)
    for literals in required:
        one = F.lit(False)
        for t in sorted(literals):
            one = one | contains(t)
        every = every & one
    return every
