"""DuckDB SQL twins of the queries that SQL can express."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()

URL_TRIE = f"""
WITH parts AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM parts),
located AS (
    SELECT page_id, translate(raw, '{_UPPER}', '{_LOWER}') AS host,
           regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM split),
rules(rule_host, rule_path, rule_verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
    SELECT page_id, arg_max({{'rule': rule_host || rule_path, 'verdict': rule_verdict}}, length(rule_host || rule_path)) AS best
    FROM located JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id)
SELECT l.page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM located l LEFT JOIN fits USING (page_id)
"""

# The states of a right conversation: 0 start, 1 after system, 2 after user, 3 after assistant. A state's best repair so
# far is a text: cost in nine digits, then the audit; the least text is the best. Rows are taken one by one.
_AFTER = {0: (), 1: ((0, "s"),), 2: ((0, "u"), (1, "u"), (3, "u")), 3: ((2, "a"),)}


def _plus(state: str, cost: str, letter: str) -> str:
    return f"printf('%09d', CAST(left({state}, 9) AS INTEGER) + {cost}) || substr({state}, 10) || '{letter}'"


def _row_step(q: int) -> str:
    ways = [_plus(f"s{q}", "4", "D")]
    for p, r in _AFTER[q]:
        ways.append(f"CASE WHEN fault NOT IN ('b', 'd') AND initial = '{r}' THEN {_plus(f's{p}', 'extra', 'K')} END")
        if r != "s":
            ways.append(f"CASE WHEN fault NOT IN ('b', 'd') THEN {_plus(f's{p}', '3 + extra', 'R')} END")
    return "least(" + ", ".join(ways) + f") AS t{q}" if len(ways) > 1 else f"{ways[0]} AS t{q}"


def _insert_step(q: int, old: str, new: str) -> str:
    ways = [f"{old}{q}"] + [_plus(f"{old}{p}", "3", "I") for p, r in _AFTER[q] if r != "s"]
    return ("least(" + ", ".join(ways) + ")" if len(ways) > 1 else ways[0]) + f" AS {new}{q}"


def _inserted(source: str, keep: str) -> str:
    """Close ``source`` (t0 to t3) under insertions: two rounds reach every state, the third proves it."""
    for old, new in (("t", "v"), ("v", "w"), ("w", "s")):
        source = f"(SELECT {keep}, {', '.join(_insert_step(q, old, new) for q in range(4))} FROM {source})"
    return source


_START = "(SELECT conv_id, 0 AS i, '000000000' AS t0, CAST(NULL AS VARCHAR) AS t1, CAST(NULL AS VARCHAR) AS t2, CAST(NULL AS VARCHAR) AS t3 FROM ids)"
_STEPPED = ("(SELECT b.conv_id, b.i + 1 AS i, " + ", ".join(_row_step(q) for q in range(4)) +
            " FROM best b JOIN judged j ON j.conv_id = b.conv_id AND j.i = b.i + 1)")

TURN_REPAIR = f"""
WITH RECURSIVE crc_table AS (
    SELECT list(v ORDER BY n) AS t FROM (
        SELECT n, list_reduce([n] || range(8), lambda a, k:
            CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS v FROM range(256) r(n))),
keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
kinds AS (
    SELECT k.*, xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(string_split(key, ''), lambda x: CAST(ord(x) AS BIGINT)),
        lambda c, b: xor(t[CAST(xor(c, b) & 255 AS INTEGER) + 1], c // 256)), 4294967295) % 20 AS kind
    FROM keyed k, crc_table),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM kinds WHERE kind <> 0),
ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
           regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS last
    FROM damaged),
judged AS (
    SELECT conv_id, turn, i, role, text, left(role, 1) AS initial,
           CASE WHEN last = '' THEN 'b'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE '.' END AS fault,
           CASE WHEN last NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS extra,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
    FROM ordered),
ids AS (SELECT DISTINCT conv_id FROM conversations),
best AS (
    SELECT conv_id, i, s0, s1, s2, s3 FROM {_inserted(_START, 'conv_id, i')}
    UNION ALL
    SELECT conv_id, i, s0, s1, s2, s3 FROM {_inserted(_STEPPED, 'conv_id, i')}),
chosen AS (
    SELECT conv_id, CAST(left(r, 9) AS BIGINT) AS cost, substr(r, 10) AS audit
    FROM (SELECT conv_id, arg_max(least(s0, s3), i) AS r FROM best GROUP BY conv_id)),
edits AS (
    SELECT conv_id, k, edit, sum(CASE WHEN edit = 'I' THEN 0 ELSE 1 END) OVER w AS i,
           sum(CASE WHEN edit = 'D' THEN 0 ELSE 1 END) OVER w AS place, total
    FROM (SELECT conv_id, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS k,
                 length(replace(audit, 'D', '')) AS total FROM chosen WHERE audit <> '')
    WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
lines AS (
    SELECT e.conv_id, string_agg(
        CASE WHEN edit = 'K' THEN role WHEN (place + total) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
        CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY place) AS repaired
    FROM edits e LEFT JOIN judged j ON j.conv_id = e.conv_id AND j.i = e.i
    WHERE edit <> 'D' GROUP BY e.conv_id),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
           count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit,
       sha256(coalesce(repaired, '')) AS repaired_sha256
FROM ids JOIN chosen USING (conv_id) LEFT JOIN counts USING (conv_id) LEFT JOIN lines USING (conv_id)
"""

_TERMS = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

TILE_RANKING = f"""
WITH doc_terms AS (
    SELECT rid, doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERMS}')) AS term
    FROM (SELECT doc_id, text, row_number() OVER () AS rid FROM documents)),
lengths AS (SELECT rid, any_value(doc_id) AS doc_id, count(*) AS n FROM doc_terms GROUP BY rid),
corpus AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths),
item_terms AS (
    SELECT DISTINCT item_id, term FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERMS}')) AS term FROM benchmark)),
tf AS (SELECT rid, term, count(*) AS tf FROM doc_terms WHERE term IN (SELECT term FROM item_terms) GROUP BY rid, term),
weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), corpus),
impacts AS (
    SELECT rid, term, (1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)) AS impact
    FROM tf JOIN lengths USING (rid), corpus),
scores AS (
    SELECT item_id, rid, CAST(sum(w * impact) AS BIGINT) AS score
    FROM item_terms JOIN weights USING (term) JOIN impacts USING (term) GROUP BY item_id, rid)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
    SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
    FROM scores JOIN lengths USING (rid) WHERE score > 0)
WHERE rank <= 10
"""

ORACLE_SQL: dict[str, str] = {
    "op11_url_trie": URL_TRIE,
    "op12_turn_repair": TURN_REPAIR,
    "op13_tile_ranking": TILE_RANKING,
}
