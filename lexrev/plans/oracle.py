"""DuckDB twins of the registered queries (independent SQL over the same parquet views).

The SQL is generated from the same fixed rule values, but every operator is
restated in plain SQL (lists, regexes, window functions), so it is an
independent check of the Spark plans.  Regexes are RE2: the one flag rule with
a negative look-ahead is restated as "match with optional suffix, keep those
without it".
"""

from __future__ import annotations

from lexrev import rulepacks as RP
from lexrev.sources.rules import flag_rule_rows, process_rule_rows, requirement_rows, type_rule_rows
from lexrev.sources.seeds import CUSTOM_FLAG_RULES, SEARCHED_FLAG_RULES, SEED_CLAUSES, seeds_sql_values

NL = "chr(10)"


def sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def wc(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, '\\S+')) AS BIGINT)"


def sc(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, '[.!?]+')) AS BIGINT)"


def rhu(x: str, n: int) -> str:
    s = float(10 ** n)
    return f"(floor(CAST({x} AS DOUBLE) * {s}::DOUBLE + 0.5::DOUBLE) / {s}::DOUBLE)"


def ccount(lx: str, terms) -> str:
    return "(" + " + ".join(f"CASE WHEN contains({lx}, {sq(t.lower())}) THEN 1 ELSE 0 END"
                            for t in dict.fromkeys(terms)) + ")"


def cany(lx: str, terms) -> str:
    return "(" + " OR ".join(f"contains({lx}, {sq(t.lower())})" for t in terms) + ")"


def is_upper(x: str) -> str:
    return f"(regexp_matches({x}, '\\p{{Lu}}') AND NOT regexp_matches({x}, '[\\p{{Ll}}\\p{{Lt}}]'))"


def is_header(x: str) -> str:
    return f"({is_upper(x)} OR regexp_matches({x}, {sq('(?i)' + RP.HEADER_PATTERN)}))"


SECTION_RE = "(?i)^(?:" + "|".join(RP.SECTION_PATTERNS) + ")"
LIST_RE = "^(?:" + RP.LIST_ITEM_PATTERN[1:] + ")"


def opens_section(x: str) -> str:
    return f"({is_header(x)} OR regexp_matches({x}, {sq(SECTION_RE)}))"


def content_type(x: str) -> str:
    lx = f"lower({x})"
    return (
        f"CASE WHEN {lx} = '' THEN 'empty' WHEN {is_header(lx)} THEN 'header' "
        f"WHEN regexp_matches({lx}, {sq(LIST_RE)}) THEN 'list_item' WHEN {wc(lx)} < 5 THEN 'short_text' "
        f"WHEN {cany(lx, RP.OBLIGATION_WORDS)} THEN 'legal_obligation' "
        f"WHEN {cany(lx, RP.DEFINITION_WORDS)} THEN 'definition' ELSE 'body_paragraph' END"
    )


def significance(x: str) -> str:
    n = ccount(f"lower({x})", RP.SIGNIFICANCE_WORDS)
    return f"CASE WHEN {n} >= 3 THEN 'high' WHEN {n} >= 1 THEN 'medium' ELSE 'low' END"


def title_words(x: str) -> str:
    """initcap of an identifier with '_' -> ' ' (words are letters only)."""
    return (f"array_to_string(list_transform(string_split(replace({x}, '_', ' '), ' '), "
            f"lambda w: upper(w[1:1]) || lower(w[2:])), ' ')")


def percent1(x: str) -> str:
    return f"(printf('%.1f', {rhu(f'({x}) * 100.0::DOUBLE', 1)}) || '%')"


# ------------------------------------------------------------------ CTE library
SEEDED = (
    f"seeded AS (SELECT d.doc_id, d.source, concat_ws({NL}, s.head, d.text, s.tail) AS text "
    f"FROM documents d LEFT JOIN {seeds_sql_values()} ON s.seed = d.doc_id % {len(SEED_CLAUSES)})"
)
LINES = (
    f"lines AS (SELECT seeded.doc_id, seeded.source, CAST(u.ord - 1 AS BIGINT) AS idx, u.line AS raw "
    f"FROM seeded, unnest(string_split(coalesce(seeded.text, ''), {NL})) WITH ORDINALITY AS u(line, ord))"
)
PARAS = (
    "paras0 AS (SELECT doc_id, source, idx, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS text FROM lines), "
    f"paras AS (SELECT doc_id, source, idx, text, {opens_section('text')} AS opens, {is_header('text')} AS is_header "
    "FROM paras0 WHERE text <> '')"
)
FT = (
    "ft AS (SELECT s.doc_id, s.source, coalesce(string_agg(p.text, ' ' ORDER BY p.idx), '') AS full_text, "
    "count(p.idx) AS n_par, coalesce(sum(CASE WHEN p.is_header THEN 1 ELSE 0 END), 0) AS n_head "
    "FROM seeded s LEFT JOIN paras p ON p.doc_id = s.doc_id GROUP BY s.doc_id, s.source)"
)
SECS = (
    "secp AS (SELECT doc_id, idx, text, opens, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER "
    "(PARTITION BY doc_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sec FROM paras), "
    "secs AS (SELECT doc_id, CAST(sec AS BIGINT) AS sec, max(CASE WHEN opens THEN text END) AS title, "
    "CAST(count(*) AS BIGINT) AS paragraph_count, CAST(min(idx) AS BIGINT) AS first_idx, "
    "string_agg(text, ' ' ORDER BY idx) AS body FROM secp WHERE sec > 0 GROUP BY doc_id, sec)"
)
TROWS = (
    "tl AS (SELECT doc_id, idx, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS line FROM lines), "
    "tl2 AS (SELECT doc_id, idx, line, contains(line, ' | ') AS is_row FROM tl), "
    "tl3 AS (SELECT doc_id, idx, line, idx - row_number() OVER (PARTITION BY doc_id ORDER BY idx) AS grp "
    "FROM tl2 WHERE is_row), "
    "tbl0 AS (SELECT doc_id, grp, CAST(min(idx) AS BIGINT) AS first_line, "
    "list(list_transform(string_split(line, '|'), lambda c: regexp_replace(c, '^\\s+|\\s+$', '', 'g')) "
    "ORDER BY idx) AS rows FROM tl3 GROUP BY doc_id, grp), "
    "tbl AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY first_line) - 1 AS BIGINT) "
    "AS table_idx, first_line, rows FROM tbl0)"
)


def with_(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


BASE = [SEEDED, LINES, PARAS, FT]


# ------------------------------------------------------------------ red flags
def _flag_rule_sql(rules):
    """Per rule: (rule_id, RE2 pattern used for extraction, suffix regex that voids a match or NULL)."""
    out = []
    for rid, pat, issue, sev, sug, ref, cat in rules:
        neg = None
        if "(?!" in pat:
            base, rest = pat.split("(?!", 1)
            suffix = rest[:-1]
            pat = base + "(" + suffix + ")?"
            neg = suffix
        out.append((rid, "(?i)" + pat, neg, issue, sev, sug, ref, cat))
    return out


def _rules_values(rules) -> str:
    rows = ", ".join(
        f"({rid}, {sq(p)}, {sq('(?i)' + n + '$') if n else 'NULL'}, {sq(issue)}, {sq(sev)}, {sq(sug)}, {sq(ref)}, "
        f"{sq(cat)})"
        for rid, p, n, issue, sev, sug, ref, cat in _flag_rule_sql(rules)
    )
    return f"(VALUES {rows}) AS r(rule_id, pat, voids, issue, severity, suggestion, reference, category)"


RULES = f"rules AS (SELECT * FROM {_rules_values(flag_rule_rows())})"
# the usable rules of the custom pack (its last one is rejected)
CUSTOM_RULES = f"rules AS (SELECT * FROM {_rules_values([(i, *r) for i, r in enumerate(CUSTOM_FLAG_RULES[:-1])])})"
FLAGS = (
    "fm AS (SELECT ft.doc_id, ft.source, r.rule_id, r.pat, r.voids, regexp_extract_all(ft.full_text, r.pat) AS m, "
    "string_split_regex(ft.full_text, r.pat) AS g FROM ft, rules r WHERE regexp_matches(ft.full_text, r.pat)), "
    "fx AS (SELECT doc_id, source, rule_id, voids, CAST(u.i AS BIGINT) AS i, u.mt AS mt, "
    "coalesce(list_sum(list_transform(g[1:u.i], lambda x: length(x))), 0) + "
    "coalesce(list_sum(list_transform(m[1:u.i - 1], lambda x: length(x))), 0) AS start "
    "FROM fm, unnest(m) WITH ORDINALITY AS u(mt, i)), "
    "fy AS (SELECT doc_id, source, rule_id, start, "
    "CASE WHEN voids IS NULL THEN mt ELSE mt END AS mt FROM fx "
    "WHERE voids IS NULL OR NOT regexp_matches(mt, voids)), "
    "flags AS (SELECT fy.doc_id, fy.source, fy.rule_id, "
    "CAST(row_number() OVER (PARTITION BY fy.doc_id, fy.rule_id ORDER BY fy.start) AS BIGINT) AS occurrence, "
    "fy.mt AS matched_text, CAST(fy.start AS BIGINT) AS start, CAST(fy.start + length(fy.mt) AS BIGINT) AS \"end\", "
    "r.issue, r.severity, r.suggestion, r.reference, r.category, r.pat "
    "FROM fy JOIN rules r ON r.rule_id = fy.rule_id)"
)
FLAG_BASE = BASE + [RULES, FLAGS]

# paragraph-level rule matches (a paragraph matches when one of its matches survives the void test)
PARA_HITS = (
    "ph AS (SELECT p.doc_id, p.idx, p.text, r.rule_id, "
    "len(list_filter(regexp_extract_all(p.text, r.pat), lambda x: r.voids IS NULL OR NOT regexp_matches(x, r.voids))) "
    "AS n_in_para FROM paras p, rules r WHERE regexp_matches(p.text, r.pat)), "
    "nd AS (SELECT doc_id, rule_id, count(*) AS n_doc FROM flags GROUP BY doc_id, rule_id)"
)



def _sev_values(severities) -> str:
    return "(VALUES " + ", ".join(f"({sq(s)})" for s in severities) + ") AS sv(severity)"


ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["red_flags"] = with_(*FLAG_BASE) + (
    "SELECT doc_id, CAST(rule_id AS BIGINT) AS rule_id, occurrence, matched_text, start, \"end\", severity, category "
    "FROM flags"
)


SEARCHED_RULES = "rules AS (SELECT * FROM " + _rules_values(
    [(i, twin or pat, *rest) for i, (pat, *rest, twin) in enumerate(SEARCHED_FLAG_RULES)]) + ")"
ORACLE_SQL["red_flags_searched"] = with_(*BASE, SEARCHED_RULES, FLAGS) + (
    "SELECT doc_id, CAST(rule_id AS BIGINT) AS rule_id, occurrence, matched_text, start, \"end\", severity, category "
    "FROM flags"
)


def _by_severity(rules: str, severities) -> str:
    return with_(*BASE, rules, FLAGS) + (
        "SELECT b.source, sv.severity, CAST(coalesce(c.n, 0) AS BIGINT) AS issues "
        f"FROM (SELECT DISTINCT source FROM documents) b CROSS JOIN {_sev_values(severities)} "
        "LEFT JOIN (SELECT source, severity, count(*) AS n FROM flags GROUP BY source, severity) c "
        "ON c.source = b.source AND c.severity = sv.severity"
    )


ORACLE_SQL["flags_by_severity"] = _by_severity(RULES, RP.SEVERITIES)
ORACLE_SQL["flags_by_severity_custom"] = _by_severity(CUSTOM_RULES, [*RP.SEVERITIES, "Critical"])

ORACLE_SQL["review_comments"] = with_(*FLAG_BASE, PARA_HITS) + (
    "SELECT ph.doc_id, CAST(ph.rule_id AS BIGINT) AS rule_id, ph.idx AS paragraph_index, "
    "r.issue || ' - ' || r.suggestion AS comment, r.severity, r.reference, CAST(nd.n_doc AS BIGINT) AS copies "
    "FROM ph JOIN nd ON nd.doc_id = ph.doc_id AND nd.rule_id = ph.rule_id JOIN rules r ON r.rule_id = ph.rule_id "
    "WHERE ph.n_in_para > 0"
)

ORACLE_SQL["review_comments_paragraph"] = with_(*FLAG_BASE, PARA_HITS) + (
    "SELECT ph.doc_id, CAST(ph.rule_id AS BIGINT) AS rule_id, ph.idx AS paragraph_index, "
    "r.issue || ' - ' || r.suggestion AS comment, r.severity, r.reference, CAST(ph.n_in_para AS BIGINT) AS copies "
    "FROM ph JOIN rules r ON r.rule_id = ph.rule_id WHERE ph.n_in_para > 0"
)

ORACLE_SQL["issue_table"] = with_(*FLAG_BASE, PARA_HITS) + (
    "SELECT ph.doc_id, CAST(ph.rule_id AS BIGINT) AS rule_id, ph.idx AS paragraph_index, "
    "CASE WHEN length(ph.text) > 80 THEN substr(ph.text, 1, 80) || '...' ELSE ph.text END AS excerpt, "
    "r.issue || ' - ' || r.suggestion AS comment, r.severity, r.reference, CAST(nd.n_doc AS BIGINT) AS copies "
    "FROM ph JOIN nd ON nd.doc_id = ph.doc_id AND nd.rule_id = ph.rule_id JOIN rules r ON r.rule_id = ph.rule_id "
    "WHERE ph.n_in_para > 0"
)

_CLAUSES = "(VALUES " + ", ".join(f"({sq(c)}, {sq(t)}, {sq(r)})" for c, t, r in RP.CLAUSE_TEMPLATES) + \
    ") AS c(category, template, reference)"
ORACLE_SQL["clause_suggestions"] = with_(*FLAG_BASE) + (
    "SELECT f.doc_id, CAST(f.rule_id AS BIGINT) AS rule_id, f.occurrence, f.category, c.template AS suggested_clause, "
    "c.reference AS legal_reference, CASE WHEN coalesce(f.matched_text, '') <> '' "
    "THEN 'Suggested replacement for: ' || f.matched_text ELSE '' END AS context_note "
    f"FROM flags f JOIN {_CLAUSES} ON c.category = f.category"
)

ORACLE_SQL["annotations"] = (with_(*FLAG_BASE, PARA_HITS) + (
    "cm AS (SELECT ph.doc_id, ph.idx, ph.text, ph.rule_id, nd.n_doc, "
    f"repeat({sq(RP.ANNOTATION_PREFIX)} || r.issue || ' - ' || r.suggestion || "
    f"CASE WHEN r.reference <> '' THEN {sq(RP.ANNOTATION_REFERENCE)} || r.reference ELSE '' END || ']', "
    "CAST(nd.n_doc AS BIGINT)) AS rendered, lower(r.severity) AS sev, "
    "repeat(CASE CASE WHEN lower(r.severity) IN ('high', 'medium', 'low') THEN lower(r.severity) ELSE 'medium' END "
    + " ".join(f"WHEN {sq(k)} THEN {sq(v[1])}" for k, v in RP.ANNOTATION_STYLES.items()) +
    " END || ',', CAST(nd.n_doc AS BIGINT)) AS fonts "
    "FROM ph JOIN nd ON nd.doc_id = ph.doc_id AND nd.rule_id = ph.rule_id JOIN rules r ON r.rule_id = ph.rule_id "
    "WHERE ph.n_in_para > 0) "
    "SELECT doc_id, idx, text, text || string_agg(rendered, '' ORDER BY rule_id) AS annotated_text, "
    "CAST(sum(n_doc) AS BIGINT) AS n_comments, "
    "CASE WHEN arg_max(sev, rule_id) IN ('high', 'medium', 'low') THEN arg_max(sev, rule_id) ELSE 'medium' END "
    "AS highlight, CASE CASE WHEN arg_max(sev, rule_id) IN ('high', 'medium', 'low') THEN arg_max(sev, rule_id) "
    "ELSE 'medium' END " + " ".join(f"WHEN {sq(k)} THEN {sq(v[0])}" for k, v in RP.ANNOTATION_STYLES.items()) +
    " END AS highlight_color, rtrim(string_agg(fonts, '' ORDER BY rule_id), ',') AS comment_colors "
    "FROM cm GROUP BY doc_id, idx, text"
)).replace(") cm AS", "), cm AS")

# ------------------------------------------------------------------ segmentation
ORACLE_SQL["paragraphs"] = with_(*BASE) + (
    f"SELECT doc_id, idx, text, {wc('text')} AS word_count, {sc('text')} AS sentence_count, "
    f"{is_header('text')} AS is_header, regexp_matches(text, {sq(LIST_RE)}) AS is_list_item, "
    f"{content_type('text')} AS content_type, {significance('text')} AS legal_significance FROM paras"
)


def _sec_type(t: str) -> str:
    lt = f"lower({t})"
    return (f"CASE WHEN contains({lt}, 'definition') THEN 'definitions' "
            f"WHEN {cany(lt, RP.SECTION_PROVISION_WORDS)} THEN 'legal_provision' "
            f"WHEN contains({lt}, 'schedule') OR contains({lt}, 'appendix') THEN 'appendix' "
            "ELSE 'general_section' END")


def _sec_imp(t: str) -> str:
    lt = f"lower({t})"
    return (f"CASE WHEN {cany(lt, RP.SECTION_IMPORTANT_WORDS)} THEN 'high' "
            f"WHEN {cany(lt, RP.SECTION_ANNEX_WORDS)} THEN 'low' ELSE 'medium' END")


ORACLE_SQL["sections"] = with_(*BASE, SECS) + (
    f"SELECT doc_id, sec, title, {_sec_type('title')} AS section_type, {_sec_imp('title')} AS importance, "
    "paragraph_count, first_idx, title || ' ' || body AS section_text FROM secs"
)

_TABLE_TEXT = "lower(array_to_string(flatten(rows), ' '))"
ORACLE_SQL["text_tables"] = with_(*BASE, TROWS) + (
    "SELECT doc_id, table_idx, first_line, "
    "array_to_string(list_transform(rows, lambda r: array_to_string(r, chr(9))), chr(10)) AS cells, "
    "CAST(len(rows) AS BIGINT) AS row_count, CAST(list_max(list_transform(rows, lambda r: len(r))) AS BIGINT) "
    "AS column_count, "
    "(len(rows) >= 2 AND len(list_filter(rows[1], lambda c: c <> '' AND ("
    "(regexp_matches(c, '\\p{Lu}') AND NOT regexp_matches(c, '[\\p{Ll}\\p{Lt}]')) OR "
    "len(list_filter(string_split_regex(c, '\\s+'), lambda w: regexp_full_match(w, "
    "'[^\\p{Lu}\\p{Ll}\\p{Lt}\\s]*[\\p{Lu}\\p{Lt}]\\p{Ll}*(?:[^\\p{Lu}\\p{Ll}\\p{Lt}\\s]+[\\p{Lu}\\p{Lt}]\\p{Ll}*)*"
    "[^\\p{Lu}\\p{Ll}\\p{Lt}\\s]*'))) > 0))) > 0) AS has_headers, "
    f"CASE WHEN len(rows) = 0 THEN 'empty' WHEN {cany(_TABLE_TEXT, RP.TABLE_PERSONNEL_WORDS)} THEN 'personnel_list' "
    f"WHEN {cany(_TABLE_TEXT, RP.TABLE_FINANCIAL_WORDS)} THEN 'financial_table' "
    f"WHEN {cany(_TABLE_TEXT, RP.TABLE_SCHEDULE_WORDS)} THEN 'schedule_table' ELSE 'general_table' END "
    "AS table_type FROM tbl"
)

_STRUCT = (
    "sx AS (SELECT doc_id, count(*) AS n_sec, bool_or(contains(lower(title), 'introduction')) AS has_intro, "
    "bool_or(contains(lower(title), 'definition')) AS has_def, arg_max(lower(title), sec) AS last_title "
    "FROM secs GROUP BY doc_id), "
    "fp AS (SELECT doc_id, arg_min(is_header, idx) AS first_header FROM paras GROUP BY doc_id)"
)
ORACLE_SQL["document_structure"] = with_(*BASE, SECS, _STRUCT) + (
    "SELECT ft.doc_id, coalesce(fp.first_header, false) AS has_title, coalesce(sx.has_intro, false) "
    "AS has_introduction, coalesce(sx.has_def, false) AS has_definitions, "
    f"coalesce({cany('sx.last_title', RP.CONCLUSION_WORDS)}, false) AS has_conclusion, "
    "CAST(coalesce(sx.n_sec, 0) AS BIGINT) AS total_levels, CAST(coalesce(sx.n_sec, 0) AS BIGINT) AS max_level, "
    "CASE WHEN coalesce(sx.n_sec, 0) >= 3 THEN 1.0::DOUBLE ELSE coalesce(sx.n_sec, 0)::DOUBLE / 3.0::DOUBLE END "
    "AS structural_completeness, least(1.0::DOUBLE, ft.n_head::DOUBLE / greatest(1, ft.n_par)::DOUBLE * 5.0::DOUBLE) "
    "AS organization_score FROM ft LEFT JOIN sx ON sx.doc_id = ft.doc_id LEFT JOIN fp ON fp.doc_id = ft.doc_id"
)

# ------------------------------------------------------------------ measures
_NSEC = "nsec AS (SELECT doc_id, count(*) AS n_sec FROM secs GROUP BY doc_id)"
_NTAB = "ntab AS (SELECT doc_id, count(*) AS n_tab FROM tbl GROUP BY doc_id)"
_FTX = "ftx AS (SELECT ft.*, coalesce(nsec.n_sec, 0) AS n_sec FROM ft LEFT JOIN nsec ON nsec.doc_id = ft.doc_id)"

ORACLE_SQL["document_stats"] = with_(*BASE, SECS, TROWS, _NSEC, _NTAB) + (
    f"SELECT ft.doc_id, {wc('ft.full_text')} AS word_count, CAST(ft.n_par AS BIGINT) AS paragraph_count, "
    "CAST(coalesce(nsec.n_sec, 0) AS BIGINT) AS section_count, CAST(coalesce(ntab.n_tab, 0) AS BIGINT) AS table_count, "
    f"{sc('ft.full_text')} AS sentence_count, "
    f"{rhu(wc('ft.full_text') + '::DOUBLE / greatest(1, ft.n_par)::DOUBLE', 2)} AS avg_words_per_paragraph, "
    f"{rhu(sc('ft.full_text') + '::DOUBLE / greatest(1, ft.n_par)::DOUBLE', 2)} AS avg_sentences_per_paragraph, "
    "CAST(length(ft.full_text) AS BIGINT) AS character_count, "
    "CAST(len(list_distinct(regexp_extract_all(lower(ft.full_text), '\\S+'))) AS BIGINT) AS unique_words "
    "FROM ft LEFT JOIN nsec ON nsec.doc_id = ft.doc_id LEFT JOIN ntab ON ntab.doc_id = ft.doc_id"
)

_W = wc("full_text")
_S = sc("full_text")
_AVG = f"(CASE WHEN n_sec > 0 THEN {_W}::DOUBLE / n_sec::DOUBLE ELSE {_W}::DOUBLE END)"
_SCORE = f"(CASE WHEN {_S} = 0 THEN 0.0::DOUBLE ELSE {rhu(_W + '::DOUBLE / ' + _S + '::DOUBLE * 2.0::DOUBLE', 2)} END)"


def density(x: str, terms) -> str:
    n = ccount(f"lower({x})", terms)
    return f"(CASE WHEN {wc(x)} > 0 THEN {rhu(f'{n}::DOUBLE / {wc(x)}::DOUBLE * 100.0::DOUBLE', 2)} ELSE 0.0::DOUBLE END)"


def share(x: str, terms, div: float) -> str:
    return f"least(1.0::DOUBLE, {ccount(f'lower({x})', terms)}::DOUBLE / {float(div)}::DOUBLE)"


ORACLE_SQL["text_analysis"] = with_(*BASE, SECS, _NSEC, _FTX) + (
    f"SELECT doc_id, {_S} AS sentence_count, {_SCORE} AS complexity_score, "
    f"CASE WHEN {_S} = 0 THEN 'unknown' WHEN {_SCORE} < 20 THEN 'easy' WHEN {_SCORE} < 30 THEN 'moderate' "
    "ELSE 'complex' END AS readability_level, "
    f"CASE WHEN {_W} > 3000 OR {_AVG} > 500 THEN 'high' WHEN {_W} > 1500 OR {_AVG} > 250 THEN 'medium' "
    f"ELSE 'low' END AS overall_complexity, {_W} AS total_words, {rhu(_AVG, 2)} AS average_section_length, "
    f"CASE WHEN {_W} > 0 THEN {rhu('length(regexp_replace(full_text, chr(92) || \'s\', \'\', \'g\'))::DOUBLE / ' + _W + '::DOUBLE', 2)} "
    "ELSE 0.0::DOUBLE END AS average_word_length, "
    f"{share('full_text', RP.FORMALITY_WORDS, 10.0)} AS formal_language_score, "
    "CAST(len(regexp_extract_all(full_text, '\\b(?:is|was|are|were|been|being)\\s+\\w+ed\\b')) AS BIGINT) "
    f"AS passive_voice_count, {density('full_text', RP.JARGON_WORDS)} AS legal_jargon_density, "
    "CAST(len(regexp_extract_all(lower(full_text), 'shall')) AS BIGINT) AS obligation_count FROM ftx"
)

_CIT = " || ".join(f"regexp_extract_all(full_text, {sq(p)})" for p in RP.CITATION_PATTERNS)
_RISK = "list_filter([" + ", ".join(sq(t) for t in RP.RISK_WORDS) + "], lambda x: contains(lower(full_text), x))"
_TERMS_RE = "\\b(?:" + "|".join(RP.LEGAL_TERMS) + ")\\b"
ORACLE_SQL["legal_elements"] = with_(*BASE) + (
    "SELECT doc_id, CAST(len(regexp_extract_all(lower(full_text), 'shall')) AS BIGINT) AS obligations, "
    "contains(lower(full_text), 'party') OR contains(lower(full_text), 'parties') AS parties, "
    "contains(lower(full_text), 'terms') AS terms, contains(lower(full_text), 'conditions') AS conditions, "
    "contains(lower(full_text), 'consideration') AS consideration, "
    f"array_to_string({_CIT}, '|') AS compliance_indicators, array_to_string({_RISK}, '|') AS risk_indicators, "
    f"array_to_string(list_sort(list_distinct(regexp_extract_all(lower(full_text), {sq(_TERMS_RE)}))), '|') "
    "AS legal_terms FROM ft"
)

_KP = (f"regexp_extract_all(full_text, {sq(RP.KEY_PHRASE_PATTERN)})")
ORACLE_SQL["key_phrases"] = (with_(*BASE) + (
    "kp AS (SELECT ft.doc_id, u.p, u.i FROM ft, unnest(" + _KP + ") WITH ORDINALITY AS u(p, i)), "
    "kf AS (SELECT doc_id, p, min(i) AS i FROM kp GROUP BY doc_id, p), "
    "kr AS (SELECT doc_id, p, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS r FROM kf) "
    "SELECT ft.doc_id, CAST(count(kr.p) AS BIGINT) AS n_phrases, coalesce(string_agg(kr.p, '|' ORDER BY kr.r), '') "
    "AS key_phrases FROM ft LEFT JOIN kr ON kr.doc_id = ft.doc_id AND kr.r <= 15 GROUP BY ft.doc_id"
)).replace(") kp AS", "), kp AS")

ORACLE_SQL["organisations"] = with_(*BASE) + (
    "SELECT ft.doc_id, CAST(u.i - 1 AS BIGINT) AS pos, u.t AS text, 'ORGANIZATION' AS label FROM ft, "
    f"unnest(regexp_extract_all(full_text, {sq(RP.ORGANISATION_PATTERN)})) WITH ORDINALITY AS u(t, i) WHERE u.i <= 20"
)

ORACLE_SQL["features"] = (with_(*BASE, SECS, TROWS, _NSEC, _NTAB) + (
    "nsx AS (SELECT doc_id, bool_or(regexp_matches(title, '^\\d+\\.')) AS numbered FROM secs GROUP BY doc_id), "
    "fp AS (SELECT doc_id, arg_min(is_header, idx) AS first_header FROM paras GROUP BY doc_id) "
    f"SELECT ft.doc_id, ft.full_text, {wc('ft.full_text')} AS word_count, CAST(ft.n_par AS BIGINT) AS paragraph_count, "
    "CAST(coalesce(nsec.n_sec, 0) AS BIGINT) AS section_count, coalesce(fp.first_header, false) AS has_title, "
    "coalesce(nsec.n_sec, 0) > 0 AS has_sections, coalesce(nsx.numbered, false) AS has_numbered_sections, "
    f"coalesce(ntab.n_tab, 0) > 0 AS has_tables, {density('ft.full_text', RP.CLASSIFIER_TERM_WORDS)} "
    f"AS legal_term_density, {share('ft.full_text', RP.FORMALITY_WORDS, 15.0)} AS formality_score "
    "FROM ft LEFT JOIN nsec ON nsec.doc_id = ft.doc_id LEFT JOIN ntab ON ntab.doc_id = ft.doc_id "
    "LEFT JOIN nsx ON nsx.doc_id = ft.doc_id LEFT JOIN fp ON fp.doc_id = ft.doc_id"
)).replace(") nsx AS", "), nsx AS")

# ------------------------------------------------------------------ classification
_KIND_RANK = "CASE tr.kind WHEN 'primary' THEN 0 WHEN 'secondary' THEN 1 WHEN 'pattern' THEN 2 ELSE 3 END"
def hits_ctes(rule_rows) -> str:
    tr = "(VALUES " + ", ".join(
        f"({sq(t)}, {o}, {sq(k)}, {ord_}, {sq(term)}, {w}::DOUBLE, {str(rx).lower()})"
        for t, o, k, ord_, term, w, rx in rule_rows
    ) + ") AS tr(type, type_order, kind, ord, term, weight, is_regex)"
    return (

    f"trules AS (SELECT tr.*, {_KIND_RANK} AS kr FROM {tr}), "
    "hits AS (SELECT ft.doc_id, ft.source, t.type, t.type_order, t.kind, t.kr, t.ord, t.term, t.weight FROM ft, trules t "
    "WHERE CASE WHEN t.is_regex THEN regexp_matches(lower(ft.full_text), '(?i)' || t.term) "
    "ELSE contains(lower(ft.full_text), lower(t.term)) END), "
    "types AS (SELECT DISTINCT type, type_order FROM trules), "
    f"ftw AS (SELECT doc_id, source, {wc('full_text')} AS w FROM ft), "
    "scores AS (SELECT ft.doc_id, ft.source, ty.type, ty.type_order, coalesce(sum(h.weight), 0.0::DOUBLE) AS raw_score, "
    "coalesce(sum(h.weight), 0.0::DOUBLE) / greatest(CASE WHEN ft.w > 0 THEN "
    "ft.w::DOUBLE / 1000.0::DOUBLE ELSE 1.0::DOUBLE END, 0.1::DOUBLE) AS score "
    "FROM ftw ft CROSS JOIN types ty LEFT JOIN hits h ON h.doc_id = ft.doc_id AND h.type = ty.type "
    "GROUP BY ft.doc_id, ft.source, ft.w, ty.type, ty.type_order), "
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, type_order) AS rn, "
    "lead(score) OVER (PARTITION BY doc_id ORDER BY score DESC, type_order) AS next_score FROM scores), "
    "ev AS (SELECT doc_id, type, "
    "coalesce(array_to_string(list(term ORDER BY ord) FILTER (WHERE kind = 'primary'), '|'), '') AS primary_hits, "
    "coalesce(array_to_string(list(term ORDER BY ord) FILTER (WHERE kind = 'secondary'), '|'), '') AS secondary_hits, "
    "coalesce(array_to_string(list(term ORDER BY ord) FILTER (WHERE kind = 'pattern'), '|'), '') AS pattern_hits, "
    "coalesce(array_to_string(list(term ORDER BY ord) FILTER (WHERE kind = 'section'), '|'), '') AS section_hits, "
    "count(*) FILTER (WHERE kind = 'primary') AS n_primary, count(*) FILTER (WHERE kind = 'pattern') AS n_pattern, "
    "count(*) FILTER (WHERE kind = 'secondary') AS n_secondary, count(DISTINCT kind) AS kinds "
    "FROM hits GROUP BY doc_id, type), "
    "best AS (SELECT r.doc_id, r.source, r.type AS predicted_type, r.raw_score, "
    f"{rhu('least(1.0::DOUBLE, least(1.0::DOUBLE, r.score / 15.0::DOUBLE) + least(0.4::DOUBLE, (r.score - r.next_score) / 10.0::DOUBLE))', 3)} "
    "AS conf, coalesce(e.kinds, 0) AS kinds, coalesce(e.n_primary, 0) AS n_primary, coalesce(e.n_pattern, 0) AS n_pattern, "
    "coalesce(e.n_secondary, 0) AS n_secondary, coalesce(e.primary_hits, '') AS primary_hits, "
    "coalesce(e.secondary_hits, '') AS secondary_hits, coalesce(e.pattern_hits, '') AS pattern_hits, "
    "coalesce(e.section_hits, '') AS section_hits FROM ranked r LEFT JOIN ev e ON e.doc_id = r.doc_id AND e.type = r.type "
    "WHERE r.rn = 1), "
    "cls AS (SELECT *, "
    f"CASE WHEN kinds >= 3 THEN {rhu('least(1.0::DOUBLE, conf * 1.3::DOUBLE)', 3)} "
    f"WHEN kinds >= 2 THEN {rhu('least(1.0::DOUBLE, conf * 1.1::DOUBLE)', 3)} ELSE {rhu('conf', 3)} END AS conf_ens "
    "FROM best)"
    )


HITS = hits_ctes(type_rule_rows())
CLS_BASE = BASE + [HITS]
CLS_BASE_WIDE = BASE + [hits_ctes(type_rule_rows(RP.WIDE_TYPE_LEXICON))]

ORACLE_SQL["rule_hits"] = with_(*CLS_BASE) + (
    "SELECT doc_id, type, CAST(type_order AS BIGINT) AS type_order, kind, CAST(ord AS BIGINT) AS ord, term, weight "
    "FROM hits"
)
ORACLE_SQL["rule_hits_large"] = with_(*BASE).rstrip() + ", " + (
    "bw AS (SELECT CAST(item_id AS INTEGER) AS type_order, list_filter(string_split_regex(lower(text), '[ \\n]+'), lambda w: w <> '') AS w "
    "FROM benchmark), "
    "bn AS (SELECT type_order, w, n FROM bw, (VALUES (2), (3), (4), (5)) AS v(n) WHERE len(w) >= n), "
    "br AS (SELECT type_order, n, i AS ord, w[i:i + n - 1] AS run FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM bn)), "
    "pack AS (SELECT 'item_' || type_order AS type, type_order, n, ord, CASE WHEN n = 2 THEN array_to_string(run, '[ ,.]+') ELSE array_to_string(run, ' ') END AS term "
    "FROM br WHERE n > 2 OR len(list_filter(run, lambda w: NOT regexp_full_match(w, '[a-z]+'))) = 0) "
    "SELECT f.doc_id, p.type, CAST(p.type_order AS BIGINT) AS type_order, "
    "CASE n WHEN 2 THEN 'pattern' WHEN 3 THEN 'primary' WHEN 4 THEN 'secondary' ELSE 'section' END AS kind, "
    "CAST(p.ord AS BIGINT) AS ord, p.term, CAST(n AS DOUBLE) AS weight "
    "FROM (SELECT doc_id, lower(full_text) AS lt FROM ft) f, pack p "
    "WHERE CASE WHEN n = 2 THEN regexp_matches(f.lt, p.term) ELSE contains(f.lt, p.term) END"
)
ORACLE_SQL["type_scores"] = with_(*CLS_BASE) + (
    f"SELECT doc_id, type, CAST(type_order AS BIGINT) AS type_order, raw_score, {rhu('score', 3)} AS normalized_score "
    "FROM scores"
)


def _cls_select(conf: str, method: str) -> str:
    return (
        f"SELECT doc_id, predicted_type, {conf} AS confidence, '{method}' AS method_used, "
        "CAST(kinds AS BIGINT) AS evidence_types, raw_score > 0 AS has_evidence, "
        "printf('Matched %d primary keywords, %d patterns', n_primary, n_pattern) AS reasoning, "
        "primary_hits, secondary_hits, pattern_hits, section_hits FROM cls"
    )


ORACLE_SQL["classification"] = with_(*CLS_BASE) + _cls_select("conf_ens", "ensemble")
ORACLE_SQL["classification_rule_based"] = with_(*CLS_BASE) + _cls_select("conf", "rule_based")

ORACLE_SQL["explanations"] = with_(*CLS_BASE) + (
    f"SELECT doc_id, 'Document classified as ''' || {title_words('predicted_type')} || ''' with ' || "
    f"{percent1('conf_ens')} || ' confidence using ensemble method.' || chr(10) || chr(10) || "
    "CASE WHEN n_primary > 0 THEN 'Primary indicators: ' || array_to_string(string_split(primary_hits, '|')[1:3], ', ') "
    "|| chr(10) ELSE '' END || "
    "CASE WHEN n_pattern > 0 THEN printf('Legal patterns: %d patterns matched', n_pattern) || chr(10) ELSE '' END || "
    "CASE WHEN n_secondary > 0 THEN printf('Secondary indicators: %d found', n_secondary) || chr(10) ELSE '' END || "
    "chr(10) || printf('Matched %d primary keywords, %d patterns', n_primary, n_pattern) AS explanation FROM cls"
)

# ------------------------------------------------------------------ compliance
_PR = "(VALUES " + ", ".join(f"({sq(p)}, {sq(t)}, {thr}, {prio})" for p, t, thr, prio in process_rule_rows()) + \
    ") AS pr(process, doc_type, threshold, priority)"
_RQ = "(VALUES " + ", ".join(f"({sq(p)}, {sq(t)})" for p, t in requirement_rows()) + ") AS rq(process, doc_type)"
COMP = (
    "present AS (SELECT source, predicted_type AS doc_type, count(*) AS n FROM cls GROUP BY source, predicted_type), "
    f"pc AS (SELECT p.source, pr.process, pr.priority FROM present p JOIN {_PR} ON pr.doc_type = p.doc_type "
    "GROUP BY p.source, pr.process, pr.threshold, pr.priority HAVING sum(p.n) >= pr.threshold), "
    "proc AS (SELECT b.source, coalesce(c.process, "
    f"{sq(RP.DEFAULT_PROCESS)}) AS process FROM (SELECT DISTINCT source FROM present) b "
    "LEFT JOIN (SELECT source, arg_min(process, priority) AS process FROM pc GROUP BY source) c ON c.source = b.source), "
    f"req AS (SELECT proc.source, proc.process, rq.doc_type FROM proc JOIN {_RQ} ON rq.process = proc.process), "
    "missing AS (SELECT r.source, r.process, r.doc_type FROM req r WHERE NOT EXISTS "
    "(SELECT 1 FROM present p WHERE p.source = r.source AND p.doc_type = r.doc_type)), "
    "extra AS (SELECT p.source, p.doc_type FROM present p WHERE NOT EXISTS "
    "(SELECT 1 FROM req r WHERE r.source = p.source AND r.doc_type = p.doc_type)), "
    "matched AS (SELECT p.source, p.doc_type FROM present p WHERE EXISTS "
    "(SELECT 1 FROM req r WHERE r.source = p.source AND r.doc_type = p.doc_type)), "
    "recs AS (SELECT source, doc_type, 'Please provide ' || " + title_words("doc_type") +
    " || ' to complete your ' || replace(process, '_', ' ') || ' submission' AS recommendation FROM missing)"
)
COMP_BASE = CLS_BASE + [COMP]

ORACLE_SQL["process"] = with_(*COMP_BASE) + "SELECT source, process FROM proc"
ORACLE_SQL["missing_documents"] = with_(*COMP_BASE) + "SELECT source, process, doc_type FROM missing"
ORACLE_SQL["extra_documents"] = with_(*COMP_BASE) + "SELECT source, doc_type FROM extra"
ORACLE_SQL["matched_documents"] = with_(*COMP_BASE) + "SELECT source, doc_type FROM matched"
ORACLE_SQL["recommendations"] = with_(*COMP_BASE) + "SELECT source, doc_type, recommendation FROM recs"

_COMPLIANCE_ROW = (
    "crow AS (SELECT proc.source, proc.process, "
    "(SELECT count(*) FROM req r WHERE r.source = proc.source) AS tr, "
    "(SELECT count(*) FROM matched m WHERE m.source = proc.source) AS dm, "
    "(SELECT sum(n) FROM present p WHERE p.source = proc.source) AS provided, "
    "(SELECT coalesce(array_to_string(list_sort(list(doc_type)), '|'), '') FROM missing x WHERE x.source = proc.source) "
    "AS missing_documents, "
    "(SELECT coalesce(array_to_string(list_sort(list(doc_type)), '|'), '') FROM extra x WHERE x.source = proc.source) "
    "AS extra_documents, "
    "(SELECT coalesce(array_to_string(list_sort(list(recommendation)), '|'), '') FROM recs x WHERE x.source = proc.source) "
    "AS recommendations FROM proc)"
)
ORACLE_SQL["compliance"] = with_(*COMP_BASE, _COMPLIANCE_ROW) + (
    "SELECT source, process, CASE WHEN tr - dm = 0 THEN 'Complete' ELSE 'Incomplete' END AS status, "
    f"CASE WHEN tr > 0 THEN {rhu('dm::DOUBLE / tr::DOUBLE * 100.0::DOUBLE', 1)} ELSE 100.0::DOUBLE END "
    "AS completeness_percentage, CAST(tr AS BIGINT) AS total_required, CAST(provided AS BIGINT) AS documents_provided, "
    "CAST(dm AS BIGINT) AS documents_matched, missing_documents, extra_documents, recommendations FROM crow"
)

# ------------------------------------------------------------------ batch analytics
ORACLE_SQL["type_distribution"] = with_(*CLS_BASE) + (
    "SELECT source, predicted_type, count(*) AS documents FROM cls GROUP BY source, predicted_type"
)
ORACLE_SQL["confidence_summary"] = with_(*CLS_BASE) + (
    "SELECT source, count(*) AS documents, "
    "sum(CAST(round(conf_ens * 1000) AS BIGINT))::DOUBLE / count(*)::DOUBLE / 1000.0::DOUBLE AS avg_confidence "
    "FROM cls GROUP BY source"
)
_NFLAGS = "nf AS (SELECT doc_id, count(*) AS n FROM flags GROUP BY doc_id)"
ORACLE_SQL["batch_summary"] = with_(*CLS_BASE, RULES, FLAGS, _NFLAGS) + (
    "SELECT c.source, CAST(count(*) AS BIGINT) AS documents, CAST(coalesce(sum(nf.n), 0) AS BIGINT) AS total_issues, "
    "sum(CAST(round(c.conf_ens * 1000) AS BIGINT))::DOUBLE / count(*)::DOUBLE / 1000.0::DOUBLE AS avg_confidence "
    "FROM cls c LEFT JOIN nf ON nf.doc_id = c.doc_id GROUP BY c.source"
)

ORACLE_SQL["processing_log"] = with_(*CLS_BASE, RULES, FLAGS, _NFLAGS) + (
    f"SELECT c.doc_id, '>> ' || CAST(c.doc_id AS VARCHAR) || ': ' || c.predicted_type || ' (' || {percent1('c.conf_ens')} "
    "|| ') | ' || CAST(coalesce(nf.n, 0) AS VARCHAR) || ' issues' AS log_line FROM cls c LEFT JOIN nf ON nf.doc_id = c.doc_id"
)

_SEV_ROW = (
    "sevc AS (SELECT source, count(*) FILTER (WHERE severity = 'High') AS hi, "
    "count(*) FILTER (WHERE severity = 'Medium') AS me, count(*) FILTER (WHERE severity = 'Low') AS lo "
    "FROM flags GROUP BY source), "
    "tys AS (SELECT source, predicted_type, count(*) AS n, min(doc_id) AS first_doc FROM cls GROUP BY source, predicted_type), "
    "tyl AS (SELECT source, string_agg(printf('- **%s**: %d document(s)', " + title_words("predicted_type") +
    ", n) || chr(10), '' ORDER BY first_doc) AS lines FROM tys GROUP BY source), "
    "summ AS (SELECT c.source, count(*) AS documents, coalesce(sum(nf.n), 0) AS total_issues, "
    "sum(CAST(round(c.conf_ens * 1000) AS BIGINT))::DOUBLE / count(*)::DOUBLE / 1000.0::DOUBLE AS avg_confidence "
    "FROM cls c LEFT JOIN nf ON nf.doc_id = c.doc_id GROUP BY c.source), "
    "recl AS (SELECT source, list_sort(list(recommendation)) AS recs FROM recs GROUP BY source), "
    "nmiss AS (SELECT source, count(*) AS n FROM missing GROUP BY source)"
)
ORACLE_SQL["summary_report"] = with_(*COMP_BASE, RULES, FLAGS, _NFLAGS, _COMPLIANCE_ROW, _SEV_ROW) + (
    f"SELECT s.source, {sq(RP.REPORT_TITLE)} || chr(10) || chr(10) || '## Overview' || chr(10) || "
    "printf('- **Documents Processed**: %d', s.documents) || chr(10) || "
    "printf('- **Total Issues Identified**: %d', s.total_issues) || chr(10) || "
    f"'- **Average Classification Confidence**: ' || {percent1('s.avg_confidence')} || chr(10) || "
    "'- **Compliance Status**: ' || CASE WHEN cr.tr - cr.dm = 0 THEN 'Complete' ELSE 'Incomplete' END || chr(10) || "
    "chr(10) || '## Document Types Identified' || chr(10) || tyl.lines || "
    "chr(10) || '## Issue Breakdown by Severity' || chr(10) || "
    "printf('- **High Severity**: %d issues', coalesce(sv.hi, 0)) || chr(10) || "
    "printf('- **Medium Severity**: %d issues  ', coalesce(sv.me, 0)) || chr(10) || "
    "printf('- **Low Severity**: %d issues', coalesce(sv.lo, 0)) || chr(10) || "
    "chr(10) || '## Compliance Analysis' || chr(10) || "
    f"'- **Process**: ' || {title_words('cr.process')} || chr(10) || "
    "'- **Completeness**: ' || printf('%.1f', CASE WHEN cr.tr > 0 THEN "
    f"{rhu('cr.dm::DOUBLE / cr.tr::DOUBLE * 100.0::DOUBLE', 1)} ELSE 100.0::DOUBLE END) || '%' || chr(10) || "
    "printf('- **Missing Documents**: %d', coalesce(nm.n, 0)) || chr(10) || "
    "CASE WHEN coalesce(len(rl.recs), 0) > 0 THEN chr(10) || '## Recommendations' || chr(10) || "
    "array_to_string(list_transform(rl.recs[1:3], lambda r: '- ' || r || chr(10)), '') ELSE '' END AS report "
    "FROM summ s JOIN crow cr ON cr.source = s.source JOIN tyl ON tyl.source = s.source "
    "LEFT JOIN sevc sv ON sv.source = s.source LEFT JOIN recl rl ON rl.source = s.source "
    "LEFT JOIN nmiss nm ON nm.source = s.source"
)

_CLAUSE_CATS = "(" + ", ".join(sq(c) for c, _, _ in RP.CLAUSE_TEMPLATES) + ")"
_DOC_EXTRA = (
    "rc AS (SELECT ph.doc_id, sum(nd.n_doc) AS n FROM ph JOIN nd ON nd.doc_id = ph.doc_id AND nd.rule_id = ph.rule_id "
    "WHERE ph.n_in_para > 0 GROUP BY ph.doc_id), "
    f"sg AS (SELECT doc_id, count(*) AS n FROM flags WHERE category IN {_CLAUSE_CATS} GROUP BY doc_id)"
)
_EXPLAIN = (
    "'Document classified as ''' || " + title_words("c.predicted_type") + " || ''' with ' || "
    + percent1("c.conf_ens") + " || ' confidence using ensemble method.' || chr(10) || chr(10) || "
    "CASE WHEN c.n_primary > 0 THEN 'Primary indicators: ' || array_to_string(string_split(c.primary_hits, '|')[1:3], ', ') "
    "|| chr(10) ELSE '' END || "
    "CASE WHEN c.n_pattern > 0 THEN printf('Legal patterns: %d patterns matched', c.n_pattern) || chr(10) ELSE '' END || "
    "CASE WHEN c.n_secondary > 0 THEN printf('Secondary indicators: %d found', c.n_secondary) || chr(10) ELSE '' END || "
    "chr(10) || printf('Matched %d primary keywords, %d patterns', c.n_primary, c.n_pattern)"
)
ORACLE_SQL["document_report"] = (with_(*CLS_BASE, RULES, FLAGS, _NFLAGS, SECS, _NSEC, _FTX, PARA_HITS, _DOC_EXTRA) + (
    "kp AS (SELECT ftx.doc_id, u.p, u.i FROM ftx, unnest(regexp_extract_all(full_text, "
    f"{sq(RP.KEY_PHRASE_PATTERN)})) WITH ORDINALITY AS u(p, i)), "
    "kf AS (SELECT doc_id, p, min(i) AS i FROM kp GROUP BY doc_id, p), "
    "kr AS (SELECT doc_id, string_agg(p, '|' ORDER BY i) AS kps FROM "
    "(SELECT doc_id, p, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS r FROM kf) WHERE r <= 5 GROUP BY doc_id) "
    "SELECT c.doc_id, c.source, c.predicted_type, c.conf_ens AS confidence, "
    f"{wc('x.full_text')} AS word_count, CAST(x.n_par AS BIGINT) AS paragraph_count, CAST(x.n_sec AS BIGINT) AS section_count, "
    f"CASE WHEN {wc('x.full_text')} > 3000 OR "
    f"(CASE WHEN x.n_sec > 0 THEN {wc('x.full_text')}::DOUBLE / x.n_sec::DOUBLE ELSE {wc('x.full_text')}::DOUBLE END) > 500 "
    f"THEN 'high' WHEN {wc('x.full_text')} > 1500 OR "
    f"(CASE WHEN x.n_sec > 0 THEN {wc('x.full_text')}::DOUBLE / x.n_sec::DOUBLE ELSE {wc('x.full_text')}::DOUBLE END) > 250 "
    "THEN 'medium' ELSE 'low' END AS complexity, "
    f"(CASE WHEN {sc('x.full_text')} = 0 THEN 0.0::DOUBLE ELSE "
    f"{rhu(wc('x.full_text') + '::DOUBLE / ' + sc('x.full_text') + '::DOUBLE * 2.0::DOUBLE', 2)} END) AS complexity_score, "
    f"CASE WHEN {sc('x.full_text')} = 0 THEN 'unknown' WHEN "
    f"{rhu(wc('x.full_text') + '::DOUBLE / ' + sc('x.full_text') + '::DOUBLE * 2.0::DOUBLE', 2)} < 20 THEN 'easy' WHEN "
    f"{rhu(wc('x.full_text') + '::DOUBLE / ' + sc('x.full_text') + '::DOUBLE * 2.0::DOUBLE', 2)} < 30 THEN 'moderate' "
    "ELSE 'complex' END AS readability_level, coalesce(kr.kps, '') AS key_phrases, "
    f"array_to_string(regexp_extract_all(x.full_text, {sq(RP.ORGANISATION_PATTERN)})[1:5], '|') AS named_entities, "
    "CAST(coalesce(nf.n, 0) AS BIGINT) AS issues, CAST(coalesce(sg.n, 0) AS BIGINT) AS suggestions, "
    "CAST(coalesce(rc.n, 0) AS BIGINT) AS review_comments_count, " + _EXPLAIN + " AS explanation "
    "FROM cls c JOIN ftx x ON x.doc_id = c.doc_id LEFT JOIN nf ON nf.doc_id = c.doc_id LEFT JOIN kr ON kr.doc_id = c.doc_id "
    "LEFT JOIN rc ON rc.doc_id = c.doc_id LEFT JOIN sg ON sg.doc_id = c.doc_id"
)).replace(") kp AS", "), kp AS")

ORACLE_SQL["quarantine"] = (
    "WITH f AS (SELECT CASE doc_id % 97 WHEN 1 THEN NULL WHEN 2 THEN doc_id - 2 ELSE doc_id END AS doc_id, "
    "CASE doc_id % 97 WHEN 3 THEN NULL WHEN 4 THEN ' ' ELSE text END AS text FROM documents), "
    "d AS (SELECT doc_id, text, count(*) OVER (PARTITION BY doc_id) AS k FROM f) "
    "SELECT coalesce(CAST(doc_id AS VARCHAR), '(no id)') AS doc_id, CASE WHEN doc_id IS NULL THEN 'missing id' WHEN k > 1 THEN 'duplicate id' "
    "WHEN text IS NULL THEN 'missing text' ELSE 'blank text' END AS error FROM d "
    "WHERE doc_id IS NULL OR k > 1 OR text IS NULL OR trim(regexp_replace(text, '\\s+', ' ', 'g')) = ''"
)

# ------------------------------------------------------------------ retrieval
ORACLE_SQL["chunks"] = (
    f"SELECT doc_id, CAST(u.i - 1 AS BIGINT) AS chunk_no, CAST(u.s AS BIGINT) AS start, "
    f"CAST(length(substr(text, u.s + 1, {RP.CHUNK_SIZE})) AS BIGINT) AS chunk_len, substr(text, u.s + 1, {RP.CHUNK_SIZE}) AS text "
    f"FROM documents, unnest(range(0, greatest(length(text) - {RP.CHUNK_OVERLAP}, 1), "
    f"{RP.CHUNK_SIZE - RP.CHUNK_OVERLAP})) WITH ORDINALITY AS u(s, i) WHERE length(text) > 0"
)

ORACLE_SQL["knn_centroids"] = (
    "WITH e AS (SELECT label, u.x, u.d FROM embeddings, unnest(embedding) WITH ORDINALITY AS u(x, d)), "
    "c AS (SELECT label, d, avg(x::DOUBLE) AS x FROM e GROUP BY label, d), "
    "ev AS (SELECT vec_id, u.x, u.d FROM embeddings, unnest(embedding) WITH ORDINALITY AS u(x, d)), "
    "dist AS (SELECT c.label AS query_id, ev.vec_id, sum((ev.x::DOUBLE - c.x) * (ev.x::DOUBLE - c.x)) AS distance "
    "FROM ev JOIN c ON c.d = ev.d GROUP BY c.label, ev.vec_id), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM dist) "
    "SELECT query_id, CAST(rank AS BIGINT) AS rank, vec_id, round(distance, 6) AS distance, 'high' AS relevance "
    "FROM r WHERE rank <= 3"
)

_TOK = "'[\\p{L}\\p{N}]+'"
ORACLE_SQL["related_passages"] = (
    "WITH pt AS (SELECT item_id AS chunk_id, unnest(regexp_extract_all(lower(coalesce(text, '')), " + _TOK + ")) AS term "
    "FROM benchmark), "
    "ptf AS (SELECT chunk_id, term, count(*) AS tf FROM pt GROUP BY chunk_id, term), "
    "np AS (SELECT count(DISTINCT item_id) AS n FROM benchmark), "
    "idf AS (SELECT term, 1.0::DOUBLE + ln((1.0::DOUBLE + (SELECT n FROM np)::DOUBLE) / (1.0::DOUBLE + count(*)::DOUBLE)) "
    "AS idf FROM ptf GROUP BY term), "
    "pv AS (SELECT p.chunk_id, p.term, p.tf * i.idf AS w FROM ptf p JOIN idf i ON i.term = p.term), "
    "pn AS (SELECT chunk_id, sqrt(sum(w * w)) AS pnorm FROM pv GROUP BY chunk_id), "
    "dt AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), " + _TOK + ")) AS term FROM documents), "
    "dtf AS (SELECT d.doc_id, d.term, count(*) * any_value(i.idf) AS w FROM dt d JOIN idf i ON i.term = d.term "
    "GROUP BY d.doc_id, d.term), "
    "dn AS (SELECT doc_id, sqrt(sum(w * w)) AS dnorm FROM dtf GROUP BY doc_id), "
    "dots AS (SELECT d.doc_id, p.chunk_id, sum(d.w * p.w) AS dot FROM dtf d JOIN pv p ON p.term = d.term "
    "GROUP BY d.doc_id, p.chunk_id), "
    f"sc AS (SELECT x.doc_id, x.chunk_id, {rhu('x.dot / (dn.dnorm * pn.pnorm)', 6)} AS score FROM dots x "
    "JOIN dn ON dn.doc_id = x.doc_id JOIN pn ON pn.chunk_id = x.chunk_id), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, chunk_id) AS rank FROM sc) "
    "SELECT doc_id, CAST(rank AS BIGINT) AS rank, chunk_id, score FROM r WHERE rank <= 3"
)

ORACLE_SQL["knn_queries"] = (
    "WITH ev AS (SELECT vec_id, u.x::DOUBLE AS x, u.d FROM embeddings, unnest(embedding) WITH ORDINALITY AS u(x, d)), "
    "dist AS (SELECT q.vec_id AS query_id, ev.vec_id, sum((ev.x - q.x) * (ev.x - q.x)) AS distance "
    "FROM ev JOIN ev q ON q.d = ev.d AND q.vec_id % 20 = 0 GROUP BY q.vec_id, ev.vec_id), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM dist) "
    "SELECT query_id, CAST(rank AS BIGINT) AS rank, vec_id, round(distance, 6) AS distance, 'high' AS relevance "
    "FROM r WHERE rank <= 10"
)

ORACLE_SQL["processing_order"] = (
    "SELECT doc_id, 'documents.parquet' AS filename, row_number() OVER (ORDER BY doc_id) AS processing_order, "
    "count(*) OVER () AS file_rows FROM documents"
)

# Benchmark texts are shorter than a chunk, so each is its only one.
_REL_CTES, _, _REL_ROWS = ORACLE_SQL["related_passages"].rpartition("SELECT doc_id, CAST(rank")
ORACLE_SQL["document_report_references"] = with_(*CLS_BASE, RULES, FLAGS, _NFLAGS).rstrip() + ", " + (
    _REL_CTES.removeprefix("WITH ").replace("SELECT item_id AS chunk_id", "SELECT item_id || '#0' AS chunk_id")
    .replace("FROM documents", "FROM seeded").replace("sc AS (", "rsc AS (").replace("FROM sc)", "FROM rsc)").replace("r AS (SELECT *,", "rel AS (SELECT *,").rstrip()
    + ", refs AS (SELECT doc_id, string_agg(chunk_id || ' ' || printf('%.6f', score) || ' high', '|' ORDER BY rank) AS related_references, "
    "arg_min(chunk_id, rank) AS best FROM rel WHERE rank <= 3 GROUP BY doc_id) "
    "SELECT c.doc_id, 'documents.parquet' AS filename, row_number() OVER (ORDER BY c.doc_id) AS processing_order, c.predicted_type, "
    "CAST(coalesce(nf.n, 0) AS BIGINT) AS issues, coalesce(refs.related_references, '') AS related_references, "
    "sha256(coalesce(regexp_replace(b.text, '^\\s+|\\s+$', '', 'g'), '')) AS best_sha256 "
    "FROM cls c LEFT JOIN nf ON nf.doc_id = c.doc_id LEFT JOIN refs ON refs.doc_id = c.doc_id "
    "LEFT JOIN benchmark b ON b.item_id || '#0' = refs.best"
)

# ------------------------------------------------------------------ trained text models
_TM = RP.TEXT_MODEL


def _bayes(docs: str, labels: str) -> str:
    """CTEs of the model fitted on ``docs(doc_id, text)`` and ``labels(doc_id, label)``: n-grams, vocabulary, class sums, labels."""
    run = " UNION ALL ".join(
        f"SELECT doc_id, unnest(list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS term FROM mw"
        for n in range(1, _TM["ngram_max"] + 1))
    return (
        f"mw AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS w FROM {docs}), "
        f"mg AS (SELECT doc_id, term, count(*) AS tf FROM ({run}) GROUP BY doc_id, term), "
        f"ml AS (SELECT doc_id, label FROM {labels} l WHERE doc_id IN (SELECT doc_id FROM {docs})), "
        "mn AS (SELECT count(*) AS n FROM ml), "
        "mv AS (SELECT term, ln(CAST(1 + (SELECT n FROM mn) AS DOUBLE) / (1 + count(*))) + 1.0::DOUBLE AS idf FROM mg JOIN ml USING (doc_id) "
        f"GROUP BY term HAVING count(*) >= {_TM['min_df']} AND count(*) <= {_TM['max_df']} * (SELECT n FROM mn) "
        f"ORDER BY sum(tf) DESC, term LIMIT {_TM['max_features']}), "
        "mwt AS (SELECT g.doc_id, g.term, l.label, tf * idf AS w FROM mg g JOIN ml l USING (doc_id) JOIN mv USING (term)), "
        "mno AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM mwt GROUP BY doc_id), "
        "ms AS (SELECT label, term, sum(w / norm) AS s FROM mwt JOIN mno USING (doc_id) GROUP BY label, term), "
        f"mt AS (SELECT l.label, ln(any_value(l.k) / CAST((SELECT n FROM mn) AS DOUBLE)) AS prior, "
        f"ln({_TM['nb_alpha']} / (coalesce(sum(s), 0) + {_TM['nb_alpha']} * (SELECT count(*) FROM mv))) AS base "
        "FROM (SELECT label, count(*) AS k FROM ml GROUP BY label) l LEFT JOIN ms USING (label) GROUP BY l.label)"
    )


_ALPHA = _TM["nb_alpha"]
ORACLE_SQL["text_model_terms"] = "WITH " + _bayes(
    "documents", "(SELECT doc_id, CAST(min(quality) AS VARCHAR) AS label FROM labels GROUP BY doc_id)") + (
    f" SELECT mv.term, round(idf, 6) AS idf, round(coalesce(max(CASE WHEN label = '0' THEN ln((s + {_ALPHA}) / {_ALPHA}) END), 0), 6) AS delta_0, "
    f"round(coalesce(max(CASE WHEN label = '1' THEN ln((s + {_ALPHA}) / {_ALPHA}) END), 0), 6) AS delta_1 "
    "FROM mv LEFT JOIN ms USING (term) GROUP BY mv.term, idf"
)
ORACLE_SQL["classification_ml"] = with_(*CLS_BASE).rstrip() + ", " + _bayes(
    "seeded", "(SELECT doc_id, predicted_type AS label FROM cls WHERE raw_score > 0 AND doc_id % 2 = 1)") + (
    ", dw AS (SELECT g.doc_id, g.term, tf * idf AS w FROM mg g JOIN mv USING (term)), "
    "dn AS (SELECT doc_id, sqrt(sum(w * w)) AS norm, sum(w) AS total FROM dw GROUP BY doc_id), "
    f"dd AS (SELECT dw.doc_id, ms.label, sum(w * ln((s + {_ALPHA}) / {_ALPHA})) AS d FROM dw JOIN ms USING (term) GROUP BY dw.doc_id, ms.label), "
    "sco AS (SELECT s.doc_id, s.source, mt.label, prior + coalesce((total * base + coalesce(d, 0)) / norm, 0) AS score FROM seeded s "
    "CROSS JOIN mt LEFT JOIN dn ON dn.doc_id = s.doc_id LEFT JOIN dd ON dd.doc_id = s.doc_id AND dd.label = mt.label), "
    "top AS (SELECT *, max(score) OVER (PARTITION BY doc_id) AS best, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS r FROM sco) "
    f"SELECT doc_id, source, max(CASE WHEN r = 1 THEN label END) AS predicted_type, {rhu('1.0::DOUBLE / sum(exp(score - best))', 3)} AS confidence, "
    "'ml' AS method_used FROM top GROUP BY doc_id, source"
)

ORACLE_SQL["classification_wide"] = with_(*CLS_BASE_WIDE) + _cls_select("conf_ens", "ensemble")
ORACLE_SQL["compliance_wide"] = with_(*CLS_BASE_WIDE, COMP, _COMPLIANCE_ROW) + (
    "SELECT source, process, CASE WHEN tr - dm = 0 THEN 'Complete' ELSE 'Incomplete' END AS status, "
    f"CASE WHEN tr > 0 THEN {rhu('dm::DOUBLE / tr::DOUBLE * 100.0::DOUBLE', 1)} ELSE 100.0::DOUBLE END "
    "AS completeness_percentage, CAST(tr AS BIGINT) AS total_required, CAST(provided AS BIGINT) AS documents_provided, "
    "CAST(dm AS BIGINT) AS documents_matched, missing_documents, extra_documents, recommendations FROM crow"
)


# ------------------------------------------------------------------ the unmodified corpus
RAW_SEEDED = "seeded AS (SELECT doc_id, source, text FROM documents)"


def _raw(sql: str) -> str:
    assert SEEDED in sql
    return sql.replace(SEEDED, RAW_SEEDED)


for _name in ("paragraphs", "sections", "text_tables", "document_stats", "text_analysis", "key_phrases",
              "classification"):
    ORACLE_SQL[_name + "_raw"] = _raw(ORACLE_SQL[_name])


# ------------------------------------------------------------------ second corpus: conversation turns
_TURN_FT = (
    "tl AS (SELECT c.conv_id, c.turn, u.ord, regexp_replace(u.line, '^\\s+|\\s+$', '', 'g') AS line FROM conversations c, "
    "unnest(string_split(coalesce(c.text, ''), chr(10))) WITH ORDINALITY AS u(line, ord)), "
    "tft AS (SELECT c.conv_id, c.turn, coalesce(string_agg(t.line, ' ' ORDER BY t.ord) FILTER (WHERE t.line <> ''), '') "
    "AS ft FROM conversations c LEFT JOIN tl t ON t.conv_id = c.conv_id AND t.turn = c.turn GROUP BY c.conv_id, c.turn)"
)
_TW = wc("ft")
_TS = sc("ft")
_TSCORE = f"(CASE WHEN {_TS} = 0 THEN 0.0::DOUBLE ELSE {rhu(_TW + '::DOUBLE / ' + _TS + '::DOUBLE * 2.0::DOUBLE', 2)} END)"
ORACLE_SQL["conversation_turns"] = "WITH " + _TURN_FT + " " + (
    f"SELECT conv_id, turn, {_TW} AS word_count, {_TS} AS sentence_count, CAST(length(ft) AS BIGINT) AS character_count, "
    "CAST(len(list_distinct(regexp_extract_all(lower(ft), '\\S+'))) AS BIGINT) AS unique_words, "
    f"{_TSCORE} AS complexity_score, "
    f"CASE WHEN {_TS} = 0 THEN 'unknown' WHEN {_TSCORE} < 20 THEN 'easy' WHEN {_TSCORE} < 30 THEN 'moderate' "
    "ELSE 'complex' END AS readability_level, "
    f"CASE WHEN {_TW} > 0 THEN {rhu('length(regexp_replace(ft, chr(92) || ' + chr(39) + 's' + chr(39) + ', ' + chr(39) + chr(39) + ', ' + chr(39) + 'g' + chr(39) + '))::DOUBLE / ' + _TW + '::DOUBLE', 2)} "
    "ELSE 0.0::DOUBLE END AS average_word_length, "
    "CAST(len(regexp_extract_all(ft, '\\b(?:is|was|are|were|been|being)\\s+\\w+ed\\b')) AS BIGINT) AS passive_voice_count "
    "FROM tft"
)
