"""Contracts with their row limits, rewriting of queries by rules, and the finer text functions, as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryline.functions.text import FENCE, fenced_blocks, topic
from quarryline.operators.retrieval import title_queries
from quarryline.plans.catalog import query
from quarryline.plans.contracts import QuerySpec, run_contract
from quarryline.plans.rewrite import rewrite
from quarryline.plans.stages import table

_WS = r"E' \t\r\n'"
#: Rules for the titles at hand, in the form of a file of rules.
TITLE_RULES = {
    "strategy": "titles-v1",
    "token_expansions": {"must": ["shall", "required"], "item": ["entry", "element"], "unwinding": ["panic", "boundary"], "checked": ["verified", "must"]},
    "suppress_tokens_when_present": {"the": ["must", "ensure"], "keep": ["apart"]},
    "row_marker_terms": {"a": ["alpha", "item"]},
    "mode_terms": {"semantic": ["intent", "semantics"], "hybrid": ["intent", "boundary"]},
    "mode_specific_rules": {"semantic": {"token_expansions": {"unwinding": ["abort", "provenance"], "shall": ["duty"]}, "semantic_intent_prefix": "semantic intent"}},
}


@query("contract_row_limit", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 1000 ORDER BY o_totalprice DESC, o_orderkey LIMIT 7")
def contract_row_limit(spark, sf_dir):
    """An ordered contract under its own row limit."""
    spec = QuerySpec("largest_orders", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= :least ORDER BY o_totalprice DESC, o_orderkey", ("least",), 7, True)
    return run_contract(spark, spec, {"least": 1000}, tables={"orders": table(spark, sf_dir, "orders")})


@query("contract_limit_inside", "SELECT n_name FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region ORDER BY r_name LIMIT 2) ORDER BY n_name LIMIT 4")
def contract_limit_inside(spark, sf_dir):
    """A limit in a subquery is no limit of the whole, so the row limit still holds."""
    spec = QuerySpec("nations", "SELECT n_name FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region ORDER BY r_name LIMIT 2) ORDER BY n_name", (), 4, True)
    return run_contract(spark, spec, tables={n: table(spark, sf_dir, n) for n in ("nation", "region")})


def _rows(section: str, of: dict[str, list[str]], mode: str = "") -> list[str]:
    return [f"('{section}', '{mode}', '{trigger}', {nth}, '{term}')" for trigger, terms in of.items() for nth, term in enumerate(terms)]


_RULES = ", ".join([r for s in ("token_expansions", "suppress_tokens_when_present", "row_marker_terms", "mode_terms") for r in _rows(s, TITLE_RULES[s])] + _rows("mode_specific_rules", TITLE_RULES["mode_specific_rules"]["semantic"]["token_expansions"], "semantic"))


@query("query_rewrite", rf"""WITH rules(section, mode, trig, nth, term) AS (VALUES {_RULES}), modes(mode) AS (VALUES ('lexical'), ('semantic'), ('hybrid')),
  titles AS (SELECT trim(guideline_id, {_WS}) AS query_id, coalesce(max(title), '') AS query FROM guideline_records WHERE trim(guideline_id, {_WS}) <> '' GROUP BY 1),
  asked AS (SELECT query_id, mode, lower(right(query_id, 1)) AS marker, trim(regexp_replace(query, '[ \t\n\r\f\x0b]+', ' ', 'g')) AS plain, regexp_extract_all(lower(query), '[a-z0-9_]+') AS w FROM titles, modes),
  words AS (SELECT query_id, mode, w, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM asked),
  gone AS (SELECT DISTINCT x.query_id, x.mode, x.word FROM words x JOIN rules r ON r.section = 'suppress_tokens_when_present' AND r.trig = x.word WHERE list_contains(x.w, r.term)),
  kept AS (SELECT x.* FROM words x LEFT JOIN gone g USING (query_id, mode, word) WHERE g.word IS NULL),
  found AS (SELECT query_id, k.mode, 0 AS s, pos, nth, term FROM kept k JOIN rules r ON r.section = 'token_expansions' AND r.trig = k.word
    UNION ALL SELECT query_id, a.mode, 1, 0, nth, term FROM asked a JOIN rules r ON r.section = 'row_marker_terms' AND r.trig = a.marker
    UNION ALL SELECT query_id, a.mode, 2, 0, nth, term FROM asked a JOIN rules r ON r.section = 'mode_terms' AND r.trig = a.mode
    UNION ALL SELECT query_id, k.mode, 3, pos, nth, term FROM kept k JOIN rules r ON r.section = 'mode_specific_rules' AND r.trig = k.word AND r.mode = k.mode),
  added AS (SELECT f.query_id, f.mode, f.term, min(s * 1000000000::BIGINT + f.pos * 10000 + f.nth) AS o FROM found f LEFT JOIN kept k ON k.query_id = f.query_id AND k.mode = f.mode AND k.word = f.term WHERE k.word IS NULL GROUP BY 1, 2, 3),
  whole AS (SELECT a.query_id, a.mode, a.plain, coalesce((SELECT string_agg(word, ' ' ORDER BY pos) FROM kept k WHERE k.query_id = a.query_id AND k.mode = a.mode), '') AS k,
    coalesce((SELECT string_agg(term, ' ' ORDER BY o) FROM added d WHERE d.query_id = a.query_id AND d.mode = a.mode), '') AS d, (SELECT count(*) FROM gone g WHERE g.query_id = a.query_id AND g.mode = a.mode) AS cut,
    coalesce((SELECT string_agg(DISTINCT o // 1000000000, '' ORDER BY o // 1000000000) FROM added d WHERE d.query_id = a.query_id AND d.mode = a.mode), '') AS ss FROM asked a)
SELECT query_id, mode, trim(CASE WHEN mode = 'semantic' THEN 'semantic intent ' ELSE '' END || CASE WHEN trim(k || ' ' || d) = '' THEN plain ELSE trim(k || ' ' || d) END) AS rewritten, d AS added,
  'titles-v1' || CASE WHEN cut > 0 THEN ',token-suppression' ELSE '' END || CASE WHEN contains(ss, '0') THEN ',token-expansion' ELSE '' END || CASE WHEN contains(ss, '1') THEN ',row-marker-terms' ELSE '' END
  || CASE WHEN contains(ss, '2') THEN ',mode-terms' ELSE '' END || CASE WHEN contains(ss, '3') THEN ',mode-specific-token-expansion' ELSE '' END || CASE WHEN mode = 'semantic' THEN ',semantic-intent-prefix' ELSE '' END AS tags FROM whole""")
def query_rewrite(spark, sf_dir):
    """Every title rewritten for each mode; the marker is the last letter of its id."""
    q = title_queries(spark, sf_dir).select("query_id", "query", F.lower(F.right("query_id", F.lit(1))).alias("marker"), F.explode(F.array(F.lit("lexical"), F.lit("semantic"), F.lit("hybrid"))).alias("mode"))
    return rewrite(q, TITLE_RULES).select("query_id", "mode", "rewritten", F.array_join("added", " ").alias("added"), F.array_join("tags", ",").alias("tags"))





@query("text_fenced_blocks", rf"""WITH t AS (SELECT doc_id, regexp_extract_all(text, '{FENCE}') AS f, string_split_regex(text, '{FENCE}') AS b FROM documents WHERE text IS NOT NULL),
  p AS (SELECT doc_id, flatten(list_transform(range(1, len(b) + 1), lambda i: list_concat(string_split_regex(b[i], '\n[ \t\r]*\n'), CASE WHEN i <= len(f) THEN [f[i]] ELSE [] END))) AS parts FROM t),
  k AS (SELECT doc_id, list_filter(list_transform(parts, lambda x: trim(x, {_WS})), lambda x: x <> '') AS parts FROM p)
SELECT doc_id, unnest(parts) AS block, generate_subscripts(parts, 1) AS place FROM k""")
def document_blocks(spark, sf_dir):
    """the blocks of every document, fences whole."""
    rows = table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.posexplode(fenced_blocks("text")).alias("at", "block"))
    return rows.select("doc_id", "block", (F.col("at") + 1).alias("place"))


_NAME = r"trim(regexp_replace(trim(regexp_replace(replace(lower(trim(coalesce(rel_path, ''))), '\', '/'), '^coding-guidelines/', ''), '/'), '/index$', ''), '/')"


@query("text_topics", rf"""SELECT doc_id, CASE WHEN {_NAME} = '' THEN coalesce(nullif(trim(regexp_replace(coalesce(nullif(lower(trim(coalesce(chapter, ''))), ''), 'general'), '[^a-z0-9/_-]+', '-', 'g'), '-/'), ''), 'general')
  ELSE array_to_string(list_transform(string_split({_NAME}, '/'), lambda s: coalesce(nullif(trim(regexp_replace(s, '[^a-z0-9_-]+', '-', 'g'), '-'), ''), 'misc')), '/') END AS topic FROM documents""")
def document_topics(spark, sf_dir):
    """every document's topic from its path, or its chapter where it has none."""
    return table(spark, sf_dir, "documents", "doc_id", "rel_path", "chapter").select("doc_id", topic("rel_path", "chapter").alias("topic"))
