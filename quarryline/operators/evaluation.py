"""What results look like and how they are judged: common rows, relevance, means by mode and slice, retries, gates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.functions.text import tokens
from quarryline.operators.retrieval import _VEC_SQL, TOP_K, WINDOW, _ranked, _vectors, ir_metrics, vector_ranking
from quarryline.plans.catalog import query
from quarryline.plans.stages import materialize, table

#: Columns that tell how a row got its rank. Fixed values.
SCORE_COLUMNS = ("bm25_raw", "phrase_match", "token_overlap_count", "lexical_score", "semantic_score", "semantic_score_raw", "reranker_score", "relevance_score", "row_marker_scores", "rrf_score", "lexical_rank", "semantic_rank", "reranker_rank")


def csv_field(col: Column) -> Column:
    """The parts between commas, stripped, without blanks; empty for null."""
    return F.filter(F.transform(F.split(F.coalesce(col, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def common_rows(rows: DataFrame, asked: Column | None = None) -> DataFrame:
    """Rows of chunks or of statements in one form (P5): ids and texts under the statement's names (and, for chunks, under the chunk's as well), lists from comma-joined fields, the digest of the text in lower case, and the score as the negative raw one.

    A statement's text wins over a chunk's, also under the chunk's name. asked: the query's tokens, to count those that a text shares. Columns that a table lacks are blank or 0; others go along.
    """
    of = lambda names, default: F.coalesce(*[F.col(n) for n in names if n in rows.columns], F.lit(default))
    text = of(("statement_text", "chunk_text"), "")
    ident = of(("statement_id", "chunk_uid"), "")
    overlap = F.lit(0) if asked is None else F.size(F.array_intersect(asked, tokens(text)))
    raw = of(("bm25_raw",), 0.0).cast("double")
    made = {"statement_id": ident, "statement_text": text, **{c: of((c,), "") for c in ("section_heading", "source_anchor", "source_fetched_at")}, **{c: csv_field(of((c,), "")) for c in ("row_markers", "mechanism_ids", "mechanism_families")},
            "text_sha256": F.sha2(F.lower(text), 256), "bm25_raw": raw, "phrase_match": of(("phrase_match",), 0).cast("int"), "token_overlap_count": overlap, "lexical_score": -raw}
    if {"chunk_uid", "chunk_text"} & set(rows.columns):
        made |= {"chunk_uid": ident, "chunk_text": text}
    return rows.withColumns(made)


def without_scores(rows: DataFrame, requested: bool = False) -> DataFrame:
    """The rows without SCORE_COLUMNS unless they are asked for."""
    return rows if requested else rows.drop(*SCORE_COLUMNS)


@query("common_rows", r"""SELECT coalesce(chunk_uid, '') AS statement_id, coalesce(chunk_uid, '') AS chunk_uid, coalesce(clean_text, '') AS statement_text, coalesce(clean_text, '') AS chunk_text, coalesce(section_id, '') AS section_heading, '' AS source_anchor, coalesce(source_fetched_at, '') AS source_fetched_at,
  array_to_string(list_filter(list_transform(string_split(coalesce(section_id, '') || ', ' || coalesce(source_commit_sha, ''), ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS row_markers, '' AS mechanism_ids, '' AS mechanism_families, sha256(lower(coalesce(clean_text, ''))) AS text_sha256 FROM chunks""")
def common_chunks(spark, sf_dir):
    """Chunks as common rows, their scores dropped."""
    c = table(spark, sf_dir, "chunks", "chunk_uid", "clean_text", "section_id", "source_fetched_at", "source_commit_sha").withColumnRenamed("clean_text", "chunk_text")
    c = c.withColumns({"row_markers": F.concat(F.coalesce("section_id", F.lit("")), F.lit(", "), F.coalesce("source_commit_sha", F.lit(""))), "section_heading": F.col("section_id"), "bm25_raw": F.lit(-1.5)}).drop("section_id", "source_commit_sha")
    rows = without_scores(common_rows(c))
    return rows.withColumns({n: F.array_join(n, "|") for n in ("row_markers", "mechanism_ids", "mechanism_families")})


def relevant() -> Column:
    """Whether a row answers a prompt (P10): by its id, by the start of its anchor, by a label that was expected together with a term of the text, or by the label alone where no terms or anchors are named.

    Columns: statement_id, source_anchor, row_markers, statement_text; relevant_statement_ids, relevant_anchor_prefixes, expected_row_markers, relevant_terms (lists). Without expected labels any label
    will do for the terms. Blank prefixes and terms, and nulls, match nothing.
    """
    given = lambda c: F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.coalesce(x, F.lit("")) != "")
    text, anchor = F.lower(F.coalesce("statement_text", F.lit(""))), F.coalesce("source_anchor", F.lit(""))
    prefixes, terms, expected = given("relevant_anchor_prefixes"), given("relevant_terms"), given("expected_row_markers")
    labels = F.transform(given("row_markers"), F.lower)
    by_id = F.array_contains(given("relevant_statement_ids"), F.coalesce("statement_id", F.lit("")))
    by_anchor = F.exists(prefixes, lambda p: F.startswith(anchor, p))
    labelled = F.arrays_overlap(expected, labels)
    by_term = ((F.size(expected) == 0) | labelled) & F.exists(terms, lambda t: F.contains(text, t))
    by_label = labelled & (F.size(terms) == 0) & (F.size(prefixes) == 0)
    return F.coalesce(by_id | by_anchor | by_term | by_label, F.lit(False))


#: Prompts for the documents at hand: id, relevant ids, anchor prefixes, expected labels, terms.
PROMPTS = (
    ("by_id", ("3", "14"), (), (), ()), ("by_anchor", (), ("src/traits/", "", "src/items/v"), (), ()), ("by_label", (), (), ("lifetimes", "types"), ()),
    ("by_label_and_term", (), (), ("lifetimes", "types"), ("must not", "")), ("by_term", (), (), (), ("undefined",)), ("nothing", (), (), (), ()), ("label_with_anchor", (), ("nowhere/",), ("types",), ()),
)
_list_sql = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]::VARCHAR[]"


@query("relevance_predicate", f"""WITH p(prompt_id, ids, prefixes, labels, terms) AS (VALUES {', '.join(f"('{p[0]}', " + ', '.join(_list_sql(x) for x in p[1:]) + ')' for p in PROMPTS)}),
  d AS (SELECT cast(doc_id AS VARCHAR) AS id, coalesce(rel_path, '') AS anchor, lower(coalesce(chapter, '')) AS label, lower(coalesce(text, '')) AS text FROM documents)
SELECT prompt_id, count(*) AS relevant FROM p, d WHERE list_contains(ids, id) OR len(list_filter(prefixes, lambda x: x <> '' AND starts_with(anchor, x))) > 0
  OR ((len(labels) = 0 OR list_contains(labels, label)) AND len(list_filter(terms, lambda x: x <> '' AND contains(text, x))) > 0) OR (list_contains(labels, label) AND len(list_filter(terms, lambda x: x <> '')) = 0 AND len(list_filter(prefixes, lambda x: x <> '')) = 0) GROUP BY 1""")
def relevance_predicate(spark, sf_dir):
    """P10: how many documents answer each of a few prompts."""
    prompts = spark.createDataFrame(PROMPTS, "prompt_id string, relevant_statement_ids array<string>, relevant_anchor_prefixes array<string>, expected_row_markers array<string>, relevant_terms array<string>")
    d = table(spark, sf_dir, "documents", "doc_id", "rel_path", "chapter", "text").select(F.col("doc_id").cast("string").alias("statement_id"), F.col("rel_path").alias("source_anchor"), F.array_compact(F.array("chapter")).alias("row_markers"), F.col("text").alias("statement_text"))
    return d.crossJoin(F.broadcast(prompts)).where(relevant()).groupBy("prompt_id").agg(F.count("*").alias("relevant"))  # a stated set of prompts


def retry_summary(cases: DataFrame) -> DataFrame:
    """(mode, event_count, total_retry_count, failure_event_count) of cases (mode, events: array of retry_count and status), null events left out."""
    rows = cases.select("mode", F.explode_outer(F.array_compact("events")).alias("e"))
    return rows.groupBy("mode").agg(F.count("e").alias("event_count"), F.coalesce(F.sum("e.retry_count"), F.lit(0)).alias("total_retry_count"), F.count_if(F.col("e.status") == "fail").alias("failure_event_count"))


@query("retry_summary", """WITH c AS (SELECT event_type AS mode, cast(json_extract_string(props, '$.k') AS INT) AS k FROM events), e AS (SELECT mode, k % 3 AS n, CASE WHEN k > 80 THEN 'fail' ELSE 'pass' END AS s FROM c UNION ALL SELECT mode, k % 2, 'pass' FROM c WHERE k % 5 = 0)
SELECT mode, count(*) AS event_count, sum(n) AS total_retry_count, count(*) FILTER (WHERE s = 'fail') AS failure_event_count FROM e GROUP BY 1""")
def retries(spark, sf_dir):
    """Nested retry events per mode."""
    k = F.get_json_object("props", "$.k").cast("int")
    event = lambda n, s: F.struct(n.alias("retry_count"), s.alias("status"))
    two = F.array(event(k % 3, F.when(k > 80, "fail").otherwise("pass")), F.when(k % 5 == 0, event(k % 2, F.lit("pass"))))
    return retry_summary(table(spark, sf_dir, "events", "event_type", "props").select(F.col("event_type").alias("mode"), two.alias("events")))


# --- cases by mode and slice, and gates ---

METRICS = ("precision", "mrr", "ndcg", "row_hit")
#: Least values of means by mode, of the semantic mode on prompts that are about meaning, and of slices; how far hybrid may lie behind the best single mode; what semantic should have over lexical; and the floors of a checkpoint. Fixed values.
MODE_FLOORS = {("lexical", "precision"): 0.55, ("lexical", "mrr"): 0.65, ("lexical", "row_hit"): 0.80, ("hybrid", "precision"): 0.65, ("hybrid", "ndcg"): 0.72}
FOCUS_FLOORS = {("semantic", "mrr"): 0.60, ("semantic", "row_hit"): 0.75}
SLICE_FLOORS = {("lexical", "row_hit"): 0.75, ("hybrid", "row_hit"): 0.75}
CHECKPOINT_FLOORS = {("semantic", "mrr"): 0.54, ("hybrid", "precision"): 0.55}
BEHIND_BEST, AHEAD_OF_LEXICAL = 0.01, 0.05


def means(cases: DataFrame) -> DataFrame:
    """(scope, slice, mode, cases, METRICS): means over all cases, over those about meaning (scope focus) and over each slice, in one pass (A9). cases: (mode, slice, focus, METRICS)."""
    scopes = F.array_compact(F.array(F.struct(F.lit("all").alias("scope"), F.lit("").alias("slice")), F.when(F.col("focus"), F.struct(F.lit("focus").alias("scope"), F.lit("").alias("slice"))), F.struct(F.lit("slice").alias("scope"), F.col("slice").alias("slice"))))
    rows = cases.select("mode", F.explode(scopes).alias("s"), *METRICS).select("mode", "s.*", *METRICS)
    return rows.groupBy("scope", "slice", "mode").agg(F.count("*").alias("cases"), *[F.round(F.avg(m), 6).alias(m) for m in METRICS])


def gates(summary: DataFrame, cases: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """(gate, subject, value, least, passed, blocking): every gate that applies to what was run.

    Floors of modes, of the semantic mode on focused prompts, of slices and of a checkpoint; hybrid against the best single mode, overall and by slice; a prompt's own floors (query_id, mode, metric, least); and, without
    blocking, semantic against lexical on focused prompts. Modes that weren't run have no gate.
    """
    spark = summary.sparkSession
    long = summary.select("scope", "slice", "mode", F.explode(F.map_from_arrays(F.array(*[F.lit(m) for m in METRICS]), F.array(*METRICS))).alias("metric", "value"))
    floors = [(gate, scope, mode, metric, least) for gate, scope, table_ in (("mode", "all", MODE_FLOORS), ("focus", "focus", FOCUS_FLOORS), ("slice", "slice", SLICE_FLOORS), ("checkpoint", "all", CHECKPOINT_FLOORS)) for (mode, metric), least in table_.items()]
    wanted = spark.createDataFrame(floors, "gate string, scope string, mode string, metric string, least double")
    floored = long.join(F.broadcast(wanted), ["scope", "mode", "metric"]).select("gate", F.concat_ws(".", F.nullif("slice", F.lit("")), "mode", "metric").alias("subject"), "value", "least", F.lit(True).alias("blocking"))
    mrr = lambda mode: F.max(F.when(F.col("mode") == mode, F.col("mrr")))
    side = summary.groupBy("scope", "slice").agg(mrr("hybrid").alias("h"), F.max(F.when(F.col("mode") != "hybrid", F.col("mrr"))).alias("best"), mrr("semantic").alias("s"), mrr("lexical").alias("l"))
    best = side.where("scope <> 'focus' AND h IS NOT NULL AND best IS NOT NULL").select(F.lit("hybrid_vs_best_single").alias("gate"), F.coalesce(F.nullif("slice", F.lit("")), F.lit("all")).alias("subject"), F.col("h").alias("value"), F.round(F.col("best") - BEHIND_BEST, 6).alias("least"), F.lit(True).alias("blocking"))
    lead = side.where("scope = 'focus' AND s IS NOT NULL AND l IS NOT NULL").select(F.lit("semantic_vs_lexical").alias("gate"), F.lit("focus").alias("subject"), F.col("s").alias("value"), F.round(F.col("l") + AHEAD_OF_LEXICAL, 6).alias("least"), F.lit(False).alias("blocking"))
    rows = floored.unionByName(best).unionByName(lead)
    if overrides is not None:
        one = cases.select("query_id", "mode", F.explode(F.map_from_arrays(F.array(*[F.lit(m) for m in METRICS]), F.array(*METRICS))).alias("metric", "value")).join(overrides, ["query_id", "mode", "metric"])
        rows = rows.unionByName(one.select(F.lit("prompt").alias("gate"), F.concat_ws(".", "query_id", "mode", "metric").alias("subject"), "value", "least", F.lit(True).alias("blocking")))
    return rows.select("gate", "subject", "value", "least", (F.col("value") >= F.col("least")).alias("passed"), "blocking")


_EVAL_SQL = f"""{_VEC_SQL}, hy AS (SELECT query_id, id, same, row_number() OVER (PARTITION BY query_id ORDER BY round(1.0::DOUBLE / (60 + crank) + 1.0::DOUBLE / (60 + rank), 9) DESC, id) AS rank FROM vr),
  j AS (SELECT 'lexical' AS mode, query_id, crank AS rank, same::INT AS rel FROM vr WHERE crank <= {TOP_K} UNION ALL SELECT 'semantic', query_id, rank, same::INT FROM vr WHERE rank <= {TOP_K} UNION ALL SELECT 'hybrid', query_id, rank, same::INT FROM hy WHERE rank <= {TOP_K}),
  cs AS (SELECT mode, query_id, round(avg(rel), 6) AS precision, round(max(rel / rank), 6) AS mrr, round(coalesce(sum(rel / log2(rank + 1)) / nullif(list_sum(list_transform(range(1, cast(sum(rel) AS BIGINT) + 1), lambda i: 1 / log2(i + 1))), 0), 0), 6) AS ndcg, max(rel)::DOUBLE AS row_hit, CASE WHEN query_id % 200 = 0 THEN 'main' ELSE 'edge' END AS slice, query_id % 300 = 0 AS focus FROM j GROUP BY 1, 2),
  sc AS (SELECT mode, 'all' AS scope, '' AS slice, precision, mrr, ndcg, row_hit FROM cs UNION ALL SELECT mode, 'focus', '', precision, mrr, ndcg, row_hit FROM cs WHERE focus UNION ALL SELECT mode, 'slice', slice, precision, mrr, ndcg, row_hit FROM cs),
  mean AS (SELECT scope, slice, mode, count(*) AS cases, round(avg(precision), 6) AS precision, round(avg(mrr), 6) AS mrr, round(avg(ndcg), 6) AS ndcg, round(avg(row_hit), 6) AS row_hit FROM sc GROUP BY 1, 2, 3)"""


def _cases_of_three(spark, sf_dir) -> DataFrame:
    """Cases of nearest vectors as three modes: by cosine (standing in for lexical), reranked (semantic), and both fused by ranks (hybrid)."""
    e, near = _vectors(spark, sf_dir)
    near = materialize(near)
    plain = _ranked(near, F.desc("cosine"), F.asc("id")).select("query_id", "id", F.col("rank").alias("crank")).where(F.col("crank") <= WINDOW)
    both = materialize(plain.join(vector_ranking(near, e).select("query_id", "id", "rank"), ["query_id", "id"]))
    fused = _ranked(both.select("query_id", "id", F.round(1.0 / (60 + F.col("crank")) + 1.0 / (60 + F.col("rank")), 9).alias("s")), F.desc("s"), F.asc("id")).drop("s")
    of = lambda df, mode, rank: df.select(F.lit(mode).alias("mode"), "query_id", "id", F.col(rank).alias("rank"))
    rows = of(both, "lexical", "crank").unionByName(of(both, "semantic", "rank")).unionByName(of(fused, "hybrid", "rank")).where(F.col("rank") <= TOP_K)
    labels = e.select(F.col("vec_id").alias("id"), "label")
    judged = materialize(rows.join(labels, "id").join(labels.select(F.col("id").alias("query_id"), F.col("label").alias("wanted")), "query_id").select("mode", "query_id", "rank", (F.col("label") == F.col("wanted")).alias("relevant")))
    hits = judged.groupBy("mode", "query_id").agg(F.max(F.col("relevant").cast("double")).alias("row_hit"))
    cases = ir_metrics(judged).join(hits, ["mode", "query_id"])
    return materialize(cases.withColumns({"slice": F.when(F.col("query_id") % 200 == 0, "main").otherwise("edge"), "focus": F.col("query_id") % 300 == 0}))


@query("eval_means", f"WITH {_EVAL_SQL} SELECT * FROM mean")
def eval_means(spark, sf_dir):
    """Means per mode, per slice and for focused prompts."""
    return means(_cases_of_three(spark, sf_dir))


def _floors_sql(gate: str, scope: str, floors: Mapping) -> str:
    return " UNION ALL ".join(f"SELECT '{gate}' AS gate, CASE WHEN slice = '' THEN '' ELSE slice || '.' END || '{mode}.{metric}' AS subject, {metric} AS value, {least}::DOUBLE AS least, true AS blocking FROM mean WHERE scope = '{scope}' AND mode = '{mode}'" for (mode, metric), least in floors.items())


@query("ir_gates_full", f"""WITH {_EVAL_SQL}, side AS (SELECT scope, slice, max(mrr) FILTER (WHERE mode = 'hybrid') AS h, max(mrr) FILTER (WHERE mode <> 'hybrid') AS best, max(mrr) FILTER (WHERE mode = 'semantic') AS s, max(mrr) FILTER (WHERE mode = 'lexical') AS l FROM mean GROUP BY 1, 2),
  every AS ({' UNION ALL '.join(_floors_sql(*x) for x in (('mode', 'all', MODE_FLOORS), ('focus', 'focus', FOCUS_FLOORS), ('slice', 'slice', SLICE_FLOORS), ('checkpoint', 'all', CHECKPOINT_FLOORS)))}
    UNION ALL SELECT 'hybrid_vs_best_single', coalesce(nullif(slice, ''), 'all'), h, round(best - {BEHIND_BEST}, 6), true FROM side WHERE scope <> 'focus' UNION ALL SELECT 'semantic_vs_lexical', 'focus', s, round(l + {AHEAD_OF_LEXICAL}, 6), false FROM side WHERE scope = 'focus'
    UNION ALL SELECT 'prompt', query_id || '.lexical.precision', precision, 0.5::DOUBLE, true FROM cs WHERE mode = 'lexical' AND query_id < 1000)
SELECT gate, subject, value, least, value >= least AS passed, blocking FROM every""")
def gates_full(spark, sf_dir):
    """All blocking classes and the advisory one; the first prompts have floors of their own."""
    cases = _cases_of_three(spark, sf_dir)
    own = cases.where("mode = 'lexical' AND query_id < 1000").select("query_id", "mode", F.lit("precision").alias("metric"), F.lit(0.5).alias("least"))
    return gates(means(cases), cases, own)
