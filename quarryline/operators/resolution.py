"""Which paragraph a guideline belongs to: nearest paragraphs, overlapping titles, explainable scores, winners by stage, and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.functions.cleaning import id_or_null, strip
from quarryline.functions.text import STOPWORDS, jaccard, ngrams, ordered_coverage, raw_tokens, singular, tokens
from quarryline.operators.ranking import most_shared
from quarryline.operators.references import link_target
from quarryline.operators.relational import full_outer_delta
from quarryline.operators.retrieval import _CASES_SQL, _cases, title_queries
from quarryline.plans.catalog import query
from quarryline.plans.stages import materialize, table

_WS = r"E' \t\r\n'"
#: Weights of the components of a score, least evidence and total, and what acceptance and review ask for. Fixed values.
COMPONENTS = {"text_overlap": 0.24, "phrase_evidence": 0.22, "document_prior": 0.05, "section_prior": 0.05, "code_evidence": 0.12}
LEAST_EVIDENCE, LEAST_TOTAL = 0.12, 0.24
ACCEPT_TOTAL, ACCEPT_MARGIN, REVIEW_TOTAL = 0.28, 0.05, 0.22
STAGES = ("section", "document", "global")
PHRASE_STOPWORDS = ("a", "an", "and", "as", "at", "be", "by", "for", "in", "is", "it", "its", "of", "on", "or", "that", "the", "this", "to", "with")


def long_tokens(text: Column | str) -> Column:
    """Distinct tokens of four letters or more that are no stopwords."""
    return F.filter(tokens(text), lambda t: F.length(t) >= 4)


def _paragraphs(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "paragraphs", "paragraph_id", "clean_text", "document_link", "section_link")
    return p.groupBy(id_or_null("paragraph_id").alias("paragraph_id")).agg(F.coalesce(F.max("clean_text"), F.lit("")).alias("text"), F.max("document_link").alias("document_link"), F.max("section_link").alias("section_link")).where("paragraph_id IS NOT NULL")


def nearest_by_overlap(queries: DataFrame, units: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, id, overlap, place): the k units that share most tokens with each query.

    queries: (query_id, tokens), units: (id, tokens), both without repeats. Nothing is paired that shares no token; every task holds the units of each token that is asked for, and no pair is written.
    """
    return most_shared(queries, units, k)


_LONG = "list_filter(list_distinct(regexp_extract_all(lower({t}), '[a-z0-9_]+')), lambda x: length(x) >= 4 AND x NOT IN ('available', 'does', 'feature', 'features', 'kinds', 'language', 'programming', 'rust', 'support', 'supports', 'techniques', 'that', 'what', 'when', 'where', 'which', 'with'))"
_NEAR_SQL = f"""par AS (SELECT trim(paragraph_id, {_WS}) AS id, coalesce(max(clean_text), '') AS text FROM paragraphs GROUP BY 1 HAVING trim(paragraph_id, {_WS}) <> ''), qs AS (SELECT trim(guideline_id, {_WS}) AS query_id, coalesce(max(title), '') AS title FROM guideline_records GROUP BY 1 HAVING trim(guideline_id, {_WS}) <> ''),
  pt AS (SELECT id, unnest({_LONG.format(t='text')}) AS t FROM par), qt AS (SELECT query_id, unnest({_LONG.format(t='title')}) AS t FROM qs), sh AS (SELECT query_id, id, count(*) AS overlap FROM qt JOIN pt USING (t) GROUP BY 1, 2), near AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY overlap DESC, id) AS place FROM sh QUALIFY place <= 5)"""


@query("nearest_by_overlap", f"WITH {_NEAR_SQL} SELECT * FROM near")
def nearest_paragraphs(spark, sf_dir):
    """Five paragraphs for every guideline's title."""
    return nearest_by_overlap(title_queries(spark, sf_dir).select("query_id", long_tokens("query").alias("tokens")), _paragraphs(spark, sf_dir).select(F.col("paragraph_id").alias("id"), long_tokens("text").alias("tokens")))


@query("mapping_audit", f"""WITH {_NEAR_SQL}, b AS (SELECT query_id, max(overlap) AS best, list(id) AS ids FROM near GROUP BY 1), m AS (SELECT trim(guideline_id, {_WS}) AS query_id, max(nullif(nullif(trim(regexp_replace(raw_fls_id, '^.*#', '', 's'), {_WS}), ''), 'fls_UNRESOLVED')) AS fls FROM guideline_fls_source_mappings GROUP BY 1),
  x AS (SELECT q.query_id, m.fls, p.id IS NOT NULL AS present, coalesce(s.overlap, 0) AS own, coalesce(b.best, 0) AS best FROM qs q JOIN m USING (query_id) LEFT JOIN par p ON p.id = m.fls LEFT JOIN sh s ON s.query_id = q.query_id AND s.id = m.fls LEFT JOIN b ON b.query_id = q.query_id)
SELECT query_id, CASE WHEN fls IS NULL OR NOT present THEN CASE WHEN best >= 3 THEN 'stale_mapping' ELSE 'corpus_gap' END WHEN own < best AND best >= 3 THEN 'weak_mapping' WHEN own < 2 THEN CASE WHEN best >= 2 THEN 'weak_mapping' ELSE 'corpus_gap' END ELSE 'true_ranking_bug' END AS classification, own, best FROM x""")
def mapping_audit(spark, sf_dir):
    """Mappings told apart by how their paragraph compares with the nearest ones."""
    q = title_queries(spark, sf_dir).select("query_id", long_tokens("query").alias("tokens"))
    p = _paragraphs(spark, sf_dir).select(F.col("paragraph_id").alias("id"), long_tokens("text").alias("own_tokens"))
    best = nearest_by_overlap(q, p.withColumnRenamed("own_tokens", "tokens"), 1).select("query_id", F.col("overlap").alias("best"))
    m = table(spark, sf_dir, "guideline_fls_source_mappings", "guideline_id", "raw_fls_id").groupBy(strip("guideline_id").alias("query_id")).agg(F.max(link_target("raw_fls_id")).alias("id"))
    x = q.join(m, "query_id").join(p, "id", "left").join(best, "query_id", "left").select("query_id", F.col("own_tokens").isNotNull().alias("present"), F.coalesce(F.size(F.array_intersect("tokens", "own_tokens")), F.lit(0)).alias("own"), F.coalesce("best", F.lit(0)).alias("best"))
    own, top = F.col("own"), F.col("best")
    kind = F.when(~F.col("present"), F.when(top >= 3, "stale_mapping").otherwise("corpus_gap")).when((own < top) & (top >= 3), "weak_mapping").when(own < 2, F.when(top >= 2, "weak_mapping").otherwise("corpus_gap")).otherwise("true_ranking_bug")
    return x.select("query_id", kind.alias("classification"), "own", "best")


@query("classification_counts", "WITH d AS (SELECT unnest(['corpus_gap', 'ranking_bug', 'stale_mapping', 'true_ranking_bug', 'weak_mapping']) AS classification) SELECT d.classification, count(t.source_id) AS n FROM d LEFT JOIN (SELECT DISTINCT source_id, classification FROM ws7_mapping_cleanup_tasks) t USING (classification) GROUP BY 1")
def classification_counts(spark, sf_dir):
    """Counts over a fixed set of classes, zeros included."""
    names = spark.createDataFrame([(c,) for c in ("corpus_gap", "ranking_bug", "stale_mapping", "true_ranking_bug", "weak_mapping")], "classification string")
    t = table(spark, sf_dir, "ws7_mapping_cleanup_tasks", "source_id", "classification").distinct().groupBy("classification").agg(F.count("source_id").alias("n"))
    return names.join(t, "classification", "left").na.fill(0)


def similar_pairs(sets: DataFrame, least: float) -> DataFrame:
    """(left_id, right_id, score): all pairs of sets with at least that Jaccard similarity, exactly.

    sets: (id, tokens). Tokens are ordered from the rarest on; two sets that are similar enough must share one of the first
    n - ceil(least * n) + 1, so only those are joined on, and common tokens are met only where a set has little else.
    """
    words = sets.select("id", F.explode("tokens").alias("t"))
    rare = words.groupBy("t").agg(F.count("*").alias("df"))
    ordered = words.join(rare, "t").groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "t"))), lambda x: x["t"]).alias("tokens")).withColumn("n", F.size("tokens"))
    ordered = materialize(ordered)
    head = ordered.select("id", "n", F.explode(F.slice("tokens", F.lit(1), F.col("n") - F.ceil(F.col("n") * least) + 1)).alias("t"))
    other = head.select(F.col("id").alias("id_"), F.col("n").alias("n_"), "t")
    near = head.join(other, "t").where((F.col("id") < F.col("id_")) & (F.col("n") >= F.col("n_") * least) & (F.col("n_") >= F.col("n") * least)).select("id", "id_").distinct()
    both = near.join(ordered.select("id", F.col("tokens").alias("a")), "id").join(ordered.select(F.col("id").alias("id_"), F.col("tokens").alias("b")), "id_")
    return both.select(F.col("id").alias("left_id"), F.col("id_").alias("right_id"), jaccard(F.col("a"), F.col("b")).alias("score")).where(F.col("score") >= least)


_TITLE_SETS = f"t AS (SELECT trim(guideline_id, {_WS}) AS id, {_LONG.format(t='''coalesce(max(title), '')''')} AS s FROM guideline_records GROUP BY 1)"


@query("overlap_pairs_jaccard", f"WITH {_TITLE_SETS} SELECT a.id AS left_id, b.id AS right_id, round(len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))), 4) AS score, CASE WHEN len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))) >= 0.6 THEN 'near_duplicate' ELSE 'family_overlap' END AS kind FROM t a JOIN t b ON a.id < b.id AND len(a.s) > 0 AND len(b.s) > 0 AND len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))) >= 0.4")
def overlap_pairs(spark, sf_dir):
    """Titles whose tokens overlap by 0.4 or more."""
    pairs = similar_pairs(title_queries(spark, sf_dir).select(F.col("query_id").alias("id"), long_tokens("query").alias("tokens")), 0.4)
    return pairs.select("left_id", "right_id", F.round("score", 4).alias("score"), F.when(F.col("score") >= 0.6, "near_duplicate").otherwise("family_overlap").alias("kind"))


@query("baseline_overlap_topk", f"""WITH {_TITLE_SETS}, w AS (SELECT source_id, {_LONG.format(t='''coalesce(max(title), '')''')} AS s FROM ws7_mapping_cleanup_tasks GROUP BY 1), wt AS (SELECT source_id, unnest(s) AS k FROM w), tt AS (SELECT id, unnest(s) AS k FROM t), h AS (SELECT source_id, id, count(*) AS n FROM wt JOIN tt USING (k) GROUP BY 1, 2),
  j AS (SELECT h.source_id, h.id, n / (len(w.s) + len(t.s) - n) AS j FROM h JOIN w USING (source_id) JOIN t USING (id))
SELECT source_id, id AS guideline_id, round(j, 4) AS score, CASE WHEN j >= 0.75 THEN 'near_duplicate' WHEN j >= 0.45 THEN 'partial_same_family' ELSE 'low' END AS kind, row_number() OVER (PARTITION BY source_id ORDER BY round(j, 4) DESC, id) AS place FROM j QUALIFY place <= 5""")
def baseline_overlap(spark, sf_dir):
    """The five stored guidelines most like each task's title, by bands."""
    t = title_queries(spark, sf_dir).select(F.col("query_id").alias("guideline_id"), long_tokens("query").alias("s"))
    w = table(spark, sf_dir, "ws7_mapping_cleanup_tasks", "source_id", "title").groupBy("source_id").agg(long_tokens(F.coalesce(F.max("title"), F.lit(""))).alias("s"))
    hits = w.select("source_id", F.explode("s").alias("k")).join(t.select("guideline_id", F.explode("s").alias("k")), "k").groupBy("source_id", "guideline_id").agg(F.count("*").alias("n"))
    j = hits.join(w.select("source_id", F.size("s").alias("a")), "source_id").join(t.select("guideline_id", F.size("s").alias("b")), "guideline_id").withColumn("j", F.col("n") / (F.col("a") + F.col("b") - F.col("n")))
    rows = j.select("source_id", "guideline_id", F.round("j", 4).alias("score"), F.when(F.col("j") >= 0.75, "near_duplicate").when(F.col("j") >= 0.45, "partial_same_family").otherwise("low").alias("kind"))
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("source_id").orderBy(F.desc("score"), "guideline_id"))).where("place <= 5")


#: Modes from the most to the least trusted.
MODES = ("hybrid", "semantic", "lexical")


def merge_modes(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """One row a key from its rows of several modes (R39): for each field the longest value, then the more trusted mode, then the smaller value.

    ``conflicts`` counts the fields with more than one value; blanks don't count. rows: (key, mode, fields...).
    """
    trust = -F.array_position(F.array(*[F.lit(m) for m in MODES]), F.col("mode"))
    picks, clashes = [], []
    for f in fields:
        value = F.nullif(F.trim(f), F.lit(""))
        picks.append(F.max_by(value, F.when(value.isNotNull(), F.struct(F.length(value), trust))).alias(f))
        clashes.append((F.size(F.collect_set(value)) > 1).cast("int"))
    return rows.groupBy(key).agg(*picks, sum(clashes).alias("conflicts"))


@query("canonical_merge", f"""WITH r AS (SELECT DISTINCT trim(paragraph_id, {_WS}) AS id, unnest([{{'m': 3, 'v': trim(raw_text)}}, {{'m': 2, 'v': trim(text)}}, {{'m': 1, 'v': trim(clean_text)}}]) AS x FROM paragraphs)
SELECT id, arg_max(x.v, {{'l': length(x.v), 't': -x.m}}) FILTER (WHERE x.v <> '') AS value, (count(DISTINCT x.v) FILTER (WHERE x.v <> '') > 1)::INT AS conflicts FROM r GROUP BY 1""")
def canonical_merge(spark, sf_dir):
    """A paragraph's three texts, as if three modes had found them, merged to one."""
    p = table(spark, sf_dir, "paragraphs", "paragraph_id", "raw_text", "text", "clean_text").distinct()
    modes = F.array(*[F.struct(F.lit(m).alias("mode"), F.col(c).alias("value")) for m, c in zip(MODES, ("clean_text", "text", "raw_text"), strict=True)])
    return merge_modes(p.select(strip("paragraph_id").alias("id"), F.inline(modes)), "id", ["value"])


def phrase_score(phrase: Column, text: Column) -> Column:
    """0 to 1: how far a text holds a phrase: as it stands, or its words in order and its runs of two and three words."""
    words = lambda c: F.filter(F.transform(raw_tokens(c), singular), lambda t: ~t.isin(*PHRASE_STOPWORDS))
    a, b = words(phrase), words(text)
    share = lambda n: F.when(F.size(ngrams(a, n)) > 0, F.size(F.array_intersect(ngrams(a, n), ngrams(b, n))) / F.size(ngrams(a, n))).otherwise(0.0)
    exact = F.when((F.length(phrase) > 0) & F.contains(F.lower(text), F.lower(phrase)), 1.0).otherwise(0.0)
    return F.round(F.greatest(exact, 0.65 * ordered_coverage(a, b) + 0.35 * F.greatest(share(2), share(3))), 6)


def candidate_components(spark, sf_dir) -> DataFrame:
    """(guideline_id, paragraph_id, stages, components...): every candidate paragraph of every guideline, its scores, and the stages in whose scope it lies."""
    c = table(spark, sf_dir, "guideline_fls_resolution_candidates", "guideline_id", "paragraph_id").select(strip("guideline_id").alias("guideline_id"), strip("paragraph_id").alias("paragraph_id")).distinct()
    p = _paragraphs(spark, sf_dir)
    m = table(spark, sf_dir, "guideline_fls_source_mappings", "guideline_id", "raw_fls_id").groupBy(strip("guideline_id").alias("guideline_id")).agg(F.max(link_target("raw_fls_id")).alias("raw"))
    prior = m.join(p.select(F.col("paragraph_id").alias("raw"), F.col("document_link").alias("prior_document"), F.col("section_link").alias("prior_section")), "raw").drop("raw")
    q = title_queries(spark, sf_dir).select(F.col("query_id").alias("guideline_id"), "query", long_tokens("query").alias("asked"))
    x = c.join(q, "guideline_id").join(p, "paragraph_id").join(prior, "guideline_id", "left")
    same = lambda a, b: F.coalesce(F.col(a) == F.col(b), F.lit(False))
    in_section, in_document = same("section_link", "prior_section"), same("document_link", "prior_document")
    code = F.filter(F.transform(F.regexp_extract_all("query", F.lit("[A-Z][a-z]+[A-Z][A-Za-z]+"), F.lit(0)), F.lower), lambda t: F.length(t) > 0)
    code = F.array_distinct(code)
    overlap = F.when(F.size("asked") > 0, F.round(F.size(F.array_intersect("asked", long_tokens("text"))) / F.size("asked"), 6)).otherwise(0.0)
    hit = F.size(F.array_intersect(code, raw_tokens("text")))
    return x.select(
        "guideline_id", "paragraph_id", F.array_compact(F.array(F.when(in_section, "section"), F.when(in_document, "document"), F.lit("global"))).alias("stages"), overlap.alias("text_overlap"), phrase_score(F.col("query"), F.col("text")).alias("phrase_evidence"),
        F.when(in_document, 1.0).otherwise(0.0).alias("document_prior"), F.when(in_section, 1.0).otherwise(0.0).alias("section_prior"), F.when(F.size(code) > 0, F.round(F.least(F.lit(1.0), hit / F.least(F.lit(3), F.size(code))), 6)).otherwise(0.0).alias("code_evidence"),
    )


def explain(scores: DataFrame) -> DataFrame:
    """Adds total, the weighed sum of the components, and eligible: enough evidence besides priors, and enough in all."""
    total = F.round(sum(w * F.col(c) for c, w in COMPONENTS.items()), 6)
    return scores.withColumn("total", total).withColumn("eligible", (F.greatest("text_overlap", "code_evidence") >= LEAST_EVIDENCE) & (F.col("total") >= LEAST_TOTAL))


@query("component_scores", f"""WITH c AS (SELECT DISTINCT trim(guideline_id, {_WS}) AS g, trim(paragraph_id, {_WS}) AS p FROM guideline_fls_resolution_candidates), par AS (SELECT trim(paragraph_id, {_WS}) AS id, coalesce(max(clean_text), '') AS text, max(document_link) AS d, max(section_link) AS s FROM paragraphs GROUP BY 1), q AS (SELECT trim(guideline_id, {_WS}) AS g, {_LONG.format(t='''coalesce(max(title), '')''')} AS t FROM guideline_records GROUP BY 1),
  m AS (SELECT trim(guideline_id, {_WS}) AS g, max(nullif(nullif(trim(regexp_replace(raw_fls_id, '^.*#', '', 's'), {_WS}), ''), 'fls_UNRESOLVED')) AS raw FROM guideline_fls_source_mappings GROUP BY 1)
SELECT c.g AS guideline_id, c.p AS paragraph_id, round(CASE WHEN len(q.t) > 0 THEN len(list_intersect(q.t, {_LONG.format(t='par.text')})) / len(q.t) ELSE 0 END, 6) AS text_overlap, CASE WHEN r.d = par.d THEN 1.0 ELSE 0.0 END AS document_prior, CASE WHEN r.s = par.s THEN 1.0 ELSE 0.0 END AS section_prior FROM c JOIN q USING (g) JOIN par ON par.id = c.p LEFT JOIN m USING (g) LEFT JOIN par r ON r.id = m.raw""")
def component_scores(spark, sf_dir):
    """The components that SQL expresses as well: overlap and priors."""
    return candidate_components(spark, sf_dir).select("guideline_id", "paragraph_id", "text_overlap", "document_prior", "section_prior")


_WORDS = "list_filter(list_transform(regexp_extract_all(lower({t}), '[a-z0-9_]+'), lambda x: CASE WHEN length(x) > 4 AND x LIKE '%s' AND x NOT LIKE '%ss' THEN x[:-2] ELSE x END), lambda x: x NOT IN (" + ", ".join(f"'{w}'" for w in PHRASE_STOPWORDS) + "))"
_GRAMS = "list_distinct(list_transform(range(1, len({a}) - {n} + 2), lambda i: array_to_string({a}[i:i + {n} - 1], ' ')))"
_WALKED = "list_reduce(list_prepend({{'h': 0, 'w': ''}}, list_transform({b}, lambda x: {{'h': 0, 'w': x}})), lambda acc_, nxt_: {{'h': CASE WHEN acc_.h < len({a}) AND {a}[acc_.h + 1] = nxt_.w THEN acc_.h + 1 ELSE acc_.h END, 'w': nxt_.w}}).h"


def _phrase_sql(a: str, b: str, exact: str, ordered: float = 0.65, runs: float = 0.35, sizes: tuple[int, ...] = (2, 3)) -> str:
    """phrase_score in SQL, of word lists a and b."""
    shares = ", ".join(f"CASE WHEN len({a}) >= {n} THEN len(list_intersect({_GRAMS.format(a=a, n=n)}, {_GRAMS.format(a=b, n=n)})) / len({_GRAMS.format(a=a, n=n)}) ELSE 0.0 END" for n in sizes)
    walked = f"CASE WHEN len({a}) > 0 THEN {_WALKED.format(a=a, b=b)} / len({a}) ELSE 0.0 END"
    return f"greatest(CASE WHEN {exact} THEN 1.0::DOUBLE ELSE 0.0 END, {ordered}::DOUBLE * ({walked}) + {runs}::DOUBLE * greatest({shares}))"


_CAND_SQL = f"""cand AS (SELECT DISTINCT trim(guideline_id, {_WS}) AS g, trim(paragraph_id, {_WS}) AS p FROM guideline_fls_resolution_candidates),
  par AS (SELECT trim(paragraph_id, {_WS}) AS id, coalesce(max(clean_text), '') AS text, max(document_link) AS d, max(section_link) AS s FROM paragraphs GROUP BY 1 HAVING trim(paragraph_id, {_WS}) <> ''),
  qs AS (SELECT trim(guideline_id, {_WS}) AS g, coalesce(max(title), '') AS query FROM guideline_records GROUP BY 1 HAVING trim(guideline_id, {_WS}) <> ''),
  raw AS (SELECT trim(guideline_id, {_WS}) AS g, max(nullif(nullif(trim(regexp_replace(raw_fls_id, '^.*#', '', 's'), {_WS}), ''), 'fls_UNRESOLVED')) AS raw FROM guideline_fls_source_mappings GROUP BY 1),
  met AS (SELECT c.g, c.p, q.query, par.text, par.d, par.s, {_LONG.format(t='q.query')} AS asked, {_WORDS.format(t='q.query')} AS a, {_WORDS.format(t='par.text')} AS b, list_distinct(list_transform(regexp_extract_all(q.query, '[A-Z][a-z]+[A-Z][A-Za-z]+'), lambda x: lower(x))) AS code,
    coalesce(par.s = o.s, false) AS in_section, coalesce(par.d = o.d, false) AS in_document FROM cand c JOIN qs q USING (g) JOIN par ON par.id = c.p LEFT JOIN raw ON raw.g = c.g LEFT JOIN par o ON o.id = raw.raw),
  comp AS (SELECT g AS guideline_id, p AS paragraph_id, in_section, in_document, round(CASE WHEN len(asked) > 0 THEN len(list_intersect(asked, {_LONG.format(t='text')})) / len(asked) ELSE 0 END, 6) AS text_overlap,
    round({_phrase_sql('a', 'b', "length(query) > 0 AND contains(lower(text), lower(query))")}, 6) AS phrase_evidence, in_document::INT::DOUBLE AS document_prior, in_section::INT::DOUBLE AS section_prior,
    CASE WHEN len(code) > 0 THEN round(least(1.0, len(list_intersect(code, regexp_extract_all(lower(text), '[a-z0-9_]+'))) / least(3, len(code))), 6) ELSE 0.0 END AS code_evidence FROM met),
  total AS (SELECT *, round({' + '.join(f'{w}::DOUBLE * {c}' for c, w in COMPONENTS.items())}, 6) AS total FROM comp),
  scored AS (SELECT *, greatest(text_overlap, code_evidence) >= {LEAST_EVIDENCE} AND total >= {LEAST_TOTAL} AS eligible FROM total)"""


@query("explainable_score", f"WITH {_CAND_SQL} SELECT * EXCLUDE (in_section, in_document) FROM scored")
def explainable_score(spark, sf_dir):
    """All components and their sum for every candidate."""
    return explain(candidate_components(spark, sf_dir)).drop("stages")


def resolve(scored: DataFrame) -> DataFrame:
    """(guideline_id, stage, paragraph_id, total, margin, decision): the winner of the first stage that accepts one, else of the first that would have it reviewed.

    All stages run at once: a candidate takes part in each stage in whose scope it lies, stages are ranked apart, and the best decision at the
    earliest stage is kept. margin is the lead over the stage's second, 1 without one. Only eligible candidates are accepted or reviewed; guidelines
    without candidates give no row.
    """
    rows = scored.select("guideline_id", "paragraph_id", "total", "eligible", "text_overlap", F.explode("stages").alias("stage"))
    w = Window.partitionBy("guideline_id", "stage").orderBy(F.desc("eligible"), F.desc("total"), F.desc("text_overlap"), "paragraph_id")
    top = rows.withColumn("rn", F.row_number().over(w)).withColumn("margin", F.round(F.coalesce(F.col("total") - F.lead("total").over(w), F.lit(1.0)), 6)).where("rn = 1")
    decision = F.when(~F.col("eligible"), "none").when((F.col("total") >= ACCEPT_TOTAL) & (F.col("margin") >= ACCEPT_MARGIN), "accepted").when(F.col("total") >= REVIEW_TOTAL, "review").otherwise("none")
    place = F.array_position(F.array(*[F.lit(s) for s in STAGES]), F.col("stage"))
    level = F.when(F.col("decision") == "accepted", 0).when(F.col("decision") == "review", 1).otherwise(2)
    best = top.withColumn("decision", decision).groupBy("guideline_id").agg(F.min_by(F.struct("stage", "paragraph_id", "total", "margin", "decision"), F.struct(level, place)).alias("x"))
    return best.select("guideline_id", "x.*")


@query("staged_resolution", f"""WITH {_CAND_SQL}, st AS (SELECT *, unnest(list_filter([CASE WHEN in_section THEN 1 END, CASE WHEN in_document THEN 2 END, 3], lambda x: x IS NOT NULL)) AS stage FROM scored),
  tops AS (SELECT *, round(coalesce(total - lead(total) OVER w, 1.0), 6) AS margin, row_number() OVER w AS rn FROM st WINDOW w AS (PARTITION BY guideline_id, stage ORDER BY eligible DESC, total DESC, text_overlap DESC, paragraph_id)),
  dec AS (SELECT *, CASE WHEN NOT eligible THEN 'none' WHEN total >= {ACCEPT_TOTAL} AND margin >= {ACCEPT_MARGIN} THEN 'accepted' WHEN total >= {REVIEW_TOTAL} THEN 'review' ELSE 'none' END AS decision FROM tops WHERE rn = 1)
SELECT guideline_id, ['section', 'document', 'global'][stage] AS stage, paragraph_id, total, margin, decision FROM dec QUALIFY row_number() OVER (PARTITION BY guideline_id ORDER BY CASE decision WHEN 'accepted' THEN 0 WHEN 'review' THEN 1 ELSE 2 END, stage) = 1""")
def staged_resolution(spark, sf_dir):
    """The resolution of every guideline."""
    return resolve(explain(candidate_components(spark, sf_dir)))


def diversified(rows: DataFrame, score: str = "total", take: int = 5, per_document: int = 2) -> DataFrame:
    """(guideline_id, paragraph_id, document_link, score, place): a choice from the best on, no document more often than a cap, which is raised by one whenever nothing else fits.

    In closed form: a row that is the n-th of its document is taken while the cap is n, and within one cap rows are taken in their order; so the place follows from the larger of n and
    the first cap, then the order. Nothing has to be walked through, however many candidates there are. Null documents count as one.
    """
    order = [F.desc(score), F.asc("paragraph_id")]
    nth = F.row_number().over(Window.partitionBy("guideline_id", "document_link").orderBy(*order))
    cap = rows.withColumn("_cap", F.greatest(nth, F.lit(per_document)))
    place = F.row_number().over(Window.partitionBy("guideline_id").orderBy("_cap", *order))
    return cap.withColumn("place", place).where(F.col("place") <= take).select("guideline_id", "paragraph_id", "document_link", score, "place")


@query("diversified_priors", f"""WITH {_CAND_SQL}, n AS (SELECT t.guideline_id, t.paragraph_id, coalesce(par.d, '') AS document_link, t.total, row_number() OVER (PARTITION BY guideline_id, coalesce(par.d, '') ORDER BY total DESC, paragraph_id) AS n FROM total t JOIN par ON par.id = t.paragraph_id)
SELECT guideline_id, paragraph_id, document_link, total, row_number() OVER (PARTITION BY guideline_id ORDER BY greatest(n, 2), total DESC, paragraph_id) AS place FROM n QUALIFY place <= 5""")
def diversified_priors(spark, sf_dir):
    """Up to five candidates a guideline from several documents."""
    scored = explain(candidate_components(spark, sf_dir)).select("guideline_id", "paragraph_id", "total").join(_paragraphs(spark, sf_dir).select("paragraph_id", F.coalesce("document_link", F.lit("")).alias("document_link")), "paragraph_id")
    return diversified(scored)


#: Shares of a prior's parts, what a hub costs, and how much of the role part counts where neither phrase nor heading says much. Fixed values.
PRIOR_SHARES = {"phrase": 0.30, "heading": 0.20, "code": 0.15, "role": 0.15, "normative": 0.20, "hub": -0.25}
HEADING_SHARES, PHRASE_SHARES, WEAK_SUPPORT = (0.70, 0.15, 0.15), (0.70, 0.30), 0.2
#: Roles of marked-up words, and kinds of content by what their link holds: the kind, its normative part, its cost as a hub and its share of the role part. Fixed values.
ROLES = {"defined_term": ":dt:`", "term_ref": ":t:`", "syntax_ref": ":s:`", "std_ref": ":std:`"}
CONTENT = (("glossary", 0.0, 1.0, 0.6), ("inventory", 0.0, 0.75, 0.5), ("index", 0.0, 0.75, 0.5), ("examples", 0.4, 0.0, 1.0))
#: Words of titles that tell little apart. Fixed values.
GENERIC = ("code", "data", "item", "items", "must", "shall", "should", "type", "types", "value", "values")


def prior_parts(pairs: DataFrame) -> DataFrame:
    """Adds phrase, heading, code, role, normative and hub, each 0 to 1, and prior_score, their weighed sum cut to 0..1 and 0 where nothing supports it.

    pairs: (query, heading, raw_text, document_link). The heading is what a candidate is judged by; names in the query written in CamelCase are its code words and constructs. Nulls count as empty.
    """
    text = {c: F.coalesce(c, F.lit("")) for c in ("query", "heading", "raw_text", "document_link")}
    held = raw_tokens(text["heading"])
    told = F.array_except(tokens(text["query"]), F.array(*[F.lit(w) for w in GENERIC]))
    ordered = F.filter(raw_tokens(text["query"]), lambda t: F.array_contains(told, t))
    built = F.array_distinct(F.transform(F.regexp_extract_all(text["query"], F.lit("[A-Z][a-z]+[A-Z][A-Za-z]+"), F.lit(0)), F.lower))
    generic = F.array_intersect(F.array_distinct(raw_tokens(text["query"])), F.array(*[F.lit(w) for w in GENERIC]))
    share = lambda a: F.size(F.array_intersect(a, held)) / F.greatest(F.size(a), F.lit(1))
    pairs_of = F.when(F.size(ngrams(ordered, 2)) > 0, F.size(F.array_intersect(ngrams(ordered, 2), ngrams(held, 2))) / F.size(ngrams(ordered, 2))).otherwise(0.0)
    said = F.array_join(raw_tokens(text["query"]), " ")
    exact = F.when((said != "") & F.contains(F.array_join(held, " "), said), 1.0).otherwise(0.0)
    phrase = F.when(F.size(ordered) > 0, F.greatest(exact, PHRASE_SHARES[0] * ordered_coverage(ordered, held) + PHRASE_SHARES[1] * pairs_of)).otherwise(0.0)
    two_generic = F.when(F.size(F.array_intersect(generic, held)) >= 2, share(generic)).otherwise(0.0)
    heading = F.least(F.lit(1.0), HEADING_SHARES[0] * share(told) + HEADING_SHARES[1] * share(built) + HEADING_SHARES[2] * two_generic)
    code = F.least(F.lit(1.0), F.size(F.array_intersect(built, held)) / F.greatest(F.least(F.size(built), F.lit(3)), F.lit(1)))
    roles = sum((F.contains(text["raw_text"], F.lit(mark)).cast("int") for mark in ROLES.values()), F.lit(0)) / len(ROLES)
    kind = lambda at, usual: F.coalesce(*[F.when(F.contains(F.lower(text["document_link"]), F.lit(c[0])), c[at]) for c in CONTENT], F.lit(usual))
    rows = pairs.withColumns({"phrase": F.round(phrase, 6), "heading_part": F.round(heading, 6), "code": F.round(code, 6)})
    weak = (F.col("phrase") < WEAK_SUPPORT) & (F.col("heading_part") < WEAK_SUPPORT)
    rows = rows.withColumns({"role": F.round(roles * F.when(weak, 0.5).otherwise(1.0) * kind(3, 1.0), 6), "normative": kind(1, 1.0), "hub": kind(2, 0.0)})
    of = lambda part: F.col("heading_part" if part == "heading" else part)
    total = sum((w * of(part) for part, w in PRIOR_SHARES.items()), F.lit(0.0))
    supported = F.greatest("phrase", "heading_part", "code", "role") > 0
    return rows.withColumn("prior_score", F.when(supported, F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)), 6)).otherwise(0.0))


_CONTENT_SQL = lambda at, usual: "CASE " + " ".join(f"WHEN contains(lower(coalesce(d, '')), '{c[0]}') THEN {c[at]}" for c in CONTENT) + f" ELSE {usual} END"
_GENERIC = "(" + ", ".join(f"'{w}'" for w in GENERIC) + ")"
_STOP = "(" + ", ".join(f"'{w}'" for w in STOPWORDS) + ")"
_PRIOR_SQL = f"""head AS (SELECT trim(paragraph_id, {_WS}) AS p, coalesce(max(concat_ws(' ', chapter, section, subsection)), '') AS heading, coalesce(max(raw_text), '') AS raw_text FROM paragraphs GROUP BY 1), {_CAND_SQL},
  w AS (SELECT g, m.p, query, heading, raw_text, d, code, regexp_extract_all(lower(heading), '[a-z0-9_]+') AS held, list_filter(regexp_extract_all(lower(query), '[a-z0-9_]+'), lambda x: x NOT IN {_STOP} AND x NOT IN {_GENERIC}) AS ordered, list_distinct(list_filter(regexp_extract_all(lower(query), '[a-z0-9_]+'), lambda x: x IN {_GENERIC})) AS gen,
    array_to_string(regexp_extract_all(lower(query), '[a-z0-9_]+'), ' ') AS said FROM met m JOIN head h ON h.p = m.p),
  one AS (SELECT *, CASE WHEN len(ordered) > 0 THEN round({_phrase_sql('ordered', 'held', "said <> '' AND contains(array_to_string(held, ' '), said)", *PHRASE_SHARES, (2,))}, 6) ELSE 0.0 END AS phrase,
    round(least(1.0, 0.7::DOUBLE * len(list_intersect(list_distinct(ordered), held)) / greatest(len(list_distinct(ordered)), 1) + 0.15::DOUBLE * len(list_intersect(code, held)) / greatest(len(code), 1) + CASE WHEN len(list_intersect(gen, held)) >= 2 THEN 0.15::DOUBLE * len(list_intersect(gen, held)) / len(gen) ELSE 0 END), 6) AS heading_part,
    round(least(1.0, len(list_intersect(code, held)) / greatest(least(len(code), 3), 1)), 6) AS code_part, ({' + '.join(f"contains(raw_text, '{m}')::INT" for m in ROLES.values())}) / 4 AS roles FROM w),
  two AS (SELECT *, round(roles * CASE WHEN phrase < 0.2 AND heading_part < 0.2 THEN 0.5 ELSE 1.0 END * {_CONTENT_SQL(3, 1.0)}, 6) AS role, {_CONTENT_SQL(1, 1.0)}::DOUBLE AS normative, {_CONTENT_SQL(2, 0.0)}::DOUBLE AS hub FROM one),
  priors AS (SELECT g AS guideline_id, p AS paragraph_id, coalesce(d, '') AS document_link, phrase, heading_part, code_part AS code, role, normative, hub,
    CASE WHEN greatest(phrase, heading_part, code_part, role) > 0 THEN round(greatest(0.0, least(1.0, 0.3::DOUBLE * phrase + 0.2::DOUBLE * heading_part + 0.15::DOUBLE * code_part + 0.15::DOUBLE * role + 0.2::DOUBLE * normative - 0.25::DOUBLE * hub)), 6) ELSE 0.0 END AS prior_score FROM two)"""


def _priors(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "guideline_fls_resolution_candidates", "guideline_id", "paragraph_id").select(strip("guideline_id").alias("guideline_id"), strip("paragraph_id").alias("paragraph_id")).distinct()
    p = table(spark, sf_dir, "paragraphs", "paragraph_id", "chapter", "section", "subsection", "raw_text", "document_link").groupBy(id_or_null("paragraph_id").alias("paragraph_id")).agg(F.max(F.concat_ws(" ", "chapter", "section", "subsection")).alias("heading"), F.max("raw_text").alias("raw_text"), F.max("document_link").alias("document_link"))
    q = title_queries(spark, sf_dir).select(F.col("query_id").alias("guideline_id"), "query")
    rows = prior_parts(c.join(q, "guideline_id").join(p, "paragraph_id"))
    return rows.select("guideline_id", "paragraph_id", F.coalesce("document_link", F.lit("")).alias("document_link"), "phrase", "heading_part", "code", "role", "normative", "hub", "prior_score")


@query("prior_scores", f"WITH {_PRIOR_SQL} SELECT * FROM priors")
def prior_scores(spark, sf_dir):
    """The prior of every candidate and its parts."""
    return _priors(spark, sf_dir)


@query("prior_selection", f"""WITH {_PRIOR_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY guideline_id, document_link ORDER BY prior_score DESC, paragraph_id) AS n FROM priors)
SELECT guideline_id, paragraph_id, document_link, prior_score, row_number() OVER (PARTITION BY guideline_id ORDER BY greatest(n, 2), prior_score DESC, paragraph_id) AS place FROM n QUALIFY place <= 5""")
def prior_selection(spark, sf_dir):
    """Up to five candidates a guideline by their priors, from several documents."""
    return diversified(_priors(spark, sf_dir), "prior_score")


#: Words that put a query into a family; the first family with one of its words holds. Fixed values.
FAMILIES = (
    ("unsafe_control_flow", ("unsafe", "undefined", "pointer", "alias", "lifetime", "control-flow", "control flow", "pattern", "match", "branch"), "weighted-v2"),
    ("error_handling", ("error", "panic", "unwrap", "expect", "result", "defensive"), "rrf-v1"),
    ("general_semantics", (), "rrf-v1"),
)


@query("prompt_family", f"SELECT trim(guideline_id, {_WS}) AS query_id, " + "CASE " + " ".join(f"WHEN regexp_matches(lower(max(title)), '{'|'.join(w)}') THEN '{n}'" for n, w, _ in FAMILIES if w) + " ELSE 'general_semantics' END AS family, CASE WHEN regexp_matches(lower(max(title)), '" + "|".join(FAMILIES[0][1]) + f"') THEN 'weighted-v2' ELSE 'rrf-v1' END AS fusion FROM guideline_records GROUP BY 1 HAVING trim(guideline_id, {_WS}) <> ''")
def prompt_family(spark, sf_dir):
    """The family of every query and the fusion that suits it."""
    family, fusion = F.lit(FAMILIES[-1][0]), F.lit(FAMILIES[-1][2])
    for name, words, method in reversed(FAMILIES[:-1]):
        hit = F.lower("query").rlike("|".join(words))
        family, fusion = F.when(hit, name).otherwise(family), F.when(hit, method).otherwise(fusion)
    return title_queries(spark, sf_dir).select("query_id", family.alias("family"), fusion.alias("fusion"))


@query("weak_prompts", f"""WITH {_CASES_SQL}, ls AS (SELECT n.query_id, {', '.join(f'greatest(0.0, coalesce(t.{c}, n.{c}) - n.{c}) AS {x}' for x, c in (('p', 'precision'), ('n', 'ndcg'), ('m', 'mrr')))} FROM m n LEFT JOIN m t ON t.query_id = n.query_id AND t.mode = 'cosine' WHERE n.mode = 'reranked'),
  sc AS (SELECT *, {', '.join(f'CASE WHEN max({x}) OVER () <= 1e-12 THEN 0.0 ELSE {x} / max({x}) OVER () END AS s{x}' for x in 'pnm')} FROM ls)
SELECT query_id, p, n, m, round(0.45::DOUBLE * sp + 0.35::DOUBLE * sn + 0.2::DOUBLE * sm, 6) AS risk FROM sc ORDER BY risk DESC, p DESC, query_id LIMIT 10""")
def weak_prompts(spark, sf_dir):
    """The ten queries that lost most between two runs, by a weighed sum of scaled losses."""
    cases = materialize(_cases(spark, sf_dir))
    now, then = (cases.where(F.col("mode") == m).select("query_id", F.col("precision").alias(f"p_{m}"), F.col("mrr").alias(f"m_{m}"), F.col("ndcg").alias(f"n_{m}")) for m in ("reranked", "cosine"))
    lost = now.join(then, "query_id", "left").select("query_id", *[F.greatest(F.lit(0.0), F.coalesce(F.col(f"{x}_cosine"), F.col(f"{x}_reranked")) - F.col(f"{x}_reranked")).alias(x) for x in "pnm"])
    tops = lost.agg(*[F.max(x).alias(f"top_{x}") for x in "pnm"])
    scaled = lambda x: F.when(F.col(f"top_{x}") <= 1e-12, 0.0).otherwise(F.col(x) / F.col(f"top_{x}"))
    risk = F.round(0.45 * scaled("p") + 0.35 * scaled("n") + 0.20 * scaled("m"), 6)
    return lost.crossJoin(F.broadcast(tops)).select("query_id", "p", "n", "m", risk.alias("risk")).orderBy(F.desc("risk"), F.desc("p"), "query_id").limit(10)


@query("spec_diff", """WITH e AS (SELECT trim(guideline_id) AS g, candidate_rank AS r, evidence_json::JSON AS j FROM guideline_fls_resolution_candidates WHERE json_valid(evidence_json) AND json_type(evidence_json) = 'OBJECT' AND candidate_rank IN (1, 2)), k AS (SELECT DISTINCT g, r, unnest(json_keys(j)) AS k FROM e)
SELECT k, count(*) FILTER (WHERE r = 1) AS first_has, count(*) FILTER (WHERE r = 2) AS second_has FROM k GROUP BY 1""")
def spec_diff(spark, sf_dir):
    """How often each key stands in the first and in the second candidate's evidence."""
    e = table(spark, sf_dir, "guideline_fls_resolution_candidates", "guideline_id", "candidate_rank", "evidence_json").where("candidate_rank IN (1, 2)")
    keys = e.select(F.trim("guideline_id").alias("g"), F.col("candidate_rank").alias("r"), F.explode(F.json_object_keys("evidence_json")).alias("k")).distinct()
    return keys.groupBy("k").agg(F.count_if(F.col("r") == 1).alias("first_has"), F.count_if(F.col("r") == 2).alias("second_has"))


@query("audit_diff", f"""WITH h AS (SELECT DISTINCT trim(guideline_id, {_WS}) AS g, coalesce(trim(effective_fls_id, {_WS}), '') AS f, lower(trim(resolution_status, {_WS})) AS s, delivered_at AS d FROM guideline_fls_resolution_history), a AS (SELECT g, max(f) AS f FROM h WHERE d < TIMESTAMP '2024-09-01' GROUP BY 1), b AS (SELECT g, max(f) AS f FROM h WHERE d >= TIMESTAMP '2024-09-01' GROUP BY 1)
SELECT coalesce(a.g, b.g) AS guideline_id, CASE WHEN a.g IS NULL THEN 'added' WHEN b.g IS NULL THEN 'deleted' WHEN a.f = b.f THEN 'unchanged' ELSE 'updated' END AS delta FROM a FULL JOIN b ON a.g = b.g""")
def audit_diff(spark, sf_dir):
    """Two halves of a history compared by guideline."""
    h = table(spark, sf_dir, "guideline_fls_resolution_history", "guideline_id", "effective_fls_id", "delivered_at").select(strip("guideline_id").alias("guideline_id"), F.coalesce(strip("effective_fls_id"), F.lit("")).alias("f"), "delivered_at")
    cut = F.col("delivered_at") < F.lit("2024-09-01").cast("timestamp_ntz")
    a, b = (x.groupBy("guideline_id").agg(F.max("f").alias("f")) for x in (h.where(cut), h.where(~cut)))
    return full_outer_delta(a, b, ["guideline_id"], ["f"])


@query("scope_cardinality", "SELECT chapter, count(DISTINCT source) AS families, count(DISTINCT source) <= 4 AS within, round(avg(CASE WHEN source IS NULL THEN 1 ELSE 0 END), 6) AS unknown FROM documents GROUP BY 1")
def scope_cardinality(spark, sf_dir):
    """How many families a scope touches, whether that is within bounds, and its unknown share."""
    d = table(spark, sf_dir, "documents", "chapter", "source")
    n = F.countDistinct("source")
    return d.groupBy("chapter").agg(n.alias("families"), (n <= 4).alias("within"), F.round(F.avg(F.col("source").isNull().cast("int")), 6).alias("unknown"))


@query("judge_verdicts", f"SELECT user_id, CASE WHEN bool_and(event_type <> 'error') THEN 'candidate' ELSE 'fail' END AS verdict, count(*) FILTER (WHERE value IS NULL) * 2 > count(*) AS diagnostic FROM events GROUP BY 1")
def judge_verdicts(spark, sf_dir):
    """All must pass; mostly missing votes make it a diagnostic."""
    e = table(spark, sf_dir, "events", "user_id", "event_type", "value")
    return e.groupBy("user_id").agg(F.when(F.bool_and(F.col("event_type") != "error"), "candidate").otherwise("fail").alias("verdict"), (F.count_if(F.col("value").isNull()) * 2 > F.count("*")).alias("diagnostic"))
