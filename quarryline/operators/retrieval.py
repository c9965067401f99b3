"""Ranked retrieval for whole batches of queries: lexical, semantic, fusion, labels, abstention and evaluation.

Every stage takes and gives rows keyed by (query_id, id). The titles of guidelines are the queries and the chunks the units.
Postings are joined on terms, so that work follows the matches; rankings are windows by query over those matches.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.functions.cleaning import id_or_null
from quarryline.functions.text import STOPWORDS, query_tokens, raw_tokens, tokens
from quarryline.operators import ranking
from quarryline.operators.relational import min_max
from quarryline.plans.catalog import query
from quarryline.plans.stages import BROADCAST_BYTES, bounded, materialize, table

K1, B = 1.2, 0.75
#: Shares of lexical score, fusion weights, shares of semantic relevance. Fixed values.
LEXICAL_SHARES = (0.55, 0.35, 0.10)
WEIGHTS = {"v1": (0.30, 0.25, 0.45), "v2": (0.55, 0.15, 0.30)}
RELEVANCE_SHARES = (0.45, 0.55)
TOP_K, RRF_K = 10, 60
WINDOW = max(8 * TOP_K, 64)

_WS = r"E' \t\r\n'"
_STOP = "(" + ", ".join(f"'{w}'" for w in STOPWORDS) + ")"


def chunk_units(spark, sf_dir: str) -> DataFrame:
    """(id, heading, text): every chunk once."""
    c = table(spark, sf_dir, "chunks", "chunk_uid", "section_id", "clean_text").select(id_or_null("chunk_uid").alias("id"), "section_id", "clean_text").where("id IS NOT NULL")
    return c.groupBy("id").agg(F.coalesce(F.max("section_id"), F.lit("")).alias("heading"), F.coalesce(F.max("clean_text"), F.lit("")).alias("text"))


def title_queries(spark, sf_dir: str) -> DataFrame:
    """(query_id, query): every guideline's title."""
    r = table(spark, sf_dir, "guideline_records", "guideline_id", "title").select(id_or_null("guideline_id").alias("query_id"), "title").where("query_id IS NOT NULL")
    return r.groupBy("query_id").agg(F.coalesce(F.max("title"), F.lit("")).alias("query"))


#: The most units by BM25 that go on as candidates of one query; None for all of them.
CANDIDATE_LIMIT = 5000
#: Bytes of text that one partition of the index is meant to hold.
INDEX_BYTES = 32_000_000


def numbered(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """df with numbers in place of its unique key, in the key's order, and (number, name): so that ties by number are ties by name, and what is joined, grouped and sorted is narrow."""
    rows = materialize(df.orderBy(key).withColumn("_number", F.monotonically_increasing_id()))
    names = rows.select(F.col("_number").alias(key), F.col(key).alias("_name"))
    return rows.select(F.col("_number").alias(key), *[c for c in df.columns if c != key]), names


def _inputs(spark, sf_dir: str) -> tuple[DataFrame, DataFrame, Callable[..., DataFrame]]:
    """Queries and units with numbers for ids, and what puts the names back: into query_id and id, and the columns named further, which hold units."""
    queries, query_names = numbered(title_queries(spark, sf_dir), "query_id")
    units, unit_names = numbered(chunk_units(spark, sf_dir), "id")

    def named(df: DataFrame, *more: str) -> DataFrame:
        columns = df.columns
        for c, names, key in [("query_id", query_names, "query_id"), ("id", unit_names, "id"), *[(m, unit_names, "id") for m in more]]:
            if c in columns:
                df = df.join(names.select(F.col(key).alias(c), F.col("_name").alias(f"_{c}")), c, "left").drop(c).withColumnRenamed(f"_{c}", c)
        return df.select(*columns)

    return queries, units, named


def _entries(units: DataFrame, with_tokens: bool) -> DataFrame:
    """(id, kind, term, tf, dl, held): what a unit is found by: index terms (kind 0) of heading and text and, if wanted, the distinct tokens (1) of its text.

    Units are parted by id once; everything that is grouped by id later, alone or with the query, needs no further exchange.
    """
    size = units.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(int(units.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // INDEX_BYTES))
    words = F.regexp_extract_all(F.lower(F.concat_ws(" ", "heading", "text")), F.lit("[a-z0-9]+"), F.lit(0))
    own = tokens("text") if with_tokens else F.array().cast("array<string>")
    base = units.repartition(parts, "id").select("id", words.alias("w"), own.alias("own"))
    items = F.concat(F.transform("w", lambda x: F.struct(F.lit(0).alias("kind"), x.alias("term"))), F.transform("own", lambda x: F.struct(F.lit(1).alias("kind"), x.alias("term"))))
    rows = base.select("id", F.size("w").alias("dl"), F.size("own").alias("held"), F.explode(items).alias("e")).select("id", "dl", "held", "e.kind", "e.term")
    return rows.groupBy("id", "kind", "term").agg(F.count("*").alias("tf"), F.max("dl").alias("dl"), F.max("held").alias("held"))


def postings(units: DataFrame) -> DataFrame:
    """(id, term, tf, dl): terms of heading and text with their counts and the unit's length."""
    return _entries(units, False).drop("kind", "held")


def _sized(df: DataFrame, row_bytes: int = 100) -> DataFrame:
    """df, written and counted: sent to every task if that is within bounds, else left to a join by exchange."""
    return bounded(materialize(df), row_bytes)


def term_weights(asked: DataFrame, index: DataFrame, units: DataFrame) -> DataFrame:
    """(query_id, term, idf, mean_dl) of the queries' terms (query_id, term), from the whole index; a term in more than half of the units weighs 1e-6."""
    stats = units.select(F.size(F.regexp_extract_all(F.lower(F.concat_ws(" ", "heading", "text")), F.lit("[a-z0-9]+"), F.lit(0))).alias("dl")).agg(F.count("*").alias("units"), F.avg("dl").alias("mean_dl"))
    df = index.groupBy("term").agg(F.count("*").alias("n"))
    raw = F.log((F.col("units") - F.col("n") + 0.5) / (F.col("n") + 0.5))
    return asked.join(df, "term").crossJoin(F.broadcast(stats)).select("query_id", "term", F.when(raw > 0, raw).otherwise(1e-6).alias("idf"), "mean_dl")


def retried(queries: DataFrame, weighed: DataFrame, index: DataFrame, units: DataFrame, scoped: DataFrame | None = None) -> DataFrame:
    """weighed, with the queries whose terms met no term of the index (or of its part in a scope) weighed anew by all their tokens.

    queries: (query_id, terms, raw); one whose raw tokens are its terms isn't tried again.
    """
    met = weighed if scoped is None else weighed.join(scoped.select("term").distinct(), "term", "left_semi")
    wider = queries.where(F.size(F.array_except("raw", "terms")) > 0).select("query_id", "raw")
    rest = materialize(wider.join(met.select("query_id").distinct(), "query_id", "left_anti").select("query_id", F.explode("raw").alias("term")).distinct())
    if rest.isEmpty():
        return weighed
    return weighed.join(rest.select("query_id").distinct(), "query_id", "left_anti").unionByName(term_weights(rest, index, units))


_PART = f"idf * tf * {K1 + 1}D / (tf + {K1}D * ({1 - B}D + {B}D * dl / mean_dl))"  # doubles, not decimals


def bm25(queries: DataFrame, index: DataFrame, units: DataFrame, scope: DataFrame | None = None) -> DataFrame:
    """(query_id, id, bm25): the smaller, the better; all units that share a term with the query.

    queries: (query_id, terms) and, to search those without a hit once more by all their tokens, raw. Weights of terms always come from the whole index; a scope, a frame of ids, only restricts which units are
    scored, and an empty one gives no rows. The statistics are one row. Queries go to the postings, which stay parted by id.
    """
    weighed = term_weights(queries.select("query_id", F.explode("terms").alias("term")).distinct(), index, units)
    scoped = None if scope is None else index.join(scope.select("id").distinct(), "id", "left_semi")
    if "raw" in queries.columns:
        weighed = retried(queries, materialize(weighed), index, units, scoped)
    weighed = _sized(weighed)
    index = index if scoped is None else scoped
    return index.join(weighed, "term").groupBy("id", "query_id").agg((-F.sum(F.expr(_PART))).alias("bm25")).select("query_id", "id", "bm25")


_UNITS_SQL = f"""units AS (SELECT trim(chunk_uid, {_WS}) AS id, coalesce(max(section_id), '') AS heading, coalesce(max(clean_text), '') AS text FROM chunks WHERE trim(chunk_uid, {_WS}) <> '' GROUP BY 1),
  queries AS (SELECT trim(guideline_id, {_WS}) AS query_id, coalesce(max(title), '') AS query FROM guideline_records WHERE trim(guideline_id, {_WS}) <> '' GROUP BY 1),
  words AS (SELECT id, regexp_extract_all(lower(heading || ' ' || text), '[a-z0-9]+') AS w FROM units), post AS (SELECT id, term, count(*) AS tf, max(dl) AS dl FROM (SELECT id, len(w) AS dl, unnest(w) AS term FROM words) GROUP BY 1, 2),
  stats AS (SELECT count(*) AS units, avg(len(w)) AS mean_dl FROM words), dfs AS (SELECT term, count(*) AS n FROM post GROUP BY 1),
  qraw AS (SELECT query_id, query, list_distinct(regexp_extract_all(lower(query), '[a-z0-9_]+')) AS r FROM queries), qtok AS (SELECT query_id, query, CASE WHEN len(list_filter(r, lambda x: x NOT IN {_STOP})) > 0 THEN list_filter(r, lambda x: x NOT IN {_STOP}) ELSE r END AS t, list_filter(r, lambda x: x NOT IN {_STOP}) AS s FROM qraw),
  scored AS (SELECT q.query_id, p.id, -sum(greatest(CASE WHEN ln((units - n + 0.5) / (n + 0.5)) > 0 THEN ln((units - n + 0.5) / (n + 0.5)) ELSE 1e-6 END, 1e-6) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / mean_dl))) AS bm25
    FROM (SELECT DISTINCT query_id, unnest(t) AS term FROM qtok) q JOIN dfs USING (term) JOIN post p USING (term), stats GROUP BY 1, 2)"""
_PAIRS_SQL = f"""{_UNITS_SQL},
  utok AS (SELECT id, list_filter(list_distinct(regexp_extract_all(lower(text), '[a-z0-9_]+')), lambda x: x NOT IN {_STOP}) AS t FROM units),
  shared AS (SELECT query_id, id, count(*) AS overlap FROM (SELECT query_id, unnest(s) AS k FROM qtok) JOIN (SELECT id, unnest(t) AS k FROM utok) USING (k) GROUP BY 1, 2),
  pairs AS (SELECT s.query_id, s.id, s.bm25, coalesce(h.overlap, 0) AS overlap, len(q.s) AS asked, len(u.t) AS held, CASE WHEN contains(lower(n.text), lower(q.query)) THEN 1 ELSE 0 END AS phrase
    FROM scored s JOIN qtok q ON q.query_id = s.query_id JOIN utok u ON u.id = s.id JOIN units n ON n.id = s.id LEFT JOIN shared h ON h.query_id = s.query_id AND h.id = s.id),
  kept AS (SELECT * FROM pairs QUALIFY asked = 0 OR overlap >= least(max(overlap) OVER (PARTITION BY query_id), greatest(1, ceil(asked * 0.6)))),
  lexn AS (SELECT query_id, id, round(bm25, 6) AS bm25, round(0.55 * CASE WHEN max(-bm25) OVER w - min(-bm25) OVER w < 1e-12 THEN 1.0 ELSE (-bm25 - min(-bm25) OVER w) / (max(-bm25) OVER w - min(-bm25) OVER w) END
    + 0.35 * CASE WHEN max(overlap) OVER w = min(overlap) OVER w THEN 1.0 ELSE (overlap - min(overlap) OVER w) / (max(overlap) OVER w - min(overlap) OVER w) END + 0.1 * phrase, 6) AS lexical FROM kept WINDOW w AS (PARTITION BY query_id)),
  lex AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY lexical DESC, bm25, id) AS rank FROM lexn),
  semn AS (SELECT query_id, id, round(CASE WHEN max(j) OVER w - min(j) OVER w < 1e-12 THEN 1.0 ELSE (j - min(j) OVER w) / (max(j) OVER w - min(j) OVER w) END, 6) AS semantic, c FROM (SELECT query_id, id, overlap / greatest(asked + held - overlap, 1) AS j, overlap / greatest(asked, 1) AS c FROM pairs WHERE overlap > 0) WINDOW w AS (PARTITION BY query_id)),
  pool AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY semantic DESC, id) AS p FROM semn),
  rer AS (SELECT query_id, id, round(CASE WHEN max(c) OVER w - min(c) OVER w < 1e-12 THEN 1.0 ELSE (c - min(c) OVER w) / (max(c) OVER w - min(c) OVER w) END, 6) AS reranker FROM pool WHERE p <= {WINDOW} WINDOW w AS (PARTITION BY query_id)),
  semr AS (SELECT p.query_id, p.id, p.semantic, coalesce(r.reranker, 0.0) AS reranker, round(0.45 * p.semantic + 0.55 * coalesce(r.reranker, 0.0), 6) AS relevance FROM pool p LEFT JOIN rer r ON r.query_id = p.query_id AND r.id = p.id),
  sem AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY relevance DESC, reranker DESC, id) AS rank FROM semr)"""


def _ranked(df: DataFrame, *order: Column, out: str = "rank") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))


def scored_pairs(queries: DataFrame, units: DataFrame, limit: int | None = CANDIDATE_LIMIT) -> DataFrame:
    """(query_id, id, bm25, overlap, asked, held): the ``limit`` best units of each query by BM25, ties by id, with their shared tokens and both token counts; written out, as all rankings read it.

    The limit is applied in every task before rows are exchanged, so that no more than limit rows a query are written; with None, or not more units than that, every unit that BM25 finds is given.
    Terms and tokens are met in one join and counted in one aggregation, which needs no exchange as the units are parted by id. A query of stopwords
    only, or whose other tokens meet no unit, is searched by all its tokens.
    """
    q = queries.select("query_id", query_tokens("query").alias("terms"), F.array_distinct(raw_tokens("query")).alias("raw"), tokens("query").alias("content"))
    both = _entries(units, True)
    index = both.where("kind = 0")
    weighed = materialize(term_weights(q.select("query_id", F.explode("terms").alias("term")).distinct(), index, units))
    weighed = retried(q, weighed, index, units)
    asked = q.select("query_id", F.explode("content").alias("term"))
    sides = weighed.select("query_id", F.lit(0).alias("kind"), "term", "idf", "mean_dl").unionByName(asked.select("query_id", F.lit(1).alias("kind"), "term", F.lit(0.0).alias("idf"), F.lit(1.0).alias("mean_dl")))
    hits = both.join(_sized(sides), ["kind", "term"]).groupBy("id", "query_id")
    part = F.when(F.col("kind") == 0, F.expr(_PART))
    found = hits.agg((-F.sum(part)).alias("bm25"), F.count_if(F.col("kind") == 1).alias("overlap"), F.max("held").alias("held")).where("bm25 IS NOT NULL")
    sizes = _sized(q.select("query_id", F.size("content").alias("asked")))
    if limit is not None and units.count() > limit:
        found = _ranked(found, F.asc("bm25"), F.asc("id"), out="_r").where(F.col("_r") <= limit).drop("_r")
    return materialize(found.join(sizes, "query_id").select("query_id", "id", "bm25", "overlap", "asked", "held"))


def lexical_rows(pairs: DataFrame, queries: DataFrame, units: DataFrame) -> DataFrame:
    """(query_id, id, lexical, bm25, rank): units that share enough tokens, scored and ranked.

    Texts are looked at for the whole query only in the rows that are kept.
    """
    best = pairs.groupBy("query_id").agg(F.max("overlap").alias("best"))
    need = F.least("best", F.greatest(F.lit(1), F.ceil(F.col("asked") * 0.6)))
    kept = pairs.join(best, "query_id").where((F.col("asked") == 0) | (F.col("overlap") >= need))
    found = kept.join(queries.select("query_id", F.lower("query").alias("low")), "query_id").join(units.select("id", F.lower("text").alias("body")), "id")
    kept = found.select("query_id", "id", "bm25", (-F.col("bm25")).alias("b"), "overlap", F.contains("body", "low").cast("int").alias("phrase"))
    bounds = kept.groupBy("query_id").agg(*[f(c).alias(f"{n}_{c}") for c in ("b", "overlap") for n, f in (("low", F.min), ("high", F.max))])
    scale = lambda c: F.when(F.col(f"high_{c}") - F.col(f"low_{c}") < 1e-12, 1.0).otherwise((F.col(c) - F.col(f"low_{c}")) / (F.col(f"high_{c}") - F.col(f"low_{c}")))
    a, b, c = LEXICAL_SHARES
    rows = kept.join(bounds, "query_id").select("query_id", "id", F.round(a * scale("b") + b * scale("overlap") + c * F.col("phrase"), 6).alias("lexical"), F.round("bm25", 6).alias("bm25"))
    return _ranked(rows, F.desc("lexical"), F.asc("bm25"), F.asc("id"))


def semantic_rows(pairs: DataFrame, keep: DataFrame | None = None) -> DataFrame:
    """(query_id, id, semantic, reranker, relevance, rank): similarity of token sets, reranked by coverage inside the pool.

    With ``keep``, only the pool and the rows of keep (query_id, id) outside it are given, the latter ranked behind the pool in their order: what lies
    outside has no reranker score and so never comes before the pool. The pool is then cut in every task before rows are exchanged.
    """
    near = pairs.where("overlap > 0").select("query_id", "id", (F.col("overlap") / F.greatest(F.col("asked") + F.col("held") - F.col("overlap"), F.lit(1))).alias("j"), (F.col("overlap") / F.greatest("asked", F.lit(1))).alias("c"))
    scaled = min_max(near, ["query_id"], "j", "s").select("query_id", "id", F.round("s", 6).alias("semantic"), "c")
    pool = _ranked(scaled, F.desc("semantic"), F.asc("id"), out="p")
    w = Window.partitionBy("query_id")
    inside = F.col("p") <= WINDOW
    if keep is not None:
        pool = materialize(pool.where(inside))
    held = F.when(inside, F.col("c"))
    low, high = F.min(held).over(w), F.max(held).over(w)
    rows = pool.withColumn("reranker", F.when(inside, F.round(F.when(high - low < 1e-12, 1.0).otherwise((F.col("c") - low) / (high - low)), 6)).otherwise(0.0))
    relevance = F.round(RELEVANCE_SHARES[0] * F.col("semantic") + RELEVANCE_SHARES[1] * F.col("reranker"), 6).alias("relevance")
    rows = _ranked(rows.select("query_id", "id", "semantic", "reranker", relevance), F.desc("relevance"), F.desc("reranker"), F.asc("id"))
    if keep is None:
        return rows
    rest = scaled.join(bounded(keep.select("query_id", "id"), 50), ["query_id", "id"], "left_semi").join(pool.select("query_id", "id"), ["query_id", "id"], "left_anti").withColumn("reranker", F.lit(0.0))
    rest = _ranked(rest.select("query_id", "id", "semantic", "reranker", relevance), F.desc("semantic"), F.asc("id"))
    return rows.unionByName(rest.withColumn("rank", F.col("rank") + WINDOW))


class Lists(NamedTuple):
    """The scored pairs, the lexical and the semantic list of every query, keyed by numbers, and what puts names in their place."""

    pairs: DataFrame
    lexical: DataFrame
    semantic: DataFrame
    units: DataFrame
    named: Callable[..., DataFrame]

    @property
    def hybrid(self) -> DataFrame:
        return hybrid(self.lexical, self.semantic)


def _lists(spark, sf_dir: str) -> Lists:
    """The lists, the semantic one with what a ranking's top can need."""
    queries, units, named = _inputs(spark, sf_dir)
    pairs = scored_pairs(queries, units)
    lexical = materialize(lexical_rows(pairs, queries, units))
    return Lists(pairs, lexical, materialize(semantic_rows(pairs, lexical)), units, named)


def ranked_by(queries: DataFrame, units: DataFrame, schema: str, answer: Callable, extra: tuple[str, ...] = (), limit: int | None = None, window: int = WINDOW, labels: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """What ``answer`` takes from the lists of every query, over all units or the ``limit`` best by BM25; no pair is written (see ranking).

    queries: (query_id, query, extra...), units: (id, heading, text), ids unique. schema: the columns of the answer, of which id and top_id hold units. labels: gives rows (id, label, score) of units, for the answer's Labels.
    """
    def damping(dl: np.ndarray) -> np.ndarray:
        return K1 * ((1 - B) + B * dl / (dl.mean() if len(dl) else 1.0))

    return ranking.answered(queries, units, _entries, damping, ranking.Rules(LEXICAL_SHARES, RELEVANCE_SHARES, WINDOW, limit), schema, answer, window, extra, labels)


def _titles_ranked(spark, sf_dir: str, schema: str, answer: Callable, labels: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    return ranked_by(title_queries(spark, sf_dir), chunk_units(spark, sf_dir), schema, answer, labels=labels)


def _weighted_answer(version: str) -> Callable:
    def answer(ix, x):
        top, final = ranking.weighted_top(x, WEIGHTS[version], TOP_K)
        return x.unit[top], final[top], np.arange(1, len(top) + 1)

    return answer


def _rrf_answer(ix, x):
    rrf, lists, order = ranking.reciprocal(x, RRF_K, WINDOW)
    top = order[:TOP_K]
    return x.unit[top], rrf[top], lists[top], np.arange(1, len(top) + 1)


def _projection_answer(ix, x, labels):
    rrf, _, order = ranking.reciprocal(x, RRF_K, WINDOW)
    top = order[:TOP_K]
    return ranking.rolled_up(x.unit[top], rrf[top], labels)


def _histogram_answer(ix, x):
    _, lists, _ = ranking.reciprocal(x, RRF_K, WINDOW)
    n = np.bincount(lists, minlength=4)
    n[0] = x.total - n[1:].sum()
    held = np.flatnonzero(n)
    return held, n[held]


def _modes_answer(ix, x):
    top, fused, coverage = ranking.capped_modes(x, ix.anchor, RRF_K, WINDOW, TOP_K, 2)
    return x.unit[top], fused[top], coverage[top], np.arange(1, len(top) + 1)


def _pool_answer(pool_of: Callable) -> Callable:
    def answer(ix, x):
        pool = pool_of(x)
        return x.unit[pool], np.arange(1, len(pool) + 1)

    return answer


def _reranked_answer(pool_of: Callable) -> Callable:
    def answer(ix, x):
        reranker = ranking.rescored(x, pool_of(x))
        top, final = ranking.weighted_top(x, WEIGHTS["v2"], TOP_K, reranker)
        return x.unit[top], reranker[top], final[top], np.arange(1, len(top) + 1)

    return answer


_FINAL, _RRF, _PLACES = "query_id string, id string, final double, rank int", "query_id string, id string, rrf double, lists int, rank int", "query_id string, id string, place int"


@query("text_tokens", f"SELECT doc_id, array_to_string(list_sort(list_filter(list_distinct(regexp_extract_all(lower(text), '[a-z0-9_]+')), lambda x: x NOT IN {_STOP})), ' ') AS tokens FROM documents")
def text_tokens(spark, sf_dir):
    """the distinct tokens of each document, sorted."""
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.array_join(F.array_sort(tokens("text")), " ").alias("tokens"))


@query("lex_bm25", f"WITH {_UNITS_SQL} SELECT query_id, id, round(bm25, 6) AS bm25 FROM scored")
def lex_bm25(spark, sf_dir):
    """BM25 of every unit for every query, those without content words or without a hit by all their words."""
    queries, units, named = _inputs(spark, sf_dir)
    q = queries.select("query_id", query_tokens("query").alias("terms"), F.array_distinct(raw_tokens("query")).alias("raw"))
    return named(bm25(q, postings(units), units).select("query_id", "id", F.round("bm25", 6).alias("bm25")))


@query("lex_bm25_scoped", f"WITH {_UNITS_SQL} SELECT query_id, id, round(bm25, 6) AS bm25 FROM scored WHERE id IN (SELECT trim(chunk_uid, {_WS}) FROM core_docs_chunk_metadata WHERE item_kind = 'struct')")
def lex_bm25_scoped(spark, sf_dir):
    """The same within a scope, weights still from all units."""
    return _scoped(spark, sf_dir, False)


def _scoped(spark, sf_dir: str, retry: bool) -> DataFrame:
    queries, units, named = _inputs(spark, sf_dir)
    names = named(units.select("id", F.col("id").alias("number")))
    scope = table(spark, sf_dir, "core_docs_chunk_metadata", "chunk_uid", "item_kind").where("item_kind = 'struct'").select(id_or_null("chunk_uid").alias("id"))
    scope = names.join(scope, "id", "left_semi").select(F.col("number").alias("id"))
    raw = [F.array_distinct(raw_tokens("query")).alias("raw")] if retry else []
    q = queries.select("query_id", query_tokens("query").alias("terms"), *raw)
    return named(bm25(q, postings(units), units, scope).select("query_id", "id", F.round("bm25", 6).alias("bm25")))


_SCORE_SQL = "-sum(CASE WHEN ln((units - n + 0.5) / (n + 0.5)) > 0 THEN ln((units - n + 0.5) / (n + 0.5)) ELSE 1e-6 END * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / mean_dl)))"


@query("lex_raw_fallback", f"""WITH {_UNITS_SQL}, scope AS (SELECT DISTINCT trim(chunk_uid, {_WS}) AS id FROM core_docs_chunk_metadata WHERE item_kind = 'struct'),
  met AS (SELECT s.* FROM scored s JOIN scope USING (id)), rest AS (SELECT query_id, unnest(r) AS term FROM qraw WHERE query_id NOT IN (SELECT query_id FROM met)),
  again AS (SELECT query_id, id, {_SCORE_SQL} AS bm25 FROM rest JOIN dfs USING (term) JOIN post USING (term) JOIN scope USING (id), stats GROUP BY 1, 2)
SELECT query_id, id, round(bm25, 6) AS bm25 FROM met UNION ALL SELECT query_id, id, round(bm25, 6) FROM again""")
def lex_raw_fallback(spark, sf_dir):
    """The scoped search, in which queries without a hit are searched again by all their tokens."""
    return _scoped(spark, sf_dir, True)


@query("lex_scored_topk", f"WITH {_PAIRS_SQL} SELECT query_id, id, lexical, bm25, rank FROM lex WHERE rank <= {TOP_K}")
def lex_scored_topk(spark, sf_dir):
    """The ten best units of each query, lexically."""
    queries, units, named = _inputs(spark, sf_dir)
    return named(lexical_rows(scored_pairs(queries, units), queries, units).where(F.col("rank") <= TOP_K))


@query("sem_reranked", f"WITH {_PAIRS_SQL} SELECT * FROM sem WHERE rank <= {TOP_K}")
def sem_reranked(spark, sf_dir):
    """The ten best units of each query by similarity and reranking."""
    queries, units, named = _inputs(spark, sf_dir)
    pairs = scored_pairs(queries, units)
    return named(semantic_rows(pairs, pairs.limit(0)).where(F.col("rank") <= TOP_K))


def hybrid(lexical: DataFrame, semantic: DataFrame) -> DataFrame:
    """Both lists side by side (J16, R15): lexical scores scaled anew, 0 for what a list lacks."""
    left = min_max(lexical.select("query_id", "id", "lexical", F.col("rank").alias("lex_rank")), ["query_id"], "lexical", "scaled").select("query_id", "id", F.col("scaled").alias("lexical"), "lex_rank")
    right = semantic.select("query_id", "id", "semantic", "reranker", F.col("rank").alias("sem_rank"))
    return left.join(right, ["query_id", "id"], "full_outer").na.fill(0.0, ["lexical", "semantic", "reranker"]).na.fill(0, ["lex_rank", "sem_rank"])


def fuse_weighted(merged: DataFrame, version: str) -> DataFrame:
    """(query_id, id, final, rank): the weighted sum of the three scores."""
    a, b, c = WEIGHTS[version]
    rows = merged.select("query_id", "id", F.round(a * F.col("lexical") + b * F.col("semantic") + c * F.col("reranker"), 6).alias("final"), "reranker")
    return _ranked(rows, F.desc("final"), F.desc("reranker"), F.asc("id")).drop("reranker")


def fuse_rrf(merged: DataFrame, k: int = RRF_K, window: int = WINDOW) -> DataFrame:
    """(query_id, id, rrf, lists, rank): reciprocal ranks in the lexical, semantic and reranker lists, each cut at the window."""
    ranked = merged.withColumn("rer_rank", F.when(F.col("sem_rank") > 0, F.row_number().over(Window.partitionBy("query_id", F.col("sem_rank") > 0).orderBy(F.desc("reranker"), F.desc("semantic"), F.asc("id")))).otherwise(0))
    inside = {c: F.when((F.col(c) > 0) & (F.col(c) <= window), F.col(c)).otherwise(0) for c in ("lex_rank", "sem_rank", "rer_rank")}
    ranked = ranked.select("query_id", "id", *[v.alias(c) for c, v in inside.items()])
    share = lambda c: F.when(F.col(c) > 0, 1.0 / (k + F.col(c))).otherwise(0.0)
    rows = ranked.withColumn("rrf", F.round(share("lex_rank") + share("sem_rank") + share("rer_rank"), 9)).withColumn("lists", sum((F.col(c) > 0).cast("int") for c in inside))
    last = lambda c: F.when(F.col(c) == 0, 10**9).otherwise(F.col(c)).asc()
    return _ranked(rows, F.desc("rrf"), last("rer_rank"), last("lex_rank"), F.asc("id")).select("query_id", "id", "rrf", "lists", "rank")


_MERGED_SQL = f"""{_PAIRS_SQL},
  lexs AS (SELECT query_id, id, rank, CASE WHEN max(lexical) OVER w - min(lexical) OVER w < 1e-12 THEN 1.0 ELSE (lexical - min(lexical) OVER w) / (max(lexical) OVER w - min(lexical) OVER w) END AS lexical FROM lex WINDOW w AS (PARTITION BY query_id)),
  merged AS (SELECT coalesce(l.query_id, s.query_id) AS query_id, coalesce(l.id, s.id) AS id, coalesce(l.lexical, 0.0) AS lexical, coalesce(s.semantic, 0.0) AS semantic, coalesce(s.reranker, 0.0) AS reranker, coalesce(l.rank, 0) AS lex_rank, coalesce(s.rank, 0) AS sem_rank FROM lexs l FULL JOIN sem s ON l.query_id = s.query_id AND l.id = s.id)"""
_RRF_SQL = f"""{_MERGED_SQL},
  rr AS (SELECT *, CASE WHEN sem_rank > 0 THEN row_number() OVER (PARTITION BY query_id, sem_rank > 0 ORDER BY reranker DESC, semantic DESC, id) ELSE 0 END AS rer0 FROM merged),
  cut AS (SELECT query_id, id, CASE WHEN lex_rank <= {WINDOW} THEN lex_rank ELSE 0 END AS a, CASE WHEN sem_rank <= {WINDOW} THEN sem_rank ELSE 0 END AS b, CASE WHEN rer0 <= {WINDOW} THEN rer0 ELSE 0 END AS c FROM rr),
  rrfs AS (SELECT *, round(CASE WHEN a > 0 THEN 1.0::DOUBLE / (60 + a) ELSE 0 END + CASE WHEN b > 0 THEN 1.0::DOUBLE / (60 + b) ELSE 0 END + CASE WHEN c > 0 THEN 1.0::DOUBLE / (60 + c) ELSE 0 END, 9) AS rrf FROM cut),
  rrf AS (SELECT query_id, id, rrf, (a > 0)::INT + (b > 0)::INT + (c > 0)::INT AS lists, row_number() OVER (PARTITION BY query_id ORDER BY rrf DESC, CASE WHEN c = 0 THEN 1000000000 ELSE c END, CASE WHEN a = 0 THEN 1000000000 ELSE a END, id) AS rank FROM rrfs)"""


def _fused_sql(version: str) -> str:
    a, b, c = WEIGHTS[version]
    return f"WITH {_MERGED_SQL}, f AS (SELECT query_id, id, round({a} * lexical + {b} * semantic + {c} * reranker, 6) AS final, reranker FROM merged) SELECT query_id, id, final, row_number() OVER (PARTITION BY query_id ORDER BY final DESC, reranker DESC, id) AS rank FROM f QUALIFY rank <= {TOP_K}"


@query("fuse_weighted_v1", _fused_sql("v1"))
def weighted_v1(spark, sf_dir):
    """Fusion by the first set of weights."""
    return _titles_ranked(spark, sf_dir, _FINAL, _weighted_answer("v1"))


@query("fuse_weighted_v2", _fused_sql("v2"))
def weighted_v2(spark, sf_dir):
    """Fusion by the second set of weights."""
    return _titles_ranked(spark, sf_dir, _FINAL, _weighted_answer("v2"))


@query("fuse_rrf", f"WITH {_RRF_SQL} SELECT * FROM rrf WHERE rank <= {TOP_K}")
def rrf(spark, sf_dir):
    """Fusion by reciprocal ranks."""
    return _titles_ranked(spark, sf_dir, _RRF, _rrf_answer)


@query("fuse_rrf_histogram", f"WITH {_RRF_SQL} SELECT lists, count(*) AS n FROM rrf GROUP BY 1")
def rrf_histogram(spark, sf_dir):
    """How many rows each number of lists contributed to."""
    return _titles_ranked(spark, sf_dir, "lists int, n long", _histogram_answer).groupBy("lists").agg(F.sum("n").alias("n"))


def fuse_modes(modes: dict[str, DataFrame], anchors: DataFrame, k: int = RRF_K, window: int = WINDOW, top_n: int = TOP_K, cap: int = 2) -> DataFrame:
    """(query_id, id, fused, coverage, rank): ranks of several modes fused, a bonus for being found by two or three, at most ``cap`` an anchor.

    modes: frames of (query_id, id, score, rank). anchors: (id, anchor); blank anchors are not capped. The cap is a rank inside the anchor under the same order
    as the whole, so that no scan in order is needed.
    """
    parts = None
    for name, rows in modes.items():
        one = min_max(rows, ["query_id"], "score", "scaled").where(F.col("rank") <= window).select("query_id", "id", F.lit(name).alias("mode"), "rank", "scaled")
        parts = one if parts is None else parts.unionByName(one)
    bonus = F.create_map(*[F.lit(x) for x in (1, 0.0, 2, 0.1, 3, 0.2)])
    grouped = parts.groupBy("query_id", "id").agg(F.sum(1.0 / (k + F.col("rank"))).alias("rrf"), F.max("scaled").alias("best"), F.min("rank").alias("best_rank"), F.count("*").cast("int").alias("coverage"))
    rows = grouped.withColumn("fused", F.round(F.col("rrf") + 0.2 * F.col("best") + F.coalesce(F.try_element_at(bonus, F.col("coverage")), F.lit(0.0)), 6)).join(anchors, "id")
    order = [F.desc("fused"), F.desc("coverage"), F.asc("best_rank"), F.asc("id")]
    capped = rows.withColumn("nth", F.row_number().over(Window.partitionBy("query_id", "anchor").orderBy(*order))).where((F.col("anchor") == "") | (F.col("nth") <= cap))
    return _ranked(capped, *order).where(F.col("rank") <= top_n).select("query_id", "id", "fused", "coverage", "rank")


@query("fuse_writer_anchor_cap", f"""WITH {_RRF_SQL}, m AS (SELECT query_id, id, 'lexical' AS mode, lexical AS score, rank FROM lex UNION ALL SELECT query_id, id, 'semantic', relevance, rank FROM sem UNION ALL SELECT query_id, id, 'hybrid', rrf, rank FROM rrf),
  n AS (SELECT *, CASE WHEN max(score) OVER w - min(score) OVER w < 1e-12 THEN 1.0 ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END AS scaled FROM m WINDOW w AS (PARTITION BY query_id, mode)),
  g AS (SELECT query_id, id, sum(1.0::DOUBLE / (60 + rank)) AS r, max(scaled) AS best, min(rank) AS best_rank, count(*) AS coverage FROM n WHERE rank <= {WINDOW} GROUP BY 1, 2),
  f AS (SELECT g.query_id, g.id, g.best_rank, g.coverage, u.heading, round(r + 0.2 * best + CASE coverage WHEN 2 THEN 0.1 WHEN 3 THEN 0.2 ELSE 0.0 END, 6) AS fused FROM g JOIN units u ON u.id = g.id),
  c AS (SELECT * FROM f QUALIFY heading = '' OR row_number() OVER (PARTITION BY query_id, heading ORDER BY fused DESC, coverage DESC, best_rank, id) <= 2)
SELECT query_id, id, fused, coverage, row_number() OVER (PARTITION BY query_id ORDER BY fused DESC, coverage DESC, best_rank, id) AS rank FROM c QUALIFY rank <= {TOP_K}""")
def writer_anchor_cap(spark, sf_dir):
    """Three modes fused for a writer, two rows a section at most."""
    return _titles_ranked(spark, sf_dir, "query_id string, id string, fused double, coverage int, rank int", _modes_answer)


def rerank_pool(lexical: DataFrame, semantic: DataFrame, size: int, lexical_min: int, semantic_min: int) -> DataFrame:
    """(query_id, id, place): the pool to rerank (T12, R16): the best lexical rows, then the best other semantic ones, then what both found, then the rest.

    Closed form: an id's place is its least (phase, rank). A minimum of 0 still takes one row, as a quota is looked at after a row is taken.
    """
    first, second = max(1, min(lexical_min, size)), max(1, min(semantic_min, size))
    ranks = lexical.select("query_id", "id", F.col("rank").alias("l")).join(semantic.select("query_id", "id", F.col("rank").alias("s")), ["query_id", "id"], "full_outer")
    ranks = ranks.withColumn("picked", F.coalesce(F.col("l") <= first, F.lit(False)))
    fresh = F.when(~F.col("picked") & F.col("s").isNotNull(), F.row_number().over(Window.partitionBy("query_id", F.col("picked") | F.col("s").isNull()).orderBy("s")))
    ranks = ranks.withColumn("n", fresh)
    at = lambda p, r: F.struct(F.lit(p).alias("p"), F.col(r).alias("r"))
    phase = F.when(F.col("picked"), at(1, "l")).when(F.col("n") <= second, at(2, "s")).when(F.col("l").isNotNull() & F.col("s").isNotNull(), at(3, "s")).when(F.col("s").isNotNull(), at(4, "s")).otherwise(at(5, "l"))
    return _ranked(ranks.withColumn("at", phase), F.asc("at.p"), F.asc("at.r"), F.asc("id"), out="place").where(F.col("place") <= size).select("query_id", "id", "place")


@query("pool_v2", f"""WITH {_PAIRS_SQL}, r AS (SELECT coalesce(l.query_id, s.query_id) AS query_id, coalesce(l.id, s.id) AS id, l.rank AS l, s.rank AS s FROM lex l FULL JOIN sem s ON l.query_id = s.query_id AND l.id = s.id),
  one AS (SELECT *, coalesce(l <= 4, false) AS picked FROM r), two AS (SELECT *, CASE WHEN NOT picked AND s IS NOT NULL THEN row_number() OVER (PARTITION BY query_id, picked OR s IS NULL ORDER BY s) END AS n FROM one),
  ph AS (SELECT query_id, id, CASE WHEN picked THEN 1 WHEN n <= 6 THEN 2 WHEN l IS NOT NULL AND s IS NOT NULL THEN 3 WHEN s IS NOT NULL THEN 4 ELSE 5 END AS p, CASE WHEN picked OR s IS NULL THEN l ELSE s END AS r FROM two)
SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY p, r, id) AS place FROM ph QUALIFY place <= 20""")
def pool_v2(spark, sf_dir):
    """Pools of twenty with four lexical and six semantic rows at least."""
    return _titles_ranked(spark, sf_dir, _PLACES, _pool_answer(lambda x: ranking.quota_pool(x, 20, 4, 6)))


def lexical_floor_pool(lexical: DataFrame, semantic: DataFrame, window: int, floor: int) -> DataFrame:
    """(query_id, id, place): the semantic window, then the best lexical rows outside it (T13, R17); a floor of 0 or less gives no pool."""
    if floor <= 0:
        return semantic.select("query_id", "id", F.col("rank").alias("place")).limit(0)
    base = semantic.where(F.col("rank") <= window).select("query_id", "id", F.lit(0).alias("p"), "rank")
    extra = _ranked(lexical.join(base, ["query_id", "id"], "left_anti").select("query_id", "id", F.col("rank").alias("r")), F.asc("r")).where(F.col("rank") <= floor).select("query_id", "id", F.lit(1).alias("p"), "rank")
    return _ranked(base.unionByName(extra), F.asc("p"), F.asc("rank"), out="place").select("query_id", "id", "place")


@query("pool_lexical_floor", f"""WITH {_PAIRS_SQL}, b AS (SELECT query_id, id, 0 AS p, rank FROM sem WHERE rank <= 12), x AS (SELECT l.query_id, l.id, 1 AS p, row_number() OVER (PARTITION BY l.query_id ORDER BY l.rank) AS rank FROM lex l ANTI JOIN b ON b.query_id = l.query_id AND b.id = l.id QUALIFY row_number() OVER (PARTITION BY l.query_id ORDER BY l.rank) <= 3)
SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY p, rank) AS place FROM (SELECT * FROM b UNION ALL SELECT * FROM x)""")
def pool_lexical_floor(spark, sf_dir):
    """A semantic window of twelve and three lexical rows besides."""
    return _titles_ranked(spark, sf_dir, _PLACES, _pool_answer(lambda x: ranking.floor_pool(x, 12, 3)))


def rerank_members(merged: DataFrame, pool: DataFrame, raw: DataFrame) -> DataFrame:
    """The rows of both lists with the reranker's score written anew for the members of the pool only.

    raw: (query_id, id, c), the reranker's scores; they are scaled within the pool, and a member without one counts as 0.
    """
    held = pool.select("query_id", "id").join(raw.select("query_id", "id", "c"), ["query_id", "id"], "left").na.fill(0.0, ["c"])
    scaled = min_max(held, ["query_id"], "c", "again").select("query_id", "id", F.round("again", 6).alias("again"))
    return merged.join(scaled, ["query_id", "id"], "left").withColumn("reranker", F.coalesce("again", "reranker")).drop("again")


def _coverage(pairs: DataFrame) -> DataFrame:
    """What stands in for the reranker of a pool: the share of the query's tokens that a unit holds."""
    return pairs.select("query_id", "id", (F.col("overlap") / F.greatest("asked", F.lit(1))).alias("c"))


#: Rows that each list has in a pool of WINDOW at least, and lexical rows beside a semantic window: the larger of a count and a share of the window.
POOL_LEAST = (24, 24)
FLOOR = max(24, math.ceil(WINDOW * 0.25))
_WINDOW_V2_SQL = f"""{_MERGED_SQL}, one AS (SELECT *, lex_rank BETWEEN 1 AND {POOL_LEAST[0]} AS picked FROM merged), two AS (SELECT *, CASE WHEN NOT picked AND sem_rank > 0 THEN row_number() OVER (PARTITION BY query_id, picked OR sem_rank = 0 ORDER BY sem_rank) END AS n FROM one),
  ph AS (SELECT query_id, id, CASE WHEN picked THEN 1 WHEN n <= {POOL_LEAST[1]} THEN 2 WHEN lex_rank > 0 AND sem_rank > 0 THEN 3 WHEN sem_rank > 0 THEN 4 ELSE 5 END AS p, CASE WHEN picked OR sem_rank = 0 THEN lex_rank ELSE sem_rank END AS r FROM two),
  chosen AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY p, r, id) AS place FROM ph QUALIFY place <= {WINDOW})"""
_WINDOW_FLOOR_SQL = f"""{_MERGED_SQL}, b AS (SELECT query_id, id, 0 AS p, rank FROM sem WHERE rank <= {WINDOW}),
  x AS (SELECT l.query_id, l.id, 1 AS p, row_number() OVER (PARTITION BY l.query_id ORDER BY l.rank) AS rank FROM lex l ANTI JOIN b ON b.query_id = l.query_id AND b.id = l.id QUALIFY row_number() OVER (PARTITION BY l.query_id ORDER BY l.rank) <= {FLOOR}),
  chosen AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY p, rank) AS place FROM (SELECT * FROM b UNION ALL SELECT * FROM x))"""


def _reranked_sql(chosen: str) -> str:
    a, b, c = WEIGHTS["v2"]
    return f"""WITH {chosen},
  anew AS (SELECT query_id, id, round(CASE WHEN max(c) OVER w - min(c) OVER w < 1e-12 THEN 1.0 ELSE (c - min(c) OVER w) / (max(c) OVER w - min(c) OVER w) END, 6) AS score FROM chosen JOIN (SELECT query_id, id, overlap / greatest(asked, 1) AS c FROM pairs) USING (query_id, id) WINDOW w AS (PARTITION BY query_id)),
  f AS (SELECT m.query_id, m.id, coalesce(n.score, m.reranker) AS reranker, round({a} * m.lexical + {b} * m.semantic + {c} * coalesce(n.score, m.reranker), 6) AS final FROM merged m LEFT JOIN anew n ON n.query_id = m.query_id AND n.id = m.id)
SELECT query_id, id, reranker, final, row_number() OVER (PARTITION BY query_id ORDER BY final DESC, reranker DESC, id) AS rank FROM f QUALIFY rank <= {TOP_K}"""


def _pool_reranked(spark, sf_dir: str, pool_of: Callable) -> DataFrame:
    return _titles_ranked(spark, sf_dir, "query_id string, id string, reranker double, final double, rank int", _reranked_answer(pool_of))


def _whole_v2(lex: DataFrame, sem: DataFrame) -> DataFrame:
    return rerank_pool(lex, sem, WINDOW, *POOL_LEAST)


def _whole_floor(lex: DataFrame, sem: DataFrame) -> DataFrame:
    return lexical_floor_pool(lex, sem, WINDOW, FLOOR)


def _quotas(x: ranking.Lists) -> np.ndarray:
    return ranking.quota_pool(x, WINDOW, *POOL_LEAST)


def _floors(x: ranking.Lists) -> np.ndarray:
    return ranking.floor_pool(x, WINDOW, FLOOR)


@query("pool_v2_window", f"WITH {_WINDOW_V2_SQL} SELECT * FROM chosen")
def pool_v2_window(spark, sf_dir):
    """Pools of the whole window."""
    return _titles_ranked(spark, sf_dir, _PLACES, _pool_answer(_quotas))


@query("pool_v2_reranked", _reranked_sql(_WINDOW_V2_SQL))
def pool_v2_reranked(spark, sf_dir):
    """Pools of the whole window reranked, their members' scores overwritten, and the ten best by the second set of weights."""
    return _pool_reranked(spark, sf_dir, _quotas)


@query("pool_lexical_floor_window", f"WITH {_WINDOW_FLOOR_SQL} SELECT * FROM chosen")
def pool_lexical_floor_window(spark, sf_dir):
    """The whole semantic window and the lexical floor besides."""
    return _titles_ranked(spark, sf_dir, _PLACES, _pool_answer(_floors))


@query("pool_lexical_floor_reranked", _reranked_sql(_WINDOW_FLOOR_SQL))
def pool_lexical_floor_reranked(spark, sf_dir):
    """The same pools reranked, and the ten best by the second set of weights."""
    return _pool_reranked(spark, sf_dir, _floors)


# --- labels, projection, abstention ---


def label_profiles(paragraphs: DataFrame, size: int = 12) -> DataFrame:
    """(label, k, terms): the twelve tokens that most paragraphs of each chapter share (R7); a row a label and token."""
    rows = paragraphs.select(F.col("chapter").alias("label"), tokens("clean_text").alias("t")).where("label IS NOT NULL").select("label", F.explode("t").alias("k"))
    counts = rows.groupBy("label", "k").agg(F.count("*").alias("n"))
    top = counts.withColumn("rn", F.row_number().over(Window.partitionBy("label").orderBy(F.desc("n"), "k"))).where(F.col("rn") <= size)
    return top.select("label", "k", F.count("*").over(Window.partitionBy("label")).alias("terms"))


#: Bounds of a unit's labels: the least score, its least share of the unit's best, and their number. Fixed values.
LABEL_LEAST, LABEL_NEAR, LABEL_MOST = 0.20, 0.72, 3


def label_scores(units: DataFrame, profiles: DataFrame) -> DataFrame:
    """(id, label, score, overlap, place): up to three labels of each unit (R6): shared tokens over the root of the label's size, near enough to the best."""
    hits = units.select("id", F.explode(tokens("text")).alias("k")).join(profiles, "k").groupBy("id", "label").agg(F.count("*").alias("overlap"), F.max("terms").alias("terms"))
    rows = hits.withColumn("raw", F.col("overlap") / F.sqrt("terms"))
    w = Window.partitionBy("id").orderBy(F.desc("raw"), F.desc("overlap"), F.asc("label"))
    rows = rows.withColumn("top", F.max("raw").over(Window.partitionBy("id"))).withColumn("place", F.row_number().over(w))
    return rows.where((F.col("raw") >= F.greatest(F.lit(LABEL_LEAST), F.col("top") * LABEL_NEAR)) & (F.col("place") <= LABEL_MOST)).select("id", "label", F.round("raw", 6).alias("score"), "overlap", "place")


def unit_labels(units: DataFrame, profiles: DataFrame) -> DataFrame:
    """(id, label, score) of label_scores for units that are one row an id; no hit is exchanged if the profiles, which should be written out, are within BROADCAST_BYTES."""
    if profiles.count() * 100 > BROADCAST_BYTES:
        return label_scores(units, profiles.hint("merge")).select("id", "label", "score")
    return ranking.unit_labels(units, profiles, LABEL_LEAST, LABEL_NEAR, LABEL_MOST).select("id", "label", F.round("raw", 6).alias("score"))


def _current_paragraphs(spark, sf_dir):
    p = table(spark, sf_dir, "paragraphs", "paragraph_id", "chapter", "clean_text")
    return p.groupBy(id_or_null("paragraph_id").alias("id")).agg(F.max("chapter").alias("chapter"), F.max("clean_text").alias("clean_text"))


_LABELS_SQL = f"""par AS (SELECT trim(paragraph_id, {_WS}) AS id, max(chapter) AS label, max(clean_text) AS t FROM paragraphs GROUP BY 1), pt AS (SELECT label, unnest(list_filter(list_distinct(regexp_extract_all(lower(t), '[a-z0-9_]+')), lambda x: x NOT IN {_STOP})) AS k FROM par WHERE label IS NOT NULL),
  prof AS (SELECT label, k, count(*) OVER (PARTITION BY label) AS terms FROM (SELECT label, k, count(*) AS n FROM pt GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, k) <= 12)),
  ut AS (SELECT id, unnest(list_filter(list_distinct(regexp_extract_all(lower(text), '[a-z0-9_]+')), lambda x: x NOT IN {_STOP})) AS k FROM units), hits AS (SELECT id, label, count(*) AS overlap, count(*) / sqrt(max(terms)) AS raw FROM ut JOIN prof USING (k) GROUP BY 1, 2),
  lab AS (SELECT id, label, round(raw, 6) AS score, overlap, row_number() OVER w AS place FROM hits WINDOW w AS (PARTITION BY id ORDER BY raw DESC, overlap DESC, label) QUALIFY raw >= greatest(0.20, max(raw) OVER (PARTITION BY id) * 0.72) AND row_number() OVER w <= 3)"""


@query("label_scores", f"WITH {_UNITS_SQL}, {_LABELS_SQL} SELECT * FROM lab")
def scored_labels(spark, sf_dir):
    """Labels of every unit from the profiles of chapters."""
    return label_scores(chunk_units(spark, sf_dir), label_profiles(_current_paragraphs(spark, sf_dir)))


def row_projection(ranked: DataFrame, labels: DataFrame, score: str) -> DataFrame:
    """(query_id, label, score, hits, top_id, place): ranked units rolled up to their labels (A8): sums of relevance over rank times label score."""
    rows = ranked.select("query_id", "id", F.col(score).alias("s"), F.col("rank").alias("r")).join(labels.select("id", "label", F.col("score").alias("p")), "id").where("p > 0")
    part = F.col("s") / F.col("r") * F.col("p")
    rolled = rows.groupBy("query_id", "label").agg(F.round(F.sum(part), 6).alias("score"), F.count("*").alias("hits"), F.min_by("id", F.struct(-F.round(part, 9), F.col("id"))).alias("top_id"))
    return _ranked(rolled, F.desc("score"), F.asc("label"), out="place")


_PROJ_SQL = f"""{_RRF_SQL}, {_LABELS_SQL}, contrib AS (SELECT r.query_id, r.id, l.label, r.rrf / r.rank * l.score AS part FROM rrf r JOIN lab l ON l.id = r.id WHERE r.rank <= {TOP_K} AND l.score > 0),
  proj AS (SELECT query_id, label, round(sum(part), 6) AS score, count(*) AS hits, arg_min(id, {{'p': -round(part, 9), 'i': id}}) AS top_id FROM contrib GROUP BY 1, 2), placed AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, label) AS place FROM proj)"""


def _projection(spark, sf_dir):
    profiles = materialize(label_profiles(_current_paragraphs(spark, sf_dir)))
    return _titles_ranked(spark, sf_dir, "query_id string, label string, score double, hits long, top_id string, place int", _projection_answer, lambda units: unit_labels(units, profiles).where("score > 0"))


@query("row_projection", f"WITH {_PROJ_SQL} SELECT * FROM placed")
def projected(spark, sf_dir):
    """Labels of every query from its ten best units."""
    return _projection(spark, sf_dir)


#: Bounds of the abstention policy: score, hits, lead over the second label. Fixed values.
THRESHOLD, LEAST_HITS, LEAST_MARGIN = 0.015, 2, 0.005


def abstain(queries: DataFrame, projection: DataFrame) -> DataFrame:
    """(query_id, reason, labels): why a query's labels are withheld, or NONE and up to three labels.

    Reasons are tried in order: no signal, too little evidence, score below the threshold, lead too small. Queries without any label are included.
    """
    enough = (F.col("hits") >= LEAST_HITS) & (F.col("score") >= THRESHOLD)
    rows = projection.groupBy("query_id").agg(*[F.max(F.when(F.col("place") == n, F.col(c))).alias(f"{c}{n}") for n, c in ((1, "score"), (1, "hits"), (2, "score"))], F.sort_array(F.collect_list(F.when(enough, F.struct("place", "label")))).alias("good"))
    reason = F.when(F.col("score1").isNull(), "NO_ROW_SIGNAL").when(F.col("hits1") < LEAST_HITS, "INSUFFICIENT_EVIDENCE").when(F.col("score1") < THRESHOLD, "ROW_SCORE_BELOW_THRESHOLD").when(F.col("score1") - F.col("score2") < LEAST_MARGIN, "LOW_CONFIDENCE_MARGIN").when(F.size("good") == 0, "NO_ROW_ABOVE_THRESHOLD").otherwise("NONE")
    out = queries.select("query_id").join(rows, "query_id", "left").withColumn("reason", reason)
    return out.select("query_id", "reason", F.when(F.col("reason") == "NONE", F.array_join(F.slice("good.label", 1, 3), ",")).otherwise("").alias("labels"))


_ABSTAIN_SQL = f"""WITH {_PROJ_SQL}, g AS (SELECT query_id, max(score) FILTER (WHERE place = 1) AS s1, max(hits) FILTER (WHERE place = 1) AS h1, max(score) FILTER (WHERE place = 2) AS s2, list(label ORDER BY place) FILTER (WHERE hits >= {LEAST_HITS} AND score >= {THRESHOLD}) AS good FROM placed GROUP BY 1),
  d AS (SELECT q.query_id, CASE WHEN s1 IS NULL THEN 'NO_ROW_SIGNAL' WHEN h1 < {LEAST_HITS} THEN 'INSUFFICIENT_EVIDENCE' WHEN s1 < {THRESHOLD} THEN 'ROW_SCORE_BELOW_THRESHOLD' WHEN s1 - s2 < {LEAST_MARGIN} THEN 'LOW_CONFIDENCE_MARGIN' WHEN good IS NULL THEN 'NO_ROW_ABOVE_THRESHOLD' ELSE 'NONE' END AS reason, good FROM queries q LEFT JOIN g ON g.query_id = q.query_id)"""


@query("abstain_decision", f"{_ABSTAIN_SQL} SELECT query_id, reason, CASE WHEN reason = 'NONE' THEN array_to_string(good[1:3], ',') ELSE '' END AS labels FROM d")
def abstain_decision(spark, sf_dir):
    """The decision for every query."""
    return abstain(title_queries(spark, sf_dir), _projection(spark, sf_dir))


@query("mining_hard_negatives", f"WITH {_RRF_SQL}, pos AS (SELECT query_id, id FROM lex WHERE rank = 1) SELECT p.query_id, p.id AS positive, r.id AS negative, row_number() OVER (PARTITION BY p.query_id ORDER BY r.rank) AS place FROM pos p JOIN rrf r ON r.query_id = p.query_id AND r.id <> p.id AND r.rank <= {TOP_K} QUALIFY place <= 4")
def hard_negatives(spark, sf_dir):
    """Each query's lexical best with up to four other units of its hybrid top ten."""
    lists = _lists(spark, sf_dir)
    positive = lists.lexical.where("rank = 1").select("query_id", F.col("id").alias("positive"))
    others = fuse_rrf(lists.hybrid).where(F.col("rank") <= TOP_K).select("query_id", F.col("id").alias("negative"), "rank")
    rows = positive.join(others, "query_id").where("positive <> negative")
    return lists.named(_ranked(rows, F.asc("rank"), out="place").where("place <= 4").select("query_id", "positive", "negative", "place"), "positive", "negative")


# --- vectors ---

#: Bytes of query vectors that are sent to the workers at once, and cosines that a task holds at once: queries of a block times rows looked at together.
BLOCK_BYTES, PRODUCT = 64_000_000, 8_000_000


def nearest_vectors(rows: DataFrame, queries: DataFrame, k: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_id, id, cosine, low, high): the k nearest rows of each query, and the least and greatest cosine over all rows.

    rows: (id, vector); queries: (query_id, vector); vectors of one length. Queries go out in blocks of a bounded size; every task keeps k rows a
    query, so that the exchange carries k rows a query and task. A vector of length 0 has cosine 0; null vectors take no part.
    """
    spark = rows.sparkSession
    width = queries.select(F.max(F.size("vector"))).first()[0] or 1
    step = max(1, min(block_bytes // (8 * width), PRODUCT // (2 * k)))
    blocks = -(-queries.count() // step)
    lots = queries.where("vector IS NOT NULL").withColumn("_lot", F.pmod(F.xxhash64("query_id"), F.lit(max(1, blocks))))
    schema = "query_id long, id long, cosine double, low double, high double"
    out = None
    for lot in range(blocks):
        block = lots.where(F.col("_lot") == lot).select("query_id", "vector").toArrow()
        ids = block.column("query_id").to_numpy()
        matrix = np.array(block.column("vector").to_pylist(), np.float64).reshape(len(ids), width)
        norm = np.linalg.norm(matrix, axis=1, keepdims=True)
        shared = spark.sparkContext.broadcast((ids, np.divide(matrix, norm, out=np.zeros_like(matrix), where=norm > 0)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, m = shared.value
            most = max(1, PRODUCT // max(len(ids), 1) - k)
            low, high = np.full(len(ids), np.inf), np.full(len(ids), -np.inf)
            best_id, best = np.empty((len(ids), 0), np.int64), np.empty((len(ids), 0))
            for whole in batches:
                for begin in range(0, whole.num_rows, most):
                    batch = whole.slice(begin, most)
                    own = batch.column("id").to_numpy()
                    x = np.array(batch.column("vector").to_pylist(), np.float64)
                    n = np.linalg.norm(x, axis=1, keepdims=True)
                    cosine = m @ np.divide(x, n, out=np.zeros_like(x), where=n > 0).T
                    low, high = np.minimum(low, cosine.min(1)), np.maximum(high, cosine.max(1))
                    best, best_id = np.concatenate([best, cosine], 1), np.concatenate([best_id, np.broadcast_to(own, cosine.shape)], 1)
                    keep = np.lexsort((best_id, -best))[:, :k] if best.shape[1] > k else np.arange(best.shape[1])[None, :].repeat(len(ids), 0)
                    best, best_id = np.take_along_axis(best, keep, 1), np.take_along_axis(best_id, keep, 1)
            if best.shape[1]:
                w = best.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, w)), pa.array(best_id.ravel()), pa.array(best.ravel()), pa.array(np.repeat(low, w)), pa.array(np.repeat(high, w))], names=["query_id", "id", "cosine", "low", "high"])

        part = rows.where("vector IS NOT NULL").select("id", "vector").mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], schema)
    bounds = Window.partitionBy("query_id")
    out = out.withColumn("low", F.min("low").over(bounds)).withColumn("high", F.max("high").over(bounds))
    return _ranked(out, F.desc("cosine"), F.asc("id")).where(F.col("rank") <= k).drop("rank")


def _vectors(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    return e, nearest_vectors(e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")), e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")))


def vector_ranking(near: DataFrame, vectors: DataFrame) -> DataFrame:
    """(query_id, id, semantic, reranker, relevance, rank): cosine scaled over all rows, reranked by distance inside the pool."""
    v = vectors.select(F.col("vec_id").alias("id"), F.col("embedding").alias("x"))
    both = near.join(v, "id").join(v.select(F.col("id").alias("query_id"), F.col("x").alias("y")), "query_id")
    gap = F.aggregate(F.zip_with("x", "y", lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double"))), F.lit(0.0), lambda s, z: s + z)
    rows = both.withColumn("d", -gap)
    w = Window.partitionBy("query_id")
    scale = lambda c, lo, hi: F.when(hi - lo < 1e-12, 1.0).otherwise((c - lo) / (hi - lo))
    rows = rows.select("query_id", "id", F.round(scale(F.col("cosine"), F.col("low"), F.col("high")), 6).alias("semantic"), F.round(scale(F.col("d"), F.min("d").over(w), F.max("d").over(w)), 6).alias("reranker"))
    rows = rows.withColumn("relevance", F.round(RELEVANCE_SHARES[0] * F.col("semantic") + RELEVANCE_SHARES[1] * F.col("reranker"), 6))
    return _ranked(rows, F.desc("relevance"), F.desc("reranker"), F.asc("id"))


_VEC_SQL = f"""e AS (SELECT vec_id, cast(embedding AS DOUBLE[]) AS v, label FROM embeddings), c AS (SELECT q.vec_id AS query_id, x.vec_id AS id, list_cosine_similarity(q.v, x.v) AS cosine, list_distance(q.v, x.v) AS d, q.label = x.label AS same FROM e q, e x WHERE q.vec_id % 100 = 0),
  b AS (SELECT *, min(cosine) OVER w AS low, max(cosine) OVER w AS high FROM c WINDOW w AS (PARTITION BY query_id)), near AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, id) AS crank FROM b QUALIFY crank <= {WINDOW}),
  s AS (SELECT query_id, id, crank, same, round((cosine - low) / (high - low), 6) AS semantic, round((-d * d - min(-d * d) OVER w) / (max(-d * d) OVER w - min(-d * d) OVER w), 6) AS reranker FROM near WINDOW w AS (PARTITION BY query_id)),
  r AS (SELECT *, round(0.45 * semantic + 0.55 * reranker, 6) AS relevance FROM s), vr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY relevance DESC, reranker DESC, id) AS rank FROM r)"""


@query("sem_cosine_topk", f"WITH {_VEC_SQL} SELECT query_id, id, semantic, crank AS rank FROM vr WHERE crank <= {TOP_K}")
def cosine_topk(spark, sf_dir):
    """The ten nearest of all vectors for every hundredth."""
    _, near = _vectors(spark, sf_dir)
    return _ranked(near, F.desc("cosine"), F.asc("id")).where(F.col("rank") <= TOP_K).select("query_id", "id", F.round((F.col("cosine") - F.col("low")) / (F.col("high") - F.col("low")), 6).alias("semantic"), "rank")


@query("sem_vector_reranked", f"WITH {_VEC_SQL} SELECT query_id, id, semantic, reranker, relevance, rank FROM vr WHERE rank <= {TOP_K}")
def vector_reranked(spark, sf_dir):
    """The same, reranked by distance."""
    e, near = _vectors(spark, sf_dir)
    return vector_ranking(near, e).where(F.col("rank") <= TOP_K)


def ir_metrics(ranked: DataFrame, k: int = TOP_K) -> DataFrame:
    """(mode, query_id, precision, mrr, ndcg) of ranked rows (mode, query_id, rank, relevant).

    Precision is over the rows there are, the ideal order is that of the rows retrieved; queries without rows give none.
    """
    top = ranked.where(F.col("rank") <= k).withColumn("rel", F.col("relevant").cast("int"))
    gain = F.col("rel") / F.log2(F.col("rank") + 1.0)
    g = top.groupBy("mode", "query_id").agg(F.avg("rel").alias("precision"), F.max(F.col("rel") / F.col("rank")).alias("mrr"), F.sum(gain).alias("dcg"), F.sum("rel").alias("n"))
    ideal = F.aggregate(F.when(F.col("n") > 0, F.sequence(F.lit(1), F.col("n").cast("int"))).otherwise(F.array().cast("array<int>")), F.lit(0.0), lambda s, i: s + 1.0 / F.log2(i + 1.0))
    return g.select("mode", "query_id", F.round("precision", 6).alias("precision"), F.round("mrr", 6).alias("mrr"), F.round(F.when(F.col("n") > 0, F.col("dcg") / ideal).otherwise(0.0), 6).alias("ndcg"))


_CASES_SQL = f"""{_VEC_SQL}, j AS (SELECT 'cosine' AS mode, query_id, crank AS rank, same::INT AS rel FROM vr WHERE crank <= {TOP_K} UNION ALL SELECT 'reranked', query_id, rank, same::INT FROM vr WHERE rank <= {TOP_K}),
  m AS (SELECT mode, query_id, round(avg(rel), 6) AS precision, round(max(rel / rank), 6) AS mrr, round(coalesce(sum(rel / log2(rank + 1)) / nullif(list_sum(list_transform(range(1, cast(sum(rel) AS BIGINT) + 1), lambda i: 1 / log2(i + 1))), 0), 0), 6) AS ndcg FROM j GROUP BY 1, 2)"""


def _cases(spark, sf_dir):
    e, near = _vectors(spark, sf_dir)
    near = materialize(near)
    labels = e.select(F.col("vec_id").alias("id"), "label")
    plain = _ranked(near, F.desc("cosine"), F.asc("id")).select(F.lit("cosine").alias("mode"), "query_id", "id", "rank")
    both = plain.unionByName(vector_ranking(near, e).select(F.lit("reranked").alias("mode"), "query_id", "id", "rank")).where(F.col("rank") <= TOP_K)
    judged = both.join(labels, "id").join(labels.select(F.col("id").alias("query_id"), F.col("label").alias("wanted")), "query_id")
    return ir_metrics(judged.select("mode", "query_id", "rank", (F.col("label") == F.col("wanted")).alias("relevant")))


@query("ir_case_metrics", f"WITH {_CASES_SQL} SELECT * FROM m")
def case_metrics(spark, sf_dir):
    """Metrics of every case and mode, relevant being what has the query's label."""
    return _cases(spark, sf_dir)


@query("ir_mode_summary", f"WITH {_CASES_SQL} SELECT mode, count(*) AS cases, round(avg(precision), 6) AS precision, round(avg(mrr), 6) AS mrr, round(avg(ndcg), 6) AS ndcg FROM m GROUP BY 1")
def mode_summary(spark, sf_dir):
    """Means per mode."""
    return _cases(spark, sf_dir).groupBy("mode").agg(F.count("*").alias("cases"), *[F.round(F.avg(c), 6).alias(c) for c in ("precision", "mrr", "ndcg")])


#: Least means that let a run pass. Fixed values.
GATES = {"precision": 0.55, "mrr": 0.65, "ndcg": 0.72}


@query("ir_gates", f"WITH {_CASES_SQL}, a AS (SELECT mode, avg(precision) AS precision, avg(mrr) AS mrr, avg(ndcg) AS ndcg FROM m GROUP BY 1) " + " UNION ALL ".join(f"SELECT mode, '{g}' AS gate, round({g}, 6) AS value, {least} AS least, {g} >= {least} AS passed FROM a" for g, least in GATES.items()))
def ir_gates(spark, sf_dir):
    """Every mode's means against the gates."""
    means = _cases(spark, sf_dir).groupBy("mode").agg(*[F.avg(c).alias(c) for c in GATES])
    rows = F.array(*[F.struct(F.lit(g).alias("gate"), F.round(F.col(g), 6).alias("value"), F.lit(least).alias("least"), (F.col(g) >= least).alias("passed")) for g, least in GATES.items()])
    return means.select("mode", F.inline(rows))


#: Kinds of API items that a query may ask for by name.
KIND_HINTS = ("struct", "enum", "trait", "function", "module", "macro", "constant")


def hinted_order(top: DataFrame, kinds: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, id, boost, place): a list that is already cut, put in order again: units of a kind that the original query names come first, each part in its old order.

    top: (query_id, id, rank); kinds: (id, kind), one row an id; units without a kind keep their places behind.
    """
    asked = queries.select("query_id", F.regexp_extract_all(F.lower("query"), F.lit("[a-z0-9_]+"), F.lit(0)).alias("words"))
    rows = top.join(kinds, "id", "left").join(asked, "query_id")
    hit = F.coalesce(F.col("kind").isin(*KIND_HINTS) & F.array_contains("words", F.col("kind")), F.lit(False)).cast("int")
    return _ranked(rows.withColumn("boost", hit), F.desc("boost"), F.asc("rank"), out="place").select("query_id", "id", "boost", "place")


@query("hinted_order", f"""WITH {_PAIRS_SQL}, k AS (SELECT trim(chunk_uid, {_WS}) AS id, max(item_kind) AS kind FROM core_docs_chunk_metadata GROUP BY 1), t AS (SELECT l.query_id, l.id, l.rank, coalesce(k.kind IN ('struct', 'enum', 'trait', 'function', 'module', 'macro', 'constant') AND list_contains(regexp_extract_all(lower(q.query), '[a-z0-9_]+'), k.kind), false)::INT AS boost
  FROM lex l JOIN queries q ON q.query_id = l.query_id LEFT JOIN k ON k.id = l.id WHERE l.rank <= {TOP_K}) SELECT query_id, id, boost, row_number() OVER (PARTITION BY query_id ORDER BY boost DESC, rank) AS place FROM t""")
def hinted(spark, sf_dir):
    """The lexical top ten with the kinds that the query names first."""
    top, queries = lex_scored_topk(spark, sf_dir), title_queries(spark, sf_dir)
    kinds = table(spark, sf_dir, "core_docs_chunk_metadata", "chunk_uid", "item_kind").groupBy(id_or_null("chunk_uid").alias("id")).agg(F.max("item_kind").alias("kind"))
    return hinted_order(top, kinds, queries)


def projection_metrics(decisions: DataFrame, expected: DataFrame) -> DataFrame:
    """(query_id, precision, recall, f1, row_hit) of predicted against expected labels.

    decisions: (query_id, labels joined by commas); expected: (query_id, label), distinct. Nothing expected and nothing predicted is 1, 1, 1; nothing predicted
    is 0, 0, 0; nothing expected has recall 0 and a hit of 1.
    """
    said = decisions.select("query_id", F.filter(F.split("labels", ","), lambda x: x != "").alias("said"))
    wanted = expected.groupBy("query_id").agg(F.collect_set("label").alias("wanted"))
    x = said.join(wanted, "query_id", "left").withColumn("wanted", F.coalesce("wanted", F.array().cast("array<string>")))
    both, n, m = F.size(F.array_intersect("said", "wanted")), F.size("said"), F.size("wanted")
    none = (n == 0) & (m == 0)
    p = F.when(none, 1.0).when(n == 0, 0.0).otherwise(both / n)
    r = F.when(none, 1.0).when((n == 0) | (m == 0), 0.0).otherwise(both / m)
    rows = x.select("query_id", p.alias("p"), r.alias("r"), F.when(m == 0, 1.0).otherwise((both > 0).cast("double")).alias("row_hit"))
    return rows.select("query_id", F.round("p", 6).alias("precision"), F.round("r", 6).alias("recall"), F.round(F.when(F.col("p") + F.col("r") > 0, 2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))).otherwise(0.0), 6).alias("f1"), "row_hit")


def _expected_labels(spark, sf_dir):
    """(query_id, label): the chapter of the paragraph that a guideline's source names."""
    m = table(spark, sf_dir, "guideline_fls_source_mappings", "guideline_id", "raw_fls_id").select(id_or_null("guideline_id").alias("query_id"), id_or_null("raw_fls_id").alias("id"))
    return m.join(_current_paragraphs(spark, sf_dir), "id").where("chapter IS NOT NULL").select("query_id", F.col("chapter").alias("label")).distinct()


_PRF_SQL = f"""{_ABSTAIN_SQL}, want AS (SELECT trim(m.guideline_id, {_WS}) AS query_id, list(DISTINCT p.label) AS w FROM guideline_fls_source_mappings m JOIN par p ON p.id = trim(m.raw_fls_id, {_WS}) WHERE p.label IS NOT NULL GROUP BY 1),
  pr AS (SELECT d.query_id, CASE WHEN reason = 'NONE' THEN good[1:3] ELSE [] END AS s, coalesce(w, []) AS w FROM d LEFT JOIN want ON want.query_id = d.query_id),
  prf AS (SELECT query_id, CASE WHEN len(s) = 0 AND len(w) = 0 THEN 1.0 WHEN len(s) = 0 THEN 0.0 ELSE len(list_intersect(s, w)) / len(s) END::DOUBLE AS p, CASE WHEN len(s) = 0 AND len(w) = 0 THEN 1.0 WHEN len(s) = 0 OR len(w) = 0 THEN 0.0 ELSE len(list_intersect(s, w)) / len(w) END::DOUBLE AS r, CASE WHEN len(w) = 0 OR len(list_intersect(s, w)) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS row_hit FROM pr),
  fs AS (SELECT query_id, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1, row_hit FROM prf)"""


@query("projection_case_metrics", f"{_PRF_SQL} SELECT * FROM fs")
def projection_cases(spark, sf_dir):
    """labels of every query against the chapter of its source's paragraph."""
    return projection_metrics(abstain_decision(spark, sf_dir), _expected_labels(spark, sf_dir))


@query("projection_summary", f"{_PRF_SQL} SELECT count(*) AS cases, round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1, round(avg(row_hit), 6) AS row_hit_rate FROM fs")
def projection_summary(spark, sf_dir):
    """A10: macro means over all queries."""
    return projection_cases(spark, sf_dir).agg(F.count("*").alias("cases"), F.round(F.avg("precision"), 6).alias("macro_precision"), F.round(F.avg("recall"), 6).alias("macro_recall"), F.round(F.avg("f1"), 6).alias("macro_f1"), F.round(F.avg("row_hit"), 6).alias("row_hit_rate"))
