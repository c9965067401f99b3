"""Retrieval in one call, by settings: rewriting, candidates, ranking, reranking by a model, routing, fusion, and falling back where the model fails."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.operators import ranking
from quarryline.operators.models import model_scores
from quarryline.operators.resolution import FAMILIES, prompt_family
from quarryline.operators.retrieval import _RRF_SQL, _WS, RELEVANCE_SHARES, TOP_K, WEIGHTS, _ranked, chunk_units, fuse_rrf, fuse_weighted, hybrid, lexical_floor_pool, lexical_rows, numbered, ranked_by, rerank_members, rerank_pool, scored_pairs, semantic_rows, title_queries
from quarryline.plans.catalog import query
from quarryline.plans.rewrite import rewrite
from quarryline.plans.stages import materialize
from quarryline.sources.config import RetrievalConfig, resolve_config

MODES = ("lexical", "semantic", "hybrid")


def _fused(merged: DataFrame, fusion: str, config: RetrievalConfig) -> DataFrame:
    rows = fuse_rrf(merged, config.rrf_k, config.window) if fusion == "rrf-v1" else fuse_weighted(merged, fusion.removeprefix("weighted-"))
    return rows.where(F.col("rank") <= config.top_k).select("query_id", "id", "rank", F.lit(fusion).alias("fusion"))


def _pool(lexical: DataFrame, semantic: DataFrame, config: RetrievalConfig) -> DataFrame:
    """What a model reranks: by quotas if a pool size is set, by a floor of lexical rows if that is, else the semantic window."""
    if config.rerank_pool_size:
        return rerank_pool(lexical, semantic, config.rerank_pool_size, config.lexical_min, config.semantic_min)
    floor = max(config.lexical_floor_count, round(config.lexical_floor_share * config.window))
    return lexical_floor_pool(lexical, semantic, config.window, floor) if floor else semantic.where(F.col("rank") <= config.window).select("query_id", "id", F.col("rank").alias("place"))


def retrieve(queries: DataFrame, units: DataFrame, config: RetrievalConfig | None = None, mode: str = "hybrid", rules: Mapping | None = None, routing: DataFrame | None = None, scorer: Callable[[list[str], list[str]], Sequence] | None = None) -> DataFrame:
    """(query_id, id, rank, fusion, degraded): up to top_k units of every query that finds any.

    queries: (query_id, query) and, for rules about labels, marker; units: (id, heading, text); ids unique. rules rewrite the queries first (R12). routing, (query_id, fusion), settles the fusion query by query (R22); queries
    that it doesn't name have the settings' one. scorer is a model that reranks the pool, from lists of queries and texts (R11, R16, R17); a query of which any batch fails is answered by its lexical list, marked as degraded (R20). fusion is that of
    hybrid lists, else the mode.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}")
    config = config or resolve_config()
    if rules is not None:
        marked = queries if "marker" in queries.columns else queries.withColumn("marker", F.lit(""))
        rewritten = rewrite(marked.select("query_id", "query", "marker", F.lit(mode).alias("mode")), rules)
        queries = rewritten.select("query_id", F.col("rewritten").alias("query"))
    queries = queries.select("query_id", F.coalesce("query", F.lit("")).alias("query"))
    if scorer is None:
        return _at_once(queries, units, config, mode, routing)
    queries, query_names = numbered(queries, "query_id")
    units, unit_names = numbered(units.select("id", "heading", "text"), "id")
    pairs = scored_pairs(queries, units, config.candidate_limit)
    lexical = materialize(lexical_rows(pairs, queries, units))
    told = lambda df, name: df.where(F.col("rank") <= config.top_k).select("query_id", "id", "rank", F.lit(name).alias("fusion"))
    degraded = None
    if mode == "lexical":
        rows = told(lexical, mode)
    else:
        semantic = materialize(semantic_rows(pairs, lexical))
        merged = hybrid(lexical, semantic)
        pool = materialize(_pool(lexical, semantic, config))
        asked = pool.select("query_id", "id").join(queries, "query_id").join(units.select("id", "text"), "id")
        scored = materialize(model_scores(asked, scorer))
        degraded = scored.where("degraded").select("query_id").distinct()
        merged = materialize(rerank_members(merged, pool, scored.select("query_id", "id", F.col("score").alias("c"))))
        if mode == "semantic":
            found = _by_relevance(merged.where(F.col("sem_rank") > 0))
            rows = told(found.select("query_id", "id", F.col("sem_rank").alias("rank")), mode)
        elif routing is None:
            rows = _fused(merged, config.fusion, config)
        else:
            way = routing.join(query_names.select(F.col("_name").alias("query_id"), F.col("query_id").alias("_number")), "query_id").groupBy(F.col("_number").alias("query_id")).agg(F.max("fusion").alias("way"))
            merged = materialize(merged.join(way, "query_id", "left").withColumn("way", F.coalesce("way", F.lit(config.fusion))))
            lots = [_fused(merged.where(F.col("way") == f).drop("way"), f, config) for f in (*(f"weighted-{v}" for v in WEIGHTS), "rrf-v1")]
            rows = lots[0].unionByName(lots[1]).unionByName(lots[2])
    rows = rows.withColumn("degraded", F.lit(False))
    if degraded is not None:
        rows = rows.join(degraded, "query_id", "left_anti").unionByName(told(lexical, "lexical").join(degraded, "query_id", "left_semi").withColumn("degraded", F.lit(True)))
    rows = rows.join(query_names, "query_id").drop("query_id").withColumnRenamed("_name", "query_id")
    return rows.join(unit_names, "id").select("query_id", F.col("_name").alias("id"), "rank", "fusion", "degraded")


def _at_once(queries: DataFrame, units: DataFrame, config: RetrievalConfig, mode: str, routing: DataFrame | None) -> DataFrame:
    """The same without a model: each query's lists are made and cut in one task."""
    ways = {f"weighted-{v}": w for v, w in WEIGHTS.items()}

    def answer(ix, x, way):
        if mode != "hybrid":
            rank = x.lex_rank if mode == "lexical" else x.sem_rank
            found = np.flatnonzero((rank > 0) & (rank <= config.top_k))
            top = found[np.argsort(rank[found])]
        elif way == "rrf-v1":
            top = ranking.reciprocal(x, config.rrf_k, config.window)[2][: config.top_k]
        else:
            top = ranking.weighted_top(x, ways[way], config.top_k)[0] if way in ways else np.empty(0, np.int64)
        return x.unit[top], np.arange(1, len(top) + 1), np.full(len(top), way)

    way = F.lit(mode if mode != "hybrid" else config.fusion)
    if mode == "hybrid" and routing is not None:
        queries = queries.join(routing.groupBy("query_id").agg(F.max("fusion").alias("way")), "query_id", "left")
        way = F.coalesce("way", way)
    name, unit = queries.schema["query_id"].dataType.simpleString(), units.schema["id"].dataType.simpleString()
    rows = ranked_by(queries.withColumn("way", way), units.select("id", "heading", "text"), f"query_id {name}, id {unit}, rank int, fusion string", answer, ("way",), config.candidate_limit, max(config.window, config.top_k))
    return rows.withColumn("degraded", F.lit(False))


def _by_relevance(merged: DataFrame) -> DataFrame:
    """Semantic rows ranked anew by the reranker's scores."""
    relevance = F.round(RELEVANCE_SHARES[0] * F.col("semantic") + RELEVANCE_SHARES[1] * F.col("reranker"), 6)
    return _ranked(merged.drop("sem_rank").withColumn("_v", relevance), F.desc("_v"), F.desc("reranker"), F.asc("id"), out="sem_rank")


_FAMILY = f"SELECT trim(guideline_id, {_WS}) AS query_id, CASE WHEN regexp_matches(lower(coalesce(max(title), '')), '" + "|".join(FAMILIES[0][1]) + "') THEN 'weighted-v2' ELSE 'rrf-v1' END AS fusion FROM guideline_records GROUP BY 1"
_A, _B, _C = WEIGHTS["v2"]


@query("retrieve_routed", f"""WITH {_RRF_SQL}, way AS ({_FAMILY}), w AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY round({_A} * lexical + {_B} * semantic + {_C} * reranker, 6) DESC, reranker DESC, id) AS rank FROM merged)
SELECT w.query_id, w.id, w.rank, fusion, false AS degraded FROM w JOIN way USING (query_id) WHERE fusion = 'weighted-v2' AND w.rank <= {TOP_K} UNION ALL SELECT r.query_id, r.id, r.rank, fusion, false FROM rrf r JOIN way USING (query_id) WHERE fusion = 'rrf-v1' AND r.rank <= {TOP_K}""")
def retrieve_routed(spark, sf_dir):
    """The ten best units of every title, fused in the way of its family."""
    config = dataclasses.replace(resolve_config({"fusion": "rrf-v1"}), candidate_limit=None)
    return retrieve(title_queries(spark, sf_dir), chunk_units(spark, sf_dir), config, routing=prompt_family(spark, sf_dir).select("query_id", "fusion"))
