"""Hand-computed rankings, SQLite's own BM25, and metrics."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from quarryline.functions.text import query_tokens, raw_tokens, tokens
from quarryline.operators import retrieval as r
from quarryline.operators.relational import min_max


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_min_max(spark):
    df = frame(spark, [("a", 2.0), ("a", 2.0), ("b", 1.0), ("b", 2.0), ("b", 3.0)], "k string, v double")
    assert sorted((x.k, x.s) for x in min_max(df, ["k"], "v", "s").collect()) == [("a", 1.0), ("a", 1.0), ("b", 0.0), ("b", 0.5), ("b", 1.0)]
    assert min_max(df.limit(0), ["k"], "v", "s").count() == 0


TEXTS = [("a", "Heap", "the pool frees the pool and the arena"), ("b", "Stack", "a stack frame is freed"), ("c", "", "pool of frames; POOL!"), ("d", "Misc", "nothing here"), ("e", "Misc", ""), ("f", "Misc", "common words here"), ("g", "x", "common words there")]


def test_bm25_is_sqlites(spark):
    units = frame(spark, TEXTS, "id string, heading string, text string")
    q = frame(spark, [("q1", "pool frames"), ("q2", "misc"), ("q3", "what is the"), ("q4", "zzz")], "query_id string, query string").select("query_id", query_tokens("query").alias("terms"))
    got = {(x.query_id, x.id): x.bm25 for x in r.bm25(q, r.postings(units), units).collect()}
    db = sqlite3.connect(":memory:")
    db.execute("CREATE VIRTUAL TABLE f USING fts5(id UNINDEXED, heading, text)")
    db.executemany("INSERT INTO f VALUES (?, ?, ?)", TEXTS)
    want = {}
    for name, terms in (("q1", "pool OR frames"), ("q2", "misc"), ("q3", "what OR \"is\" OR the")):
        want |= {(name, i): s for i, s in db.execute("SELECT id, bm25(f) FROM f WHERE f MATCH ?", (terms,))}
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)


def test_common_terms_keep_a_floor(spark):
    units = frame(spark, [(str(i), "", "same") for i in range(4)], "id string, heading string, text string")
    q = frame(spark, [("q", ["same"])], "query_id string, terms array<string>")
    assert all(-1e-5 < x.bm25 < 0 for x in r.bm25(q, r.postings(units), units).collect())


def test_scope(spark):
    units = frame(spark, TEXTS, "id string, heading string, text string")
    q = frame(spark, [("q1", ["pool"])], "query_id string, terms array<string>")
    whole = {x.id: x.bm25 for x in r.bm25(q, r.postings(units), units).collect()}
    part = {x.id: x.bm25 for x in r.bm25(q, r.postings(units), units, frame(spark, [("a",), ("a",)], "id string")).collect()}
    assert part == {"a": whole["a"]}
    assert r.bm25(q, r.postings(units), units, frame(spark, [], "id string")).count() == 0


def test_stopword_query(spark):
    row = frame(spark, [("what is the",)], "t string").select(tokens("t").alias("t"), query_tokens("t").alias("q")).first()
    assert row.t == [] and row.q == ["what", "is", "the"]


LEX, SEM = "query_id string, id string, lexical double, bm25 double, rank int", "query_id string, id string, semantic double, reranker double, relevance double, rank int"


def test_rrf_of_two_lists(spark):
    lex = frame(spark, [("q", "s1", 1.0, -2.0, 1), ("q", "s2", 0.5, -1.0, 2)], LEX)
    sem = frame(spark, [("q", "s2", 0.8, 0.9, 0.85, 1), ("q", "s1", 0.4, 0.2, 0.3, 2)], SEM)
    got = {x.id: (x.rrf, x.lists, x.rank) for x in r.fuse_rrf(r.hybrid(lex, sem)).collect()}
    assert got["s2"] == (pytest.approx(1 / 62 + 2 / 61, abs=1e-8), 3, 1) and got["s1"] == (pytest.approx(1 / 61 + 2 / 62, abs=1e-8), 3, 2)


def brute_pool(lex, sem, size, a, b):
    pool, seen = [], set()

    def add(ids, most):
        n = 0
        for i in ids:
            if i in seen:
                continue
            seen.add(i)
            pool.append(i)
            n += 1
            if n >= most or len(pool) >= size:
                return

    add(lex, min(a, size))
    add(sem, min(b, size))
    add([i for i in sem if i in lex], size)
    add(sem, size)
    add(lex, size)
    return pool[:size]


@pytest.mark.parametrize("size, a, b", [(5, 2, 2), (4, 0, 0), (3, 9, 9), (20, 1, 3)])
def test_pools(spark, size, a, b):
    lex_ids, sem_ids = ["l1", "x", "l2", "y", "l3"], ["s1", "y", "s2", "x", "s3", "s4"]
    lex = frame(spark, [("q", i, 1.0, -1.0, n) for n, i in enumerate(lex_ids, 1)], LEX)
    sem = frame(spark, [("q", i, 1.0, 1.0, 1.0, n) for n, i in enumerate(sem_ids, 1)], SEM)
    got = [x.id for x in r.rerank_pool(lex, sem, size, a, b).orderBy("place").collect()]
    assert got == brute_pool(lex_ids, sem_ids, size, a, b)
    floor = [x.id for x in r.lexical_floor_pool(lex, sem, 2, 2).orderBy("place").collect()]
    assert floor == ["s1", "y", "l1", "x"] and r.lexical_floor_pool(lex, sem, 2, 0).count() == 0


def test_queries_without_a_hit_are_searched_by_all_their_tokens(spark):
    units = frame(spark, TEXTS, "id string, heading string, text string")
    q = frame(spark, [("q1", "zzz the and"), ("q2", "frame the"), ("q3", "zzz yyy"), ("q4", "pool")], "query_id string, query string")
    pairs = r.scored_pairs(q, units)
    assert sorted((x.query_id, x.id) for x in pairs.collect()) == [("q1", "a"), ("q2", "b"), ("q4", "a"), ("q4", "c")]
    terms = q.select("query_id", query_tokens("query").alias("terms"), F.array_distinct(raw_tokens("query")).alias("raw"))
    scope = frame(spark, [("a",), ("e",)], "id string")
    got = r.bm25(terms, r.postings(units), units, scope).collect()
    assert sorted((x.query_id, x.id) for x in got) == [("q1", "a"), ("q2", "a"), ("q4", "a")]


def test_pools_of_the_whole_window_overwrite_their_members_only(spark):
    lex = frame(spark, [("q", f"l{n:03}", 1.0 - n / 1000, -1.0, n) for n in range(1, 31)], LEX)
    sem = frame(spark, [("q", f"s{n:03}", 1.0 - n / 1000, 0.25, 0.5, n) for n in range(1, 121)], SEM)
    pool = r._whole_v2(lex, sem)
    assert pool.count() == r.WINDOW == 80 and r._whole_floor(lex, sem).count() == 80 + r.FLOOR
    members = {x.id for x in pool.collect()}
    raw = frame(spark, [("q", i, float(n)) for n, i in enumerate(sorted(members)[:-1], 1)], "query_id string, id string, c double")
    got = {x.id: x.reranker for x in r.rerank_members(r.hybrid(lex, sem), pool, raw).collect()}
    assert len(got) == 150 and all(got[i] == (0.25 if i[0] == "s" else 0.0) for i in got.keys() - members)
    order = sorted(members)
    assert [got[i] for i in order] == [round(n / 79, 6) for n in range(1, 80)] + [0.0]


def test_anchor_cap(spark):
    rows = frame(spark, [("q", f"s{i}", 1.0 - i / 10, i) for i in range(1, 5)], "query_id string, id string, score double, rank int")
    anchors = frame(spark, [("s1", "a"), ("s2", "a"), ("s3", "a"), ("s4", "")], "id string, anchor string")
    assert [x.id for x in r.fuse_modes({"lexical": rows}, anchors).orderBy("rank").collect()] == ["s1", "s2", "s4"]


def test_metrics(spark):
    rows = [("m", "a", 1, True), ("m", "a", 2, False), ("m", "b", 1, False), ("m", "b", 2, True), ("m", "c", 1, False)]
    got = {x.query_id: (x.precision, x.mrr, x.ndcg) for x in r.ir_metrics(frame(spark, rows, "mode string, query_id string, rank int, relevant boolean")).collect()}
    assert got == {"a": (0.5, 1.0, 1.0), "b": (0.5, 0.5, 0.63093), "c": (0.0, 0.0, 0.0)}


def test_labels_and_abstention(spark):
    units = frame(spark, [("u", "", "alpha beta")], "id string, heading string, text string")
    profiles = frame(spark, [("L", t, 4) for t in ("alpha", "beta", "gamma", "delta")], "label string, k string, terms long")
    assert [(x.label, x.score, x.overlap) for x in r.label_scores(units, profiles).collect()] == [("L", 1.0, 2)]
    cases = [("ok", "L", 0.1, 3, "u", 1), ("few", "L", 0.1, 1, "u", 1), ("low", "L", 0.001, 3, "u", 1), ("near", "L", 0.100, 3, "u", 1), ("near", "M", 0.098, 3, "u", 2)]
    proj = frame(spark, cases, "query_id string, label string, score double, hits long, top_id string, place int")
    got = {x.query_id: x.reason for x in r.abstain(frame(spark, [(q,) for q in ("ok", "few", "low", "near", "none")], "query_id string"), proj).collect()}
    assert got == {"ok": "NONE", "few": "INSUFFICIENT_EVIDENCE", "low": "ROW_SCORE_BELOW_THRESHOLD", "near": "LOW_CONFIDENCE_MARGIN", "none": "NO_ROW_SIGNAL"}


def test_vectors_in_blocks(spark):
    rows = frame(spark, [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(50)] + [(99, None), (98, [0.0, 0.0, 0.0])], "id long, vector array<float>")
    q = rows.where("id % 10 = 0").select(F.col("id").alias("query_id"), "vector")
    one = sorted((x.query_id, x.id, round(x.cosine, 9)) for x in r.nearest_vectors(rows, q, k=5).collect())
    two = sorted((x.query_id, x.id, round(x.cosine, 9)) for x in r.nearest_vectors(rows, q, k=5, block_bytes=48).collect())
    assert one == two and len(one) == 25
    assert r.nearest_vectors(rows, q.limit(0), k=5).count() == 0


def test_projection_metrics(spark):
    said = frame(spark, [("both", "a,b"), ("none", ""), ("silent", ""), ("extra", "a"), ("wrong", "z")], "query_id string, labels string")
    want = frame(spark, [("both", "a"), ("both", "c"), ("silent", "a"), ("wrong", "a")], "query_id string, label string")
    got = {x.query_id: (x.precision, x.recall, x.f1, x.row_hit) for x in r.projection_metrics(said, want).collect()}
    assert got == {"both": (0.5, 0.5, 0.5, 1.0), "none": (1.0, 1.0, 1.0, 1.0), "silent": (0.0, 0.0, 0.0, 0.0), "extra": (0.0, 0.0, 0.0, 1.0), "wrong": (0.0, 0.0, 0.0, 0.0)}
