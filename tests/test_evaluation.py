"""Common rows, relevance, retries and gates on a few rows."""

from pyspark.sql import functions as F

from quarryline.operators import evaluation as e


def test_common_rows(spark):
    df = spark.createDataFrame([("s", "Said", "u", "Chunk", " a, ,b", None, -2.0), (None, None, "u", "Chunk text", None, 1, None)], "statement_id string, statement_text string, chunk_uid string, chunk_text string, row_markers string, phrase_match int, bm25_raw double")
    one, two = e.common_rows(df, F.array(F.lit("chunk"), F.lit("said"))).collect()
    assert (one.statement_id, one.chunk_uid, one.statement_text, one.chunk_text, one.row_markers, one.lexical_score, one.phrase_match, one.token_overlap_count) == ("s", "s", "Said", "Said", ["a", "b"], 2.0, 0, 1)
    assert (two.statement_id, two.statement_text, two.row_markers, two.mechanism_ids, two.lexical_score, two.section_heading, two.token_overlap_count) == ("u", "Chunk text", [], [], 0.0, "", 1)
    plain = e.common_rows(spark.createDataFrame([("x",)], "statement_text string"))
    assert "chunk_uid" not in plain.columns and not set(e.without_scores(plain).columns) & set(e.SCORE_COLUMNS) and e.without_scores(plain, True).columns == plain.columns
    assert e.common_rows(df.limit(0)).count() == 0


def test_relevance(spark):
    schema = "statement_id string, source_anchor string, row_markers array<string>, statement_text string, relevant_statement_ids array<string>, relevant_anchor_prefixes array<string>, expected_row_markers array<string>, relevant_terms array<string>"
    row = ("i", "src/a#x", ["A1"], "Must not alias")
    cases = [
        ((["i"], [], [], []), True), (([], ["src/"], [], []), True), (([], ["", None], [], []), False), (([], [], ["a1"], []), True), (([], [], ["b"], []), False), (([], [], ["a1"], ["alias"]), True),
        (([], [], ["b"], ["alias"]), False), (([], [], [], ["alias"]), True), (([], [], ["a1"], ["", None]), True), (([], ["x"], ["a1"], []), False), ((None, None, None, None), False), (([], [], [], []), False),
    ]
    df = spark.createDataFrame([(*row, *p) for p, _ in cases], schema)
    assert [r.x for r in df.select(e.relevant().alias("x")).collect()] == [w for _, w in cases]
    nothing = spark.createDataFrame([(None, None, None, None, ["i"], ["a"], ["b"], ["c"])], schema)
    assert not nothing.select(e.relevant().alias("x")).first().x


def test_retries(spark):
    schema = "mode string, events array<struct<retry_count:int, status:string>>"
    df = spark.createDataFrame([("a", [(1, "pass"), None, (2, "fail")]), ("a", None), ("b", [])], schema)
    assert sorted(map(tuple, e.retry_summary(df).collect())) == [("a", 2, 3, 1), ("b", 0, 0, 0)]
    assert e.retry_summary(df.limit(0)).count() == 0


def test_gates(spark):
    schema = "query_id long, mode string, slice string, focus boolean, precision double, mrr double, ndcg double, row_hit double"
    cases = spark.createDataFrame([(1, "lexical", "main", True, 0.6, 0.7, 0.9, 1.0), (1, "hybrid", "main", True, 0.7, 0.6, 0.5, 1.0), (2, "lexical", "edge", False, 0.4, 0.7, 0.9, 0.0)], schema)
    own = spark.createDataFrame([(2, "lexical", "precision", 0.5), (9, "lexical", "mrr", 0.1)], "query_id long, mode string, metric string, least double")
    got = {(r.gate, r.subject): (r.value, r.passed, r.blocking) for r in e.gates(e.means(cases), cases, own).collect()}
    assert got["mode", "lexical.precision"] == (0.5, False, True) and got["mode", "lexical.mrr"] == (0.7, True, True) and got["hybrid_vs_best_single", "all"] == (0.6, False, True)
    assert got["slice", "edge.lexical.row_hit"] == (0.0, False, True) and got["prompt", "2.lexical.precision"] == (0.4, False, True) and got["checkpoint", "hybrid.precision"] == (0.7, True, True)
    assert not any(g in ("focus", "semantic_vs_lexical") for g, _ in got) and ("hybrid_vs_best_single", "edge") not in got
    assert e.gates(e.means(cases.limit(0)), cases).count() == 0
