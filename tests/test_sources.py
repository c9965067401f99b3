"""Readers, writers, streams, contracts, rewriting and settings on files of a few lines."""

import hashlib
import json
import sqlite3
import time

import pytest
from pyspark.sql import functions as F

from quarryline.plans import contracts as k
from quarryline.plans.rewrite import rewrite
from quarryline.sources import readers as s
from quarryline.sources import sinks
from quarryline.sources.config import resolve_config
from quarryline.streaming.refresh import refresh_documents, windowed_counts


def test_markdown_tree(spark, tmp_path):
    (tmp_path / "SUMMARY.md").write_text("# Summary\n- [Intro](intro.md)\n- [Types](types.md)\n  - [Enums](types/enums.md)\n- [Gone](gone.md)\n- [Again](intro.md)\n")
    (tmp_path / "types").mkdir()
    for name in ("intro.md", "types.md", "types/enums.md"):
        (tmp_path / name).write_text(f"# {name}\n")
    got = [(r.rel_path, r.title, r.chapter, r.doc_order) for r in s.read_markdown_tree(spark, str(tmp_path)).orderBy("doc_order").collect()]
    assert got == [("intro.md", "Intro", "Intro", 1), ("types.md", "Types", "Types", 2), ("types/enums.md", "Enums", "Types", 3)]


def test_rustdoc(spark, tmp_path):
    doc = {"index": {"1": {"name": "A", "docs": " Doc. ", "attrs": ["#[unstable]"], "inner": {"struct": {"x": 1}}}, "2": {"name": "B", "docs": "", "inner": {"enum": {}}}, "3": {"name": "C", "docs": "d", "inner": {"macro": "m"}}, "4": {"name": "D", "docs": "d", "attrs": None, "inner": {"trait": {}}}}, "paths": {"1": {"path": ["core", "a", "A"]}}}
    (tmp_path / "core.json").write_text(json.dumps(doc))
    got = sorted((r.item_path, r.item_kind, r.stability) for r in s.read_rustdoc_json(spark, str(tmp_path / "core.json"), "x86").collect())
    assert got == [("D", "trait", "unspecified"), ("core::a::A", "struct", "unstable")]


def test_rst(spark, tmp_path):
    (tmp_path / "a.rst").write_text("Types\n=====\n\n:dp:`fls_a1`\nA :dt:`[type]s <kind>` is ``x``\nand :t:`more`.\n\n.. code:: rust\n\n   skip\n\n:dp:`fls_b2` Second :std:`core::A`.\n\nNext\n----\n")
    got = {r.paragraph_id: r for r in s.read_rst_spec(spark, str(tmp_path / "*.rst")).collect()}
    assert got["fls_a1"].clean_text == "A types <kind> is x and more." and got["fls_a1"].chapter == "Types"
    assert [(x.text, x.target) for x in got["fls_a1"].defined_terms] == [("types", "kind")] and [x.text for x in got["fls_a1"].term_refs] == ["more"]
    assert got["fls_b2"].clean_text == "Second core::A." and [x.text for x in got["fls_b2"].std_refs] == ["core::A"]


def test_needs_topology_jsonl(spark, tmp_path):
    (tmp_path / "needs.json").write_text(json.dumps({"needs": {"g": {"title": "T", "content": "a\n\nb\n \nc", "category": "x", "docname": "d"}}}))
    (tmp_path / "ids.json").write_text(json.dumps({"g": "p.html#g"}))
    rows = s.read_needs(spark, str(tmp_path / "needs.json"), str(tmp_path / "ids.json"))
    assert [r.content for r in s.needs_blocks(rows).orderBy("order_index").collect()] == ["a", "b", "c"]
    (tmp_path / "ids.json").write_text(json.dumps({"g": "p", "h": "q"}))
    with pytest.raises(ValueError):
        s.read_needs(spark, str(tmp_path / "needs.json"), str(tmp_path / "ids.json"))
    (tmp_path / "t.json").write_text(json.dumps({"documents": [{"link": "d", "sections": [{"link": "d#s", "paragraphs": [{"id": "p"}, {"id": "q"}]}]}]}))
    assert [(r.paragraph_id, r.paragraph_ordinal) for r in s.read_topology(spark, str(tmp_path / "t.json")).collect()] == [("p", 0), ("q", 1)]
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n\nnot json\n{"a": 2}\n')
    assert [r.a for r in s.read_jsonl(spark, str(tmp_path / "l.jsonl"), "a int").collect()] == [1, 2]
    with pytest.raises(Exception, match="(?i)malformed"):
        s.read_jsonl(spark, str(tmp_path / "l.jsonl"), "a int", strict=True).collect()


def test_prompts_and_sqlite(spark, tmp_path):
    p = tmp_path / "p.yaml"
    p.write_text("prompts:\n- {prompt_id: a, slice: main, query_text: q, relevant_terms: [x]}\n- {prompt_id: b, query_text: r, modes: [lexical], expect_abstain: true}\n")
    assert [(r.prompt_id, r.modes) for r in s.read_prompt_suite(spark, str(p)).orderBy("prompt_id").collect()] == [("a", ["lexical", "semantic", "hybrid"]), ("b", ["lexical"])]
    for bad in ("{prompt_id: a, query_text: q}", "{prompt_id: a, modes: [psychic], relevant_terms: [x]}", "{query_text: q}"):
        p.write_text(f"prompts:\n- {bad}\n")
        with pytest.raises(ValueError):
            s.read_prompt_suite(spark, str(p))
    with sqlite3.connect(tmp_path / "x.db") as db:
        db.execute("CREATE TABLE t (a INTEGER, b TEXT)")
        db.executemany("INSERT INTO t VALUES (?, ?)", [(1, "x"), (2, None), (None, "z")])
    read = lambda sql, **more: sorted(map(str, map(tuple, s.read_sqlite(spark, str(tmp_path / "x.db"), sql, "a long, b string", **more).collect())))
    assert read("SELECT a, b FROM t") == read("SELECT a, b FROM t", rows=1) == ["(1, 'x')", "(2, None)", "(None, 'z')"] and read("SELECT a, b FROM t WHERE a > 9") == []


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_versions(spark, tmp_path, scheme):
    t = sinks.VersionedTable(f"{scheme}{tmp_path}/t")
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    with pytest.raises(FileNotFoundError):
        t.read(spark)
    assert t.write(one) == "v000001"
    assert t.upsert(spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string"), ["k"]) == "v000002"
    assert sorted(map(tuple, t.read(spark).collect())) == [(1, "a"), (2, "B"), (3, "c")]
    with pytest.raises(ValueError):
        t.write(one.limit(0), check=lambda df: df.count() > 0)
    assert t.current() == "v000002" and t.roll_back() == "v000001" and t.read(spark).count() == 2


def test_merges_write_what_they_touch(spark, tmp_path):
    t = sinks.MergedTable(f"file://{tmp_path}/m", ["k"], 8)
    df = lambda rows: spark.createDataFrame(rows, "k int, v string")
    with pytest.raises(FileNotFoundError):
        t.read(spark)
    assert t.merge(df([])) is None and t.merge(df([(i, "old") for i in range(100)])) == "manifest-000001.json"
    first = t._held()
    assert len(first) == 8 and t.merge(df([(7, "new"), (200, "new")]), gone=df([(8, ""), (999, "")])) == "manifest-000002.json"
    second = t._held()
    changed = {b for b in second if second[b] != first.get(b)}
    assert 1 <= len(changed) <= 4 and {b: second[b] for b in first if b not in changed} == {b: n for b, n in first.items() if b not in changed}
    got = {r.k: r.v for r in t.read(spark).collect()}
    assert len(got) == 100 and got[7] == got[200] == "new" and 8 not in got and got[9] == "old"
    assert t.roll_back() == "manifest-000001.json" and {r.v for r in t.read(spark).collect()} == {"old"}
    with pytest.raises(ValueError):
        t.roll_back()


def test_other_sinks(spark, tmp_path):
    v = spark.createDataFrame([("a", "m", "1", "h", [3.0, 4.0])] * 2, "id string, model string, version string, text_sha256 string, vector array<float>")
    sinks.write_vectors(v, str(tmp_path / "v"))
    sinks.write_vectors(v, str(tmp_path / "v"))
    assert [r.norm for r in spark.read.parquet(str(tmp_path / "v")).collect()] == [5.0]
    assert json.loads(open(sinks.write_report(tmp_path / "r", "x.json", {"b": 1, "a": 2})).read()) == {"a": 2, "b": 1}
    assert sinks.markdown_table(spark.createDataFrame([(1, "a|b"), (2, None)], "n int, s string").orderBy("n")).splitlines()[2:] == ["| 1 | a\\|b |", "| 2 |  |"]
    records = spark.createDataFrame([("g", "Title", "ch"), ("h", None, " "), ("i", "Third", "ch")], "guideline_id string, title string, chapter string")
    blocks = spark.createDataFrame([("g", 2, "two"), ("g", 1, "one"), ("none", 1, "lost")], "guideline_id string, order_index int, content string")
    cited = spark.createDataFrame([("g", "B", "second"), ("g", "A", "first"), ("g", "A", "first")], "guideline_id string, key string, text string")
    sinks.export_texts(records, blocks, str(tmp_path / "x"), cited)
    files = {p.parent.name: p.read_text() for p in (tmp_path / "x" / "texts").glob("*/*/*.txt")}
    assert len(files) == 3 and files["guideline_id=g"] == "Title\n=====\n\none\n\ntwo\n\nBibliography\n------------\n\n.. [A] first\n.. [B] second\n" and (tmp_path / "x" / "texts" / "chapter=general" / "guideline_id=h").exists()
    assert {r.guideline_id: r.sha256 for r in spark.read.json(str(tmp_path / "x" / "manifest")).collect()}["g"] == hashlib.sha256(files["guideline_id=g"].rstrip("\n").encode()).hexdigest()


def test_streams(spark, tmp_path):
    inbox, target = tmp_path / "in", sinks.MergedTable(tmp_path / "t", ["k"], 4)
    schema = "k int, h string, text string"

    def arrive(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(inbox))
        refresh_documents(spark.readStream.schema(schema).json(str(inbox)), target, "h", str(tmp_path / "c")).awaitTermination(120)

    arrive((1, "x", "one"), (2, "y", "two"))
    arrive((2, "z", "TWO"), (3, "w", "three"))
    assert sorted((r.k, r.text) for r in target.read(spark).collect()) == [(1, "one"), (2, "TWO"), (3, "three")]
    before = target.current()
    arrive((3, "w", "three"))
    assert target.current() == before
    events = spark.createDataFrame([("2024-01-01 00:01:00", "a", 1.0), ("2024-01-01 00:04:59", "a", 2.0), ("2024-01-01 00:05:00", "a", 4.0)], "ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    assert sorted((str(r.start), r.n, r.total) for r in windowed_counts(events).collect()) == [("2024-01-01 00:00:00", 2, 3.0), ("2024-01-01 00:05:00", 1, 4.0)]


def test_contract_guard(spark, tmp_path):
    spark.range(10).createOrReplaceTempView("numbers")
    spec = k.QuerySpec("q", "SELECT id FROM numbers WHERE id >= :least ORDER BY id", ("least",), requires_order=True)
    assert [r.id for r in k.run_contract(spark, spec, {"least": 5}, limit=3).collect()] == [5, 6, 7]
    bad = [
        (k.QuerySpec("d", "DROP TABLE numbers"), {}, None), (k.QuerySpec("r", "SELECT replace('a', 'a', 'b') AS x"), {}, None), (k.QuerySpec("o", "SELECT id FROM numbers", requires_order=True), {}, None),
        (k.QuerySpec("i", "SELECT id FROM (SELECT id FROM numbers ORDER BY id LIMIT 3)", requires_order=True), {}, None), (k.QuerySpec("u", "SELECT id FROM numbers WHERE id > :hidden"), {}, None), (k.QuerySpec("n", "SELECT id FROM numbers", ("unused",)), {"unused": 1}, None),
        (spec, {}, None), (spec, {"least": 1, "more": 2}, None), (spec, {"least": 1}, 0), (spec, {"least": 1}, 5001), (k.QuerySpec("c", "CACHE TABLE numbers"), {}, None), (k.QuerySpec("s", "SELEC 1"), {}, None),
    ]
    for s_, params, limit in bad:
        with pytest.raises(k.GuardError):
            k.run_contract(spark, s_, params, limit)
    few = k.QuerySpec("f", "SELECT id FROM numbers WHERE id <> length(':no') ORDER BY id", (), 4, True)
    assert [r.id for r in k.run_contract(spark, few).collect()] == [0, 1, 2, 4] and k.run_contract(spark, few, limit=2).count() == 2
    assert k.run_contract(spark, k.QuerySpec("l", "WITH n AS (SELECT id FROM numbers) SELECT id FROM n ORDER BY id LIMIT 6", (), 4, True)).count() == 6
    assert k.run_contract(spark, k.QuerySpec("s", "SELECT id FROM numbers WHERE id IN (SELECT id FROM numbers LIMIT 9) ORDER BY id", (), 4, True)).count() == 4
    path = tmp_path / "c.yaml"
    path.write_text("defaults: {row_limit: 7}\nqueries:\n  a: {sql: 'SELECT 1 AS x', params: []}\n")
    assert k.load_specs(path)["a"].row_limit == 7
    line = json.loads(k.log_query(tmp_path / "log", spec, {"least": "secret"}, 3, time.time()).read_text())
    assert line["params"] == ["least"] and "secret" not in json.dumps(line)


def test_rewrite(spark):
    rules = {"strategy": "v2", "token_expansions": {"ptr": ["pointer", "raw"]}, "suppress_tokens_when_present": {"safe": ["unsafe"]}, "row_marker_terms": {"1a": ["subset"]}, "mode_terms": {"lexical": ["lex"]}, "mode_specific_rules": {"semantic": {"semantic_intent_prefix": "Find", "token_expansions": {"ptr": ["address"]}}}}
    q = spark.createDataFrame([("q", "Unsafe  safe ptr", "1A", "semantic"), ("q", "Unsafe  safe ptr", "1A", "lexical"), ("n", None, None, "lexical"), ("d", "ptr ptr raw", "x", "lexical"), ("p", " ?! ", "x", "other")], "query_id string, query string, marker string, mode string")
    got = {(r.query_id, r.mode): r for r in rewrite(q, rules).collect()}
    assert got["q", "semantic"].rewritten == "find unsafe ptr pointer raw subset address" and got["q", "semantic"].tags == ["v2", "token-suppression", "token-expansion", "row-marker-terms", "mode-specific-token-expansion", "semantic-intent-prefix"]
    assert got["q", "lexical"].added == ["pointer", "raw", "subset", "lex"] and got["n", "lexical"].rewritten == "lex" and got["d", "lexical"].rewritten == "ptr ptr raw pointer lex" and got["p", "other"].rewritten == "?!"
    assert {r.rewritten for r in rewrite(q.limit(1), rules, enabled=False).collect()} == {"Unsafe safe ptr"} and rewrite(q.limit(0), rules).count() == 0


def test_settings():
    c = resolve_config({"top_k": None}, {"top_k": 3, "lexical_floor_share": 7}, {"top_k": 9, "candidate_limit": 99999})
    assert (c.top_k, c.candidate_limit, c.lexical_floor_share, c.window) == (3, 5000, 1.0, 64)
    with pytest.raises(ValueError):
        resolve_config({"top": 1})
