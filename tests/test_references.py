"""Orphans by kind, their children, and circles among tables."""

from datetime import datetime

from pyspark.sql import functions as F

from quarryline.functions.cleaning import id_or_null
from quarryline.operators.references import ForeignKey, link_target, orphan_cascade

T1, T2 = datetime(2024, 1, 5), datetime(2024, 2, 5)
CHILD = "k string, ref string, delivered_at timestamp_ntz"
PARENT = "id string, delivered_at timestamp_ntz, removed_at timestamp_ntz"


def direct():
    return ForeignKey("child", id_or_null("k"), link_target("ref"), "parent", id_or_null("id"))


def run(spark, children, parents, inherited=(), **more):
    c = spark.createDataFrame(children, CHILD).withColumns({"gone": F.lit(1), "arrived": F.lit("clash"), "row_key": F.lit(0)})
    tables = {"child": c, "parent": spark.createDataFrame(parents, PARENT), **more}
    return sorted((r.source_table, r.row_key, r.orphan_kind, r.orphan_month, r.depth) for r in orphan_cascade(tables, [direct()], list(inherited)).collect())


def test_kinds(spark):
    children = [("a", "p1", T1), ("b", " p1 ", T1), ("c", "doc.html#p2", T1), ("d", "nope", T2), ("d", "nope", T1), ("e", "p3", T1), ("f", None, T1), ("g", " ", T1), ("h", "fls_UNRESOLVED", T1), (None, "x", T1), ("i", "P1", T1), ("j", "nope", None)]
    parents = [("p1", T1, None), ("p1", T2, T2), ("p2", T1, T2), (" p2", T1, T2), ("p3", T2, None), (None, T1, None)]
    assert run(spark, children, parents) == [("child", "c", "deleted", "2024-01", 0), ("child", "d", "missing", "2024-01", 0), ("child", "e", "late", "2024-01", 0), ("child", "i", "missing", "2024-01", 0), ("child", "j", "missing", None, 0)]


def test_empty(spark):
    assert run(spark, [], []) == []
    assert run(spark, [("a", "p", T1)], []) == [("child", "a", "missing", "2024-01", 0)]


def test_children_of_orphans(spark):
    grand = spark.createDataFrame([("g1", "a", T2), ("g2", "ok", T1), ("g1", "a", T1)], CHILD)
    great = spark.createDataFrame([("h1", "g1", T2)], CHILD)
    keys = [ForeignKey("grand", id_or_null("k"), id_or_null("ref"), "child", id_or_null("k")), ForeignKey("great", id_or_null("k"), id_or_null("ref"), "grand", id_or_null("k"))]
    got = run(spark, [("a", "nope", T1), ("ok", "p", T1)], [("p", T1, None)], keys, grand=grand, great=great)
    assert got == [("child", "a", "missing", "2024-01", 0), ("grand", "g1", "inherited", "2024-01", 1), ("great", "h1", "inherited", "2024-02", 2)]


def test_circle_ends(spark):
    loop = ForeignKey("child", id_or_null("k"), id_or_null("ref"), "child", id_or_null("k"))
    got = run(spark, [("a", "nope", T1), ("b", "a", T1), ("c", "b", T1), ("x", "p", T1)], [("p", T1, None), ("a", T1, None), ("b", T1, None)], [loop])
    assert got == [("child", "a", "missing", "2024-01", 0), ("child", "b", "inherited", "2024-01", 1), ("child", "c", "inherited", "2024-01", 2)]


def test_chain_deeper_than_fifty(spark):
    loop = ForeignKey("child", id_or_null("k"), id_or_null("ref"), "child", id_or_null("k"))
    names = [f"n{i:02d}" for i in range(54)]
    rows = [(k, "nope" if i == 0 else names[i - 1], T1) for i, k in enumerate(names)]
    got = run(spark, rows, [(k, T1, None) for k in names], [loop])
    assert [(x[1], x[4]) for x in got] == [(k, i) for i, k in enumerate(names)]


def test_wide_chain(spark):
    """Thirty levels of a table that refers to itself, seven chains side by side."""
    loop = ForeignKey("child", id_or_null("k"), id_or_null("ref"), "child", id_or_null("k"))
    rows = [(f"n{i:03d}x{w}", "nope" if i == 0 else f"n{i - 1:03d}x{w}", T1) for i in range(30) for w in range(7)]
    got = run(spark, rows, [(k, T1, None) for k, _, _ in rows], [loop])
    assert len(got) == 210 and {x[4] for x in got} == set(range(30))


def test_the_parent_of_an_inherited_orphan_is_named(spark):
    two = spark.createDataFrame([("g", "b", T1), ("g", "a", T2)], CHILD)
    keys = [ForeignKey("grand", id_or_null("k"), id_or_null("ref"), "child", id_or_null("k"))]
    c = spark.createDataFrame([("a", "nope", T1), ("b", "nope", T1)], CHILD)
    rows = orphan_cascade({"child": c, "parent": spark.createDataFrame([], PARENT), "grand": two}, [direct()], keys).where("depth = 1").collect()
    assert [(r.row_key, r.inherited_from, r.inherited_key, r.orphan_month) for r in rows] == [("g", "child", "a", "2024-01")]


def test_hot_parent(spark):
    children = [(f"k{i}", "hot" if i % 3 else "nope", T1) for i in range(600)]
    assert len(run(spark, children, [("hot", T1, None)])) == 200
