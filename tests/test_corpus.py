"""Sections, statements, chunks, refresh and resolution on small texts."""

import random

import pytest

from quarryline.functions import text as t
from quarryline.operators import corpus as c
from quarryline.operators import resolution as res
from pyspark.sql import functions as F

BODY = "intro\n\n# One {#x}\n\nThe first rule must hold for every value here. It is short. A borrow denotes a loan of a place in memory.\n\n```rust\nlet x = 1;\n```\n\n## Two\n# One\ntail"


def test_sections_and_statements(spark):
    docs = spark.createDataFrame([(1, BODY), (2, "no heading at all, just one long enough sentence"), (3, ""), (4, None)], "doc_id long, text string")
    parts = c.sections(docs)
    got = sorted((r.doc_id, r.heading, r.body[:10]) for r in parts.collect())
    assert got == [(1, "One", "The first "), (1, "One", "tail"), (1, "Two", "Two"), (2, "", "no heading")]
    lines = [(r.sentence_index, r.statement_type) for r in c.statements(parts).where("doc_id = 1").orderBy("order_index", "sentence_index").collect()]
    assert lines == [(1, "constraint"), (2, "definition")]


def test_text_functions(spark):
    df = spark.createDataFrame([("[!NOTE] a `b` <!-- x --> r[items.fn] c[^1]  ```\nq\n```  d",)], "s string")
    row = df.select(t.clean_markup("s").alias("c"), t.slug(F.lit("  A & B! ")).alias("s"), t.slug(F.lit("!!")).alias("e"), t.fold_accents(F.lit("café")).alias("f")).first()
    assert (row.c, row.s, row.e, row.f) == ("a b c d", "a-b", "section", "cafe")
    words = lambda x: F.array(*[F.lit(w) for w in x.split()])
    row = df.select(t.ordered_coverage(words("a b c"), words("x a y b")).alias("o"), F.size(t.ngrams(words("a b c"), 2)).alias("n"), F.size(t.ngrams(words("a"), 2)).alias("z"), t.jaccard(words("a b"), words("b c")).alias("j"), F.transform(words("pointers class bus"), t.singular).alias("p")).first()
    assert (round(row.o, 6), row.n, row.z, round(row.j, 6), row.p) == (0.666667, 2, 0, 0.333333, ["pointer", "class", "bus"])


def words(n, start=0):
    return " ".join(f"w{i}" for i in range(start, start + n))


def chunks(spark, text, least, most, overlap=0.0):
    df = spark.createDataFrame([(1, 1, text)], "doc_id long, order_index int, body string")
    rows = sorted(c.chunk_sections(df, least, most, overlap).collect(), key=lambda r: r.order_index)
    assert [r.order_index for r in rows] == list(range(1, len(rows) + 1))
    return [(r.clean_text, r.token_len) for r in rows]


def test_chunk_packing(spark):
    blocks = "\n\n".join(words(30, 100 * i) for i in range(4))
    assert [n for _, n in chunks(spark, blocks, 50, 100)] == [60, 60]
    lapped = chunks(spark, blocks, 50, 100, 0.2)
    assert [n for _, n in lapped] == [60, 60, 60, 30] or lapped[1][0].startswith(words(30, 100))
    big = chunks(spark, " ".join(f"{words(40, 100 * i)}. Z" for i in range(4)), 40, 60)
    assert len(big) > 1 and all(n <= 62 for _, n in big)
    assert chunks(spark, "", 50, 100) == [] and chunks(spark, "``` x ```", 50, 100) == [] and chunks(spark, None, 50, 100) == []
    assert chunks(spark, "one\u00a0two", 40, 60) == [("one two", 2)]


def walked(sizes, most, least=None, full=None, again=0):
    """The same spans item by item."""
    out, begin = [], 0

    def restart(b, e):
        while b < e and (not again or sum(sizes[b + 1 : e]) >= again):
            b += 1
        return b

    for i in range(len(sizes)):
        if begin < i and (sum(sizes[begin : i + 1]) > most or full is not None and sum(sizes[begin:i]) >= full):
            out.append((begin, i))
            begin = restart(begin, i)
        if least is not None and sum(sizes[begin : i + 1]) >= least:
            out.append((begin, i + 1))
            begin = restart(begin, i + 1)
    return out + ([(begin, len(sizes))] if begin < len(sizes) and out[-1:] != [(begin, len(sizes))] else [])


@pytest.mark.parametrize("bounds", [{"most": 100, "least": 50}, {"most": 100, "least": 50, "again": 20}, {"most": 60}, {"most": 90, "full": 40}, {"most": 50, "least": 40, "again": 22}])
def test_spans_by_running_sums(spark, bounds):
    rng = random.Random(11)
    rows = [(i, [rng.randrange(1, 60) for _ in range(rng.randrange(0, 14))]) for i in range(200)]
    got = {r.i: [tuple(x) for x in r.x] for r in spark.createDataFrame(rows, "i int, s array<int>").select("i", c.cut_spans(F.col("s"), **bounds).alias("x")).collect()}
    assert got == {i: walked(s, **bounds) for i, s in rows}


def test_paragraph_packing(spark):
    text = "\n\n".join(words(20, 100 * i) for i in range(4))
    of = lambda t: spark.createDataFrame([(t,)], "t string").select(c.pack_paragraphs("t", 5, 40, 60).alias("x")).first().x
    assert [len(x.split("\n\n")) for x in of(text)] == [2, 2]
    assert [len(x.split("\n\n")) for x in of(text + "\n\nend")] == [2, 3]
    assert of("  ") == [""]


def test_fences_are_whole(spark):
    text = "one\n\ntwo\n```rust\na\n\nb\n```\nthree\n \n  ```\nopen\n\nend"
    got = spark.createDataFrame([(text,), ("",), (None,)], "t string").select(t.fenced_blocks("t").alias("b")).collect()
    assert [r.b for r in got] == [["one", "two", "```rust\na\n\nb\n```", "three", "```\nopen\n\nend"], [], None]


@pytest.mark.parametrize("key", ["added", "updated", "deleted", "unchanged"])
def test_delta_of_three(spark, key):
    old = spark.createDataFrame([("a", "1"), ("b", "1"), ("gone", "1"), ("n", None)], "k string, h string")
    new = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "1"), ("n", None)], "k string, h string")
    delta, after = c.refresh(old, new, "k", "h")
    want = {"added": {"c"}, "updated": {"b"}, "deleted": {"gone"}, "unchanged": {"a", "n"}}
    assert {r.k for r in delta.where(F.col("delta") == key).collect()} == want[key]
    assert sorted(map(tuple, after.collect()), key=str) == sorted(map(tuple, new.collect()), key=str)


def test_similar_pairs_are_all_found(spark):
    import random

    rng = random.Random(1)
    sets = [(str(i), sorted({rng.choice("abcdefghijkl") for _ in range(rng.randrange(1, 8))})) for i in range(60)] + [("empty", [])]
    want = sorted((a, b) for a, x in sets for b, y in sets if a < b and x and y and len(set(x) & set(y)) / len(set(x) | set(y)) >= 0.4)
    got = sorted((r.left_id, r.right_id) for r in res.similar_pairs(spark.createDataFrame(sets, "id string, tokens array<string>"), 0.4).collect())
    assert got == want


def test_phrases(spark):
    df = spark.createDataFrame([("raw pointers to data", "Use raw pointers to data here"), ("raw pointers to data", "data about a raw thing"), ("", "x")], "p string, t string")
    got = [r[0] for r in df.select(res.phrase_score(F.col("p"), F.col("t"))).collect()]
    assert got[0] == 1.0 and 0 < got[1] < 0.5 and got[2] == 0.0


def test_stages(spark):
    rows = [("g", "p1", ["global"], 0.9, 0.5, True), ("g", "p2", ["section", "document", "global"], 0.3, 0.5, True), ("h", "p3", ["global"], 0.5, 0.5, True), ("h", "p4", ["global"], 0.48, 0.5, True), ("i", "p5", ["global"], 0.1, 0.0, False)]
    got = {r.guideline_id: (r.stage, r.paragraph_id, r.decision) for r in res.resolve(spark.createDataFrame(rows, "guideline_id string, paragraph_id string, stages array<string>, total double, text_overlap double, eligible boolean")).collect()}
    assert got == {"g": ("section", "p2", "accepted"), "h": ("global", "p3", "review"), "i": ("global", "p5", "none")}


def greedy(rows, take=5, cap=2):
    """From the best on, one by one, the cap raised whenever nothing fits."""
    left, out, used = sorted(rows, key=lambda r: (-r[3], r[1])), [], {}
    while left and len(out) < take:
        fit = next((r for r in left if used.get(r[2], 0) < cap), None)
        if fit is None:
            cap += 1
            continue
        left.remove(fit)
        out.append(fit[1])
        used[fit[2]] = used.get(fit[2], 0) + 1
    return out


def test_diversified(spark):
    rng = random.Random(2)
    rows = [("g", k, d, float(t)) for k, d, t in zip("abcdef", ["d"] * 4 + ["e", "f"], range(6, 0, -1), strict=True)]
    rows += [(f"r{i}", f"p{k}", rng.choice("xyz"), float(rng.randrange(4))) for i in range(30) for k in range(rng.randrange(1, 9))]
    got = {}
    for r in res.diversified(spark.createDataFrame(rows, "guideline_id string, paragraph_id string, document_link string, total double")).orderBy("place").collect():
        got.setdefault(r.guideline_id, []).append(r.paragraph_id)
    assert got["g"] == ["a", "b", "e", "f", "c"] and got == {g: greedy([r for r in rows if r[0] == g]) for g in {r[0] for r in rows}}


def test_merge_modes(spark):
    rows = [("k", "lexical", "long one", None), ("k", "hybrid", "short", "ab"), ("k", "semantic", "other", "cd"), ("m", "lexical", " ", "")]
    got = {r.k: (r.x, r.y, r.conflicts) for r in res.merge_modes(spark.createDataFrame(rows, "k string, mode string, x string, y string"), "k", ["x", "y"]).collect()}
    assert got == {"k": ("long one", "ab", 2), "m": (None, None, 0)}
