"""Pieces of texts: limits, overlaps, natural ends, nothing lost."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarryline.llm import splitting as s

words = st.text(alphabet="abcé.!?-*#1\U0001f600", min_size=1, max_size=30)
texts = st.lists(words | st.sampled_from(["\n\n", "\n", ". ", "\r\n", "\t", "- ", "# H\n", "x" * 90, "y" * 45]), max_size=80).map(lambda p: " ".join(p).strip(" \t\r\n"))


@settings(max_examples=400, deadline=None)
@given(texts, st.integers(20, 80), st.integers(0, 10))
def test_pieces(text, limit, overlap):
    pieces = s.split_text(text, limit, overlap)
    assert (not pieces) == (text == "")
    at = 0
    runs = [len(w) for w in __import__("re").split("[ \t\r\n]+", text)]
    for i, (start, end, fresh, cut) in enumerate(pieces):
        assert 0 < end - start <= limit and start <= fresh < end
        assert text[at:fresh].strip(" \t\r\n") == "" and fresh >= at
        if i:
            assert pieces[i - 1][0] < start and pieces[i - 1][1] - start <= overlap
        if cut not in ("end", s.CHARACTER):
            assert text[end] in " \t\r\n"
        at = end
    assert at == len(text)
    assert any(p[3] == s.CHARACTER for p in pieces) == (max(runs) > limit and len(text) > limit)


def test_natural_ends():
    para = "One sentence here. Another one there. " * 8
    pieces = s.split_text(f"{para}\n\n{para}\n\n{para}".strip(), 400, 40)
    assert [p[3] for p in pieces][0] == "paragraph" and pieces[-1][3] == "end"
    lines = "\n".join(f"- item number {i} of the list" for i in range(40))
    assert {p[3] for p in s.split_text(lines, 200, 20)[:-1]} == {"list"}
    assert s.split_text("a" * 1200) == [(0, 1200, 0, "end")] and len(s.split_text("a" * 1201)) == 2


def test_overlap_is_near_its_size():
    text = " ".join(f"word{i}" for i in range(2000))
    pieces = s.split_text(text)
    assert all(100 < a[1] - b[0] <= 120 for a, b in zip(pieces, pieces[1:], strict=False))


def test_frame(spark):
    rows = [("a", "x " * 1000), ("b", "y" * 3000), ("c", "short"), ("d", None), ("e", ""), ("f", "  " + "z" * 1200 + "\n"), (None, "w " * 900), ("a", "x " * 1000)]
    df = spark.createDataFrame(rows, "k string, t string").withColumns({"_text": F.lit("clash"), "piece": F.lit(1)})
    got = s.split_items(df, ["k"], "t")
    assert {r.k for r in got.collect()} == {"a", "b", None}
    assert s.split_items(df.limit(0), ["k"], "t").count() == 0
    one = got.where("k = 'b'").orderBy("piece_no").collect()
    assert "".join(r.piece[r.fresh - r.start :] for r in one) == "y" * 3000 and {r.cut for r in one} == {"character", "end"}


def test_sql(same_as_sql):
    same_as_sql(s.p2_found, s.ORACLES["p2_found"])


def test_very_long_text():
    text = "lorem ipsum dolor. " * 50_000
    assert len(s.split_text(text.strip())) > 700


def test_the_last_delivery_counts(spark):
    from datetime import datetime

    t1, t2 = datetime(2024, 1, 1), datetime(2024, 2, 1)
    rows = [("corrected", "a" * 2000, t1), ("corrected", "short", t2), ("grown", "short", t1), ("grown", "b " * 900, t2), ("padded", "c" + " " * 3000, t1), ("twice", "d" * 1500, t1), ("twice", "e" * 1500, t1), (None, "f" * 2000, t1), ("null", None, t2), ("undated", "g" * 1300, None)]
    df = spark.createDataFrame(rows, "k string, text string, delivered_at timestamp_ntz")
    got = {r.k: r.text[:1] for r in s.last_long(df, ["k"], "text", "delivered_at").collect()}
    assert got == {"grown": "b", "twice": "e", "undated": "g"}
    assert s.last_long(df.limit(0), ["k"], "text", "delivered_at").count() == 0
