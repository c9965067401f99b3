"""Prose, surprise and grades against plain Python."""

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarryline.llm import reading as r


def brute(text):
    prose = re.sub(r"(?ms)^```.*?^```[^\n]*$", "\n\n", text)
    words = re.findall(r"[A-Za-z0-9]+", prose)
    pieces = re.split(r"[.!?](?=[ \t\r\n]|\Z)|\n[ \t\r]*(?=\n)", prose)
    return len(words), sum(map(len, words)), sum(bool(re.search(r"[A-Za-z0-9]", p)) for p in pieces)


parts = st.sampled_from(["word", "a1", "don't", ". ", "! ", "?", "...", "\n", "\n\n", "\n \t\n", "\r\n", "```\n", "\n```rust\n", "``", "é", " ", "3.14", "end.", "```"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(parts, max_size=25).map("".join), max_size=6))
def test_counts(texts):
    if not texts:
        return
    p = r.Prose([t.encode() for t in texts])
    assert list(zip(p.words.tolist(), p.chars.tolist(), p.sentences.tolist(), strict=True)) == [brute(t) for t in texts]


def test_texts_do_not_touch_each_other():
    texts = [b"The cat sat. It ran", b"", b"dogs! \n\nbark", b"...", b"caf\xc3\xa9 x"]
    model = r.interpolated_bits(np.bincount(r.Prose(texts).codes(), minlength=r.SYMBOLS**r.ORDER))
    whole = r.measure(texts, model)
    for i, t in enumerate(texts):
        alone = r.measure([t], model)
        for m in r.MEASURES:
            assert np.array_equal(alone[m][0], whole[m][i], equal_nan=True), m


def test_model_is_a_distribution():
    counts = np.bincount(r.Prose([b"the cat sat on the mat. the dog sat."]).codes(), minlength=r.SYMBOLS**r.ORDER)
    bits = r.interpolated_bits(counts)
    assert np.allclose((2.0 ** -bits.reshape(-1, r.SYMBOLS).astype(float)).sum(1), 1, atol=1e-4)
    empty = r.interpolated_bits(np.zeros(r.SYMBOLS**r.ORDER, np.int64))
    assert np.allclose(empty, np.log2(r.SYMBOLS))


def test_isotonic():
    v, w = np.array([1.0, 3, 2, 2, 5, 4]), np.array([1.0, 1, 1, 2, 1, 3])
    got = r.isotonic(v, w)
    assert np.allclose(got, [1, 2.25, 2.25, 2.25, 4.25, 4.25]) and np.all(np.diff(got) >= 0)
    assert len(r.isotonic(np.array([]), np.array([]))) == 0


EASY, HARD = "The cat sat. The dog ran. I see it. " * 20, "Notwithstanding incontrovertible misinterpretation, the internationalization of counterintuitive representations unconditionally invalidates every straightforward correspondence throughout implementation. " * 6


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, lang string, text string").withColumns({"level": F.lit("clash"), "score": F.lit(1), "words": F.lit("x")})


def test_levels(spark):
    rows = [(i, "en", EASY + f"word{i}") for i in range(10)] + [(10 + i, "EN-us", HARD + f"word{i}") for i in range(10)] + [(20, None, None), (21, "en", ""), (22, "xx", "foreign text"), (23, "de", "```\ncode\n```"), (24, "en", EASY * 300)]
    got = {x.doc_id: x for x in r.reading_levels(frame(spark, rows), "doc_id", "text", "lang").collect()}
    assert len(got) == len(rows)
    assert max(got[i].level for i in range(10)) < min(got[i].level for i in range(10, 20))
    assert all(got[i].level is None and got[i].words == 0 for i in (20, 21, 23)) and got[22].level is not None and got[22].lang == "other"
    levels = sorted((x.score, x.level) for x in got.values() if x.level is not None and x.lang == "en")
    assert all(a[1] <= b[1] for a, b in zip(levels, levels[1:], strict=False))
    assert r.reading_levels(frame(spark, rows).limit(0), "doc_id", "text", "lang").count() == 0


def test_percentiles():
    rng = np.random.default_rng(4)
    counts = np.array([3, 0, 1, 40, 0])
    of, bits = np.repeat(np.arange(5), counts), rng.integers(0, 10**6, 44) / 1024
    for q, got in zip((0.1, 0.5, 0.9), r.percentiles(bits, of, counts, (0.1, 0.5, 0.9)), strict=True):
        for i in (0, 2, 3):
            assert got[i] == np.sort(bits[of == i])[int(np.ceil(counts[i] * q)) - 1]
    assert len(r.percentiles(np.zeros(0), np.zeros(0, int), np.zeros(2, int), (0.5,))[0]) == 2


def test_grades_of_documents_held_out(spark, small):
    """Rank correlation of the grade with the index on documents that neither weights nor grades were fitted to."""
    d = r.p9_levels(spark, small).where("words >= 50 AND lang = 'en'").where(~r.fitted_half("doc_id")).select("level", "ari").toPandas().rank()
    assert d.corr().iloc[0, 1] > 0.9


def test_the_grade_decides(spark):
    """Most documents are dropped by their grade before the exact index is looked at, and none of the demanding ones is."""
    rng = np.random.default_rng(6)
    short, long = [f"w{c}" for c in "abcdefgh"], ["internationalization", "counterintuitive", "representation", "incontrovertible", "misinterpretation"]
    rows = []
    for i in range(400):
        hard = i % 5 == 0
        words = [str(rng.choice(long if hard or rng.random() < 0.1 else short)) for _ in range(int(rng.integers(60, 120)))]
        rows.append((i, "en", " ".join(w + ("." if k % (25 if hard else 6) == 5 else "") for k, w in enumerate(words))))
    x = r.demanding_documents(r.reading_levels(frame(spark, rows), "doc_id", "text", "lang"), "doc_id").toPandas()
    assert 80 <= x.exact.sum() <= 100 and not (x.exact & ~x.candidate).any() and (~x.candidate).sum() > 200
    assert set(x.doc_id[x.candidate & x.exact]) == {i for i, _, t in rows if 4.71 * brute(t)[1] / brute(t)[0] + 0.5 * brute(t)[0] / brute(t)[2] - 21.43 >= 15}


def test_steps_on_documents_at_hand(spark, small):
    x = r.p9_steps(spark, small).where("lang = 'en'").groupBy().sum("documents", "candidates", "dropped", "confirmed", "missed").first()
    assert x[0] == x[1] + x[2] and x[4] == 0 and x[2] > x[0] / 3 and x[3] > 0


def test_sql(same_as_sql):
    same_as_sql(r.p9_found, r.ORACLES["p9_found"])


def test_queries_run(spark, small):
    from quarryline.llm import registry

    assert set(registry.oracle_sql()) <= set(registry.queries())
    for name, f in registry.queries().items():
        assert f(spark, small).count() >= 0, name
