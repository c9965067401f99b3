"""Reading level of documents (problem 9): n-gram surprisal, graded by isotonic regression.

Interpolated n-gram models, one a language, give every symbol of a document its surprisal. What the whole document's surprisals look like (per
symbol, per word with spread and percentiles, per sentence) is weighed into one score, and isotonic regression maps the score to a grade. Weights
and map are fitted to the readability index of one half of the documents, chosen by a hash of the key; the grades of the
other half are predictions, so that what they miss can be measured.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.plans.stages import materialize, table

#: Symbols: 0 a gap between words, 1-26 letters, 27 digits, 28 a gap at a sentence's end, 29 bytes outside ASCII.
SYMBOLS, GAP, END = 30, 0, 28
ORDER = 4
#: Languages with a model of their own; all others share one.
LANGUAGES = ("en", "de", "fr", "es", "other")
#: Bytes of text that are worked on at once.
SLICE = 1 << 20
#: Scores, logarithms of grades, are summed in steps of 1 / BINS.
BINS = 500
#: Grades below the lowest of the demanding documents of the fitted half down to which a document is still a candidate; more where these are few.
MARGIN = 2.0
#: The lowest automated readability index, and the fewest words, of a text that counts as demanding.
DEMANDING, LEAST_WORDS = 15.0, 50

_ALNUM = np.zeros(256, bool)
_SYMBOL = np.zeros(256, np.uint8)
for _i in range(26):
    _SYMBOL[[65 + _i, 97 + _i]] = 1 + _i
_SYMBOL[48:58] = 27
_ALNUM[:] = _SYMBOL > 0
_SYMBOL[128:] = 29
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\r\n")] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True


class Prose:
    """Texts without their fenced blocks, as arrays.

    words, chars, sentences: one number a text. symbols: all texts' symbols in one row; text i has those from first[i] to first[i + 1].
    word_at: where words begin among the symbols (one position for each), word_of: the text of each.
    """

    def __init__(self, texts: Sequence[bytes]) -> None:
        n = len(texts)
        b = np.frombuffer(b"\n\n".join(texts) + b"\n\n", np.uint8).copy()
        begin = np.concatenate([[0], np.cumsum([len(t) + 2 for t in texts])]).astype(np.int64)
        newline = np.flatnonzero(b == 10)
        self._drop_fences(b, begin, newline)
        newline = np.flatnonzero(b == 10)
        space = _SPACE[b]
        filled = np.flatnonzero(~space)  # a line is blank if nothing is filled between its two newlines
        before = np.searchsorted(filled, newline)
        blank = newline[1:][before[1:] == before[:-1]]
        stop = np.flatnonzero(_STOP[b[:-1]] & space[1:])
        cuts = np.sort(np.concatenate([stop, blank]))
        alnum = _ALNUM[b]
        starts = np.flatnonzero(alnum & ~np.concatenate([[False], alnum[:-1]]))
        total = np.concatenate([[0], np.cumsum(alnum, dtype=np.int32)])
        self.chars = (total[begin[1:]] - total[begin[:-1]]).astype(np.int64)
        owner = np.searchsorted(begin, starts, side="right") - 1
        self.words = np.bincount(owner, minlength=n)
        piece = np.searchsorted(cuts, starts)
        new = np.concatenate([[True], (piece[1:] != piece[:-1]) | (owner[1:] != owner[:-1])]) if len(starts) else np.zeros(0, bool)
        self.sentences = np.bincount(owner[new], minlength=n)
        s = _SYMBOL[b]
        solid = s > 0
        kept = np.flatnonzero(solid | np.concatenate([[True], solid[:-1]]))
        gap = ~solid[kept]
        at = np.searchsorted(cuts, kept)
        after = np.concatenate([at[1:], [len(cuts)]])
        self.symbols = np.where(gap, np.where(after > at, END, GAP), s[kept]).astype(np.uint8)
        self.first = np.searchsorted(kept, begin)
        self.word_at = np.searchsorted(kept, starts)
        self.word_of = owner

    @staticmethod
    def _drop_fences(b: np.ndarray, begin: np.ndarray, newline: np.ndarray) -> None:
        """Makes newlines of each block from a line that begins with three backticks to the next such line of the same text."""
        lines = np.concatenate([begin[:-1], newline[:-1] + 1])
        lines = np.unique(lines[lines + 2 < len(b)])
        fence = lines[(b[lines] == 96) & (b[lines + 1] == 96) & (b[lines + 2] == 96)]
        if not len(fence):
            return
        owner = np.searchsorted(begin, fence, side="right") - 1
        nth = np.arange(len(fence)) - np.searchsorted(owner, owner)
        opening = np.flatnonzero(nth % 2 == 0)
        opening = opening[opening + 1 < len(fence)]
        opening = opening[owner[opening + 1] == owner[opening]]
        ends = newline[np.searchsorted(newline, fence[opening + 1])]
        for start, end in zip(fence[opening].tolist(), ends.tolist(), strict=True):
            b[start : end + 1] = 10

    def codes(self) -> np.ndarray:
        """The n-gram that ends at each symbol, as a number; before a text's first symbol stand sentence ends."""
        s = self.symbols.astype(np.int32)
        code, weight = s.copy(), 1
        for back in range(1, ORDER):
            weight *= SYMBOLS
            shifted = np.full(len(s), END, np.int32)
            shifted[back:] = s[:-back]
            for k in range(back):
                edge = self.first[:-1] + k
                shifted[edge[edge < self.first[1:]]] = END
            code += shifted * weight
        return code


def interpolated_bits(counts: np.ndarray) -> np.ndarray:
    """Bits of surprise of every n-gram, by Witten-Bell interpolation down to equal chances.

    counts: how often each of SYMBOLS ** ORDER n-grams was seen.
    """
    levels = [counts.reshape(-1, SYMBOLS).astype(np.float64)]
    while levels[-1].shape[0] > 1:
        levels.append(levels[-1].reshape(SYMBOLS, -1, SYMBOLS).sum(0))
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for table_ in reversed(levels):
        seen = table_.sum(1, keepdims=True)
        kinds = (table_ > 0).sum(1, keepdims=True)
        lower = np.tile(p.reshape(-1, SYMBOLS), (table_.shape[0] // p.reshape(-1, SYMBOLS).shape[0], 1))
        p = np.where(seen > 0, (table_ + kinds * lower) / np.maximum(seen + kinds, 1), lower)
    return -np.log2(p).reshape(-1).astype(np.float32)


def language(col: str) -> Column:
    """The language's main part in lower case if it has a model of its own, else ``other``."""
    main = F.regexp_extract(F.lower(F.btrim(F.coalesce(F.col(col), F.lit("")))), "^[a-z]+", 0)
    return F.when(main.isin(*LANGUAGES[:-1]), main).otherwise(LANGUAGES[-1])


def _slices(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        texts = batch.column(text).to_pylist()
        sizes = np.cumsum([len(t) if t is not None else 0 for t in texts])
        at = 0
        while at < len(texts):
            base = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, base + SLICE, side="right")))
            yield batch.slice(at, end - at), [t or b"" for t in texts[at:end]]
            at = end


def train(df: DataFrame) -> dict[str, np.ndarray]:
    """A model for each language from all texts; df: (lang, text as bytes), lang one of LANGUAGES.

    Each task counts n-grams in arrays of a fixed size and sends on what it has seen; the driver gets at most SYMBOLS ** ORDER sums a language.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part, texts in _slices(batches, 1):
            langs = part.column(0).to_pylist()
            for lang in sorted(set(langs)):
                codes = Prose([t for t, x in zip(texts, langs, strict=True) if x == lang]).codes()
                mine = sums.setdefault(lang, np.zeros(SYMBOLS**ORDER, np.int64))
                seen, n = np.unique(codes, return_counts=True) if len(codes) < 50_000 else ((n := np.bincount(codes, minlength=SYMBOLS**ORDER)).nonzero()[0], n[n > 0])
                mine[seen] += n
        for lang, mine in sums.items():
            seen = mine.nonzero()[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), pa.array(seen.astype(np.int32)), pa.array(mine[seen])], names=["lang", "code", "n"])

    sums = df.mapInArrow(count, "lang string, code int, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")).toArrow()
    models = {}
    langs, codes, n = sums.column("lang").to_numpy(zero_copy_only=False), sums.column("code").to_numpy(), sums.column("n").to_numpy()
    for lang in LANGUAGES:
        counts = np.zeros(SYMBOLS**ORDER, np.int64)
        mine = langs == lang
        counts[codes[mine]] = n[mine]
        models[lang] = interpolated_bits(counts)
    return models


#: Numbers of each document: words, their characters, sentences, the automated readability index, bits a symbol, the mean and spread of bits
#: a word, its 10th, 50th and 90th percentile (to a 1024th of a bit), and bits a sentence.
MEASURES = ("words", "chars", "sentences", "ari", "bits_symbol", "bits_word", "bits_word_sd", "bits_word_p10", "bits_word_p50", "bits_word_p90", "bits_sentence")
#: The measures that are weighed into the score: those of surprisal alone.
WEIGHED = MEASURES[4:]


def percentiles(bits: np.ndarray, of: np.ndarray, counts: np.ndarray, shares: Sequence[float]) -> list[np.ndarray]:
    """For each share, the least of a text's values that so large a part of them doesn't exceed; of: each value's text, in order."""
    order = np.sort(of.astype(np.int64) << 40 | np.round(bits * 1024).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(counts)[:-1]])
    at = [begin + np.maximum(np.ceil(counts * q).astype(np.int64), 1) - 1 for q in shares]
    last = max(len(order) - 1, 0)
    return [(order[np.minimum(i, last)] & (1 << 40) - 1) / 1024 if len(order) else np.zeros(len(counts)) for i in at]


def measure(texts: Sequence[bytes], model: np.ndarray) -> dict[str, np.ndarray]:
    """MEASURES of each text, not a number where there are no words."""
    bits = model
    prose = Prose(texts)
    n = len(texts)
    surprise = bits[prose.codes()].astype(np.float64)
    total = np.concatenate([[0.0], np.cumsum(surprise)])
    whole = total[prose.first[1:]] - total[prose.first[:-1]]
    length = np.maximum(prose.first[1:] - prose.first[:-1], 1)
    at, of = prose.word_at, prose.word_of
    until = np.concatenate([at[1:], [0]])
    last = np.concatenate([of[1:] != of[:-1], [True]]) if len(of) else np.zeros(0, bool)
    until[last] = prose.first[1:][of[last]]
    word_bits = total[until] - total[at]
    words = prose.words.astype(np.float64)
    with np.errstate(invalid="ignore", divide="ignore"):
        mean = np.bincount(of, word_bits, n) / words
        spread = np.sqrt(np.maximum(np.bincount(of, word_bits**2, n) / words - mean**2, 0))
        ari = 4.71 * prose.chars / words + 0.5 * words / prose.sentences - 21.43
        sentence = whole / prose.sentences
    low, middle, high = percentiles(word_bits, of, prose.words, (0.1, 0.5, 0.9))
    values = (words, prose.chars.astype(float), prose.sentences.astype(float), ari, whole / length, mean, spread, low, middle, high, sentence)
    return dict(zip(MEASURES, (np.where(words > 0, v, np.nan if i > 2 else v) for i, v in enumerate(values)), strict=True))


def score_documents(df: DataFrame, models: dict, key: str) -> DataFrame:
    """(key, lang, MEASURES) of every text; df: (lang, text as bytes, key). Null and empty texts have no words and null measures."""
    shared = df.sparkSession.sparkContext.broadcast(models)  # SYMBOLS ** ORDER floats a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _slices(batches, 1):
            langs = np.array(part.column(0).to_pylist(), object)
            out = {m: np.full(len(texts), np.nan) for m in MEASURES}
            for lang in sorted(set(langs)):
                mine = np.flatnonzero(langs == lang)
                for m, v in measure([texts[i] for i in mine], shared.value[lang]).items():
                    out[m][mine] = v
            yield pa.RecordBatch.from_arrays([part.column(2), part.column(0), *[pa.array(out[m], from_pandas=True) for m in MEASURES]], names=[key, "lang", *MEASURES])

    schema = f"`{key}` {dict(df.dtypes)[key]}, lang string, " + ", ".join(f"{m} double" for m in MEASURES)
    return df.select("lang", "text", key).mapInArrow(run, schema)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to values in weighed squares, by pooling adjacent violators."""
    sums, mass, size = [], [], []
    for v, w in zip(values.tolist(), weights.tolist(), strict=True):
        sums.append(v * w)
        mass.append(w)
        size.append(1)
        while len(sums) > 1 and sums[-2] * mass[-1] >= sums[-1] * mass[-2]:
            s, m, k = sums.pop(), mass.pop(), size.pop()
            sums[-1] += s
            mass[-1] += m
            size[-1] += k
    return np.repeat([s / m for s, m in zip(sums, mass, strict=True)], size)


def features(values: np.ndarray) -> np.ndarray:
    """What is weighed, from WEIGHED in columns: a constant and the logarithms of one plus each."""
    return np.concatenate([np.ones((len(values), 1)), np.log1p(values)], axis=1)


def fitted_half(key: str) -> Column:
    """Whether a document is one of those that weights and grades are fitted to."""
    return F.xxhash64(F.col(key).cast("string")) % 2 == 0


def _numbers(part: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    return np.stack([part.column(c).to_numpy(zero_copy_only=False) for c in names], axis=1).astype(np.float64)


def fit_weights(scored: DataFrame, key: str) -> dict[str, np.ndarray]:
    """For each language, the weights of the features that come nearest, in squares, to the logarithm of one plus the index.

    Tasks send on sums of products only; the driver gets (features + 1) ** 2 numbers a language. Indices below 0 count as 0. A language of which
    nothing is in the fitted half has the weights, and the grades, of all languages together.
    """
    names, size = (*WEIGHED, "ari"), len(WEIGHED) + 2

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part in batches:
            x, langs = _numbers(part, names), np.array(part.column("lang").to_pylist(), object)
            x = np.concatenate([features(x[:, :-1]), np.log1p(np.maximum(x[:, -1:], 0))], axis=1)
            for lang in set(langs):
                mine = x[langs == lang]
                sums[lang] = sums.get(lang, 0) + mine.T @ mine
        for lang, m in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * m.size, pa.string()), pa.array(np.arange(m.size, dtype=np.int32)), pa.array(m.reshape(-1))], names=["lang", "at", "v"])

    rows = scored.where(fitted_half(key) & F.col("ari").isNotNull()).select("lang", *names)
    total = rows.mapInArrow(products, "lang string, at int, v double").groupBy("lang", "at").agg(F.sum("v").alias("v")).toPandas()
    sums = {lang: part.sort_values("at")["v"].to_numpy().reshape(size, size) for lang, part in total.groupby("lang")}
    pooled = sum(sums.values(), np.zeros((size, size)))
    solve = lambda m: np.linalg.solve(m[:-1, :-1] + 1e-3 * np.eye(size - 1), m[:-1, -1])
    return {lang: solve(sums.get(lang, pooled)) for lang in LANGUAGES}


def with_scores(scored: DataFrame, weights: dict[str, np.ndarray], curves: dict[str, tuple[np.ndarray, np.ndarray]] | None = None) -> DataFrame:
    """Adds score and, with curves (knots and grades of each language), level, between knots in proportion; null where a document has no words."""
    names = [*scored.columns, "score", *(["level"] if curves is not None else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            x, langs = features(_numbers(part, WEIGHED)), np.array(part.column("lang").to_pylist(), object)
            score, level = np.full(len(x), np.nan), np.full(len(x), np.nan)
            for lang in set(langs):
                mine = langs == lang
                score[mine] = x[mine] @ weights[lang]
                if curves is not None and lang in curves:
                    level[mine] = np.where(np.isnan(score[mine]), np.nan, np.interp(score[mine], *curves[lang]))
            added = [score, level][: 1 if curves is None else 2]
            yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array(v, from_pandas=True) for v in added]], names=names)

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in scored.schema.fields), *(f"{n} double" for n in names[len(scored.columns) :])])
    return scored.mapInArrow(run, schema)


def fit_curves(scored: DataFrame, key: str) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """For each language, isotonic regression of the index on the score over the fitted half, summed in steps of 1 / BINS of the score.

    Scores are logarithms, so the driver sees some thousands of rows a language; each step stands at its mean score.
    """
    bins = scored.where(fitted_half(key) & F.col("score").isNotNull()).groupBy("lang", F.floor(F.col("score") * BINS).alias("bin"))
    sums = bins.agg(F.count("*").alias("n"), F.avg("score").alias("at"), F.avg("ari").alias("mean")).toPandas().sort_values("at")
    curve = lambda part: (part["at"].to_numpy(), isotonic(part["mean"].to_numpy(), part["n"].to_numpy()))
    if sums.empty:
        return {}
    return {lang: curve(sums) for lang in LANGUAGES} | {lang: curve(part) for lang, part in sums.groupby("lang")}


def reading_levels(documents: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """(key, lang, MEASURES, score, level) of every document; other columns are ignored, whatever their names.

    Documents without words have null measures and no level. If the fitted half has no words at all, no document has a level.
    """
    rows = documents.select(language(lang).alias("lang"), F.col(text).cast("binary").alias("text"), F.col(key))
    measured = materialize(score_documents(rows, train(rows.select("lang", "text")), key))
    weights = fit_weights(measured, key)
    return with_scores(measured, weights, fit_curves(with_scores(measured, weights), key))


def least_level(graded: DataFrame, key: str) -> DataFrame:
    """(lang, least): a row a language: the grade from which on documents are candidates, MARGIN below the lowest demanding one of the fitted half, twice that if there are ten of them."""
    demanding = (F.col("words") >= LEAST_WORDS) & (F.col("ari") >= DEMANDING)
    return graded.where(fitted_half(key) & demanding).groupBy("lang").agg((F.min("level") - MARGIN * (1 + 10 / F.count("*"))).alias("least"))


def demanding_documents(graded: DataFrame, key: str) -> DataFrame:
    """The rows of graded, with ``candidate`` (the grade is high enough) and ``exact`` (long enough, and the index itself reaches the bound).

    A language without a demanding document in the fitted half has all its graded documents as candidates.
    """
    graded = materialize(graded)
    rows = graded.join(F.broadcast(least_level(graded, key)), "lang", "left")  # a row a language
    return rows.withColumn("candidate", F.col("level").isNotNull() & (F.col("least").isNull() | (F.col("level") >= F.col("least")))).withColumn("exact", F.coalesce((F.col("words") >= LEAST_WORDS) & (F.col("ari") >= DEMANDING), F.lit(False))).drop("least")


def _levels(spark, sf_dir: str) -> DataFrame:
    return reading_levels(table(spark, sf_dir, "documents", "doc_id", "lang", "text"), "doc_id", "text", "lang")


def p9_found(spark, sf_dir: str) -> DataFrame:
    """Demanding English documents: those whose grade, MARGIN allowed, is that of a demanding text, verified by the exact index."""
    rows = demanding_documents(_levels(spark, sf_dir), "doc_id").where("candidate AND exact").select("doc_id")
    english = table(spark, sf_dir, "documents", "doc_id", "lang").where(F.lower("lang").startswith("en")).select("doc_id")
    return english.join(rows, "doc_id", "left_semi")


def p9_steps(spark, sf_dir: str) -> DataFrame:
    """Per language and half (fitted or held out): documents, how many the grade leaves as candidates and drops, how many of these the
    exact index confirms, and how many demanding documents the grade missed."""
    rows = demanding_documents(_levels(spark, sf_dir), "doc_id")
    return rows.groupBy("lang", fitted_half("doc_id").alias("fitted")).agg(F.count("*").alias("documents"), F.count_if(F.col("candidate")).alias("candidates"), F.count_if(~F.col("candidate")).alias("dropped"), F.count_if(F.col("candidate") & F.col("exact")).alias("confirmed"), F.count_if(~F.col("candidate") & F.col("exact")).alias("missed"))


def p9_levels(spark, sf_dir: str) -> DataFrame:
    """Each document's reading level with the surprisal distribution behind it."""
    return _levels(spark, sf_dir)


def p9_profile(spark, sf_dir: str) -> DataFrame:
    """Documents per language and whole grade; null grades are documents without words."""
    return _levels(spark, sf_dir).groupBy("lang", F.floor("level").alias("grade")).agg(F.count("*").alias("documents"), F.avg("ari").alias("mean_index"))


ORACLES = {
    "p9_found": r"""WITH prose AS (SELECT doc_id, regexp_replace(text, '(?ms)^```.*?^```[^\n]*$', E'\n\n', 'g') AS t FROM documents WHERE lower(lang) LIKE 'en%'),
  counted AS (SELECT doc_id, regexp_extract_all(t, '[A-Za-z0-9]+') AS w, len(list_filter(string_split_regex(t, '[.!?](?:[ \t\r\n]|$)|\n[ \t\r]*\n'), lambda x: regexp_matches(x, '[A-Za-z0-9]'))) AS s FROM prose)
SELECT doc_id FROM counted WHERE len(w) >= 50 AND 4.71 * length(array_to_string(w, '')) / len(w) + 0.5 * len(w) / s - 21.43 >= 15"""
}
