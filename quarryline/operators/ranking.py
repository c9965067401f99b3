"""Rankings of all units for every query without writing their pairs: each task holds the index and looks at its queries one after another.

Only what a ranking gives leaves a task. No unit is left out: the lists are those over all pairs of a query and a unit that share a term. What the lists
say about a unit that shares tokens depends, but for BM25 and the phrase, on two small numbers only (shared tokens, own tokens), so scores of the whole list come from a table of these.
"""

from __future__ import annotations

import math
import pickle
import re
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.functions.text import query_tokens, raw_tokens, tokens
from quarryline.plans.stages import bounded, materialize

#: Queries that one task looks at.
TASK_QUERIES = 250
#: How far below the last row of a pool semantic scores can be rounded to the same weighted sum.
ROUNDING = 2e-5
#: Bytes of bit masks of terms that a worker keeps.
MASK_BYTES = 64_000_000
#: Hits of units and labels that a task looks at together, besides those of one unit.
LABEL_HITS = 2_000_000
_WORD = re.compile("[a-z0-9_]+")


def rounded(x: np.ndarray, digits: int = 6) -> np.ndarray:
    """Rounded half away from zero."""
    scaled = np.abs(x) * 10.0**digits
    whole = np.floor(scaled)
    return np.copysign((whole + (scaled - whole >= 0.5)) / 10.0**digits, x) + 0.0


def min_max(x: np.ndarray, low: float, high: float) -> np.ndarray:
    return np.ones(len(x)) if high - low < 1e-12 else (x - low) / (high - low)


def ranks(*keys: np.ndarray) -> np.ndarray:
    """Places from 1 on by keys, the first of which counts most."""
    out = np.empty(len(keys[0]), np.int64)
    out[np.lexsort(keys[::-1])] = np.arange(1, len(out) + 1)
    return out


class Postings(NamedTuple):
    """Units, by their numbers in ascending order, that hold each term; counts are those of the term in the unit, or None; masks keeps the bit masks of terms once they are made."""

    at: dict[str, tuple[int, int]]
    units: np.ndarray
    counts: np.ndarray | None
    masks: dict[str, np.ndarray]

    def of(self, term: str) -> np.ndarray:
        begin, end = self.at[term]
        return self.units[begin:end]


class Index(NamedTuple):
    """What every task holds of the units, numbered from 0 on in the order of their ids; texts are in lower case, anchor is the number of the heading or -1 where it is blank."""

    names: pa.Array
    texts: pa.Array
    anchor: np.ndarray
    damping: np.ndarray
    held_values: np.ndarray
    held_at: np.ndarray
    terms: Postings
    tokens: Postings


def shared_tokens(index: Postings, words: Sequence[str], units: int) -> tuple[np.ndarray, np.ndarray]:
    """The units that hold any of the words, and how many."""
    lists = [index.of(w) for w in words if w in index.at]
    if not lists:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    total = sum(map(len, lists))
    if total * 64 < units:
        return np.unique(np.concatenate(lists), return_counts=True)
    counts = np.zeros(units, np.uint8 if len(lists) < 256 else np.int32)
    for x in lists:
        counts[x] += 1
    found = np.flatnonzero(counts)
    return found, counts[found].astype(np.int64)


def _mask(index: Postings, word: str, units: int) -> np.ndarray:
    """A bit for every unit, set for those that hold the word."""
    got = index.masks.get(word)
    if got is None:
        flags = np.zeros(-(-units // 64) * 64, np.bool_)
        flags[index.of(word)] = True
        got = np.packbits(flags, bitorder="little").view(np.uint64)
        if (len(index.masks) + 1) * got.nbytes <= MASK_BYTES:
            index.masks[word] = got
    return got


def shared_counts(index: Postings, words: Sequence[str], units: int) -> np.ndarray:
    """How many of the words each unit holds. Common words are added as bits, 64 units at once, rare ones unit by unit."""
    met = [w for w in words if w in index.at]
    common = [w for w in met if len(index.of(w)) * 64 >= units]
    digits: list[np.ndarray] = []  # binary digits of the numbers
    for w in common:
        carry = _mask(index, w, units)
        for i, d in enumerate(digits):
            digits[i], carry = d ^ carry, d & carry
        if len(digits) < len(common).bit_length() and carry.any():
            digits.append(carry)
    counts = np.zeros(units, np.uint8 if len(met) < 256 else np.int32)
    for i, d in enumerate(digits):
        counts |= np.unpackbits(d.view(np.uint8), count=units, bitorder="little").astype(counts.dtype, copy=False) << counts.dtype.type(i)
    for w in met:
        if len(index.of(w)) * 64 < units:
            counts[index.of(w)] += 1
    return counts


class Lists(NamedTuple):
    """One query's rows that can be in any top list, by unit; total is the size of both whole lists together, relevance_low the least relevance of the whole semantic one.

    Ranks are 0 outside a list; those beyond the depth keep the order of the semantic list only. lexical is scaled; score is the lexical score itself.
    """

    unit: np.ndarray
    share: np.ndarray
    score: np.ndarray
    lexical: np.ndarray
    semantic: np.ndarray
    reranker: np.ndarray
    relevance: np.ndarray
    lex_rank: np.ndarray
    sem_rank: np.ndarray
    score_low: float
    relevance_low: float
    total: int


class Rules(NamedTuple):
    """Fixed values of the lists: shares of the lexical score and of relevance, the pool that is reranked, and the most units by BM25 that are looked at, or None for all."""

    lexical: tuple[float, float, float]
    relevance: tuple[float, float]
    window: int
    limit: int | None = None


def weights(ix: Index, terms: Sequence[str], unit: np.ndarray) -> np.ndarray:
    """Sums of the terms' weights in the units, which are in ascending order."""
    out = np.zeros(len(unit))
    n = len(ix.names)
    damping = ix.damping[unit]
    for t in terms:
        begin, end = ix.terms.at[t]
        own = ix.terms.units[begin:end]
        idf = math.log((n - len(own) + 0.5) / (len(own) + 0.5))
        idf = idf if idf > 0 else 1e-6
        if len(own) < len(unit):
            at = np.searchsorted(unit, own)
            fits = at < len(unit)
            fits[fits] = unit[at[fits]] == own[fits]
            at, tf = at[fits], ix.terms.counts[begin:end][fits]
        else:
            near = np.searchsorted(own, unit)
            fits = near < len(own)
            fits[fits] = own[near[fits]] == unit[fits]
            at = np.flatnonzero(fits)
            tf = ix.terms.counts[begin:end][near[at]]
        out[at] += idf * tf * 2.2 / (tf + damping[at])
    return out


def phrases(ix: Index, query: str, content: set[str], unit: np.ndarray, overlap: np.ndarray) -> np.ndarray:
    """Whether the texts hold the whole query; a text that does holds every token that is not at the query's edge, so others aren't looked at."""
    inner = {m.group() for m in _WORD.finditer(query) if m.start() > 0 and m.end() < len(query)} & content
    out = np.zeros(len(unit))
    near = np.flatnonzero(overlap >= len(inner))
    if len(near):
        out[near] = pc.match_substring(ix.texts.take(pa.array(unit[near])), query).to_numpy(zero_copy_only=False)
    return out


def lists_of(ix: Index, query: str, terms: Sequence[str], raw: Sequence[str], content: Sequence[str], rules: Rules, depth: int) -> Lists | None:
    """The lists of one query, in lower case; None without a hit. terms are tried first, then raw."""
    met = [t for t in terms if t in ix.terms.at] or [t for t in raw if t in ix.terms.at]
    if not met:
        return None
    n, asked = len(ix.names), len(content)
    counts = shared_counts(ix.tokens, content, n)
    allowed = None
    if rules.limit is not None and n > rules.limit:
        every, _ = shared_tokens(ix.terms, met, n)
        allowed = np.zeros(n, bool)
        allowed[every[np.lexsort((every, -weights(ix, met, every)))[: rules.limit]]] = True
    elif any("_" in t for t in content):  # such a token is no term, so that a unit may hold it and not be met
        allowed = np.zeros(n, bool)
        for t in met:
            allowed[ix.terms.of(t)] = True
    if allowed is not None:
        counts[~allowed] = 0
    most = int(counts.max())
    if not most:  # no tokens are shared: all units that are met are in the lexical list
        unit, _ = shared_tokens(ix.terms, met, n)
        if allowed is not None:
            unit = unit[allowed[unit]]
        overlap = np.zeros(len(unit), np.int64)
        need, semantic = 0, np.zeros(len(unit))
        total = len(unit)
    else:
        need = min(most, max(1, -(-asked * 6 // 10)))
        width = len(ix.held_values)
        kind = np.min_scalar_type((most + 1) * width)
        code = counts.astype(kind) * kind.type(width) + ix.held_at.astype(kind, copy=False)
        many = np.bincount(code)
        many[:width] = 0  # units that share nothing
        pairs = np.flatnonzero(many)
        o, h = pairs // width, ix.held_values[pairs % width]
        j = o / np.maximum(asked + h - o, 1)
        value = rounded(min_max(j, j.min(), j.max()))
        order = np.argsort(-value, kind="stable")
        last = min(np.searchsorted(np.cumsum(many[pairs[order]]), max(depth, rules.window)), len(order) - 1)
        table, wanted = np.zeros(len(many)), np.zeros(len(many), bool)
        table[pairs] = value
        wanted[pairs] = (value >= value[order[last]] - ROUNDING) | (o >= need)
        unit = np.flatnonzero(counts >= (pairs[wanted[pairs]] // width).min())
        unit, total = unit[wanted[code[unit]]], int(many.sum())
        overlap = counts[unit].astype(np.int64)
        semantic = table[code[unit]]
        semantic_low = value.min()
    share = overlap / max(asked, 1)
    zero = lambda: np.zeros(len(unit))
    # lexical
    kept = np.flatnonzero(overlap >= need)
    b = weights(ix, met, unit[kept])
    shared = overlap[kept].astype(float)
    x, y, z = rules.lexical
    own = rounded(x * min_max(b, b.min(), b.max()) + y * min_max(shared, shared.min(), shared.max()) + z * phrases(ix, query, set(content), unit[kept], overlap[kept]))
    score, lexical, lex_rank = zero(), zero(), np.zeros(len(unit), np.int64)
    score[kept], lexical[kept] = own, min_max(own, own.min(), own.max())
    deep = 2 * max(depth, rules.window)
    top = np.flatnonzero(own >= np.partition(own, len(own) - deep)[len(own) - deep]) if len(own) > deep else np.arange(len(own))
    lex_rank[kept] = len(own)  # behind those that are ranked
    lex_rank[kept[top]] = ranks(-own[top], rounded(-b[top]), unit[kept[top]])
    # semantic
    reranker, relevance, sem_rank, relevance_low = zero(), zero(), np.zeros(len(unit), np.int64), 0.0
    if need:
        pool = np.argsort(-semantic, kind="stable")[: rules.window]
        c = share[pool]
        reranker[pool] = rounded(min_max(c, c.min(), c.max()))
        x, y = rules.relevance
        relevance = rounded(x * semantic + y * reranker)
        sem_rank = ranks(-relevance, -reranker, unit)
        relevance_low = float(relevance.min() if total <= rules.window else rounded(np.array([x * semantic_low]))[0])
    return Lists(unit, share, score, lexical, semantic, reranker, relevance, lex_rank, sem_rank, float(own.min()), relevance_low, total)


def first(count: int, *keys: np.ndarray) -> np.ndarray:
    """The first rows by keys, in their order."""
    return np.lexsort(keys[::-1])[:count]


def weighted_top(x: Lists, shares: Sequence[float], count: int, reranker: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The best rows by the weighted sum of three scores, and the sums of all rows."""
    r = x.reranker if reranker is None else reranker
    final = rounded(shares[0] * x.lexical + shares[1] * x.semantic + shares[2] * r)
    return first(count, -final, -r, x.unit), final


def reciprocal(x: Lists, k: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of reciprocal ranks in three lists, numbers of lists, and the order of the rows by them."""
    found = x.sem_rank > 0
    last = np.zeros(len(x.unit), np.int64)
    last[found] = ranks(-x.reranker[found], -x.semantic[found], x.unit[found])
    a, b, c = (np.where(r <= window, r, 0) for r in (x.lex_rank, x.sem_rank, last))
    share = lambda r: np.where(r > 0, 1.0 / (k + r), 0.0)
    rrf = rounded(share(a) + share(b) + share(c), 9)
    far = lambda r: np.where(r == 0, 10**9, r)
    return rrf, (a > 0).astype(np.int64) + (b > 0) + (c > 0), np.lexsort((x.unit, far(a), far(c), -rrf))


def quota_pool(x: Lists, size: int, lexical_min: int, semantic_min: int) -> np.ndarray:
    """Rows of the pool by quotas, in their order; see retrieval.rerank_pool."""
    lead, second = max(1, min(lexical_min, size)), max(1, min(semantic_min, size))
    picked = (x.lex_rank > 0) & (x.lex_rank <= lead)
    found = x.sem_rank > 0
    fresh = np.flatnonzero(found & ~picked)
    nth = np.full(len(x.unit), np.iinfo(np.int64).max)
    nth[fresh] = ranks(x.sem_rank[fresh])
    phase = np.select([picked, nth <= second, found & (x.lex_rank > 0), found], [1, 2, 3, 4], 5)
    return first(size, phase, np.where(picked | ~found, x.lex_rank, x.sem_rank), x.unit)


def floor_pool(x: Lists, window: int, floor: int) -> np.ndarray:
    """Rows of the semantic window and of the lexical floor, in their order; see retrieval.lexical_floor_pool."""
    if floor <= 0:
        return np.empty(0, np.int64)
    base = np.flatnonzero((x.sem_rank > 0) & (x.sem_rank <= window))
    more = np.flatnonzero((x.lex_rank > 0) & ~((x.sem_rank > 0) & (x.sem_rank <= window)))
    return np.concatenate([base[np.argsort(x.sem_rank[base])], more[first(floor, x.lex_rank[more], x.unit[more])]])


def rescored(x: Lists, pool: np.ndarray) -> np.ndarray:
    """The reranker's scores with those of the pool's members written anew."""
    out = x.reranker.copy()
    c = x.share[pool]
    if len(pool):
        out[pool] = rounded(min_max(c, c.min(), c.max()))
    return out


def capped_modes(x: Lists, anchor: np.ndarray, k: int, window: int, top_n: int, cap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best rows by three modes fused, at most ``cap`` an anchor, with scores and numbers of modes of all rows; see retrieval.fuse_modes."""
    rrf, lists, order = reciprocal(x, k, window)
    both = np.empty(len(order), np.int64)
    both[order] = np.arange(1, len(order) + 1)
    low = 0.0 if (lists > 0).sum() < x.total else rrf.min()
    modes = [(x.score, x.lex_rank, x.score_low), (x.relevance, x.sem_rank, x.relevance_low), (rrf, both, low)]
    total, best, near, coverage = np.zeros(len(order)), np.zeros(len(order)), np.full(len(order), 10**9), np.zeros(len(order), np.int64)
    for score, rank, least in modes:
        at = np.flatnonzero((rank > 0) & (rank <= window))
        if len(at):
            total[at] += 1.0 / (k + rank[at])
            best[at] = np.maximum(best[at], min_max(score[at], least, score[at].max()))
            near[at] = np.minimum(near[at], rank[at])
            coverage[at] += 1
    fused = rounded(total + 0.2 * best + np.array([0.0, 0.0, 0.1, 0.2])[coverage])
    turn = [i for i in first(len(order), -fused, -coverage, near, x.unit) if coverage[i]]
    out, taken = [], {}
    for i in turn:
        a = anchor[x.unit[i]]
        taken[a] = taken.get(a, 0) + 1
        if a < 0 or taken[a] <= cap:
            out.append(i)
            if len(out) == top_n:
                break
    return np.array(out, np.int64), fused, coverage


# --- in Spark ---


class _Packed:
    """A value that is pickled compressed, as every executor and the driver keep a file of what is sent to the tasks; there it is the value itself."""

    def __init__(self, value: object):
        self.value = value

    def __reduce__(self):
        whole = pickle.dumps(self.value, 5)
        return _unpacked, (len(whole), pa.compress(whole, "zstd", asbytes=True))


def _unpacked(size: int, packed: bytes) -> object:
    return pickle.loads(pa.decompress(packed, size, "zstd"))


def _sender(spark) -> Callable:
    return lambda value: spark.sparkContext.broadcast(_Packed(value))


def numbered(units: DataFrame) -> DataFrame:
    """units, written out, with their ids as name and, as id, their number from 0 on in the order of the ids."""
    rows = materialize(units.orderBy("id").withColumn("_row", F.monotonically_increasing_id()))
    part = F.shiftright("_row", 33)
    sizes = sorted(rows.groupBy(part.alias("part")).count().collect())
    starts = {p: sum(n for _, n in sizes[:i]) for i, (p, n) in enumerate(sizes)} or {0: 0}
    start = F.element_at(F.create_map(*[F.lit(x) for e in starts.items() for x in e]), part)
    number = (start + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))).cast("int")
    return rows.select(number.alias("id"), F.col("id").alias("name"), *[c for c in units.columns if c != "id"])


def _postings(rows: DataFrame, counted: bool) -> Postings:
    """Postings from rows (term, id, tf), brought to the driver term by term in narrow columns."""
    grouped = rows.groupBy("term").agg(F.sort_array(F.collect_list(F.struct("id", F.least("tf", F.lit(32767)).cast("short").alias("tf")) if counted else F.col("id"))).alias("e"))
    got = grouped.select("term", *(["e.id", "e.tf"] if counted else [F.col("e").alias("id")])).toArrow()
    words, ids = got.column("term").to_pylist(), got.column("id").combine_chunks()
    ends = ids.offsets.to_numpy().tolist() if words else [0]
    return Postings(dict(zip(words, zip(ends, ends[1:]), strict=True)), ids.flatten().to_numpy(), got.column("tf").combine_chunks().flatten().to_numpy() if counted else None, {})


def _spread(queries: DataFrame) -> DataFrame:
    """Written-out queries, TASK_QUERIES or so a task."""
    return queries.repartition(max(1, -(-queries.count() // TASK_QUERIES)), "query_id")


def indexed(queries: DataFrame, units: DataFrame, entries: Callable[[DataFrame, bool], DataFrame], damping: Callable[[np.ndarray], np.ndarray]) -> list:
    """The fields of an Index of numbered units by the terms of the queries (query_id, terms, raw), each sent to the tasks by itself, so that the driver never holds all of them; entries gives the units' terms."""
    spark = units.sparkSession
    send = _sender(spark)
    words = F.size(F.regexp_extract_all(F.lower(F.concat_ws(" ", "heading", "text")), F.lit("[a-z0-9]+"), F.lit(0)))
    found = entries(units.select("id", "heading", "text"), False)
    of = lambda rows, asked: rows.join(bounded(asked, 100), "term", "left_semi")
    asked = materialize(queries.select(F.explode("terms").alias("term")).distinct())
    terms = _postings(of(found, asked), True)
    # queries whose terms are met nowhere are searched by all their tokens
    wider = queries.where(F.size(F.array_except("raw", "terms")) > 0).select("query_id", "terms", "raw")
    known = spark.createDataFrame(pa.table({"term": pa.array(list(terms.at), pa.string())}))
    hit = wider.select("query_id", F.explode("terms").alias("term")).join(bounded(known, 100), "term", "left_semi").select("query_id")
    rest = materialize(wider.join(hit, "query_id", "left_anti").select(F.explode("raw").alias("term")).distinct())
    if not rest.isEmpty():
        asked = materialize(asked.unionByName(rest).distinct())
        terms = _postings(of(found, asked), True)
    terms = send(terms)
    # a unit's tokens are distinct, so they need not be brought together
    held = send(_postings(of(units.select("id", F.explode(tokens("text")).alias("term")), asked), False))
    texts = send(_column(units.select("id", F.lower("text").alias("text")), "text").cast(pa.large_string()))
    own = units.select("id", "name", "heading", words.alias("dl"), F.size(tokens("text")).alias("held")).toArrow().sort_by("id")
    held_values, held_at = np.unique(own.column("held").to_numpy(), return_inverse=True)
    headings = own.column("heading").combine_chunks()
    anchor = np.where(pc.equal(headings, "").to_numpy(zero_copy_only=False), -1, headings.dictionary_encode().indices.to_numpy())
    return [send(own.column("name").combine_chunks()), texts, *map(send, (anchor.astype(np.int32), damping(own.column("dl").to_numpy()), held_values.astype(np.int64), held_at.astype(np.min_scalar_type(len(held_values))))), terms, held]


def _column(units: DataFrame, name: str) -> pa.Array:
    """A column of numbered units in their order, which they are written in."""
    got = units.toArrow()
    if not np.array_equal(got.column("id").to_numpy(), np.arange(got.num_rows)):
        got = got.sort_by("id")
    return got.column(name).combine_chunks()


class Labels(NamedTuple):
    """The labels of numbered units: those of unit i, by their places in names, and their scores lie from at[i] to at[i + 1]."""

    names: np.ndarray
    at: np.ndarray
    label: np.ndarray
    score: np.ndarray


def labelled(rows: DataFrame, units: int) -> Labels:
    """Labels from rows (id, label, score) of numbered units, brought to the driver; names are in ascending order."""
    got = rows.select("id", "label", "score").toArrow().sort_by([("id", "ascending"), ("label", "ascending")])
    names, label = np.unique(np.array(got.column("label").to_pylist(), object), return_inverse=True)
    return Labels(names, np.searchsorted(got.column("id").to_numpy(), np.arange(units + 1)), label.astype(np.int32), got.column("score").to_numpy())


def best_labels(row: np.ndarray, label: np.ndarray, terms: np.ndarray, least: float, near: float, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, label and raw score of up to ``most`` labels of each row, from hits (row, label); see retrieval.label_scores."""
    key, overlap = np.unique(row * len(terms) + label, return_counts=True)
    row, label = np.divmod(key, max(len(terms), 1))
    raw = overlap / np.sqrt(terms[label])
    order = np.lexsort((label, -overlap, -raw, row))
    row, label, raw = row[order], label[order], raw[order]
    first_of = np.searchsorted(row, row)
    keep = (raw >= np.maximum(least, raw[first_of] * near)) & (np.arange(len(row)) - first_of < most)
    return row[keep], label[keep], raw[keep]


def unit_labels(units: DataFrame, profiles: DataFrame, least: float, near: float, most: int) -> DataFrame:
    """(id, label, raw): labels of units (id, text), one row an id, from the task that holds the unit, without an exchange; profiles: (label, k, terms), sent to every task; see retrieval.label_scores."""
    got = profiles.where("k IS NOT NULL").select("k", "label", "terms").toArrow()
    words, term = np.unique(np.array(got.column("k").to_pylist(), object), return_inverse=True)
    names, one, own = np.unique(np.array(got.column("label").to_pylist(), object), return_index=True, return_inverse=True)
    by = np.argsort(term, kind="stable")
    held = pa.array(words.tolist(), pa.string()), np.searchsorted(term[by], np.arange(len(words) + 1)), own[by], pa.array(names.tolist(), pa.string()), got.column("terms").to_numpy()[one]
    sent = _sender(units.sparkSession)(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, at, labels, names, terms = sent.value
        for batch in batches:
            lists = batch.column("tokens")
            place = pc.index_in(lists.flatten(), value_set=words)
            hit = place.is_valid().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(lists)), pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False))[hit]
            term = place.drop_null().to_numpy().astype(np.int64)
            many = at[term + 1] - at[term]
            before = np.concatenate([[0], np.cumsum(many)])
            begin = 0
            while begin < len(row):
                last = row[max(begin, np.searchsorted(before, before[begin] + LABEL_HITS, "right") - 2)]
                end = np.searchsorted(row, last, "right")
                n = many[begin:end]
                rows = np.repeat(at[term[begin:end]] + n - np.cumsum(n), n) + np.arange(n.sum())
                r, found, raw = best_labels(np.repeat(row[begin:end], n), labels[rows], terms, least, near, most)
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(r)), names.take(pa.array(found)), pa.array(raw)], names=["id", "label", "raw"])
                begin = end

    kind = units.schema["id"].dataType.simpleString()
    return units.select("id", tokens("text").alias("tokens")).mapInArrow(run, f"id {kind}, label string, raw double")


def rolled_up(unit: np.ndarray, score: np.ndarray, labels: Labels) -> tuple[np.ndarray, ...]:
    """Label, score, hits, best unit and place of every label of one query's ranked units, as in retrieval.row_projection."""
    begin, end = labels.at[unit], labels.at[unit + 1]
    many = end - begin
    place = np.repeat(np.arange(1, len(unit) + 1), many)
    rows = np.repeat(end - np.cumsum(many), many) + np.arange(many.sum())
    own = np.repeat(unit, many)
    part = np.repeat(score, many) / place * labels.score[rows]
    held, group = np.unique(labels.label[rows], return_inverse=True)
    total = rounded(np.bincount(group, part, len(held)))
    order = np.lexsort((own, -rounded(part, 9), group))
    best = own[order[np.searchsorted(group[order], np.arange(len(held)))]]
    return labels.names[held], total, np.bincount(group, minlength=len(held)), best, ranks(-total, held)


def answered(queries: DataFrame, units: DataFrame, entries, damping, rules: Rules, schema: str, answer: Callable, depth: int, extra: Sequence[str] = (), labels: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """What ``answer`` gives for each query's lists: the columns of the schema but query_id, the numbers of units as id or top_id; these are named by their ids.

    queries: (query_id, query, extra...); units: (id, heading, text). answer: of the index, the lists, the Labels if there are any, and the extra columns' values. labels: gives rows (id, label, score) of numbered units.
    """
    parts = [F.lower("query").alias("low"), query_tokens("query").alias("terms"), F.array_distinct(raw_tokens("query")).alias("raw"), tokens("query").alias("content")]
    asked = materialize(queries.select("query_id", "query", *extra))
    rows = numbered(units)
    shared = indexed(asked.select("query_id", *parts), rows, entries, damping)
    beside = [] if labels is None else [_sender(units.sparkSession)(labelled(labels(rows), rows.count()))]
    form = [f.split(" ") for f in schema.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix, more = Index(*(f.value for f in shared)), [b.value for b in beside]
        for batch in batches:
            at, got = [], []
            for i, row in enumerate(batch.to_pylist()):
                x = lists_of(ix, row["low"], row["terms"], row["raw"], row["content"], rules, depth)
                if x is not None:
                    out = answer(ix, x, *more, *[row[c] for c in extra])
                    at.append(np.full(len(out[0]), i))
                    got.append(out)
            if got:
                columns = dict(zip([name for name, _ in form if name != "query_id"], [np.concatenate(c) for c in zip(*got, strict=True)], strict=True))
                whole = {}
                for name, kind in form:
                    if name == "query_id":
                        column = batch.column(name).take(pa.array(np.concatenate(at)))
                    else:
                        column = ix.names.take(pa.array(columns[name])) if name in ("id", "top_id") else pa.array(columns[name])
                    whole[name] = column.cast(kinds[kind])
                yield pa.RecordBatch.from_pydict(whole)

    return _spread(asked).select("query_id", *parts, *extra).mapInArrow(run, schema)


def most_shared(queries: DataFrame, units: DataFrame, k: int) -> DataFrame:
    """(query_id, id, overlap, place): the k units that share most tokens with each query, ties by id; queries: (query_id, tokens), units: (id, tokens), without repeats."""
    asked = materialize(queries.select("query_id", "tokens"))
    rows = numbered(units.select("id", "tokens"))
    words = materialize(asked.select(F.explode("tokens").alias("term")).distinct())
    held = rows.select(F.explode("tokens").alias("term"), "id").join(bounded(words, 100), "term", "left_semi")
    send = _sender(queries.sparkSession)
    index_of, names_of = send(_postings(held, False)), send(_column(rows.select("id", "name"), "name"))
    name, unit = queries.schema["query_id"].dataType.simpleString(), units.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, names = index_of.value, names_of.value
        for batch in batches:
            ids, found, counts, places = [], [], [], []
            for i, words in enumerate(batch.column("tokens").to_pylist()):
                overlap = shared_counts(index, words or [], len(names))
                least = int(overlap.max(initial=0))
                if least:
                    while least > 1 and np.count_nonzero(overlap >= least) < k:
                        least -= 1
                    rows = np.flatnonzero(overlap >= least)
                    shared = overlap[rows].astype(np.int64)
                    top = np.argsort(-shared, kind="stable")[:k]
                    rows, shared = rows[top], shared[top]
                    ids.append(np.full(len(rows), i))
                    found.append(rows)
                    counts.append(shared)
                    places.append(np.arange(1, len(rows) + 1))
            if ids:
                yield pa.RecordBatch.from_arrays([batch.column("query_id").take(pa.array(np.concatenate(ids))), names.take(pa.array(np.concatenate(found))), pa.array(np.concatenate(counts).astype(np.int64)), pa.array(np.concatenate(places).astype(np.int32))], names=["query_id", "id", "overlap", "place"])

    return _spread(asked).mapInArrow(run, f"query_id {name}, id {unit}, overlap long, place int")
