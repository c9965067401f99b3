"""Near-duplicate texts (problem 6), by a generalised pigeonhole principle over min-hash codes.

A text's code is SYMBOLS min-hash values of its shingles; two texts of similarity s agree in each with chance s. The bits of one value agree or
differ together, and values that collide often do so on the same common shingles: such correlated bits are grouped into
partitions of WIDTH values, the commonest together. A partition may be left out (threshold -1), have to agree wholly (0), or in all but one
value (1). With fixed radii the integer pigeonhole bound would need sum(threshold + 1) to exceed about half the values, which at
0.6 selects nearly all pairs; so the budget that the thresholds must fill is the chance to miss a pair: dynamic programming
allocates them at the least estimated number of signatures and candidates such that a pair exactly at the threshold is missed with a
chance of at most ``miss``. Candidates are probed by signature, thinned by a bit sketch and verified exactly on their sets.

No text, set or signature is broadcast here: signatures are many times the texts, which the planner's estimates don't know, so every join is hinted to be a merge.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.functions.cleaning import id_or_null
from quarryline.plans.stages import bounded, materialize, table

#: The least similarity of a pair, as a fraction; its values are compared in whole numbers.
SIMILAR = (6, 10)
#: Min-hash values of a code, values of a partition, and the chance of missing a pair that is just similar enough.
SYMBOLS, WIDTH, MISS = 192, 3, 1e-5
#: Rows on which thresholds are fitted: a bound on what the driver sees, not on what is indexed.
FIT_ROWS = 4096
#: Bits of each of the first SKETCH_OF values of a code that make its sketch, and the most values in which these may differ in a similar pair:
#: 4.75 standard deviations beyond the mean of three in ten.
SKETCH_BITS, SKETCH_OF, SKETCH_MOST = 2, 128, 63
#: What probing one signature and one candidate cost, in the same unit.
SIGNATURE_COST, CANDIDATE_COST = 1.0, 0.2
#: Sets of one signature beyond which they are first compared with one of them only, where groups are wanted.
HOT_SIGNATURE = 1000
#: Copies of one text, letter by letter, up to which they are spelled out pair by pair; of more, each is linked to the first copy.
SPELL_OUT = 64
_MIX = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.default_rng(20240229)
_A = (_random.integers(0, 2**63, SYMBOLS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_B = _random.integers(0, 2**63, SYMBOLS, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_shingles(text: str, least: int = 25, size: int = 3) -> np.ndarray | None:
    """The distinct runs of ``size`` words, hashed; None for a text of fewer than ``least`` words."""
    import xxhash

    words = re.findall(r"[a-z0-9_]+", text.lower())
    if len(words) < max(least, size):
        return None
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    with np.errstate(over="ignore"):
        code = h[: len(h) - size + 1]
        for k in range(1, size):
            code = _mix(code * _MIX + h[k : len(h) - size + 1 + k])
    return np.unique(code.view(np.int64))


def character_shingles(text: str, least: int = 10, size: int = 3) -> np.ndarray | None:
    """The distinct runs of ``size`` characters of a text cut down to a-z, 0-9 and single spaces, hashed; None for a short text."""
    plain = re.sub(r"[^a-z0-9]+", " ", text.lower()).strip()
    if len(plain) < max(least, size):
        return None
    b = np.frombuffer(plain.encode(), np.uint8).astype(np.uint64)
    code = b[: len(b) - size + 1].copy()
    for k in range(1, size):
        code = code << np.uint64(8) | b[k : len(b) - size + 1 + k]
    return np.unique(_mix(code + _MIX).view(np.int64))


SHINGLES = {"content": word_shingles, "title": character_shingles}


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(field_name, key, id, raw, n, items): the set of shingles of each text that is long enough; id is a digest of the field and the set, raw one of the text.

    texts: (field_name, key, text). Null texts and texts too short for a comparison give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            fields, keys, ids, raw, n, items = [], [], [], [], [], []
            for f, k, t in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                s = SHINGLES[f](t)
                if s is not None:
                    fields.append(f), keys.append(k), ids.append(xxhash.xxh3_128_digest(s.tobytes(), zlib.crc32(f.encode()))), raw.append(xxhash.xxh3_128_digest(t.encode())), n.append(len(s)), items.append(s)
            offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
            flat = pa.array(np.concatenate(items) if items else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(fields, pa.string()), pa.array(keys, pa.string()), pa.array(ids, pa.binary()), pa.array(raw, pa.binary()), pa.array(n, pa.int32()), pa.ListArray.from_arrays(offsets, flat)], names=["field_name", "key", "id", "raw", "n", "items"])

    return texts.select("field_name", "key", "text").where("text IS NOT NULL AND key IS NOT NULL").mapInArrow(run, "field_name string, key string, id binary, raw binary, n int, items array<long>")


def codes_of(flat: np.ndarray, sizes: np.ndarray, columns: Sequence[int] | None = None) -> np.ndarray:
    """Min-hash values of each set, a row each; flat has the sets' items one after another. With ``columns`` only those values are worked out."""
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    base = _mix(flat.view(np.uint64))
    x = np.empty_like(base)
    out = np.zeros((len(sizes), SYMBOLS), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(SYMBOLS) if columns is None else columns:
            np.multiply(base, _A[j], out=x)
            np.add(x, _B[j], out=x)
            out[:, j] = np.minimum.reduceat(x, starts)
    return (_mix(out) >> np.uint64(32)).astype(np.uint32)


def _unlike(codes: np.ndarray, values: int = 64) -> np.ndarray:
    """The rows of codes without those that agree with an earlier kept one in a third of some values.

    Candidates that are similar indeed are wanted, so they must not count as a cost: a template that many texts follow would else lead
    to the very values in which its texts differ.
    """
    left, kept = codes[:, np.linspace(0, codes.shape[1] - 1, values).astype(int)], []
    rows = np.arange(len(codes))
    while len(rows):
        block = rows[:256]
        same = np.zeros((len(block), len(rows)), np.uint8)
        for j in range(values):
            same += left[block, j][:, None] == left[rows, j][None, :]
        like = same >= values // 3
        gone = np.zeros(len(rows), bool)
        for i in range(len(block)):
            if not gone[i]:
                kept.append(block[i])
                gone |= like[i]
                gone[i] = True
        rows = rows[~gone]
    return codes[kept]


def allocate(sample: np.ndarray, total: int, similar: float = SIMILAR[0] / SIMILAR[1], miss: float = MISS) -> list[tuple[tuple[int, ...], int]]:
    """Partitions of the code's values and their thresholds (-1 left out), from the codes of a sample of ``total`` texts."""
    sample = _unlike(sample)
    n = max(len(sample), 2)
    pairs = n * (n - 1) / 2

    def collisions(columns: np.ndarray) -> float:
        h = np.zeros(len(sample), np.uint64)
        for c in columns.T:
            h = _mix(h * np.uint64(31) + c.astype(np.uint64) + _MIX)
        _, counts = np.unique(h, return_counts=True)
        # in powers of four: finer differences are those of the texts at hand, and picking by them would pick the values in which these differ
        return 4.0 ** round(math.log(float((counts * (counts - 1) // 2).sum() + 0.5) / pairs, 4))

    with np.errstate(over="ignore"):
        order = np.argsort([-collisions(sample[:, [j]]) for j in range(sample.shape[1])], kind="stable")
        groups = [tuple(int(x) for x in order[i : i + WIDTH]) for i in range(0, len(order), WIDTH)]
        chance = (similar**WIDTH, similar**WIDTH + WIDTH * similar ** (WIDTH - 1) * (1 - similar))
        unit = 0.01
        gain = [int(-np.log1p(-c) / unit) for c in chance]
        need = int(np.ceil(-np.log(miss) / unit))
        best = np.full(need + 1, np.inf)
        best[0] = 0
        picks = np.full((len(groups), need + 1), -1, np.int8)
        before: list[np.ndarray] = []
        everyone = total * (total - 1) / 2
        for g, columns in enumerate(groups):
            part = sample[:, list(columns)]
            costs = (
                SIGNATURE_COST * total + CANDIDATE_COST * everyone * collisions(part),
                SIGNATURE_COST * total * WIDTH + CANDIDATE_COST * everyone * sum(collisions(np.delete(part, k, 1)) for k in range(WIDTH)),
            )
            old = best.copy()
            for threshold in (0, 1):
                reach = np.minimum(np.arange(need + 1) + gain[threshold], need)
                cost = old + costs[threshold]
                for at in range(need + 1):
                    if cost[at] < best[reach[at]]:
                        best[reach[at]] = cost[at]
                        picks[g, reach[at]] = threshold
            before.append(old)
        plan, at = [], need
        for g in range(len(groups) - 1, -1, -1):
            threshold = int(picks[g, at])
            plan.append((groups[g], threshold))
            if threshold >= 0:
                old = before[g]
                sources = [s for s in range(need + 1) if min(s + gain[threshold], need) == at and np.isfinite(old[s])]
                at = min(sources, key=lambda s: old[s])
    return plan[::-1]



def signature_rows(codes: np.ndarray, plan: list[tuple[tuple[int, ...], int]], field: str = "") -> tuple[np.ndarray, np.ndarray]:
    """(row of codes, signature) by the plan: one for a threshold of 0, one for each value left out for 1. The field is part of the signature."""
    salt = np.uint64(zlib.crc32(field.encode())) << np.uint64(32)
    rows, signatures = [], []
    with np.errstate(over="ignore"):
        for g, (columns, threshold) in enumerate(plan):
            if threshold < 0:
                continue
            for skip in [-1] if threshold == 0 else range(len(columns)):
                h = np.full(len(codes), (np.uint64(g * 16 + skip + 1) | salt) * _MIX, np.uint64)
                for k, c in enumerate(columns):
                    if k != skip:
                        h = _mix(h * np.uint64(31) + codes[:, c].astype(np.uint64) + _MIX)
                rows.append(np.arange(len(codes)))
                signatures.append(h.view(np.int64))
    return (np.concatenate(rows), np.concatenate(signatures)) if rows else (np.empty(0, np.int64), np.empty(0, np.int64))


def sketches(codes: np.ndarray) -> np.ndarray:
    """SKETCH_BITS planes of one bit of each of the first values, in words of 64."""
    planes = [np.packbits((codes[:, :SKETCH_OF] >> k & 1).astype(np.uint8), axis=1) for k in range(SKETCH_BITS)]
    return np.ascontiguousarray(np.concatenate(planes, axis=1)).view(np.int64)


_WORDS = SKETCH_OF // 64
_SKETCH = [f"s{i}" for i in range(SKETCH_BITS * _WORDS)]


def candidate_signatures(firsts: DataFrame, plans: dict[str, list], *extra: str) -> DataFrame:
    """(sig, id, n, s0.., extra): the signatures of each set.

    firsts: one row an id; extra: further columns of it, of type long, that go along.
    """
    used = {f: sorted({*range(SKETCH_OF), *(c for columns, t in plan if t >= 0 for c in columns)}) for f, plan in plans.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 512):
                batch = whole.slice(begin, 512)
                fields = np.array(batch.column("field_name").to_pylist(), object)
                for name in sorted(set(fields)):
                    part = batch.filter(pa.array(fields == name))
                    items = part.column("items")
                    codes = codes_of(items.flatten().to_numpy(), items.value_lengths().to_numpy(), used[name])
                    rows, signatures = signature_rows(codes, plans[name], name)
                    sketch = sketches(codes)[rows]
                    along = [part.column(c).take(pa.array(rows)) for c in ("id", "n", *extra)]
                    yield pa.RecordBatch.from_arrays([pa.array(signatures), *along[:2], *[pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(len(_SKETCH))], *along[2:]], names=["sig", "id", "n", *_SKETCH, *extra])

    return firsts.select("field_name", "id", "n", "items", *extra).mapInArrow(run, "sig long, id binary, n int, " + ", ".join(f"{w} long" for w in (*_SKETCH, *extra)))


def fit_plans(members: DataFrame, sets: DataFrame, miss: float = MISS) -> dict[str, list]:
    """For each field, its partitions and thresholds, from the number of its classes and the codes of FIT_ROWS of them, those of the least hashes."""
    classes = members.where("key = first").select("field_name", "id", F.xxhash64("id").alias("h"))
    plans = {}
    for row in classes.groupBy("field_name").agg(F.count("*").alias("total")).collect():  # a row a field
        name = row["field_name"]
        least = classes.where(F.col("field_name") == name).select("h").orderBy("h").limit(FIT_ROWS).agg(F.max("h")).first()[0]
        sample = first_sets(sets.where((F.col("field_name") == name) & (F.xxhash64("id") <= least))).select("n", "items").toArrow()
        flat = np.concatenate([np.asarray(x.values.to_numpy()) for x in sample.column("items").chunks if len(x)])
        plans[name] = allocate(codes_of(flat, sample.column("n").to_numpy()), row["total"], miss=miss)
    return plans


def _near(x: str, y: str):
    """Whether two sets of these aliases may be similar, by their sizes and sketches."""
    p, q = SIMILAR
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    different = lambda w: F.col(f"{x}.s{w}").bitwiseXOR(F.col(f"{y}.s{w}"))
    apart = F.lit(0)
    for w in range(_WORDS):
        any_plane = different(w)
        for k in range(1, SKETCH_BITS):
            any_plane = any_plane.bitwiseOR(different(w + k * _WORDS))
        apart = apart + F.bit_count(any_plane)
    return (n * q >= m * p) & (m * q >= n * p) & (apart <= SKETCH_MOST)


def _merged(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    return left.join(right.hint("merge"), on, how)


def first_sets(sets: DataFrame) -> DataFrame:
    """(id, field_name, n, items): one row an id, parted by it. Not written out: within a query all its readers share one exchange."""
    return sets.groupBy("id").agg(F.first("field_name").alias("field_name"), F.first("n").alias("n"), F.first("items").alias("items"))


def verified(pairs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(field_name, a, b, both, either): those of the candidates (a, b: ids) whose sets are similar, each once.

    firsts is parted by id already, so that only the pairs and the sets of those on the left are exchanged.
    """
    p, q = SIMILAR
    left = firsts.select(F.col("id").alias("a"), "field_name", F.col("n").alias("na"), F.col("items").alias("ia"))
    right = firsts.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("items").alias("ib"))
    met = _merged(_merged(pairs.select("a", "b").distinct(), left, "a"), right, "b")
    met = met.select("field_name", "a", "b", "na", "nb", F.size(F.array_intersect("ia", "ib")).alias("both"))
    either = F.col("na") + F.col("nb") - F.col("both")
    return met.where(F.col("both") * q >= either * p).select("field_name", "a", "b", "both", either.alias("either"))


def similar_sets(members: DataFrame, sets: DataFrame, miss: float = MISS) -> DataFrame:
    """(field_name, a, b, both, either): pairs of ids whose sets are similar; members and sets: as from classes_of.

    Both sides of the self-join are one exchange, read twice. Signatures that many sets share make large partitions of the join, which adaptive
    execution cuts on either side. All pairs are given, so a template of n reworked texts has up to n * n / 2 rows here; groups_of has one row a text.
    """
    firsts = first_sets(sets)
    return verified(_paired(candidate_signatures(firsts, fit_plans(members, sets, miss))), firsts)


def _paired(sigs: DataFrame) -> DataFrame:
    """(a, b): all two ids that share a signature and may be similar, a before b."""
    near = _merged(sigs.alias("x"), sigs.alias("y"), F.col("x.sig") == F.col("y.sig")).where((F.col("x.id") < F.col("y.id")) & _near("x", "y"))
    return near.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def classes_of(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (field_name, id, key, raw, size, first, copies, head) and sets (field_name, key, id, raw, n, items).

    texts: (field_name, key, text); a key's repeated rows count once if their sets agree. All texts with one set of shingles are one
    member class, found by its digest, so that copies are never paired with one another. size and first are the class's
    number of keys and least key, copies and head those of the keys in it with the very same text (raw).
    """
    sets = materialize(shingle_sets(texts))
    members = sets.groupBy("field_name", "id", "key").agg(F.min("raw").alias("raw"))
    same = members.groupBy("field_name", "id", "raw").agg(F.min("key").alias("head"), F.count("*").alias("copies"))
    classes = same.groupBy("field_name", "id").agg(F.min("head").alias("first"), F.sum("copies").alias("size"))
    return materialize(_merged(_merged(members, same, ["field_name", "id", "raw"]), classes, ["field_name", "id"])), sets


def near_duplicates(texts: DataFrame, miss: float = MISS) -> tuple[DataFrame, DataFrame]:
    """Members, as from classes_of, and links (field_name, a, b, both, either) between the ids of different sets."""
    members, sets = classes_of(texts)
    return members, materialize(similar_sets(members, sets, miss))


def spelled_out(members: DataFrame, links: DataFrame, spell_out: int | None = SPELL_OUT) -> DataFrame:
    """(field_name, left_key, right_key): every similar pair of keys, the smaller first.

    Of more than spell_out copies of the very same text only the first is paired with other texts, of its own class and of others, and each
    other copy is linked to it: the pairs left out follow, as such copies have the same partners. Different texts are always paired. With None
    all copies are spelled out, however many.
    """
    many = F.lit(False) if spell_out is None else F.col("copies") > spell_out
    shown = members.where(~many | (F.col("key") == F.col("head")))
    few = shown.where("size > 1")
    inner = _merged(few.select("field_name", "id", F.col("key").alias("x")), few.select("field_name", "id", F.col("key").alias("y")), ["field_name", "id"]).where("x < y")
    star = members.where(many & (F.col("key") != F.col("head"))).select("field_name", F.col("head").alias("x"), F.col("key").alias("y"))
    cross = _merged(links, shown.select("field_name", F.col("id").alias("a"), F.col("key").alias("x")), ["field_name", "a"])
    cross = _merged(cross, shown.select("field_name", F.col("id").alias("b"), F.col("key").alias("y")), ["field_name", "b"])
    pairs = inner.select("field_name", "x", "y").unionByName(star.select("field_name", "x", "y")).unionByName(cross.select("field_name", "x", "y"))
    return pairs.where("x <> y").select("field_name", F.least("x", "y").alias("left_key"), F.greatest("x", "y").alias("right_key")).distinct()


def connected(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(field_name, id, group): the least id that can be reached over links, by passing on least labels and jumping over them."""
    edges = materialize(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = materialize(edges.select(F.col("a").alias("id")).distinct().withColumn("group", F.col("id")))
    while True:
        heard = _merged(edges, labels.select(F.col("id").alias("b"), "group"), "b").groupBy(F.col("a").alias("id")).agg(F.min("group").alias("near"))
        step = _merged(labels, heard, "id").select("id", F.col("group").alias("old"), F.least("group", "near").alias("group"))
        jump = _merged(step, labels.select(F.col("id").alias("group"), F.col("group").alias("far")), "group").select("id", "old", F.least("group", "far").alias("group"))
        jump = materialize(jump)
        labels = jump.select("id", "group")
        if jump.where("old <> group").isEmpty():
            break
    nodes = nodes.select("field_name", "id").distinct()
    return _merged(nodes, labels, "id", "left").select("field_name", "id", F.coalesce("group", "id").alias("group"))


def groups_of(members: DataFrame, sets: DataFrame, miss: float = MISS, hot: int = HOT_SIGNATURE) -> DataFrame:
    """(field_name, id, group): the connected group of every set, without ever pairing all sets of a template with one another.

    Signatures of at most ``hot`` sets give all their pairs. In those of more, each set is compared with the least one only, at first: at most one candidate a signature. What all these links connect is
    one group already, and its sets need no further comparison. Then every two sets that share a hot signature but not a group are compared, which
    gives the same groups as all pairs do: a pair left out lies inside a group.
    """
    firsts = first_sets(sets)
    plans = fit_plans(members, sets, miss)
    sigs = candidate_signatures(firsts, plans)
    many = materialize(sigs.groupBy("sig").agg(F.count("*").alias("held")).where(F.col("held") > hot).select("sig"))
    if many.isEmpty():
        return connected(members, materialize(verified(_paired(sigs), firsts)))
    many = bounded(many, 50)  # one row for more than ``hot`` signatures
    warm = materialize(sigs.join(many, "sig", "left_semi"))
    heads = materialize(warm.groupBy("sig").agg(F.min(F.struct("id", "n", *_SKETCH)).alias("h")).select("sig", "h.*"))
    near = _merged(warm.alias("y"), heads.alias("x"), F.col("x.sig") == F.col("y.sig")).where((F.col("x.id") < F.col("y.id")) & _near("x", "y"))
    pairs = _paired(sigs.join(many, "sig", "left_anti")).unionByName(near.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")))
    links = materialize(verified(pairs, firsts))
    grouped = connected(members, links).select("id", F.xxhash64("group").alias("label"))
    rows = materialize(_merged(warm, grouped, "id"))
    mixed = rows.groupBy("sig").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("sig")
    rows = materialize(_merged(rows, mixed, "sig", "left_semi"))
    cells = rows.select("sig", "label").distinct()
    two = _merged(cells.alias("x"), cells.alias("y"), F.col("x.sig") == F.col("y.sig")).where("x.label < y.label").select("x.sig", F.col("x.label").alias("one"), F.col("y.label").alias("two"))
    met = _merged(two.alias("t"), rows.alias("x"), (F.col("t.sig") == F.col("x.sig")) & (F.col("t.one") == F.col("x.label"))).select(F.struct("t.*").alias("t"), F.struct("x.*").alias("x"))
    met = _merged(met, rows.select(F.struct("*").alias("y")), (F.col("t.sig") == F.col("y.sig")) & (F.col("t.two") == F.col("y.label"))).where(_near("x", "y"))
    far = materialize(verified(met.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")), firsts))
    return connected(members, links if far.isEmpty() else links.unionByName(far))


def _texts(spark, sf_dir: str) -> DataFrame:
    blocks = table(spark, sf_dir, "guideline_blocks").select(F.lit("content").alias("field_name"), id_or_null("block_id").alias("key"), F.col("content").alias("text"))
    titles = table(spark, sf_dir, "guideline_records").select(F.lit("title").alias("field_name"), id_or_null("guideline_id").alias("key"), F.col("title").alias("text"))
    return blocks.unionByName(titles)


def p6_found(spark, sf_dir: str) -> DataFrame:
    return spelled_out(*near_duplicates(_texts(spark, sf_dir)))


def p6_groups(spark, sf_dir: str) -> DataFrame:
    """(field_name, key, group_key, group_size): every text that was compared, with the least key of its group."""
    members, sets = classes_of(_texts(spark, sf_dir))
    rows = materialize(_merged(members, groups_of(members, sets), ["field_name", "id"]).select("field_name", "key", "group"))
    heads = rows.groupBy("field_name", "group").agg(F.min("key").alias("group_key"), F.count("*").alias("group_size"))
    return _merged(rows, heads, ["field_name", "group"]).select("field_name", "key", "group_key", "group_size")


def _pairs_sql(field: str, source: str) -> str:
    return f"""SELECT '{field}' AS field_name, a.k AS left_key, b.k AS right_key
  FROM (SELECT x.k AS ka, y.k AS kb, count(*) AS n FROM {source}_x x JOIN {source}_x y ON x.s = y.s AND x.k < y.k GROUP BY 1, 2) p
  JOIN {source}_n a ON a.k = p.ka JOIN {source}_n b ON b.k = p.kb WHERE p.n * 10 >= 6 * (a.n + b.n - p.n)"""


_WS = r"E' \t\r\n'"
_FOUND = f"""c AS (SELECT DISTINCT trim(block_id, {_WS}) AS k, regexp_extract_all(lower(content), '[a-z0-9_]+') AS w FROM guideline_blocks WHERE trim(block_id, {_WS}) <> ''),
  c_x AS (SELECT DISTINCT k, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS s FROM c WHERE len(w) >= 25), c_n AS (SELECT k, count(*) AS n FROM c_x GROUP BY 1),
  t AS (SELECT DISTINCT trim(guideline_id, {_WS}) AS k, trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')) AS w FROM guideline_records WHERE trim(guideline_id, {_WS}) <> ''),
  t_x AS (SELECT DISTINCT k, unnest(list_transform(range(1, length(w) - 1), lambda i: substr(w, i, 3))) AS s FROM t WHERE length(w) >= 10), t_n AS (SELECT k, count(*) AS n FROM t_x GROUP BY 1)"""
_PAIRS = f"{_pairs_sql('content', 'c')} UNION ALL {_pairs_sql('title', 't')}"
ORACLES = {
    "p6_found": f"WITH {_FOUND} {_PAIRS}",
    "p6_groups": f"""WITH RECURSIVE {_FOUND}, pairs AS ({_PAIRS}),
  edges AS (SELECT field_name, left_key AS a, right_key AS b FROM pairs UNION ALL SELECT field_name, right_key, left_key FROM pairs),
  reach AS (SELECT 'content' AS field_name, k, k AS g FROM c_n UNION SELECT 'title', k, k FROM t_n UNION SELECT r.field_name, e.b, r.g FROM reach r JOIN edges e ON e.field_name = r.field_name AND e.a = r.k),
  least AS (SELECT field_name, k AS key, min(g) AS group_key FROM reach GROUP BY 1, 2)
SELECT *, count(*) OVER (PARTITION BY field_name, group_key) AS group_size FROM least""",
}
