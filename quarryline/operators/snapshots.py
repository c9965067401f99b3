"""What changed between full snapshots (problem 5), by invertible Bloom lookup tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryline.functions.cleaning import content_digest, epoch_micros, id_or_null, strip
from quarryline.plans.stages import bounded, materialize, table

#: Rows, over all snapshots, that a hash bucket is meant to hold.
BUCKET_ROWS = 16_384
#: Cells of each of the three parts of a bucket's first table, and how much larger each next one is.
FIRST_CELLS, GROWTH = 64, 4
#: The digest that stands for unknown content.
UNKNOWN = 0

_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def xxhash64_long(values: np.ndarray, seed) -> np.ndarray:
    """XXH64 of 8-byte integers, as F.xxhash64 has it; seed is a number or an array (the hash of the column before)."""
    with np.errstate(over="ignore"):
        rot = lambda x, n: (x << np.uint64(n)) | (x >> np.uint64(64 - n))
        h = np.asarray(seed).astype(np.int64).view(np.uint64) + _P5 + np.uint64(8)
        h = h ^ (rot(values.view(np.uint64) * _P2, 31) * _P1)
        h = rot(h, 27) * _P1 + _P4
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        return (h ^ (h >> np.uint64(32))).view(np.int64)


def _pair_hash(keys: np.ndarray, digests: np.ndarray, salt: int) -> np.ndarray:
    """F.xxhash64(key, digest, lit(salt)) on the driver's or a worker's side."""
    h = xxhash64_long(keys, np.full(len(keys), 42, np.int64))
    return xxhash64_long(np.full(len(keys), salt, np.int64), xxhash64_long(digests, h))


def peel(pair: np.ndarray, cell: np.ndarray, count: np.ndarray, keys: np.ndarray, digests: np.ndarray, checks: np.ndarray, cells: int):
    """Peels many subtracted tables at once; cells without content may be absent.

    Returns (pair, key, digest, sign) of the recovered elements and the pairs whose tables could not be emptied.
    """
    width = 3 * cells
    pairs, index = np.unique(pair, return_inverse=True)
    size = len(pairs) * width
    at = index * width + cell
    c, k, d, x = (np.zeros(size, np.int64) for _ in range(4))
    c[at], k[at], d[at], x[at] = count, keys, digests, checks
    found = []
    while True:
        pure = np.flatnonzero((np.abs(c) == 1))
        pure = pure[_pair_hash(k[pure], d[pure], -1) == x[pure]]
        if not len(pure):
            break
        element = np.rec.fromarrays([pure // width, k[pure], d[pure]], names="p,k,d")
        _, first = np.unique(element, return_index=True)
        pure = pure[first]
        p, kk, dd, cc, xx = pure // width, k[pure], d[pure], c[pure], x[pure]
        found.append((pairs[p], kk, dd, cc))
        for part in range(3):
            where = p * width + part * cells + _pair_hash(kk, dd, part) % cells
            np.subtract.at(c, where, cc)
            np.bitwise_xor.at(k, where, kk)
            np.bitwise_xor.at(d, where, dd)
            np.bitwise_xor.at(x, where, xx)
    left = np.unique(np.flatnonzero(c | k | d | x) // width)
    stuck = pairs[left]
    parts = [np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(4)]
    keep = ~np.isin(parts[0], stuck)
    return [a[keep] for a in parts], stuck


def _peeler(cells: int):
    def run(cells_of_bucket: pa.Table) -> pa.Table:
        col = {n: cells_of_bucket.column(n).to_numpy() for n in cells_of_bucket.column_names}
        (pair, key, digest, sign), stuck = peel(col["pair"].astype(np.int64), col["cell"].astype(np.int64), col["count"], col["keys"], col["digests"], col["checks"], cells)
        n, s = len(pair), len(stuck)
        zero = np.zeros(s, np.int64)
        return pa.table({
            "bucket": np.full(n + s, col["bucket"][0] if len(col["bucket"]) else 0, np.int64), "pair": np.concatenate([pair, stuck]).astype(np.int64), "kh": np.concatenate([key, zero]),
            "vh": np.concatenate([digest, zero]), "sign": np.concatenate([sign, zero]).astype(np.int32),
        })

    return run


def snapshot_differences(rows: DataFrame, chain: DataFrame, first_cells: int = FIRST_CELLS) -> DataFrame:
    """(pair, kh, vh, sign): the elements that only the later (1) or only the earlier (-1) snapshot of a pair has.

    rows: (bucket, ord, kh, vh), one row a record and snapshot, best partitioned by bucket. chain: (ord, next_ord), the number of each
    snapshot and of the one after it, null for the last; a pair has the number of its later snapshot. Every snapshot adds its elements to the
    table of the pair that it ends and takes them from the table of the pair that it begins, so that the subtraction is the sum of
    one aggregation, most of it done before the exchange: equal elements cancel. Tables that cannot be emptied are built
    again, larger, from their own buckets only.
    """
    starts = chain.where(F.col("next_ord").isNotNull())
    followers = starts.select(F.col("next_ord").alias("ord"), F.lit(True).alias("follows"))
    linked = rows.join(bounded(chain), "ord").join(bounded(followers), "ord", "left")
    sides = F.array(F.when(F.col("follows"), F.struct(F.col("ord").cast("long").alias("pair"), F.lit(1).alias("sign"))), F.when(F.col("next_ord").isNotNull(), F.struct(F.col("next_ord").cast("long").alias("pair"), F.lit(-1).alias("sign"))))
    signed = linked.select("bucket", "kh", "vh", F.explode(F.filter(sides, lambda s: s.isNotNull())).alias("s")).select("bucket", "kh", "vh", "s.pair", "s.sign")
    done, todo, cells = None, None, first_cells
    schema = "bucket long, pair long, kh long, vh long, sign int"
    while True:
        some = signed if todo is None else signed.join(todo, ["bucket", "pair"], "left_semi")
        spots = F.array(*[F.pmod(F.xxhash64("kh", "vh", F.lit(part).cast("long")), F.lit(cells)).cast("int") + part * cells for part in range(3)])
        # pmod and numpy's % both give a remainder of the divisor's sign
        table_cells = (
            some.select("bucket", "pair", "sign", "kh", "vh", F.xxhash64("kh", "vh", F.lit(-1).cast("long")).alias("check"), F.explode(spots).alias("cell"))
            .groupBy("bucket", "pair", "cell")
            .agg(F.sum("sign").alias("count"), F.bit_xor("kh").alias("keys"), F.bit_xor("vh").alias("digests"), F.bit_xor("check").alias("checks"))
            .where((F.col("count") != 0) | (F.col("keys") != 0) | (F.col("digests") != 0) | (F.col("checks") != 0))
        )
        out = materialize(table_cells.groupBy("bucket").applyInArrow(_peeler(cells), schema))
        good = out.where("sign <> 0").select("pair", "kh", "vh", "sign")
        done = good if done is None else done.unionByName(good)
        failed = out.where("sign = 0").select("bucket", "pair")
        if failed.isEmpty():
            return done
        todo, cells = failed, cells * GROWTH


def classify(differences: DataFrame, rows: DataFrame) -> DataFrame:
    """(kh, source_table, corpus, entity_id, ord, change_kind) from recovered elements, each verified against its row.

    rows: (ord, prior_ord, kh, vh, source_table, corpus, entity_id), prior_ord being the snapshot before. A record on both sides has
    changed if the later content is known and differs from the last known since the record was added; unknown content is no change.
    """
    plus, minus = differences.where("sign = 1"), differences.where("sign = -1")
    owner = rows.select("kh", "vh", "ord", "next_ord", "source_table", "corpus", "entity_id")
    new = plus.select("kh", "vh", F.col("pair").alias("ord")).join(owner.drop("next_ord"), ["kh", "vh", "ord"]).withColumn("side", F.lit(1))
    old = minus.select("kh", "vh", F.col("pair").alias("next_ord")).join(owner.drop("ord"), ["kh", "vh", "next_ord"]).withColumnRenamed("next_ord", "ord").withColumn("side", F.lit(-1))
    known = F.when(F.col("vh") != UNKNOWN, F.col("vh"))
    events = new.unionByName(old).groupBy("kh", "ord", "source_table", "corpus", "entity_id").agg(
        F.max(F.when(F.col("side") == 1, known)).alias("new"), F.max(F.when(F.col("side") == -1, known)).alias("old"), F.max("side").alias("here"), F.min("side").alias("there")
    )
    w = Window.partitionBy("kh", "source_table", "corpus", "entity_id").orderBy("ord")
    events = events.withColumn("life", F.sum(F.when(F.col("there") == 1, 1).otherwise(0)).over(w))
    life = Window.partitionBy("kh", "source_table", "corpus", "entity_id", "life").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    last = F.coalesce("old", F.last(F.coalesce("new", "old"), ignorenulls=True).over(life))
    kind = F.when(F.col("there") == 1, "added").when(F.col("here") == -1, "removed").when(F.col("new") != last, "changed")
    return events.select("kh", "source_table", "corpus", "entity_id", "ord", kind.alias("change_kind")).where(F.col("change_kind").isNotNull())


def snapshot_order(snapshots: DataFrame) -> DataFrame:
    """(corpus, snapshot_id, instant, sha): one row a snapshot with a readable time; a fixed, small table."""
    rows = snapshots.select(id_or_null("corpus").alias("corpus"), id_or_null("snapshot_id").alias("snapshot_id"), epoch_micros("fetched_at").alias("instant"), F.coalesce(F.lower(strip("commit_sha")), F.lit("")).alias("sha"))
    return rows.where("corpus IS NOT NULL AND snapshot_id IS NOT NULL AND instant IS NOT NULL").groupBy("corpus", "snapshot_id").agg(F.min(F.struct("instant", "sha")).alias("x")).select("corpus", "snapshot_id", "x.instant", "x.sha")


def _inventory(spark, sf_dir: str) -> DataFrame:
    """(source_table, corpus, entity_id, snapshot_id, digest, at) of both inventories."""
    common = [id_or_null("corpus").alias("corpus"), id_or_null("snapshot_id").alias("snapshot_id"), content_digest("content_sha256").alias("digest"), F.col("last_materialized_at").alias("at")]
    documents = table(spark, sf_dir, "source_inventory_documents").select(F.lit("source_inventory_documents").alias("source_table"), id_or_null("document_id").alias("entity_id"), *common)
    kind, unit = id_or_null("unit_kind"), id_or_null("unit_id")
    units = table(spark, sf_dir, "source_inventory_units").select(F.lit("source_inventory_units").alias("source_table"), F.when(kind.isNotNull() & unit.isNotNull(), F.concat_ws("|", kind, unit)).alias("entity_id"), *common)
    return documents.unionByName(units).where("corpus IS NOT NULL AND snapshot_id IS NOT NULL AND entity_id IS NOT NULL")


def inventory_changes(inventory: DataFrame, snapshots: DataFrame, bucket_rows: int = BUCKET_ROWS, first_cells: int = FIRST_CELLS) -> DataFrame:
    """(source_table, corpus, entity_id, snapshot_id, change_kind) between consecutive snapshots of each corpus.

    inventory: (source_table, corpus, entity_id, snapshot_id, digest, at). Rows without ids, or of a snapshot that ``snapshots`` doesn't
    date, take no part. Of repeated rows the latest ``at`` holds, unreadable times counting as earliest, then the larger digest.
    """
    present = inventory.groupBy("source_table", "corpus", "snapshot_id").agg(F.count("*").alias("n")).join(bounded(materialize(snapshot_order(snapshots))), ["corpus", "snapshot_id"])
    chain = materialize(present.orderBy("source_table", "corpus", "instant", "snapshot_id").withColumn("ord", F.monotonically_increasing_id()))
    line = Window.partitionBy("source_table", "corpus").orderBy("ord")
    chain = materialize(chain.select("source_table", "corpus", "snapshot_id", "ord", "n", F.lead("ord").over(line).alias("next_ord")))
    total = chain.agg(F.sum("n")).first()[0] or 0
    buckets = max(12, -(-total // bucket_rows))
    kh = F.xxhash64("source_table", "corpus", "entity_id")
    rows = inventory.join(bounded(chain.select("source_table", "corpus", "snapshot_id", "ord", "next_ord")), ["source_table", "corpus", "snapshot_id"])
    vh = F.when(F.col("digest").isNull(), F.lit(UNKNOWN).cast("long")).otherwise(F.xxhash64("digest"))
    rows = rows.select(kh.alias("kh"), F.pmod(kh, F.lit(buckets)).alias("bucket"), "ord", "next_ord", "source_table", "corpus", "entity_id", F.struct(F.coalesce(epoch_micros("at"), F.lit(-(2**63)).cast("long")).alias("at"), vh.alias("vh")).alias("x"))
    last = rows.repartition("bucket").groupBy("bucket", "kh", "ord", "next_ord", "source_table", "corpus", "entity_id").agg(F.max("x").alias("x")).select("bucket", "kh", "ord", "next_ord", "source_table", "corpus", "entity_id", "x.vh")
    last = materialize(last)
    changes = classify(snapshot_differences(last.select("bucket", "ord", "kh", "vh"), chain.select("ord", "next_ord"), first_cells), last)
    return changes.join(bounded(chain.select("ord", "snapshot_id")), "ord").select("source_table", "corpus", "entity_id", "snapshot_id", "change_kind")


def commit_changes(snapshots: DataFrame) -> DataFrame:
    """Snapshots whose commit differs from the one before; a shortened sha equals what begins with it, a blank one equals all."""
    w = Window.partitionBy("corpus").orderBy("instant", "snapshot_id")
    rows = snapshot_order(snapshots).withColumn("before", F.lag("sha").over(w))
    moved = F.col("before").isNotNull() & ~F.col("sha").startswith(F.col("before")) & ~F.col("before").startswith(F.col("sha"))
    return rows.where(moved).select(F.lit("snapshots").alias("source_table"), "corpus", F.col("corpus").alias("entity_id"), "snapshot_id", F.lit("changed").alias("change_kind"))


def p5_found(spark, sf_dir: str) -> DataFrame:
    snapshots = table(spark, sf_dir, "snapshots")
    return inventory_changes(_inventory(spark, sf_dir), snapshots).unionByName(commit_changes(snapshots))


def p5_report(spark, sf_dir: str) -> DataFrame:
    """Changes per table, corpus, snapshot and kind."""
    return p5_found(spark, sf_dir).groupBy("source_table", "corpus", "snapshot_id", "change_kind").agg(F.count("*").alias("records"))
