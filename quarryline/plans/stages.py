"""What the iterative operators share: shared-folder checkpoints and ways round hot keys."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of one key beyond which it is split into several window partitions.
HOT_ROWS = 200_000
#: Cut points of a hot key.
HOT_CUTS = 63


def materialize(df: DataFrame) -> DataFrame:
    """The rows, written to the folder of spark.checkpoint.dir; a lost executor costs no recomputation.

    Only a local session without that setting gets a folder of its own.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="quarryline-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


#: The most bytes that are sent to every task; more are joined by exchange.
BROADCAST_BYTES = 64_000_000


def bounded(df: DataFrame, row_bytes: int = 200) -> DataFrame:
    """df, which should be written out, to be sent to every task if its rows, counted, are within BROADCAST_BYTES; else to be joined by exchange."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df.hint("merge")


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A Parquet table, or the named columns of it."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def split_hot(df: DataFrame, key: list[str], order: str, hot_rows: int = HOT_ROWS, out: str = "_bucket") -> DataFrame:
    """Adds a bucket number, 0 but for keys of more than ``hot_rows`` rows, which are cut at quantiles of ``order``.

    There are at most rows / hot_rows hot keys, each with HOT_CUTS cut points, so the joined side is bounded by
    HOT_CUTS / hot_rows of the input. Buckets follow the order: a later bucket holds only larger values.
    """
    hot = df.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows).select(*key)
    cuts = df.join(hot, key, "left_semi").groupBy(*key).agg(F.percentile_approx(order, F.array(*[F.lit(i / (HOT_CUTS + 1)) for i in range(1, HOT_CUTS + 1)]), F.lit(2000)).alias("_cuts"))
    bucket = F.coalesce(F.size(F.filter(F.array_distinct("_cuts"), lambda c: c < F.col(order))), F.lit(0))
    return df.join(cuts, key, "left").withColumn(out, F.when(F.col("_cuts").isNull(), 0).otherwise(bucket)).drop("_cuts")


def carry(df: DataFrame, key: list[str], order: str, values: dict[str, str], bucket: str = "_bucket", forward: bool = True, ignore_null: bool = False) -> DataFrame:
    """Adds, for each ``new: old`` of values, old's value in the key's row before (or, not forward, after) this one.

    ``order`` must be unique within a key. Each bucket is one window partition; what crosses a bucket's edge comes from a table of
    one row per bucket. With ignore_null, nulls are passed over.
    """
    turn = (lambda c: F.col(c).asc()) if forward else (lambda c: F.col(c).desc())
    inner = Window.partitionBy(*key, bucket).orderBy(turn(order))
    before = inner.rowsBetween(Window.unboundedPreceding, -1)
    pick = (lambda c, w: F.last(c, ignorenulls=True).over(w)) if ignore_null else (lambda c, w: F.lag(c).over(w))
    frame = before if ignore_null else inner
    out = df
    for new, old in values.items():
        out = out.withColumn(new, pick(old, frame))
    out = out.withColumn("_rn", F.row_number().over(inner))
    far = F.max_by if forward else F.min_by
    edges = df.groupBy(*key, bucket).agg(*[far(F.struct(F.col(old).alias("v")), F.when(F.col(old).isNotNull(), F.col(order)) if ignore_null else F.col(order)).alias(f"_e_{new}") for new, old in values.items()])
    outer = Window.partitionBy(*key).orderBy(turn(bucket)).rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select(*key, bucket, *[F.last(f"_e_{new}", ignorenulls=True).over(outer).alias(f"_e_{new}") for new in values])
    edges = edges.where(" OR ".join(f"_e_{new} IS NOT NULL" for new in values))
    out = out.join(edges, [*key, bucket], "left")
    for new in values:
        edge = F.col(f"_e_{new}.v")
        out = out.withColumn(new, F.coalesce(new, edge) if ignore_null else F.when(F.col("_rn") == 1, edge).otherwise(F.col(new)))
    return out.drop("_rn", *[f"_e_{new}" for new in values])


def salts_for(rows: int, part_rows: int = 100_000) -> int:
    """How many salts, a power of two and 256 at least, keep the parts of a key of so many rows near ``part_rows``."""
    return max(256, 1 << max(0, -(-rows // part_rows) - 1).bit_length())


def rank_in_key(df: DataFrame, key: list[str], order: list[str], salts: int = 256, out: str = "rank") -> DataFrame:
    """Adds the zero-based rank of a row within its key by a seeded hash of ``order``, which must be unique.

    A key is cut into ``salts`` ranges of the hash, ranked apart and shifted by the sizes of the ranges before; a key of a third of
    all rows is so spread over ``salts`` window partitions. The table of sizes has at most salts rows a key.
    """
    h = df.withColumn("_h", F.xxhash64(*order)).withColumn("_salt", F.shiftrightunsigned("_h", 64 - (salts - 1).bit_length()).cast("int"))
    sizes = h.groupBy(*key, "_salt").agg(F.count("*").alias("_n"))
    outer = Window.partitionBy(*key).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select(*key, "_salt", F.coalesce(F.sum("_n").over(outer), F.lit(0)).alias("_shift"))
    inner = Window.partitionBy(*key, "_salt").orderBy("_h", *order)
    ranked = h.withColumn("_r", F.row_number().over(inner) - 1)
    return ranked.join(shift, [*key, "_salt"]).withColumn(out, F.col("_r") + F.col("_shift")).drop("_h", "_salt", "_r", "_shift")
