"""Histories of changing attributes (problem 3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryline.functions.cleaning import epoch_micros, id_or_null, strip, utc_text
from quarryline.plans.stages import HOT_ROWS, carry, materialize, split_hot, table


def observed_states(events: DataFrame, entity: str, recorded: str, delivered: str, attributes: dict[str, object]) -> DataFrame:
    """(entity, instant, one column an attribute): of an entity's rows with one instant, the one delivered last.

    Rows without a readable time or entity are left out; rows delivered at one time are told apart by their values. Other
    columns are ignored, whatever their names.
    """
    rows = events.select(id_or_null(F.col(entity)).alias("entity"), epoch_micros(F.col(recorded)).alias("instant"), F.col(delivered).alias("delivered"), F.struct(*[F.coalesce(c, F.lit("")).alias(a) for a, c in attributes.items()]).alias("state"))
    rows = rows.where(F.col("entity").isNotNull() & F.col("instant").isNotNull())
    last = rows.groupBy("entity", "instant").agg(F.max(F.struct("delivered", "state")).alias("last"))
    return last.select("entity", "instant", *[F.col(f"last.state.{a}").alias(a) for a in attributes])


#: A table has at most so many hot entities: their list is sent to every task.
MOST_HOT = 1_000_000


def by_heat(df: DataFrame, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """The rows of the usual entities and those, if there are any, of entities with more than hot_rows rows, or than a MOST_HOT-th of all.

    df is read twice and should be written out. The usual entities are parted by entity: all that follows needs no further exchange.
    """
    counts = df.groupBy("entity").agg(F.count("*").alias("n"))
    most, total = counts.agg(F.max("n"), F.sum("n")).first()
    least = max(hot_rows, (total or 0) // MOST_HOT)
    if (most or 0) <= least:
        return df.repartition("entity"), None
    hot = F.broadcast(counts.where(F.col("n") > least).select("entity"))  # MOST_HOT rows at most
    return df.join(hot, "entity", "left_anti").repartition("entity"), df.join(hot, "entity", "left_semi")


def _long(states: DataFrame, attributes: Sequence[str]) -> DataFrame:
    items = F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).alias("value")) for a in attributes])
    return states.select("entity", "instant", F.explode(items).alias("x")).select("entity", "x.attribute", "instant", "x.value")


def _log(states: DataFrame, attributes: Sequence[str]) -> DataFrame:
    w = Window.partitionBy("entity", "attribute").orderBy("instant")
    seen = _long(states, attributes).withColumn("before", F.lag(F.struct("value")).over(w))
    starts = seen.where(F.col("before").isNull() | ~F.col("before.value").eqNullSafe(F.col("value")))
    return starts.select("entity", "attribute", "value", F.col("instant").alias("valid_from"), F.lead("instant").over(w).alias("valid_to"))


def _log_in_buckets(states: DataFrame, attributes: Sequence[str], hot_rows: int) -> DataFrame:
    key = ["entity", "attribute"]
    long = split_hot(_long(states, attributes), key, "instant", hot_rows)
    seen = carry(long.withColumn("held", F.struct("value")), key, "instant", {"before": "held"})
    log = seen.where(F.col("before").isNull() | ~F.col("before.value").eqNullSafe(F.col("value"))).select(*key, "value", "instant", "_bucket")
    return carry(log, key, "instant", {"valid_to": "instant"}, forward=False).select(*key, "value", F.col("instant").alias("valid_from"), "valid_to")


def attribute_log(states: DataFrame, attributes: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """(entity, attribute, value, valid_from, valid_to): the intervals of each attribute by itself; valid_to is null for the last.

    states: as from observed_states, one row an entity and instant. A repeated value opens no interval. Entities of more than hot_rows
    instants are worked on in several buckets of time.
    """
    usual, hot = by_heat(states, hot_rows)
    log = _log(usual, attributes)
    return log if hot is None else log.unionByName(_log_in_buckets(hot, attributes, hot_rows))


def _boundaries(log: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """(entity, instant, own_...): one row a boundary, with what begins there of each attribute."""
    return log.groupBy("entity", F.col("valid_from").alias("instant")).agg(*[F.max(F.when(F.col("attribute") == a, F.struct("value"))).alias(f"own_{a}") for a in attributes])


def _combined(log: DataFrame, attributes: Sequence[str]) -> DataFrame:
    w = Window.partitionBy("entity").orderBy("instant")
    held = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = F.struct(*[F.last(f"own_{a}", ignorenulls=True).over(held)["value"].alias(a) for a in attributes])
    full = _boundaries(log, attributes).select("entity", "instant", state.alias("state"))
    begins = full.withColumn("before", F.lag("state").over(w)).where(~F.col("state").eqNullSafe(F.col("before")))
    return begins.select("entity", F.col("instant").alias("valid_from"), F.lead("instant").over(w).alias("valid_to"), *[F.col(f"state.{a}").alias(a) for a in attributes])


def _combined_in_buckets(log: DataFrame, attributes: Sequence[str], hot_rows: int) -> DataFrame:
    cut = split_hot(_boundaries(log, attributes), ["entity"], "instant", hot_rows)
    full = carry(cut, ["entity"], "instant", {f"old_{a}": f"own_{a}" for a in attributes}, ignore_null=True)
    full = full.select("entity", "instant", "_bucket", F.struct(*[F.coalesce(f"own_{a}", f"old_{a}")["value"].alias(a) for a in attributes]).alias("state"))
    whole = carry(full, ["entity"], "instant", {"before": "state"}).where(~F.col("state").eqNullSafe(F.col("before")))
    whole = carry(whole.drop("before"), ["entity"], "instant", {"valid_to": "instant"}, forward=False)
    return whole.select("entity", F.col("instant").alias("valid_from"), "valid_to", *[F.col(f"state.{a}").alias(a) for a in attributes])


def combine_logs(log: DataFrame, attributes: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """(entity, valid_from, valid_to, one column an attribute): versions of the whole, from the attributes' intervals.

    Time is split at the union of all boundaries, each attribute is carried to the boundaries that are not its own, and
    neighbours that agree are joined into one version.
    """
    usual, hot = by_heat(log, hot_rows)
    whole = _combined(usual, attributes)
    return whole if hot is None else whole.unionByName(_combined_in_buckets(hot, attributes, hot_rows))


def versions(states: DataFrame, attributes: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """The same versions straight from the states: combine_logs of attribute_log, on one exchange by entity; hot entities are looked for once."""
    usual, hot = by_heat(states, hot_rows)
    whole = _combined(_log(usual, attributes), attributes)
    if hot is None:
        return whole
    return whole.unionByName(_combined_in_buckets(materialize(_log_in_buckets(hot, attributes, hot_rows)), attributes, hot_rows))


#: The attributes of a guideline's mapping.
MAPPING = ("effective_fls_id", "resolution_status")


def mapping_states(spark, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "guideline_fls_resolution_history", "guideline_id", "effective_fls_id", "resolution_status", "recorded_at", "delivered_at")
    return materialize(observed_states(events, "guideline_id", "recorded_at", "delivered_at", {"effective_fls_id": strip("effective_fls_id"), "resolution_status": F.lower(strip("resolution_status"))}))


def mapping_log(spark, sf_dir: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    return attribute_log(mapping_states(spark, sf_dir), MAPPING, hot_rows)


def mapping_versions(spark, sf_dir: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every version of every guideline's mapping, times as microseconds."""
    return versions(mapping_states(spark, sf_dir), MAPPING, hot_rows)


def p3_found(spark, sf_dir: str) -> DataFrame:
    v = mapping_versions(spark, sf_dir)
    return v.select(F.col("entity").alias("guideline_id"), utc_text("valid_from").alias("valid_from"), F.coalesce(utc_text("valid_to"), F.lit("")).alias("valid_to"))


def p3_versions(spark, sf_dir: str) -> DataFrame:
    v = mapping_versions(spark, sf_dir)
    return v.select(F.col("entity").alias("guideline_id"), utc_text("valid_from").alias("valid_from"), F.coalesce(utc_text("valid_to"), F.lit("")).alias("valid_to"), *MAPPING)


def p3_attribute_log(spark, sf_dir: str) -> DataFrame:
    g = mapping_log(spark, sf_dir)
    return g.select(F.col("entity").alias("guideline_id"), "attribute", "value", utc_text("valid_from").alias("valid_from"), F.coalesce(utc_text("valid_to"), F.lit("")).alias("valid_to"))
