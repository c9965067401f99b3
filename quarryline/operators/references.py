"""References to records that do not exist (problem 4)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.functions.cleaning import id_or_null, month_of, strip
from quarryline.plans.stages import materialize, table

#: What stands for "not yet resolved" and so refers to nothing.
UNRESOLVED = "fls_UNRESOLVED"


@dataclass(frozen=True)
class ForeignKey:
    """A column of one table that names records of another.

    row_key: the child's own key; reference: the expression that gives the parent's id, null where there is none; delivered: the
    child's time of delivery, or None; removed: the parent's time of removal, or None where its table has none.
    """

    child: str
    row_key: Column
    reference: Column
    parent: str
    parent_key: Column
    delivered: str | None = "delivered_at"
    parent_delivered: str | None = "delivered_at"
    removed: str | None = "removed_at"


def link_target(col: str) -> Column:
    """The id in a reference, plain or as a link's fragment; null for blanks and for the placeholder."""
    plain = strip(F.regexp_replace(F.col(col), "(?s)^.*#", ""))
    return F.nullif(F.nullif(plain, F.lit("")), F.lit(UNRESOLVED))


def parent_state(parents: DataFrame, fk: ForeignKey) -> DataFrame:
    """(ref, gone, arrived): one row an id of the parent table; gone if every row of it was removed."""
    gone = F.col(fk.removed).isNotNull() if fk.removed else F.lit(False)
    arrived = F.col(fk.parent_delivered) if fk.parent_delivered else F.lit(None).cast("timestamp_ntz")
    rows = parents.select(fk.parent_key.alias("ref"), gone.alias("gone"), arrived.alias("arrived")).where(F.col("ref").isNotNull())
    return rows.groupBy("ref").agg(F.min("gone").alias("gone"), F.min("arrived").alias("arrived"))


def child_references(children: DataFrame, fk: ForeignKey) -> DataFrame:
    """(row_key, ref, first): one row a record and the id it names; first is the record's first delivery.

    Rows without a key are no records; a record whose repeated deliveries name several ids has a row for each.
    """
    first = F.col(fk.delivered) if fk.delivered else F.lit(None).cast("timestamp_ntz")
    rows = children.select(fk.row_key.alias("row_key"), fk.reference.alias("ref"), first.alias("first")).where(F.col("row_key").isNotNull())
    return rows.groupBy("row_key").agg(F.min("first").alias("first"), F.collect_set("ref").alias("refs")).select("row_key", "first", F.explode("refs").alias("ref"))


def direct_orphans(children: DataFrame, parents: DataFrame, fk: ForeignKey) -> DataFrame:
    """(source_table, row_key, orphan_kind, orphan_month): missing, deleted or late, by one join on the referred id.

    The parents have one row an id, so that a much-named id makes only the children's side large; the join is left without an exchange
    above it, and adaptive execution cuts such a partition in pieces.
    """
    joined = child_references(children, fk).join(parent_state(parents, fk), "ref", "left")
    kind = F.when(F.col("gone").isNull(), "missing").when(F.col("gone"), "deleted").when(F.col("arrived") > F.col("first"), "late")
    found = joined.select(F.lit(fk.child).alias("source_table"), "row_key", kind.alias("orphan_kind"), month_of("first").alias("orphan_month"))
    return found.where(F.col("orphan_kind").isNotNull())


def orphan_cascade(tables: Mapping[str, DataFrame], direct: Sequence[ForeignKey], inherited: Sequence[ForeignKey] = ()) -> DataFrame:
    """(source_table, row_key, orphan_kind, orphan_month, depth, inherited_from, inherited_key): direct orphans at depth 0, then their children.

    direct: keys whose own target is looked up. inherited: keys along which being an orphan passes on: records that refer
    to an orphaned record are orphans themselves, level by level until a level is empty, however deep. A record is reported
    at its first depth only, with the table and the least key of the orphans that it refers to. Every level is written out, since the next one and the result both read it. Empty tables give no rows.
    """
    level = None
    for fk in direct:
        found = direct_orphans(tables[fk.child], tables[fk.parent], fk)
        level = found if level is None else level.unionByName(found)
    level = level.withColumns({"depth": F.lit(0), "inherited_from": F.lit(None).cast("string"), "inherited_key": F.lit(None).cast("string")})
    total, hit_tables, known = level, {fk.child for fk in direct}, {fk.child for fk in direct}
    for depth in count(1):
        ahead = [fk for fk in inherited if fk.parent in hit_tables]
        if not ahead:
            return total
        if depth == 1:
            total = level = materialize(level)
        found = None
        for fk in ahead:
            orphans = level.where(F.col("source_table") == fk.parent).select(F.col("row_key").alias("ref")).distinct()
            hit = child_references(tables[fk.child], fk).join(orphans, "ref", "left_semi").select(F.lit(fk.child).alias("source_table"), "row_key", "first", F.lit(fk.parent).alias("parent"), "ref")
            found = hit if found is None else found.unionByName(hit)
        found = found.groupBy("source_table", "row_key").agg(F.min("first").alias("first"), F.min(F.struct("parent", "ref")).alias("by"))
        found = found.select("source_table", "row_key", F.lit("inherited").alias("orphan_kind"), month_of("first").alias("orphan_month"), F.lit(depth).alias("depth"), F.col("by.parent").alias("inherited_from"), F.col("by.ref").alias("inherited_key"))
        hit_tables = {fk.child for fk in ahead}
        if hit_tables & known:
            found = found.join(total.select("source_table", "row_key"), ["source_table", "row_key"], "left_anti")
        known |= hit_tables
        level = materialize(found)
        if level.isEmpty():
            return total
        total = total.unionByName(level)


def _keys() -> tuple[list[ForeignKey], list[ForeignKey]]:
    direct = [
        ForeignKey("guideline_fls_source_mappings", id_or_null("guideline_id"), link_target("raw_fls_id"), "paragraphs", id_or_null("paragraph_id")),
        ForeignKey("core_docs_chunk_metadata", id_or_null("chunk_uid"), link_target("chunk_uid"), "chunks", id_or_null("chunk_uid")),
        ForeignKey("guideline_blocks", id_or_null("block_id"), link_target("guideline_id"), "guideline_records", id_or_null("guideline_id")),
    ]
    history = F.concat_ws("|", id_or_null("guideline_id"), id_or_null("history_id"))
    candidate = F.concat_ws("|", id_or_null("audit_run_id"), id_or_null("guideline_id"), F.col("candidate_rank").cast("string"))
    inherited = [
        ForeignKey("guideline_fls_resolution_history", history, id_or_null("guideline_id"), "guideline_fls_source_mappings", id_or_null("guideline_id")),
        ForeignKey("guideline_fls_resolution_candidates", candidate, id_or_null("guideline_id"), "guideline_fls_source_mappings", id_or_null("guideline_id"), delivered=None),
    ]
    return direct, inherited


def _cascade(spark, sf_dir: str, direct: list[ForeignKey], inherited: list[ForeignKey]) -> DataFrame:
    names = {n for fk in [*direct, *inherited] for n in (fk.child, fk.parent)}
    return orphan_cascade({n: table(spark, sf_dir, n) for n in names}, direct, inherited)


def p4_found(spark, sf_dir: str) -> DataFrame:
    """The direct part of the whole cascade."""
    return _cascade(spark, sf_dir, *_keys()).where("depth = 0").select("source_table", "row_key", "orphan_kind", "orphan_month")


def p4_report(spark, sf_dir: str) -> DataFrame:
    """Orphans per table, month, kind and depth; null months are shown blank."""
    rows = _cascade(spark, sf_dir, *_keys())
    return rows.groupBy("source_table", F.coalesce("orphan_month", F.lit("")).alias("orphan_month"), "orphan_kind", "depth").agg(F.count("*").alias("orphans"))


def p4_cascade(spark, sf_dir: str) -> DataFrame:
    """Every inherited orphan with the orphan it hangs on: history rows on their guideline's mapping, and on these the candidates of the same guideline and audit run."""
    direct, (history, candidates) = _keys()
    run = F.concat_ws("|", id_or_null("guideline_id"), id_or_null("audit_run_id"))
    rows = ForeignKey(history.child, run, history.reference, history.parent, history.parent_key)
    below = ForeignKey(candidates.child, candidates.row_key, run, history.child, run, delivered=None)
    return _cascade(spark, sf_dir, direct[:1], [rows, below]).where("depth > 0").select("source_table", "row_key", F.coalesce("orphan_month", F.lit("")).alias("orphan_month"), "depth", "inherited_from", "inherited_key")
