"""Mixing sources to target shares (problem 8)."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.functions.cleaning import strip
from quarryline.llm.tokens import token_counts
from quarryline.plans.stages import materialize, rank_in_key, salts_for, table

#: The rest of a budget that dynamic programming fits exactly; what is more is first taken in proportion.
REST = 65_536
SEED = 17


@dataclass(frozen=True)
class SourcePlan:
    """How often every document of a source is used (laps), and of how many documents of each length once more."""

    budget: int
    laps: int
    extra: dict[int, int]


def fit_subset(counts: Mapping[int, int], target: int, rest: int = REST) -> dict[int, int]:
    """Numbers of items by length, at most ``counts``, whose lengths add up to target or to the nearest reachable sum below.

    Every length first gives the same share of its items, rounded down; longest lengths first then bring the rest under ``rest``, and
    bounded-knapsack dynamic programming over sets of reachable sums (one bit a sum) fits what remains.
    """
    total = sum(length * n for length, n in counts.items())
    target = max(0, min(target, total))
    if not target:
        return {}
    take = {length: n * target // total for length, n in counts.items() if length > 0}
    open_ = target - sum(length * n for length, n in take.items())
    for length in sorted(take, reverse=True):
        more = min(counts[length] - take[length], max(0, open_ - rest) // length)
        take[length] += more
        open_ -= more * length
    mask = (1 << (open_ + 1)) - 1
    sums, steps = 1, []
    for length in sorted(take):
        spare, lot = min(counts[length] - take[length], open_ // length), 1
        while spare and not sums >> open_ & 1:
            lot = min(lot, spare)
            steps.append((sums, length, lot))
            sums = (sums | sums << length * lot) & mask
            spare -= lot
            lot *= 2
    at = sums.bit_length() - 1
    for before, length, lot in reversed(steps):
        if not before >> at & 1:
            take[length] += lot
            at -= length * lot
    return {length: n for length, n in take.items() if n}


def plan_mix(counts: Mapping[str, Mapping[int, int]], targets: Mapping[str, tuple[float, int]], total: int | None = None) -> tuple[int, dict[str, SourcePlan]]:
    """The total to aim at and the plan of each source; targets: share and largest number of uses of a document.

    Without a total, it is the largest at which no source runs out. A source without tokens can't have its share: it gets a budget of 0, and the
    shares of the others are scaled up to 1.
    """
    size = {s: sum(length * n for length, n in counts.get(s, {}).items()) for s in targets}
    live = {s: share for s, (share, uses) in targets.items() if size[s] and share > 0 and uses > 0}
    scale = math.fsum(live.values())
    if not live:
        return 0, {s: SourcePlan(0, 0, {}) for s in targets}
    most = min(int(size[s] * targets[s][1] * scale / share) for s, share in live.items())
    total = most if total is None else min(total, most)
    plans = {}
    for s in targets:
        budget = min(round(live[s] / scale * total), size[s] * targets[s][1]) if s in live else 0
        laps = budget // size[s] if size[s] else 0
        plans[s] = SourcePlan(budget, laps, fit_subset(counts[s], budget - laps * size[s]) if budget else {})
    return total, plans


def source_name(col: str) -> Column:
    """One spelling of a source's name: lower case, stripped, with underscores; null if blank."""
    return F.nullif(F.regexp_replace(F.lower(strip(col)), "[ -]+", "_"), F.lit(""))


def mix(sized: DataFrame, targets: DataFrame, total: int | None = None, seed: int = SEED) -> tuple[DataFrame, dict[str, SourcePlan], dict[str, tuple[float, int]]]:
    """(doc_id, source, n_tokens, uses) of the selected documents, the plans and the targets.

    sized: (doc_id, source, n_tokens), doc_id unique, source in one spelling. targets is a small, fixed table (source, target_share, max_repeats);
    of repeated sources one row counts. Only the number of documents of each source and length comes to the driver. Which documents of a length are
    used once more is settled by a seeded hash, ranked in salted parts. Documents without tokens, or of no listed source, aren't selected.
    """
    wanted = {r["source"]: (float(r["target_share"] or 0), int(r["max_repeats"] or 0)) for r in targets.select(source_name("source").alias("source"), "target_share", "max_repeats").where("source IS NOT NULL").collect()}
    listed = materialize(sized.select("doc_id", "source", "n_tokens").where(F.col("source").isin(list(wanted)) & (F.col("n_tokens") > 0)))
    counts: dict[str, dict[int, int]] = {s: {} for s in wanted}
    for r in listed.groupBy("source", "n_tokens").agg(F.count("*").alias("n")).collect():
        counts[r["source"]][r["n_tokens"]] = r["n"]
    _, plans = plan_mix(counts, wanted, total)
    spark = sized.sparkSession
    rows = [(s, length, plans[s].laps, plans[s].extra.get(length, 0)) for s in counts for length in counts[s]]
    plan = spark.createDataFrame(rows, "source string, n_tokens long, laps long, extra long")  # a row a source and length
    ranked = rank_in_key(listed.withColumn("_seed", F.lit(seed)), ["source", "n_tokens"], ["_seed", "doc_id"], salts_for(max((n for c in counts.values() for n in c.values()), default=0)))
    used = ranked.join(plan, ["source", "n_tokens"]).withColumn("uses", (F.col("laps") + F.when(F.col("rank") < F.col("extra"), 1).otherwise(0)).cast("int"))
    return used.where("uses > 0").select("doc_id", "source", "n_tokens", "uses"), plans, wanted


def _documents(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents", "doc_id", "source", "text").select("doc_id", source_name("source").alias("source"), "text").where("source IS NOT NULL")
    return token_counts(rows, "text")


def p8_selection(spark, sf_dir: str) -> DataFrame:
    return mix(_documents(spark, sf_dir), table(spark, sf_dir, "mix_targets"))[0]


def p8_report(spark, sf_dir: str) -> DataFrame:
    """Per source of the targets: its share as wanted and as reached, documents, uses, tokens and the most uses of one document."""
    selected, plans, wanted = mix(_documents(spark, sf_dir), table(spark, sf_dir, "mix_targets"))
    goal = spark.createDataFrame([(s, share, uses, plans[s].budget) for s, (share, uses) in wanted.items()], "source string, target_share double, max_repeats int, budget long")
    got = selected.groupBy("source").agg(F.count("*").alias("documents"), F.sum("uses").alias("uses"), F.sum(F.col("uses") * F.col("n_tokens")).alias("tokens"), F.max("uses").alias("most_uses"))
    report = goal.join(got, "source", "left").na.fill(0, ["documents", "uses", "tokens", "most_uses"])
    whole = got.agg(F.sum("tokens").alias("whole"))
    return report.join(F.broadcast(whole)).select("source", "target_share", F.coalesce(F.col("tokens") / F.col("whole"), F.lit(0.0)).alias("actual_share"), "documents", "uses", "tokens", "budget", "max_repeats", "most_uses")


#: How far a share may lie from its target for p8_checks.
NEAR = 1e-3


def p8_checks(spark, sf_dir: str) -> DataFrame:
    """Per source of the targets: whether its share is reached within NEAR or one document of it, and how many of its documents are used too often, twice listed, or none of its own."""
    targets, documents = table(spark, sf_dir, "mix_targets"), _documents(spark, sf_dir)
    selected, _, wanted = mix(documents, targets)
    selected = materialize(selected)
    bound = spark.createDataFrame([(s, share, uses) for s, (share, uses) in wanted.items()], "source string, target_share double, max_repeats int")  # the targets
    own = selected.join(documents.select("doc_id", F.col("source").alias("its"), F.col("n_tokens").alias("size")), "doc_id", "left")
    rows = own.join(F.broadcast(bound), "source").groupBy("source").agg(
        F.count_if(F.col("uses") > F.col("max_repeats")).alias("over_repeats"), (F.count("*") - F.countDistinct("doc_id")).alias("repeated_rows"),
        F.count_if(~F.col("its").eqNullSafe(F.col("source")) | ~F.col("size").eqNullSafe(F.col("n_tokens"))).alias("not_its_own"), F.sum(F.col("uses") * F.col("n_tokens")).alias("tokens"))
    whole = rows.agg(F.sum("tokens").alias("whole"))
    rows = F.broadcast(bound).join(rows, "source", "left").join(F.broadcast(whole))
    longest = documents.groupBy("source").agg(F.max("n_tokens").alias("longest"))
    rows = rows.join(longest, "source", "left")
    near = F.abs(F.coalesce("tokens", F.lit(0)) - F.col("target_share") * F.col("whole")) <= F.greatest(F.lit(NEAR) * F.col("whole"), F.coalesce("longest", F.lit(0)))
    return rows.select("source", "max_repeats", near.alias("within"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("over_repeats", "repeated_rows", "not_its_own")])


ORACLES = {"p8_checks": "SELECT lower(trim(source)) AS source, max_repeats, true AS within, 0 AS over_repeats, 0 AS repeated_rows, 0 AS not_its_own FROM mix_targets"}
