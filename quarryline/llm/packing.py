"""Filling fixed-capacity containers with documents (problem 7)."""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.tokens import token_counts
from quarryline.plans.stages import materialize, rank_in_key, salts_for, table

#: Tokens of a container, the context sizes that documents are routed to, and containers of a training step.
CAPACITY, TIERS, STEP = 2048, (256, 512, 1024, 2048), 64


@dataclass(frozen=True)
class Pattern:
    """``times`` containers that all hold the same lengths: (length, how often), longest first; tier is that of the longest."""

    lengths: tuple[tuple[int, int], ...]
    times: int
    tier: int

    @property
    def used(self) -> int:
        return sum(length * n for length, n in self.lengths)

    @property
    def cost(self) -> int:
        return sum(length * length * n for length, n in self.lengths)


def plan_containers(counts: Mapping[int, int], capacity: int = CAPACITY, tiers: tuple[int, ...] = TIERS) -> list[Pattern]:
    """Patterns that together hold every item of a table of lengths (1 to capacity) and their numbers.

    One pass, longest first: a container begins with the longest item left and is filled always with the longest item that fits, so that items of
    its own tier come before those of shorter ones. Tiers label the patterns and do not change them. A pattern is repeated as often as the numbers allow, so that
    the work and the plan depend on the lengths there are, at most ``capacity``, and not on the number of items.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    stock: list[int] = []
    for length in sorted(left):
        insort(stock, length)
    plan: list[Pattern] = []
    bounds = [0, *tiers]
    for t in range(len(tiers) - 1, -1, -1):
        low = bounds[t]
        while stock and stock[-1] > low:
            room, pattern, ceiling = capacity, {}, len(stock)
            while room and ceiling:
                ceiling = bisect_right(stock, room, 0, ceiling)
                while ceiling and left[stock[ceiling - 1]] <= pattern.get(stock[ceiling - 1], 0):
                    ceiling -= 1
                if not ceiling:
                    break
                length = stock[ceiling - 1]
                n = min(room // length, left[length] - pattern.get(length, 0))
                pattern[length] = pattern.get(length, 0) + n
                room -= n * length
            times = min(left[length] // n for length, n in pattern.items())
            for length, n in pattern.items():
                left[length] -= n * times
                if not left[length]:
                    del left[length]
            stock = [x for x in stock if x in left]
            plan.append(Pattern(tuple(sorted(pattern.items(), reverse=True)), times, tiers[t]))
    return plan


def pieces_of(sized: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece_no, token_start, n_tokens): one row a document, several only where it is larger than a container."""
    cuts = F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("n_tokens") / capacity) - 1, F.lit(0)).cast("long"))
    rows = sized.select("doc_id", "n_tokens", F.explode(cuts).alias("piece_no"))
    start = F.col("piece_no") * capacity
    return rows.select("doc_id", F.col("piece_no").cast("int").alias("piece_no"), start.alias("token_start"), F.least(F.lit(capacity), F.col("n_tokens") - start).cast("long").alias("n_tokens"))


def pack(sized: DataFrame, capacity: int = CAPACITY, tiers: tuple[int, ...] = TIERS, step: int = STEP) -> DataFrame:
    """(doc_id, piece_no, token_start, n_tokens, tier, container_id, container_offset, step_group): every piece's place.

    sized: (doc_id, n_tokens), doc_id unique. Only the table of lengths, at most ``capacity`` rows, comes to the driver. Items of one length are
    ranked by a hash, in salted parts, and a rank names a container through the plan, whose size is bounded by the lengths.
    Containers are numbered by falling cost (the sum of squared lengths) and dealt to and fro over the steps, so that steps cost alike.
    Documents without tokens take no room and have null places.
    """
    if tiers[-1] != capacity:
        raise ValueError("the largest tier must be the capacity")
    pieces = materialize(pieces_of(sized, capacity))
    counts = {r["n_tokens"]: r["n"] for r in pieces.where("n_tokens > 0").groupBy("n_tokens").agg(F.count("*").alias("n")).collect()}
    plan = sorted(plan_containers(counts, capacity, tiers), key=lambda p: (-p.cost, p.lengths))
    total = sum(p.times for p in plan)
    steps = max(1, -(-total // step))
    segments, taken, base = [], dict.fromkeys(counts, 0), 0
    for p in plan:
        offset = 0
        for length, n in p.lengths:
            segments.append((length, taken[length], n, base, offset, p.tier))
            taken[length] += n * p.times
            offset += n * length
        base += p.times
    segments.sort()
    seg = np.array(segments, np.int64).reshape(-1, 6)
    shared = sized.sparkSession.sparkContext.broadcast((seg, (seg[:, 0] << 48) + seg[:, 1]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg, first = shared.value
        for batch in batches:
            length, rank = batch.column("n_tokens").to_numpy(), batch.column("rank").to_numpy()
            s = seg[np.searchsorted(first, (length << 48) + rank, side="right") - 1]
            nth = rank - s[:, 1]
            container = s[:, 3] + nth // s[:, 2]
            offset = s[:, 4] + nth % s[:, 2] * length
            lap, at = container // steps, container % steps
            group = np.where(lap % 2 == 0, at, steps - 1 - at)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "piece_no", "token_start", "n_tokens")], pa.array(s[:, 5].astype(np.int32)), pa.array(container), pa.array(offset.astype(np.int32)), pa.array(group)], names=names)

    names = ["doc_id", "piece_no", "token_start", "n_tokens", "tier", "container_id", "container_offset", "step_group"]
    ranked = rank_in_key(pieces.where("n_tokens > 0"), ["n_tokens"], ["doc_id", "piece_no"], salts_for(max(counts.values(), default=0))).select("doc_id", "piece_no", "token_start", "n_tokens", F.col("rank").cast("long").alias("rank"))
    schema = f"doc_id {dict(sized.dtypes)['doc_id']}, piece_no int, token_start long, n_tokens long, tier int, container_id long, container_offset int, step_group long"
    placed = ranked.mapInArrow(place, schema) if len(seg) else sized.sparkSession.createDataFrame([], schema)
    empty = pieces.where("n_tokens = 0").selectExpr("doc_id", "piece_no", "token_start", "n_tokens", "cast(null AS int) AS tier", "cast(null AS long) AS container_id", "cast(null AS int) AS container_offset", "cast(null AS long) AS step_group")
    return placed.unionByName(empty)


def p7_packing(spark, sf_dir: str) -> DataFrame:
    return pack(token_counts(table(spark, sf_dir, "documents", "doc_id", "text"), "text"))


def p7_report(spark, sf_dir: str) -> DataFrame:
    """Containers, pieces, tokens and the share of room used, per tier."""
    placed = p7_packing(spark, sf_dir).where("container_id IS NOT NULL")
    boxes = placed.groupBy("container_id").agg(F.max("tier").alias("tier"), F.count("*").alias("pieces"), F.sum("n_tokens").alias("tokens"))
    return boxes.groupBy("tier").agg(F.count("*").alias("containers"), F.sum("pieces").alias("pieces"), F.sum("tokens").alias("tokens"), (F.sum("tokens") / (F.count("*") * CAPACITY)).alias("fill"))


def p7_checks(spark, sf_dir: str) -> DataFrame:
    """One row: the documents and how many break a rule of packing: lost or repeated, their pieces not following on one another, cut although
    they fit, or without a place although they have tokens; the containers that are too full or have gaps, and the steps of more than STEP containers."""
    sized = token_counts(table(spark, sf_dir, "documents", "doc_id", "text"), "text").select("doc_id", F.col("n_tokens").alias("whole"))
    placed = materialize(pack(sized.withColumnRenamed("whole", "n_tokens")))
    follows = F.col("token_start") == F.col("piece_no") * CAPACITY
    docs = placed.groupBy("doc_id").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("pieces"), F.count_if(~follows).alias("apart"), F.count_if((F.col("n_tokens") > 0) & F.col("container_id").isNull()).alias("unplaced"))
    docs = sized.join(docs, "doc_id", "full_outer")
    lost = F.count_if(~F.col("whole").eqNullSafe(F.col("tokens")))
    cut = F.count_if(F.col("pieces") > F.greatest(F.ceil(F.col("whole") / CAPACITY), F.lit(1)))
    first = docs.agg(F.count("*").alias("documents"), lost.alias("lost"), F.count_if(F.col("apart") > 0).alias("apart"), cut.alias("needless_cuts"), F.count_if(F.col("unplaced") > 0).alias("unplaced"))
    ends = F.max(F.col("container_offset") + F.col("n_tokens"))
    boxes = placed.where("container_id IS NOT NULL").groupBy("container_id", "step_group").agg(F.sum("n_tokens").alias("tokens"), ends.alias("ends"), F.min("container_offset").alias("begins"))
    second = boxes.agg(F.count_if(F.col("tokens") > CAPACITY).alias("too_full"), F.count_if((F.col("ends") != F.col("tokens")) | (F.col("begins") != 0)).alias("with_gaps"))
    third = boxes.groupBy("step_group").agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > STEP).alias("large_steps"))
    return first.join(F.broadcast(second)).join(F.broadcast(third))  # a row each


ORACLES = {"p7_checks": "SELECT count(*) AS documents, 0 AS lost, 0 AS apart, 0 AS needless_cuts, 0 AS unplaced, 0 AS too_full, 0 AS with_gaps, 0 AS large_steps FROM documents"}
