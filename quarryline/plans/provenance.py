"""Fingerprints of pipeline runs, identities of tables, and filling in what is missing."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def canonical_hash(payload: Any) -> str:
    """SHA-256 of JSON with sorted names and no spaces: equal for equal payloads, whatever their order."""
    return hashlib.sha256(json.dumps(payload, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


class StaleRun(RuntimeError):
    """What a table was built from isn't what is asked for now."""


def guard_run(last: Mapping[str, Any] | None, now: Mapping[str, Any], allow_stale: bool = False) -> tuple[str, list[str]]:
    """The fingerprint of ``now`` and the names of the settings that changed since ``last``; raises StaleRun for changes unless they are allowed."""
    changed = [] if last is None else sorted(k for k in {*last, *now} if last.get(k) != now.get(k))
    if changed and not allow_stale:
        raise StaleRun(f"changed since the last run: {', '.join(changed)}")
    return canonical_hash(now), changed


def identities(df: DataFrame, group: str, *columns: str) -> DataFrame:
    """(group, n, identity): a count and a digest of a group's rows that is the same in every order.

    The digest adds up pieces of the rows' hashes, so that nothing is gathered or sorted and every task contributes one sum a group.
    """
    h = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256)
    piece = lambda at: F.sum(F.conv(F.substring(h, at, 8), 16, 10).cast("long"))
    return df.groupBy(group).agg(F.count("*").alias("n"), F.concat_ws("-", piece(1), piece(9)).alias("identity"))


def regressions(before: DataFrame, after: DataFrame, group: str) -> DataFrame:
    """The groups whose count or identity changed, appeared or went; empty if nothing that should stay has moved."""
    b = before.select(group, F.struct("n", "identity").alias("before"))
    a = after.select(group, F.struct("n", "identity").alias("after"))
    return b.join(a, group, "full_outer").where(~F.col("before").eqNullSafe(F.col("after")))


def fill_if_empty(existing: DataFrame, make: Callable[[], DataFrame]) -> DataFrame:
    """The table itself or, if it has no rows, what can be derived for it; doing so again changes nothing."""
    return make().select(*existing.columns) if existing.isEmpty() else existing
