"""The core queries and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from quarryline.operators import corpus, evaluation, history, nested, pipeline, references, relational, resolution, retrieval, rules, snapshots  # noqa: F401
from quarryline.plans import catalog, problem_oracles

FLAGSHIP = "p4_found"


def queries() -> dict[str, Callable]:
    return {
        **nested.queries(),
        "p3_found": history.p3_found, "p3_versions": history.p3_versions, "p3_attribute_log": history.p3_attribute_log,
        "p4_found": references.p4_found, "p4_report": references.p4_report, "p4_cascade": references.p4_cascade,
        "p5_found": snapshots.p5_found, "p5_report": snapshots.p5_report,
        **catalog.QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    return problem_oracles.oracle_sql() | catalog.ORACLES
