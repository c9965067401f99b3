"""The queries of the operators for training data, and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from quarryline.llm import mixing, neardup, packing, reading, splitting


def queries() -> dict[str, Callable]:
    return {
        "p2_found": splitting.p2_found, "p2_pieces": splitting.p2_pieces,
        "p6_found": neardup.p6_found, "p6_groups": neardup.p6_groups,
        "p7_packing": packing.p7_packing, "p7_report": packing.p7_report, "p7_checks": packing.p7_checks,
        "p8_selection": mixing.p8_selection, "p8_report": mixing.p8_report, "p8_checks": mixing.p8_checks,
        "p9_found": reading.p9_found, "p9_steps": reading.p9_steps, "p9_levels": reading.p9_levels, "p9_profile": reading.p9_profile,
    }


def oracle_sql() -> dict[str, str]:
    return splitting.ORACLES | neardup.ORACLES | packing.ORACLES | mixing.ORACLES | reading.ORACLES
