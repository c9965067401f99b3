"""Models as parts of a plan: scores and vectors in batches, with retries inside the task and a flag where the model gave out."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

#: Texts of one call. A fixed value.
BATCH = 32


def with_retries(call: Callable[[], list[float]], retries: int, pause: float = 0.2) -> list[float] | None:
    """The call's result, tried once and ``retries`` times more with growing pauses; None if it always failed."""
    for attempt in range(retries + 1):
        try:
            return call()
        except Exception:  # a model's failure, whatever its class, only counts as an attempt
            if attempt < retries:
                time.sleep(pause * (attempt + 1))
    return None


def aligned(values: Sequence[dict] | Sequence[float], size: int) -> list[float]:
    """Scores in the order of the texts from either plain numbers or rows with an index; 0.0 for what is missing."""
    out = [0.0] * size
    for i, v in enumerate(values):
        at, score = (v.get("index", i), v.get("relevance_score", v.get("score", 0.0))) if isinstance(v, dict) else (i, v)
        if isinstance(at, int) and 0 <= at < size:
            out[at] = float(score or 0.0)
    return out


def model_scores(pairs: DataFrame, scorer: Callable[[list[str], list[str]], Sequence], retries: int = 2, batch: int = BATCH) -> DataFrame:
    """(query_id, id, score, degraded): what a model says of (query, text), batch by batch.

    pairs: (query_id, id, query, text). scorer takes two lists of one length and is sent to the workers. A batch whose calls all fail has scores of 0 and is
    flagged, so that a caller can fall back to another ranking; nothing is lost.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, batch):
                part = whole.slice(begin, batch)
                queries, texts = ([x or "" for x in part.column(c).to_pylist()] for c in (2, 3))
                got = with_retries(lambda q=queries, t=texts: aligned(scorer(q, t), len(t)), retries)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(got or [0.0] * part.num_rows, pa.float64()), pa.array([got is None] * part.num_rows)], names=["query_id", "id", "score", "degraded"])

    kinds = dict(pairs.dtypes)
    return pairs.select("query_id", "id", "query", "text").mapInArrow(run, f"query_id {kinds['query_id']}, id {kinds['id']}, score double, degraded boolean")
