"""Splitting oversized texts at natural boundaries (problem 2)."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.functions.cleaning import id_or_null, strip
from quarryline.plans.stages import table

#: Most characters of a piece, and how many of them repeat the end of the piece before.
LIMIT, OVERLAP = 1200, 120
#: A coarser boundary is taken only if it fills this share of a piece; else a finer one is looked for.
LEAST_FILL = 0.5

_W = r"[ \t\r\n]"
#: What parts pieces, from the coarsest to the finest; each matches the white space between what it parts.
SEPARATORS = (
    ("section", re.compile(rf"\n{_W}*\n(?=[^\n]+\n(?:={{3,}}|-{{3,}}|~{{3,}}|\^{{3,}}|\"{{3,}})[ \t\r]*(?:\n|\Z))|\n{_W}*(?=#{{1,6}}[ \t])")),
    ("paragraph", re.compile(rf"\n[ \t\r]*\n{_W}*")),
    ("list", re.compile(r"[ \t\r]*\n(?=[ \t]*(?:[-*+•]|\d{1,4}[.)])[ \t])")),
    ("line", re.compile(rf"[ \t\r]*\n{_W}*")),
    ("sentence", re.compile(rf"(?:(?<=[.!?])|(?<=[.!?][\"')\]`]))(?<!\be\.g\.)(?<!\bi\.e\.){_W}+")),
    ("word", re.compile(rf"{_W}+")),
)
CHARACTER = "character"


def split_text(text: str, limit: int = LIMIT, overlap: int = OVERLAP, least_fill: float = LEAST_FILL) -> list[tuple[int, int, int, str]]:
    """(start, end, fresh, cut) of each piece of a text: text[start:end] has at most ``limit`` characters.

    text[start:fresh] repeats the piece before, and the pieces from fresh on, with the white space between them, are the whole text. cut names the
    separator at which the piece ends, ``end`` for the last one. An end is sought among sections first, then paragraphs,
    list items, lines, sentences and words; only a run of more than ``limit`` characters without white space is cut between characters.
    A text within the limit is one piece, an empty one none.
    """
    ends: list[tuple[str, list[int], list[int]]] = []
    for name, pattern in SEPARATORS:
        spans = [m.span() for m in pattern.finditer(text) if m.start() > 0 and m.end() < len(text)]
        ends.append((name, [s for s, _ in spans], [e for _, e in spans]))
    words_after = ends[-1][2]
    pieces: list[tuple[int, int, int, str]] = []
    start = fresh = 0
    while fresh < len(text):
        if len(text) - start <= limit:
            pieces.append((start, len(text), fresh, "end"))
            break
        least = fresh + max(1, int((limit - (fresh - start)) * least_fill))
        choice = None
        for floor in (least, fresh + 1):
            for name, stops, resumes in ends:
                i = bisect_right(stops, start + limit) - 1
                if i >= 0 and stops[i] >= floor:
                    choice = (stops[i], resumes[i], name)
                    break
            if choice:
                break
        if choice is None and start < fresh:
            # the next word alone is too long for a full overlap: give up overlap before cutting the word
            i = bisect_right(ends[-1][1], fresh)
            stop = ends[-1][1][i] if i < len(ends[-1][1]) else len(text)
            start = max(stop - limit, start) if stop - fresh <= limit else start
            if stop - fresh <= limit:
                i = bisect_left(words_after, start)
                start = min(words_after[i], fresh) if i < len(words_after) else fresh
                continue
        stop, resume, name = choice or (start + limit, start + limit, CHARACTER)
        pieces.append((start, stop, fresh, name))
        fresh = resume
        back = max(stop - overlap, pieces[-1][0] + 1)
        i = bisect_left(words_after, back)
        start = words_after[i] if i < len(words_after) and words_after[i] < stop else back
    return pieces


def split_items(df: DataFrame, key: list[str], text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(key..., piece_no, start, fresh, end, cut, piece) of the items whose stripped text is longer than ``limit``.

    Items within the limit need no splitting and give no rows, nor do nulls and blanks. Offsets are code points of the stripped text. Other
    columns are ignored. Repeated rows give repeated pieces.
    """
    rows = df.select(*key, strip(text).alias("_text")).where(F.length("_text") > limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                whole = batch.column(len(key))[at].as_py()
                pieces = split_text(whole, limit, overlap)
                columns = [pa.array([batch.column(k)[at].as_py()] * len(pieces), batch.column(k).type) for k in range(len(key))]
                start, end, fresh, cut = ([p[i] for p in pieces] for i in range(4))
                columns += [pa.array(range(len(pieces)), pa.int32()), pa.array(start, pa.int32()), pa.array(fresh, pa.int32()), pa.array(end, pa.int32()), pa.array(cut, pa.string()), pa.array([whole[a:b] for a, b in zip(start, end, strict=True)], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*key, "piece_no", "start", "fresh", "end", "cut", "piece"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{schema}, piece_no int, start int, fresh int, end int, cut string, piece string")


def last_long(items: DataFrame, key: list[str], text: str, delivered: str, limit: int = LIMIT) -> DataFrame:
    """(key..., text) of the items whose last delivery is longer than ``limit``; of deliveries at one time the greatest text counts, if it is that long.

    Only long texts are exchanged: whether a later delivery is shorter is told by times alone.
    """
    known = items.where(" AND ".join(f"`{k}` IS NOT NULL" for k in key))
    last = known.groupBy(*key).agg(F.max(delivered).alias("_last"))
    long = known.where(F.length(strip(text)) > limit).groupBy(*key).agg(F.max(F.struct(F.col(delivered).alias("d"), F.col(text).alias("t"))).alias("_x"))
    return long.join(last, key).where(F.col("_x.d").eqNullSafe(F.col("_last"))).select(*key, F.col("_x.t").alias(text))


def _items(spark, sf_dir: str) -> DataFrame:
    """(source_table, item_key, text): every paragraph and block with an id whose last delivery is too long."""
    paragraphs = table(spark, sf_dir, "paragraphs").select(F.lit("paragraphs").alias("source_table"), id_or_null("paragraph_id").alias("item_key"), F.col("clean_text").alias("text"), "delivered_at")
    blocks = table(spark, sf_dir, "guideline_blocks").select(F.lit("guideline_blocks").alias("source_table"), id_or_null("block_id").alias("item_key"), F.col("content").alias("text"), "delivered_at")
    return last_long(paragraphs.unionByName(blocks), ["source_table", "item_key"], "text", "delivered_at")


def p2_pieces(spark, sf_dir: str) -> DataFrame:
    """Every piece of every oversized paragraph and block."""
    return split_items(_items(spark, sf_dir), ["source_table", "item_key"], "text")


def p2_found(spark, sf_dir: str) -> DataFrame:
    """The items that had to be split, told apart by whether a piece had to be cut between characters."""
    pieces = p2_pieces(spark, sf_dir)
    kind = F.when(F.max((F.col("cut") == CHARACTER).cast("int")) == 1, "unbroken").otherwise("boundaries")
    return pieces.groupBy("source_table", "item_key").agg(kind.alias("size_kind"))


_WS = r"E' \t\r\n'"
_FOUND = """SELECT DISTINCT '{t}' AS source_table, trim({k}, {ws}) AS item_key, CASE WHEN len(list_filter(string_split_regex(trim({c}, {ws}), '[ \\t\\r\\n]+'), lambda x: length(x) > 1200)) > 0 THEN 'unbroken' ELSE 'boundaries' END AS size_kind
FROM {t} WHERE length(trim({c}, {ws})) > 1200 AND trim({k}, {ws}) <> ''"""
ORACLES = {"p2_found": _FOUND.format(t="paragraphs", k="paragraph_id", c="clean_text", ws=_WS) + " UNION ALL " + _FOUND.format(t="guideline_blocks", k="block_id", c="content", ws=_WS)}
