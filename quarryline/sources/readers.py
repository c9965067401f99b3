"""Readers of Markdown trees, API and specification dumps, record pairs, logs and prompt suites; each gives a lazy frame."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Kinds of API items that are kept. Fixed values.
ITEM_KINDS = ("module", "struct", "enum", "trait", "impl", "function", "assoc_type", "assoc_const", "constant", "type_alias")
#: Inline roles of specification texts and the lists that they fill. Fixed values.
ROLES = {"dt": "defined_terms", "t": "term_refs", "ds": "syntax_defs", "s": "syntax_refs", "std": "std_refs", "p": "paragraph_refs"}
MODES, SLICES = ("lexical", "semantic", "hybrid"), 2


def _whole(spark: SparkSession, pattern: str) -> DataFrame:
    return spark.read.text(pattern, wholetext=True).select(F.col("value").alias("text"), F.input_file_name().alias("path"))


def read_markdown_tree(spark: SparkSession, root: str) -> DataFrame:
    """(rel_path, title, chapter, chapter_order, doc_order, text): documents in the order of SUMMARY.md (S3).

    An entry without indent opens a chapter, indented ones belong to the last such. Entries of missing files and repeats are left out.
    """
    lines = spark.read.text(f"{root}/SUMMARY.md", wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("line", "value"))
    entry = r"^(\s*)[-*]\s+\[([^\]]+)\]\(([^)#]+)[^)]*\)"
    rows = lines.where(F.col("value").rlike(entry)).select("line", F.length(F.regexp_extract("value", entry, 1)).alias("indent"), F.regexp_extract("value", entry, 2).alias("title"), F.regexp_replace(F.regexp_extract("value", entry, 3), r"^\./", "").alias("rel_path"))
    order = Window.orderBy("line")  # one small file
    rows = rows.withColumn("first", F.row_number().over(Window.partitionBy("rel_path").orderBy("line"))).where("first = 1")
    rows = rows.select("line", "title", "rel_path", F.last(F.when(F.col("indent") == 0, F.col("title")), ignorenulls=True).over(order).alias("chapter"), F.sum(F.when(F.col("indent") == 0, 1).otherwise(0)).over(order).alias("chapter_order"))
    base = Path(root).resolve().as_posix()
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").text(root, wholetext=True).select(F.col("value").alias("text"), F.regexp_replace(F.col("_metadata.file_path"), f"^.*?{base}/", "").alias("rel_path"))
    return rows.join(files, "rel_path").select("rel_path", "title", F.coalesce("chapter", F.lit("")).alias("chapter"), "chapter_order", F.row_number().over(order).alias("doc_order"), "text")


def read_rustdoc_json(spark: SparkSession, path: str, target: str) -> DataFrame:
    """(item_id, item_path, item_kind, stability, docs_text, target): the documented items of ten kinds in an API dump."""
    whole = _whole(spark, path)
    item = "struct<name:string,docs:string,attrs:array<string>,inner:map<string,string>>"
    parsed = whole.select(F.from_json("text", f"struct<index:map<string,{item}>,paths:map<string,struct<path:array<string>>>>").alias("d"))
    rows = parsed.select(F.explode("d.index").alias("item_id", "i"), F.col("d.paths").alias("paths"))
    kind = F.element_at(F.map_keys("i.inner"), 1)
    attrs = F.lower(F.array_join(F.coalesce("i.attrs", F.array().cast("array<string>")), "\n"))
    stability = F.when(attrs.contains("deprecated"), "deprecated").when(attrs.contains("unstable"), "unstable").when(attrs.contains("stable"), "stable").otherwise("unspecified")
    full = F.array_join(F.try_element_at("paths", F.col("item_id"))["path"], "::")
    return rows.where(F.coalesce(F.trim("i.docs"), F.lit("")) != "").where(F.size("i.inner") > 0).select("item_id", F.coalesce(F.nullif(full, F.lit("")), F.nullif(F.col("i.name"), F.lit("")), F.concat(F.lit("item::"), "item_id")).alias("item_path"), kind.alias("item_kind"), stability.alias("stability"), F.trim("i.docs").alias("docs_text"), F.lit(target).alias("target")).where(F.col("item_kind").isin(*ITEM_KINDS))


def read_rst_spec(spark: SparkSession, pattern: str) -> DataFrame:
    """(source_file, paragraph_id, chapter, raw_text, clean_text, roles...): marked paragraphs of specification files, with the roles inside.

    A paragraph runs from its mark to the next mark, heading, label or directive. chapter is the file's first heading.
    """
    files = _whole(spark, pattern).select(F.element_at(F.split("path", "/"), -1).alias("source_file"), "text")
    chapter = F.regexp_extract("text", r"(?m)^(\S[^\n]*)\n(?:={3,}|-{3,})[ \t]*$", 1)
    parts = files.select("source_file", F.trim(chapter).alias("chapter"), F.posexplode(F.split("text", r"(?m)^(?=:dp:`fls_)")).alias("position", "part")).where(F.col("part").startswith(":dp:`"))
    cut = F.regexp_replace("part", r"(?s)\n\.\. .*$|\n[^\n]+\n(?:={3,}|-{3,}|~{3,}|\^{3,})[ \t]*\n.*$", "")
    raw = F.trim(F.regexp_replace(F.regexp_replace(cut, r"^:dp:`fls_[A-Za-z0-9_]+`", ""), r"\s+", " "))
    clean = raw
    for p, r in ((r":[a-z_]+:`([^`]*)`", "$1"), (r"``([^`]*)``", "$1"), (r"`([^`]*)`", "$1"), (r"\[([^\]]+)\]", "$1"), (r"\s+", " ")):
        clean = F.regexp_replace(clean, p, r)

    def role(name: str):
        found = F.regexp_extract_all("raw_text", F.lit(f"(?<![a-z]):{name}:`([^`]*)`"), F.lit(1))
        tidy = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, r"\[([^\]]+)\]", "$1"), r"\s+", " "))
        return F.transform(found, lambda x: F.struct(tidy(F.regexp_replace(x, r"<[^>]*>\s*$", "")).alias("text"), tidy(F.regexp_extract(x, r"<([^>]*)>\s*$", 1)).alias("target")))

    rows = parts.select("source_file", F.regexp_extract("part", r"^:dp:`(fls_[A-Za-z0-9_]+)`", 1).alias("paragraph_id"), "position", "chapter", raw.alias("raw_text"), F.trim(clean).alias("clean_text"))
    return rows.where("clean_text <> ''").select("*", *[role(r).alias(n) for r, n in ROLES.items()])


def read_needs(spark: SparkSession, needs: str, ids: str) -> DataFrame:
    """(guideline_id, title, content, category, docname, href): two JSON files of records joined by id (S6). Ids that only one file has raise ValueError."""
    n = _whole(spark, needs).select(F.explode(F.from_json("text", "struct<needs:map<string,struct<title:string,content:string,category:string,docname:string>>>")["needs"]).alias("guideline_id", "n"))
    i = _whole(spark, ids).select(F.explode(F.from_json("text", "map<string,string>")).alias("guideline_id", "href"))
    both = n.join(i, "guideline_id", "full_outer")
    if not (lost := both.where("n IS NULL OR href IS NULL").select("guideline_id").limit(5)).isEmpty():
        raise ValueError(f"ids in one file only, such as {[r[0] for r in lost.collect()]}")
    return both.select("guideline_id", "n.*", "href")


def needs_blocks(records: DataFrame) -> DataFrame:
    """(guideline_id, order_index, content): a record's content cut at blank lines."""
    return records.select("guideline_id", F.posexplode(F.filter(F.transform(F.split("content", r"\n[ \t]*\n"), F.trim), lambda b: b != "")).alias("order_index", "content"))


def read_topology(spark: SparkSession, path: str) -> DataFrame:
    """(document_link, section_link, paragraph_id, document_ordinal, section_ordinal, paragraph_ordinal): a nested tree flattened."""
    tree = _whole(spark, path).select(F.from_json("text", "struct<documents:array<struct<link:string,sections:array<struct<link:string,paragraphs:array<struct<id:string>>>>>>>")["documents"].alias("d"))
    d = tree.select(F.posexplode("d").alias("document_ordinal", "d"))
    s = d.select("document_ordinal", F.col("d.link").alias("document_link"), F.posexplode("d.sections").alias("section_ordinal", "s"))
    return s.select("document_link", F.col("s.link").alias("section_link"), "document_ordinal", "section_ordinal", F.posexplode("s.paragraphs").alias("paragraph_ordinal", "p")).select("document_link", "section_link", F.col("p.id").alias("paragraph_id"), "document_ordinal", "section_ordinal", "paragraph_ordinal")


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """Lines of JSON; bad and blank lines are dropped, or fail the read if strict."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def read_prompt_suite(spark: SparkSession, path: str) -> DataFrame:
    """(prompt_id, slice, query_text, modes, expected_row_markers, relevant_terms, relevant_statement_ids, relevant_anchor_prefixes): a checked YAML suite.

    Raises ValueError for an unknown mode, a repeated id, a prompt without any sign of relevance, or more than two slices.
    """
    import yaml

    prompts = yaml.safe_load(Path(path).read_text(encoding="utf-8")).get("prompts") or []
    lists = ("expected_row_markers", "relevant_terms", "relevant_statement_ids", "relevant_anchor_prefixes")
    rows, seen = [], set()
    for p in prompts:
        pid, modes = str(p.get("prompt_id", "")).strip(), [str(m) for m in p.get("modes") or MODES]
        if not pid or pid in seen:
            raise ValueError(f"prompt without an id of its own: {pid!r}")
        if bad := set(modes) - set(MODES):
            raise ValueError(f"{pid}: unknown modes {sorted(bad)}")
        values = [[str(x) for x in p.get(k) or []] for k in lists]
        if not any(values) and not p.get("expect_abstain"):
            raise ValueError(f"{pid}: nothing says what is relevant")
        seen.add(pid)
        rows.append((pid, str(p.get("slice", "")), str(p.get("query_text", "")), modes, *values))
    if len({r[1] for r in rows}) > SLICES:
        raise ValueError("more than two slices")
    return spark.createDataFrame(rows, "prompt_id string, slice string, query_text string, modes array<string>, " + ", ".join(f"{k} array<string>" for k in lists))


def read_sqlite(spark: SparkSession, path: str, sql: str, schema: str, rows: int = 10_000) -> DataFrame:
    """The rows of a query on an SQLite file, opened read-only by one task and passed on in batches of the declared types (S1). The file must be reachable from the executors.

    Columns are taken by their place. Nulls stay null; a value that its type can't hold fails the read.
    """
    declared = to_arrow_schema(StructType.fromDDL(schema))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            with sqlite3.connect(f"file:{path}?mode=ro", uri=True, timeout=1.5) as db:
                db.execute("PRAGMA query_only = ON")
                cursor = db.execute(sql)
                while part := cursor.fetchmany(rows):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), declared, strict=True)], schema=declared)

    return spark.range(1, numPartitions=1).mapInArrow(scan, schema)
