"""Writers: versioned tables that are swapped in whole, upserts, vector caches, reports and text exports."""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.operators.relational import upsert
from quarryline.sources.files import Folder


class VersionedTable:
    """A table as numbered folders and a pointer to the current one (K1, K5).

    A write goes to a new folder; only when it is complete and passes its check is the pointer replaced, in one rename. Readers keep the version that
    they opened, and the one before stays for going back.
    """

    def __init__(self, root: object) -> None:
        self.folder = Folder(root)

    def versions(self) -> list[str]:
        return [n for n in self.folder.names() if n.startswith("v")]

    def current(self) -> str | None:
        return self.folder.read("CURRENT").strip() if self.folder.exists("CURRENT") else None

    def read(self, spark: SparkSession) -> DataFrame:
        if (version := self.current()) is None:
            raise FileNotFoundError(f"{self.folder.root} has no version")
        return spark.read.parquet(self.folder.path(version))

    def write(self, df: DataFrame, check: Callable[[DataFrame], bool] | None = None, partition_by: tuple[str, ...] = ()) -> str:
        """The new version's name; ValueError, and the pointer as it was, if the written rows don't pass the check."""
        version = f"v{len(self.versions()) + 1:06d}"
        df.write.partitionBy(*partition_by).parquet(self.folder.path(version))
        if check is not None and not check(df.sparkSession.read.parquet(self.folder.path(version))):
            raise ValueError(f"{version} doesn't pass its check")
        self.folder.replace("CURRENT", version)
        return version

    def upsert(self, incoming: DataFrame, keys: list[str]) -> str:
        """A version in which incoming rows replace those of the same keys (K2)."""
        return self.write(incoming if self.current() is None else upsert(self.read(incoming.sparkSession), incoming, keys))

    def roll_back(self) -> str:
        """Points to the version before the current one."""
        older = [v for v in self.versions() if v < (self.current() or "")]
        if not older:
            raise ValueError("there is no older version")
        self.folder.replace("CURRENT", older[-1])
        return older[-1]


class MergedTable:
    """A table in buckets of its keys' hash, of which a merge writes only those that it touches (K1, K2, K3, K5).

    A version is a list of the folders of all buckets; the pointer to it is replaced in one rename when its new folders are complete. Untouched buckets keep theirs,
    so a merge costs what it touches and not what the table holds. Earlier versions can be gone back to.
    """

    def __init__(self, root: object, keys: list[str], buckets: int = 64) -> None:
        self.folder, self.keys, self.buckets = Folder(root), keys, buckets

    def current(self) -> str | None:
        return self.folder.read("CURRENT").strip() if self.folder.exists("CURRENT") else None

    def _held(self) -> dict[str, str]:
        return json.loads(self.folder.read(self.current())) if self.current() else {}

    def _rows(self, spark: SparkSession, schema: Any, names: list[str]) -> DataFrame:
        """The rows of the folders, or none."""
        return spark.read.schema(schema).parquet(*[self.folder.path(n) for n in names]) if names else spark.createDataFrame([], schema)

    def read(self, spark: SparkSession) -> DataFrame:
        held = self._held()
        if not held:
            raise FileNotFoundError(f"{self.folder.root} has no version")
        return spark.read.parquet(*[self.folder.path(n) for n in sorted(set(held.values()))])

    def merge(self, incoming: DataFrame, gone: DataFrame | None = None) -> str | None:
        """Puts incoming rows, their keys unique, in the place of those with the same keys, takes away those whose keys are in ``gone``, and gives the new version's name, or None if nothing is touched.

        A key in both is kept as it comes in. incoming has the table's columns, in any order.
        """
        spark, schema = incoming.sparkSession, incoming.schema
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("_bucket")
        keys = incoming.select(*self.keys) if gone is None else incoming.select(*self.keys).unionByName(gone.select(*self.keys)).distinct()
        touched = [str(r[0]) for r in keys.select(bucket).distinct().collect()]  # at most ``buckets``
        if not touched:
            return None
        held = self._held()
        old = self._rows(spark, schema, [held[b] for b in touched if b in held]).join(keys, self.keys, "left_anti")
        number = len([n for n in self.folder.names() if n.startswith("manifest-")]) + 1
        version = f"manifest-{number:06d}.json"
        written = f"v{number:06d}"
        incoming.unionByName(old).select("*", bucket).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(self.folder.path(written))
        full = {n.removeprefix("_bucket=") for n in Folder(self.folder.path(written)).names() if n.startswith("_bucket=")}
        held = {b: n for b, n in held.items() if b not in touched} | {b: f"{written}/_bucket={b}" for b in touched if b in full}
        self.folder.replace(version, json.dumps(held, sort_keys=True))
        self.folder.replace("CURRENT", version)
        return version

    def roll_back(self) -> str:
        """Points to the version before the current one."""
        older = [n for n in self.folder.names() if n.startswith("manifest-") and n < (self.current() or "")]
        if not older:
            raise ValueError("there is no older version")
        self.folder.replace("CURRENT", older[-1])
        return older[-1]


def write_vectors(df: DataFrame, path: str) -> None:
    """Appends (id, model, version, text_sha256, vector) with the vector's norm, only the keys that aren't there yet (K9)."""
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    new = df.withColumn("norm", norm).dropDuplicates(["id", "model", "version", "text_sha256"])
    if Folder(path).exists():
        new = new.join(df.sparkSession.read.parquet(path).select("id", "model", "version", "text_sha256"), ["id", "model", "version", "text_sha256"], "left_anti")
    new.write.mode("append").parquet(path)


def write_report(folder: object, name: str, payload: dict[str, Any]) -> str:
    """A report as sorted JSON, complete or not at all (K7); gives its path."""
    Folder(folder).replace(name, json.dumps(payload, indent=2, sort_keys=True) + "\n")
    return Folder(folder).path(name)


def markdown_table(df: DataFrame, limit: int = 50) -> str:
    """The first rows as a Markdown table for people to read."""
    head = "| " + " | ".join(df.columns) + " |\n" + "| --- " * len(df.columns) + "|"
    return "\n".join([head, *("| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in df.limit(limit).collect())])


def exported_texts(records: DataFrame, blocks: DataFrame, citations: DataFrame | None = None) -> DataFrame:
    """(chapter, guideline_id, value, sha256): each record as one text: title, underline, its blocks in order and, where it has any, its citations by key (K8).

    records: (guideline_id, title, chapter); blocks: (guideline_id, order_index, content); citations: (guideline_id, key, text), of which repeated ones count once. Records without blocks have their title only;
    blank chapters are named general.
    """
    in_order = lambda order, text: F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda b: b[text])
    bodies = blocks.groupBy("guideline_id").agg(F.array_join(in_order("order_index", "content"), "\n\n").alias("body"))
    rows = records.join(bodies, "guideline_id", "left")
    sources = F.lit(None).cast("string")
    if citations is not None:
        lines = citations.select("guideline_id", "key", F.concat(F.lit(".. ["), "key", F.lit("] "), "text").alias("line")).distinct()
        rows = rows.join(lines.groupBy("guideline_id").agg(F.array_join(in_order("key", "line"), "\n").alias("cited")), "guideline_id", "left")
        sources = F.col("cited")
    title = F.coalesce("title", F.lit(""))
    text = F.concat_ws("\n", title, F.repeat(F.lit("="), F.length(title)), F.lit(""), F.coalesce("body", F.lit("")), F.when(sources.isNotNull(), F.concat(F.lit("\nBibliography\n------------\n\n"), sources)))
    rows = rows.select(F.coalesce(F.nullif(F.trim("chapter"), F.lit("")), F.lit("general")).alias("chapter"), "guideline_id", text.alias("value"))
    return rows.withColumn("sha256", F.sha2("value", 256))


def export_texts(records: DataFrame, blocks: DataFrame, path: str, citations: DataFrame | None = None) -> None:
    """One text file a record, in a folder of its own within its chapter's, and beside them the table of digests, ``manifest`` (K8)."""
    rows = exported_texts(records, blocks, citations)
    rows.select("chapter", "guideline_id", "value").repartition("chapter", "guideline_id").write.mode("overwrite").partitionBy("chapter", "guideline_id").text(f"{path}/texts")
    rows.select("chapter", "guideline_id", "sha256").write.mode("overwrite").json(f"{path}/manifest")
