"""Contract queries, joins, aggregates, ranking windows and set operations over the tables at hand.

Each query stands beside SQL that gives the same rows. Joins leave the choice of strategy to adaptive execution; only tables of a
fixed number of rows (regions, nations, snapshots) are broadcast by hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarryline.functions.cleaning import id_or_null, strip
from quarryline.plans.catalog import query
from quarryline.plans.contracts import QuerySpec, run_contract
from quarryline.plans.stages import table

_WS = r"E' \t\r\n'"


def _views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


# --- contract queries: SQL with named parameters, guarded ---

OVERVIEW = QuerySpec("region_overview", """
  SELECT r.r_regionkey AS region_id, r.r_name AS title, count(DISTINCT n.n_nationkey) AS nation_count, count(DISTINCT c.c_custkey) AS customer_count
  FROM region AS r LEFT JOIN nation AS n ON n.n_regionkey = r.r_regionkey LEFT JOIN customer AS c ON c.c_nationkey = n.n_nationkey
  GROUP BY r.r_regionkey, r.r_name ORDER BY region_id ASC""", requires_order=True)  # fmt: skip


@query("contract_left_join_distinct", "SELECT r_regionkey AS region_id, r_name AS title, (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey) AS nation_count, (SELECT count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = r_regionkey) AS customer_count FROM region")
def left_join_distinct(spark, sf_dir):
    """Counts per parent over a chain of left joins, as one guarded contract."""
    _views(spark, sf_dir, "region", "nation", "customer")
    return run_contract(spark, OVERVIEW)


METADATA = QuerySpec("snapshot_metadata", "SELECT DISTINCT trim(snapshot_id) AS snapshot_id, commit_sha, source_url, fetched_at, sha256 FROM snapshots ORDER BY fetched_at DESC", requires_order=True)


@query("contract_snapshot_metadata", "SELECT trim(snapshot_id) AS snapshot_id, commit_sha, source_url, fetched_at, sha256 FROM snapshots GROUP BY ALL")
def snapshot_metadata(spark, sf_dir):
    """A plain projection, repeated deliveries once."""
    _views(spark, sf_dir, "snapshots")
    return run_contract(spark, METADATA)


COVERAGE = QuerySpec("document_coverage", """
  SELECT source AS source, count(*) AS document_count, sum(CASE WHEN trim(coalesce(chapter, '')) = '' THEN 1 ELSE 0 END) AS missing_chapter,
    sum(CASE WHEN trim(coalesce(lang, '')) = '' THEN 1 ELSE 0 END) AS missing_lang
  FROM documents GROUP BY source ORDER BY document_count DESC""", requires_order=True)  # fmt: skip


@query("contract_conditional_coverage", "SELECT source, count(*) AS document_count, count(*) FILTER (WHERE chapter IS NULL OR trim(chapter) = '') AS missing_chapter, count(*) FILTER (WHERE lang IS NULL OR trim(lang) = '') AS missing_lang FROM documents GROUP BY source")
def conditional_coverage(spark, sf_dir):
    """Conditional sums of blanks."""
    _views(spark, sf_dir, "documents")
    return run_contract(spark, COVERAGE)


OPTIONAL = QuerySpec("orders_by_status", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE :status = '' OR o_orderstatus = :status ORDER BY o_orderkey ASC", ("status",), requires_order=True)


@query("contract_optional_param", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def optional_param(spark, sf_dir):
    """An optional parameter; its literal folds away and the filter reaches the scan."""
    _views(spark, sf_dir, "orders")
    return run_contract(spark, OPTIONAL, {"status": "F"})


PAGE = QuerySpec("orders_page", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > :after ORDER BY o_orderkey ASC", ("after",), requires_order=True)


@query("contract_keyset_page", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 500 ORDER BY o_orderkey LIMIT 250")
def keyset_page(spark, sf_dir):
    """One page after a key; the limit is the page's size."""
    _views(spark, sf_dir, "orders")
    return run_contract(spark, PAGE, {"after": 500}, limit=250)


@query("contract_case_url", r"""SELECT doc_id, 'https://docs.example.invalid/' || CASE WHEN lower(rel_path) LIKE '%.md' THEN substr(rel_path, 1, length(rel_path) - 3) || '.html' ELSE rel_path END || '#' || coalesce(nullif(trim(chapter), ''), source, '') AS source_anchor FROM documents""")
def case_url(spark, sf_dir):
    """A page's address with a fragment, from the first of several columns that isn't blank."""
    d = table(spark, sf_dir, "documents", "doc_id", "rel_path", "chapter", "source")
    return d.select("doc_id", F.concat(F.lit("https://docs.example.invalid/"), F.regexp_replace("rel_path", r"(?i)\.md$", ".html"), F.lit("#"), F.coalesce(F.nullif(F.trim("chapter"), F.lit("")), "source", F.lit(""))).alias("source_anchor"))


@query("contract_multi_scalar_stats", f"""SELECT (SELECT count(DISTINCT trim(paragraph_id, {_WS})) FROM paragraphs) AS paragraphs, (SELECT count(DISTINCT trim(paragraph_id, {_WS})) FROM paragraphs WHERE retrieval_eligible = 1) AS eligible,
  (SELECT count(DISTINCT section_id) FROM paragraphs) AS sections, (SELECT count(DISTINCT document_link) FROM paragraphs) AS documents, (SELECT count(DISTINCT trim(chunk_uid, {_WS})) FROM chunks) AS chunks""")
def multi_scalar_stats(spark, sf_dir):
    """A3: one row of counts, one pass a table; the only cross join is of one-row frames."""
    p = table(spark, sf_dir, "paragraphs", "paragraph_id", "retrieval_eligible", "section_id", "document_link")
    key = strip("paragraph_id")
    left = p.agg(F.countDistinct(key).alias("paragraphs"), F.countDistinct(F.when(F.col("retrieval_eligible") == 1, key)).alias("eligible"), F.countDistinct("section_id").alias("sections"), F.countDistinct("document_link").alias("documents"))
    return left.crossJoin(table(spark, sf_dir, "chunks", "chunk_uid").agg(F.countDistinct(strip("chunk_uid")).alias("chunks")))


# --- joins ---


@query("contract_left_agg_string", "SELECT n_nationkey, n_name, coalesce((SELECT string_agg(s_name, ',' ORDER BY s_name) FROM supplier WHERE s_nationkey = n_nationkey), '') AS suppliers FROM nation")
def left_agg_string(spark, sf_dir):
    """A left join to an aggregated list, its order fixed by sorting."""
    lists = table(spark, sf_dir, "supplier", "s_nationkey", "s_name").groupBy("s_nationkey").agg(F.array_join(F.array_sort(F.collect_list("s_name")), ",").alias("suppliers"))
    n = F.broadcast(table(spark, sf_dir, "nation", "n_nationkey", "n_name"))
    return lists.join(n, lists.s_nationkey == n.n_nationkey, "right").select("n_nationkey", "n_name", F.coalesce("suppliers", F.lit("")).alias("suppliers"))


@query("join_corpus_rows", f"""SELECT c.id, c.section_id, c.order_index, coalesce(m.item_path, '') AS item_path, coalesce(m.item_kind, 'unknown') AS item_kind
FROM (SELECT trim(chunk_uid, {_WS}) AS id, max(section_id) AS section_id, max(order_index) AS order_index FROM chunks GROUP BY 1) c
LEFT JOIN (SELECT trim(chunk_uid, {_WS}) AS id, max(item_path) AS item_path, max(item_kind) AS item_kind FROM core_docs_chunk_metadata GROUP BY 1) m ON m.id = c.id""")
def corpus_rows(spark, sf_dir):
    """Units with their sections and the metadata that some have."""
    c = table(spark, sf_dir, "chunks", "chunk_uid", "section_id", "order_index").groupBy(strip("chunk_uid").alias("id")).agg(F.max("section_id").alias("section_id"), F.max("order_index").alias("order_index"))
    m = table(spark, sf_dir, "core_docs_chunk_metadata", "chunk_uid", "item_path", "item_kind").groupBy(strip("chunk_uid").alias("id")).agg(F.max("item_path").alias("item_path"), F.max("item_kind").alias("item_kind"))
    return c.join(m, "id", "left").select("id", "section_id", "order_index", F.coalesce("item_path", F.lit("")).alias("item_path"), F.coalesce("item_kind", F.lit("unknown")).alias("item_kind"))


@query("join_composite_left_fallback", """SELECT l.l_partkey, l.l_suppkey, p.p_brand, coalesce(s.returned, l.quantity) AS relevance, coalesce(s.returned, 0.0) AS semantic, coalesce(s.version, 'plain') AS version
FROM (SELECT l_partkey, l_suppkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2) l JOIN part p ON p.p_partkey = l.l_partkey
LEFT JOIN (SELECT l_partkey, l_suppkey, sum(l_quantity) AS returned, 'scored' AS version FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2) s ON s.l_partkey = l.l_partkey AND s.l_suppkey = l.l_suppkey""")
def composite_left_fallback(spark, sf_dir):
    """An inner join and a left join on two columns, with fallbacks; both sides aggregate in one pass over the facts."""
    quantity = F.col("l_quantity")
    both = table(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag").groupBy("l_partkey", "l_suppkey").agg(F.sum(quantity).alias("quantity"), F.sum(F.when(F.col("l_returnflag") == "R", quantity)).alias("returned"))
    p = table(spark, sf_dir, "part", "p_partkey", "p_brand")
    return both.join(p, both.l_partkey == p.p_partkey).select("l_partkey", "l_suppkey", "p_brand", F.coalesce("returned", "quantity").alias("relevance"), F.coalesce("returned", F.lit(0.0)).alias("semantic"), F.when(F.col("returned").isNull(), "plain").otherwise("scored").alias("version"))


@query("join_verdicts", f"""SELECT DISTINCT trim(r.guideline_id, {_WS}) AS guideline_id, m.raw_fls_present FROM guideline_records r JOIN guideline_fls_source_mappings m ON trim(m.guideline_id, {_WS}) = trim(r.guideline_id, {_WS})""")
def verdicts(spark, sf_dir):
    """An inner join of a record with its verdict."""
    r = table(spark, sf_dir, "guideline_records", "guideline_id").select(strip("guideline_id").alias("guideline_id")).distinct()
    m = table(spark, sf_dir, "guideline_fls_source_mappings", "guideline_id", "raw_fls_present").select(strip("guideline_id").alias("guideline_id"), "raw_fls_present").distinct()
    return r.join(m, "guideline_id")


@query("join_json_ids", f"""SELECT DISTINCT w.source_id, p.id AS paragraph_id FROM (SELECT source_id, unnest(from_json(suggested_fls_ids_json, '["VARCHAR"]')) AS fls FROM ws7_mapping_cleanup_tasks WHERE json_valid(suggested_fls_ids_json) AND json_type(suggested_fls_ids_json) = 'ARRAY') w
JOIN (SELECT DISTINCT trim(paragraph_id, {_WS}) AS id FROM paragraphs) p ON p.id = trim(w.fls, {_WS})""")
def json_ids(spark, sf_dir):
    """Ids in a JSON list joined to the rows that they name; repeated ids count once."""
    w = table(spark, sf_dir, "ws7_mapping_cleanup_tasks", "source_id", "suggested_fls_ids_json").select("source_id", F.explode(F.from_json("suggested_fls_ids_json", "array<string>")).alias("id")).select("source_id", strip("id").alias("paragraph_id")).distinct()
    p = table(spark, sf_dir, "paragraphs", "paragraph_id").select(strip("paragraph_id").alias("paragraph_id")).distinct()
    return w.join(p, "paragraph_id").select("source_id", "paragraph_id")


@query("ordered_child_json", f"""SELECT r.id AS guideline_id, coalesce(b.children, '[]') AS children, coalesce(b.n, 0) AS n FROM (SELECT DISTINCT trim(guideline_id, {_WS}) AS id FROM guideline_records) r
LEFT JOIN (SELECT g, to_json(list({{'o': order_index, 'b': b}} ORDER BY order_index, b)) AS children, count(*) AS n FROM (SELECT DISTINCT trim(guideline_id, {_WS}) AS g, order_index, trim(block_id, {_WS}) AS b FROM guideline_blocks) GROUP BY 1) b ON b.g = r.id""")
def ordered_child_json(spark, sf_dir):
    """Ordered child lists as JSON, ``[]`` where there are none."""
    r = table(spark, sf_dir, "guideline_records", "guideline_id").select(strip("guideline_id").alias("guideline_id")).distinct()
    b = table(spark, sf_dir, "guideline_blocks", "guideline_id", "order_index", "block_id").select(strip("guideline_id").alias("guideline_id"), F.struct(F.col("order_index").alias("o"), strip("block_id").alias("b")).alias("c")).distinct()
    lists = b.groupBy("guideline_id").agg(F.to_json(F.array_sort(F.collect_list("c"))).alias("children"), F.count("*").alias("n"))
    return r.join(lists, "guideline_id", "left").select("guideline_id", F.coalesce("children", F.lit("[]")).alias("children"), F.coalesce("n", F.lit(0)).alias("n"))


@query("anti_missing", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def anti_missing(spark, sf_dir):
    """Keys without a partner of some kind."""
    o = table(spark, sf_dir, "orders", "o_custkey", "o_orderstatus").where("o_orderstatus = 'P'")
    c = table(spark, sf_dir, "customer", "c_custkey")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti")


@query("anti_not_in", f"SELECT DISTINCT trim(chunk_uid, {_WS}) AS id FROM chunks WHERE trim(chunk_uid, {_WS}) NOT IN (SELECT trim(chunk_uid, {_WS}) FROM core_docs_chunk_metadata WHERE chunk_uid IS NOT NULL)")
def anti_not_in(spark, sf_dir):
    """Ids that no link names (NOT IN over keys without nulls)."""
    linked = table(spark, sf_dir, "core_docs_chunk_metadata", "chunk_uid").select(strip("chunk_uid").alias("id"))
    return table(spark, sf_dir, "chunks", "chunk_uid").select(strip("chunk_uid").alias("id")).distinct().join(linked, "id", "left_anti")


@query("theta_mismatch", "SELECT l_orderkey, l_linenumber, l_shipdate, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_shipdate < o_orderdate")
def theta_mismatch(spark, sf_dir):
    """An equi-join with a residual inequality."""
    l, o = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate"), table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    return l.join(o, (l.l_orderkey == o.o_orderkey) & (l.l_shipdate < o.o_orderdate)).select("l_orderkey", "l_linenumber", "l_shipdate", "o_orderdate")


@query("dup_having", f"SELECT trim(block_id, {_WS}) AS block_id, count(*) AS deliveries FROM guideline_blocks GROUP BY 1 HAVING count(*) > 1")
def dup_having(spark, sf_dir):
    """A4: keys that occur more than once."""
    return table(spark, sf_dir, "guideline_blocks", "block_id").groupBy(strip("block_id").alias("block_id")).agg(F.count("*").alias("deliveries")).where("deliveries > 1")


@query("latest_group", "SELECT event_type, arg_max(event_id, {'t': ts, 'e': event_id}) AS last_event, max(ts) AS last_ts FROM events GROUP BY event_type")
def latest_group(spark, sf_dir):
    """A5: the latest row of each group."""
    return table(spark, sf_dir, "events", "event_type", "event_id", "ts").groupBy("event_type").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("last_event"), F.max("ts").alias("last_ts"))


@query("pivot_self_join", f"""SELECT k AS guideline_id, max(b) FILTER (WHERE o = 0) AS first_block, max(b) FILTER (WHERE o = 1) AS second_block FROM (SELECT trim(guideline_id, {_WS}) AS k, order_index AS o, trim(block_id, {_WS}) AS b FROM guideline_blocks) WHERE k <> '' GROUP BY k""")
def pivot_self_join(spark, sf_dir):
    """A node's numbered cells beside each other, by one aggregation instead of self-joins."""
    b = table(spark, sf_dir, "guideline_blocks", "guideline_id", "order_index", "block_id").select(id_or_null("guideline_id").alias("guideline_id"), "order_index", strip("block_id").alias("b")).where("guideline_id IS NOT NULL")
    return b.groupBy("guideline_id").agg(F.max(F.when(F.col("order_index") == 0, F.col("b"))).alias("first_block"), F.max(F.when(F.col("order_index") == 1, F.col("b"))).alias("second_block"))


@query("overlay_effective", f"""WITH h AS (SELECT trim(guideline_id, {_WS}) AS g, arg_max({{'f': trim(effective_fls_id, {_WS}), 's': lower(trim(resolution_status, {_WS}))}}, {{'d': delivered_at, 'h': history_id}}) AS x FROM guideline_fls_resolution_history GROUP BY 1),
 m AS (SELECT trim(guideline_id, {_WS}) AS g, max(trim(raw_fls_id, {_WS})) AS raw FROM guideline_fls_source_mappings GROUP BY 1)
SELECT m.g AS guideline_id, coalesce(m.raw, '') AS raw_fls_id, CASE WHEN h.x.s = 'approved' AND coalesce(h.x.f, '') <> '' THEN h.x.f ELSE coalesce(m.raw, '') END AS effective_fls_id, CASE WHEN h.x.s = 'approved' AND coalesce(h.x.f, '') <> '' THEN 'override' ELSE 'raw' END AS origin FROM m LEFT JOIN h ON h.g = m.g""")
def overlay_effective(spark, sf_dir):
    """The raw value, unless the last override stands."""
    h = table(spark, sf_dir, "guideline_fls_resolution_history", "guideline_id", "effective_fls_id", "resolution_status", "delivered_at", "history_id")
    last = h.groupBy(strip("guideline_id").alias("guideline_id")).agg(F.max_by(F.struct(strip("effective_fls_id").alias("f"), F.lower(strip("resolution_status")).alias("s")), F.struct("delivered_at", "history_id")).alias("x"))
    m = table(spark, sf_dir, "guideline_fls_source_mappings", "guideline_id", "raw_fls_id").groupBy(strip("guideline_id").alias("guideline_id")).agg(F.coalesce(F.max(strip("raw_fls_id")), F.lit("")).alias("raw_fls_id"))
    stands = F.coalesce((F.col("x.s") == "approved") & (F.coalesce("x.f", F.lit("")) != ""), F.lit(False))
    return m.join(last, "guideline_id", "left").select("guideline_id", "raw_fls_id", F.when(stands, F.col("x.f")).otherwise(F.col("raw_fls_id")).alias("effective_fls_id"), F.when(stands, "override").otherwise("raw").alias("origin"))


def full_outer_delta(current: DataFrame, incoming: DataFrame, keys: list[str], hashes: list[str]) -> DataFrame:
    """(keys, delta): added, deleted, updated or unchanged, by one full outer join with null-safe comparison."""
    left = current.select(*keys, F.struct(*hashes).alias("_old"))
    right = incoming.select(*keys, F.struct(*hashes).alias("_new"))
    kind = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "deleted").when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged").otherwise("updated")
    return left.join(right, keys, "full_outer").select(*keys, kind.alias("delta"))


@query("full_outer_delta", """WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents), a AS (SELECT * FROM d WHERE doc_id % 7 <> 0), b AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN sha256(h) ELSE h END AS h FROM d WHERE doc_id % 7 <> 1)
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN a.doc_id IS NULL THEN 'added' WHEN b.doc_id IS NULL THEN 'deleted' WHEN a.h = b.h THEN 'unchanged' ELSE 'updated' END AS delta FROM a FULL JOIN b ON a.doc_id = b.doc_id""")
def document_delta(spark, sf_dir):
    """Two made-up inventories of all documents: each lacks a seventh and the later has other hashes for a fifth."""
    d = table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    later = d.where("doc_id % 7 <> 1").withColumn("h", F.when(F.col("doc_id") % 5 == 0, F.sha2("h", 256)).otherwise(F.col("h")))
    return full_outer_delta(d.where("doc_id % 7 <> 0"), later, ["doc_id"], ["h"])


@query("join_component_diff", """WITH e AS (SELECT o_orderpriority AS component, o_orderstatus AS s, count(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1, 2), f AS (SELECT component, n FROM e WHERE s = 'F'), o AS (SELECT component, n FROM e WHERE s = 'O')
SELECT coalesce(f.component, o.component) AS component, coalesce(f.n, 0) AS expected, coalesce(o.n, 0) AS observed, coalesce(o.n, 0) - coalesce(f.n, 0) AS delta FROM f FULL JOIN o ON f.component = o.component ORDER BY abs(coalesce(o.n, 0) - coalesce(f.n, 0)) DESC, component LIMIT 8""")
def component_diff(spark, sf_dir):
    """The eight components that differ most between what was expected and observed."""
    e = table(spark, sf_dir, "orders", "o_orderpriority", "o_orderstatus").where("o_orderstatus IN ('F', 'O')").groupBy(F.col("o_orderpriority").alias("component"), "o_orderstatus").count()
    f, o = (e.where(F.col("o_orderstatus") == s).select("component", F.col("count").alias(n)) for s, n in (("F", "expected"), ("O", "observed")))
    return f.join(o, "component", "full_outer").na.fill(0).withColumn("delta", F.col("observed") - F.col("expected")).orderBy(F.abs("delta").desc(), "component").limit(8)


@query("semi_join_rate", "SELECT e.event_type, count(*) AS events, count(*) FILTER (WHERE u.user_id IS NOT NULL) AS joined, round(count(*) FILTER (WHERE u.user_id IS NOT NULL) / count(*), 6) AS join_rate FROM events e LEFT JOIN (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase') u ON u.user_id = e.user_id GROUP BY 1")
def semi_join_rate(spark, sf_dir):
    """How many rows of each kind have a partner in another set of ids."""
    e = table(spark, sf_dir, "events", "event_type", "user_id")
    buyers = e.where("event_type = 'purchase'").select("user_id", F.lit(1).alias("hit")).distinct()
    hit = F.count("hit")
    return e.join(buyers, "user_id", "left").groupBy("event_type").agg(F.count("*").alias("events"), hit.alias("joined"), F.round(hit / F.count("*"), 6).alias("join_rate"))


@query("join_normalised_stem", f"""SELECT d.doc_id, p.source_file FROM (SELECT doc_id, upper(replace(trim(chapter, {_WS}), '-', '_')) AS stem FROM documents) d JOIN (SELECT DISTINCT source_file, upper(replace(regexp_extract(source_file, '([^/]*)[.][a-z]+$', 1), '-', '_')) AS stem FROM paragraphs) p ON p.stem = d.stem""")
def normalised_stem(spark, sf_dir):
    """A join of chapters with normalised file stems; each stem is one file."""
    d = table(spark, sf_dir, "documents", "doc_id", "chapter").select("doc_id", F.upper(F.translate(strip("chapter"), "-", "_")).alias("stem"))
    p = table(spark, sf_dir, "paragraphs", "source_file").distinct().select("source_file", F.upper(F.translate(F.regexp_extract("source_file", r"([^/]*)\.[a-z]+$", 1), "-", "_")).alias("stem"))
    return d.join(p, "stem").select("doc_id", "source_file")


@query("join_many_reports", f"""SELECT r.g AS guideline_id, m.fls, h.n AS history_rows, b.n AS blocks, c.n AS candidates FROM (SELECT DISTINCT trim(guideline_id, {_WS}) AS g FROM guideline_records) r
LEFT JOIN (SELECT trim(guideline_id, {_WS}) AS g, arg_max(raw_fls_id, delivered_at) AS fls FROM guideline_fls_source_mappings GROUP BY 1) m ON m.g = r.g LEFT JOIN (SELECT trim(guideline_id, {_WS}) AS g, count(DISTINCT history_id) AS n FROM guideline_fls_resolution_history GROUP BY 1) h ON h.g = r.g
LEFT JOIN (SELECT trim(guideline_id, {_WS}) AS g, count(DISTINCT trim(block_id, {_WS})) AS n FROM guideline_blocks GROUP BY 1) b ON b.g = r.g LEFT JOIN (SELECT trim(guideline_id, {_WS}) AS g, count(DISTINCT candidate_rank) AS n FROM guideline_fls_resolution_candidates GROUP BY 1) c ON c.g = r.g""")
def many_reports(spark, sf_dir):
    """Reports put side by side by id, the last of repeated ones; each side is reduced to its key before it is joined."""
    g = strip("guideline_id").alias("guideline_id")
    sides = [
        table(spark, sf_dir, "guideline_fls_source_mappings", "guideline_id", "raw_fls_id", "delivered_at").groupBy(g).agg(F.max_by("raw_fls_id", F.when(F.col("raw_fls_id").isNotNull(), F.col("delivered_at"))).alias("fls")),
        table(spark, sf_dir, "guideline_fls_resolution_history", "guideline_id", "history_id").groupBy(g).agg(F.countDistinct("history_id").alias("history_rows")),
        table(spark, sf_dir, "guideline_blocks", "guideline_id", "block_id").groupBy(g).agg(F.countDistinct(strip("block_id")).alias("blocks")),
        table(spark, sf_dir, "guideline_fls_resolution_candidates", "guideline_id", "candidate_rank").groupBy(g).agg(F.countDistinct("candidate_rank").alias("candidates")),
    ]
    out = table(spark, sf_dir, "guideline_records", "guideline_id").select(g).distinct()
    for s in sides:
        out = out.join(s, "guideline_id", "left")
    return out


# --- set operations and inventories ---


@query("set_union_titles", f"SELECT 'title' AS kind, title AS text FROM guideline_records UNION ALL SELECT 'section', section FROM paragraphs")
def union_titles(spark, sf_dir):
    """Titles and headings in one list, repeats kept."""
    return table(spark, sf_dir, "guideline_records").select(F.lit("title").alias("kind"), F.col("title").alias("text")).unionByName(table(spark, sf_dir, "paragraphs").select(F.lit("section").alias("kind"), F.col("section").alias("text")))


@query("set_difference", "SELECT chapter AS name, 'documents' AS only_in FROM (SELECT chapter FROM documents EXCEPT SELECT chapter FROM paragraphs) UNION ALL SELECT chapter, 'paragraphs' FROM (SELECT chapter FROM paragraphs EXCEPT SELECT chapter FROM documents)")
def set_difference(spark, sf_dir):
    """What one set has and the other lacks, both ways."""
    a, b = table(spark, sf_dir, "documents", "chapter"), table(spark, sf_dir, "paragraphs", "chapter")
    return a.subtract(b).select(F.col("chapter").alias("name"), F.lit("documents").alias("only_in")).unionByName(b.subtract(a).select(F.col("chapter").alias("name"), F.lit("paragraphs").alias("only_in")))


@query("table_row_counts", "SELECT 'documents' AS name, count(*) AS n FROM documents UNION ALL SELECT 'chunks', count(*) FROM chunks UNION ALL SELECT 'paragraphs', count(*) FROM paragraphs UNION ALL SELECT 'guideline_blocks', count(*) FROM guideline_blocks")
def row_counts(spark, sf_dir):
    """Rows a table; counts come from the files' footers."""
    parts = [table(spark, sf_dir, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n") for n in ("documents", "chunks", "paragraphs", "guideline_blocks")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("drift_ratio", f"""WITH n AS (SELECT corpus, snapshot_id, count(DISTINCT document_id) AS n FROM source_inventory_documents GROUP BY 1, 2), s AS (SELECT DISTINCT snapshot_id, substr(trim(fetched_at), 1, 10) AS day FROM snapshots), o AS (SELECT n.corpus, n.snapshot_id, n.n, lag(n.n) OVER (PARTITION BY n.corpus ORDER BY s.day, n.snapshot_id) AS before FROM n JOIN s USING (snapshot_id))
SELECT corpus, snapshot_id, n, before, round(abs(n - before) / before, 6) AS drift, abs(n - before) / before > 0.35 AS warns FROM o WHERE before IS NOT NULL""")
def drift_ratio(spark, sf_dir):
    """How far a snapshot's count lies from the one before; more than 35 % warns."""
    n = table(spark, sf_dir, "source_inventory_documents", "corpus", "snapshot_id", "document_id").groupBy("corpus", "snapshot_id").agg(F.countDistinct("document_id").alias("n"))
    s = table(spark, sf_dir, "snapshots", "snapshot_id", "fetched_at").select("snapshot_id", F.substring(F.trim("fetched_at"), 1, 10).alias("day")).distinct()
    w = Window.partitionBy("corpus").orderBy("day", "snapshot_id")  # a row a snapshot
    ratio = F.abs(F.col("n") - F.col("before")) / F.col("before")
    return n.join(F.broadcast(s), "snapshot_id").withColumn("before", F.lag("n").over(w)).where("before IS NOT NULL").select("corpus", "snapshot_id", "n", "before", F.round(ratio, 6).alias("drift"), (ratio > 0.35).alias("warns"))


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """The incoming rows and those existing ones whose key they lack (K2); incoming keys must be unique."""
    return incoming.unionByName(existing.join(incoming.select(*keys), keys, "left_anti"))


@query("upsert_last_wins", "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 3 THEN 'U' ELSE o_orderstatus END AS o_orderstatus FROM orders UNION ALL SELECT -o_orderkey, 'N' FROM orders WHERE o_orderkey % 100 = 3")
def upsert_orders(spark, sf_dir):
    """K2: all orders with a changed tenth and some new ones merged in; the last writer wins."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    changed = o.where("o_orderkey % 10 = 3").withColumn("o_orderstatus", F.lit("U"))
    new = o.where("o_orderkey % 100 = 3").select((-F.col("o_orderkey")).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"))
    return upsert(o, changed.unionByName(new), ["o_orderkey"])


def subtree_delete(levels: list[tuple[DataFrame, str, str | None]], doomed: DataFrame) -> list[DataFrame]:
    """What is left of each level of a tree after the roots in ``doomed`` (column id) and all below them are taken away (K3).

    levels: (frame, key, parent column or None for the root), from the root down; ids travel down by semi-joins.
    """
    kept, gone = [], doomed.select(F.col("id").alias("_gone")).distinct()
    for frame, key, parent in levels:
        column = parent or key
        hit = frame.join(gone, frame[column] == gone["_gone"], "left_semi")
        kept.append(frame.join(gone, frame[column] == gone["_gone"], "left_anti"))
        gone = hit.select(F.col(key).alias("_gone")).distinct()
    return kept


@query("subtree_delete", "SELECT 'customer' AS level, count(*) AS n FROM customer WHERE c_nationkey <> 3 UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3) UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3))")
def subtree_delete_customers(spark, sf_dir):
    """K3: customers of one nation with their orders and lines taken away."""
    c, o, l = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    kept = subtree_delete([(c, "c_custkey", None), (o, "o_orderkey", "o_custkey"), (l, "l_orderkey", "l_orderkey")], c.where("c_nationkey = 3").select(F.col("c_custkey").alias("id")))
    parts = [k.agg(F.count("*").alias("n")).select(F.lit(n).alias("level"), "n") for k, n in zip(kept, ("customer", "orders", "lineitem"), strict=True)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("orphan_delete", f"SELECT DISTINCT trim(paragraph_id, {_WS}) AS paragraph_id FROM paragraphs p WHERE EXISTS (SELECT 1 FROM guideline_fls_source_mappings m WHERE trim(m.raw_fls_id, {_WS}) = trim(p.paragraph_id, {_WS}))")
def orphan_delete(spark, sf_dir):
    """K4: rows that no link names, deleted; what is left."""
    links = table(spark, sf_dir, "guideline_fls_source_mappings", "raw_fls_id").select(strip("raw_fls_id").alias("paragraph_id"))
    return table(spark, sf_dir, "paragraphs", "paragraph_id").select(strip("paragraph_id").alias("paragraph_id")).distinct().join(links, "paragraph_id", "left_semi")


# --- aggregates of logs ---


@query("duration_percentiles", """SELECT event_type, round(sum(value), 3) AS total, round(avg(value), 3) AS mean, round(list_sort(list(value))[cast(floor((count(*) - 1) * 0.50) AS BIGINT) + 1], 3) AS p50, round(list_sort(list(value))[cast(floor((count(*) - 1) * 0.95) AS BIGINT) + 1], 3) AS p95, round(max(value), 3) AS top FROM events GROUP BY 1""")
def duration_percentiles(spark, sf_dir):
    """Lower-index percentiles, exact. A running count over the distinct values, aggregated first, finds the value at the index: no list is gathered."""
    e = table(spark, sf_dir, "events", "event_type", "value")
    hist = e.groupBy("event_type", "value").agg(F.count("*").alias("n"))
    upto = hist.withColumn("upto", F.sum("n").over(Window.partitionBy("event_type").orderBy("value")))
    whole = e.groupBy("event_type").agg(F.count("*").alias("all_n"), F.sum("value").alias("total"), F.avg("value").alias("mean"), F.max("value").alias("top"))
    at = lambda q: F.min(F.when(F.col("upto") > F.floor((F.col("all_n") - 1) * q), F.col("value")))
    pct = upto.join(F.broadcast(whole.select("event_type", "all_n")), "event_type").groupBy("event_type").agg(at(0.50).alias("p50"), at(0.95).alias("p95"))
    return whole.join(pct, "event_type").select("event_type", *[F.round(c, 3).alias(c) for c in ("total", "mean", "p50", "p95", "top")])


@query("skew_entropy_gini", """WITH p AS (SELECT event_type, count(*) / (SELECT count(*) FROM events) AS p FROM events GROUP BY 1) SELECT round(max(p), 6) AS max_share, round(-sum(p * log2(p)) / log2(9), 6) AS entropy, round(1 - sum(p * p), 6) AS gini, (SELECT round(avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END), 6) FROM events) AS abstain_rate, max(p) > 0.75 OR -sum(p * log2(p)) / log2(9) < 0.35 AS alarm FROM p""")
def skew_entropy_gini(spark, sf_dir):
    """Largest share, entropy over that of nine labels, Gini and abstention; alarms at fixed bounds."""
    n = table(spark, sf_dir, "events", "event_type").groupBy("event_type").agg(F.count("*").alias("n"))
    p = n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("whole")))).select("event_type", (F.col("n") / F.col("whole")).alias("p"))
    entropy = -F.sum(F.col("p") * F.log2("p")) / F.log2(F.lit(9.0))
    return p.agg(F.round(F.max("p"), 6).alias("max_share"), F.round(entropy, 6).alias("entropy"), F.round(1 - F.sum(F.col("p") * F.col("p")), 6).alias("gini"), F.round(F.coalesce(F.sum(F.when(F.col("event_type") == "error", F.col("p"))), F.lit(0.0)), 6).alias("abstain_rate"), ((F.max("p") > 0.75) | (entropy < 0.35)).alias("alarm"))


@query("confusion_prf", """WITH c AS (SELECT count(*) FILTER (WHERE l_returnflag = 'R' AND l_linestatus = 'F') AS tp, count(*) FILTER (WHERE l_returnflag <> 'R' AND l_linestatus = 'F') AS fp, count(*) FILTER (WHERE l_returnflag = 'R' AND l_linestatus <> 'F') AS fn, count(*) FILTER (WHERE l_returnflag <> 'R' AND l_linestatus <> 'F') AS tn FROM lineitem)
SELECT tp, fp, fn, tn, round(tp / (tp + fp), 4) AS prec, round(tp / (tp + fn), 4) AS rec, round(2.0 * tp / (2 * tp + fp + fn), 4) AS f1 FROM c""")
def confusion_prf(spark, sf_dir):
    """A confusion matrix with precision, recall and F1, 0 where nothing can be divided."""
    actual, predicted = F.col("l_returnflag") == "R", F.col("l_linestatus") == "F"
    m = table(spark, sf_dir, "lineitem", "l_returnflag", "l_linestatus").agg(F.count_if(actual & predicted).alias("tp"), F.count_if(~actual & predicted).alias("fp"), F.count_if(actual & ~predicted).alias("fn"), F.count_if(~actual & ~predicted).alias("tn"))
    share = lambda a, b: F.round(F.when(b > 0, a / b).otherwise(0.0), 4)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return m.select("tp", "fp", "fn", "tn", share(tp, tp + fp).alias("prec"), share(tp, tp + fn).alias("rec"), share(2.0 * tp, 2 * tp + fp + fn).alias("f1"))


@query("attribution_hotspots", "SELECT user_id, event_type, round(sum(value), 6) AS spent, row_number() OVER (PARTITION BY event_type ORDER BY round(sum(value), 6) DESC, user_id) AS place FROM events GROUP BY 1, 2 QUALIFY place <= 3")
def attribution_hotspots(spark, sf_dir):
    """The three costliest users of each kind; ranking follows the aggregation and stops early in each task."""
    s = table(spark, sf_dir, "events", "user_id", "event_type", "value").groupBy("user_id", "event_type").agg(F.round(F.sum("value"), 6).alias("spent"))
    return s.withColumn("place", F.row_number().over(Window.partitionBy("event_type").orderBy(F.desc("spent"), "user_id"))).where("place <= 3")


@query("abstain_prf", """WITH c AS (SELECT event_type = 'error' AS active, cast(json_extract_string(props, '$.k') AS INT) > 50 AS expected FROM events) SELECT round(avg(active::INT), 6) AS abstain_rate, round(coalesce(sum((active AND expected)::INT) / nullif(sum(active::INT), 0), 0.0), 6) AS abstain_precision, round(coalesce(sum((active AND expected)::INT) / nullif(sum(expected::INT), 0), 1.0), 6) AS abstain_recall FROM c""")
def abstain_prf(spark, sf_dir):
    """abstention's precision (0 if none abstained) and recall (1 if none was expected), from nested properties."""
    c = table(spark, sf_dir, "events", "event_type", "props").select((F.col("event_type") == "error").alias("active"), (F.get_json_object("props", "$.k").cast("int") > 50).alias("expected"))
    n = lambda x: F.count_if(x)
    both = n(F.col("active") & F.col("expected"))
    return c.agg(F.round(n(F.col("active")) / F.count("*"), 6).alias("abstain_rate"), F.round(F.when(n(F.col("active")) > 0, both / n(F.col("active"))).otherwise(0.0), 6).alias("abstain_precision"), F.round(F.when(n(F.col("expected")) > 0, both / n(F.col("expected"))).otherwise(1.0), 6).alias("abstain_recall"))


OUTCOMES = ("purchase", "click", "view", "error", "signup", "other")


@query("outcome_counts", "WITH o AS (SELECT unnest(['purchase', 'click', 'view', 'error', 'signup', 'other']) AS outcome), n AS (SELECT CASE WHEN event_type IN ('purchase', 'click', 'view', 'error', 'signup') THEN event_type ELSE 'other' END AS outcome, count(*) AS n FROM events GROUP BY 1) SELECT o.outcome, coalesce(n.n, 0) AS n, round(coalesce(n.n, 0) / (SELECT count(*) FROM events), 6) AS share FROM o LEFT JOIN n ON n.outcome = o.outcome")
def outcome_counts(spark, sf_dir):
    """Counts and shares over a fixed set of outcomes, zeros filled in."""
    kind = F.when(F.col("event_type").isin(*OUTCOMES[:-1]), F.col("event_type")).otherwise("other")
    n = table(spark, sf_dir, "events", "event_type").groupBy(kind.alias("outcome")).agg(F.count("*").alias("n"))
    whole = n.agg(F.sum("n").alias("whole"))
    names = spark.createDataFrame([(o,) for o in OUTCOMES], "outcome string")
    return names.join(n, "outcome", "left").na.fill(0).crossJoin(F.broadcast(whole)).select("outcome", "n", F.round(F.col("n") / F.col("whole"), 6).alias("share"))


@query("split_counts", f"SELECT coalesce(item_kind, '') AS label, count(DISTINCT id) FILTER (WHERE b < 70) AS train, count(DISTINCT id) FILTER (WHERE b >= 70 AND b < 85) AS dev, count(DISTINCT id) FILTER (WHERE b >= 85) AS test FROM (SELECT item_kind, trim(chunk_uid, {_WS}) AS id, cast('0x' || substr(sha256(trim(chunk_uid, {_WS})), 1, 8) AS BIGINT) % 100 AS b FROM core_docs_chunk_metadata) GROUP BY 1")
def split_counts(spark, sf_dir):
    """Labels per split, the split by a hash of the id."""
    key = strip("chunk_uid")
    bucket = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long") % 100
    rows = table(spark, sf_dir, "core_docs_chunk_metadata", "chunk_uid", "item_kind").select(F.coalesce("item_kind", F.lit("")).alias("label"), key.alias("id"), F.when(bucket < 70, "train").when(bucket < 85, "dev").otherwise("test").alias("split"))
    return rows.groupBy("label").pivot("split", ["train", "dev", "test"]).agg(F.countDistinct("id")).na.fill(0)


@query("hash_split", f"SELECT doc_id, cast('0x' || substr(sha256(cast(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 AS bucket FROM documents")
def hash_split(spark, sf_dir):
    """F16: a bucket from the first eight hex digits of a hash."""
    return table(spark, sf_dir, "documents", "doc_id").select("doc_id", (F.conv(F.substring(F.sha2(F.col("doc_id").cast("string"), 256), 1, 8), 16, 10).cast("long") % 100).alias("bucket"))


@query("inventory_digest", f"""SELECT section_id, count(*) AS n, sha256(string_agg(h, ',' ORDER BY h)) AS digest FROM (SELECT DISTINCT section_id, sha256(coalesce(clean_text, '')) AS h FROM paragraphs) GROUP BY 1""")
def inventory_digest(spark, sf_dir):
    """A section's digest from the sorted digests of its parts, the order of rows notwithstanding."""
    p = table(spark, sf_dir, "paragraphs", "section_id", "clean_text").select("section_id", F.sha2(F.coalesce("clean_text", F.lit("")), 256).alias("h")).distinct()
    return p.groupBy("section_id").agg(F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ","), 256).alias("digest"))


@query("duplicate_families", "SELECT h AS family, count(*) AS size, min(doc_id) AS first_id FROM (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents) GROUP BY 1 HAVING count(*) > 1")
def duplicate_families(spark, sf_dir):
    """Groups of equal texts, by digest."""
    return table(spark, sf_dir, "documents", "doc_id", "text").groupBy(F.sha2(F.coalesce("text", F.lit("")), 256).alias("family")).agg(F.count("*").alias("size"), F.min("doc_id").alias("first_id")).where("size > 1")


# --- ranking windows ---


@query("window_rank_map", "SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents QUALIFY rank <= 64")
def window_rank_map(spark, sf_dir):
    """Ranks under a full order, inside a window of 64."""
    w = Window.partitionBy("source").orderBy(F.desc("n_chars"), "doc_id")
    return table(spark, sf_dir, "documents", "doc_id", "source", "n_chars").withColumn("rank", F.row_number().over(w)).where("rank <= 64").select("doc_id", "source", "rank")


def min_max(df: DataFrame, key: list[str], column: str, out: str) -> DataFrame:
    """Adds the column scaled to 0..1 within its key, 1.0 where the pool is constant (W2); bounds are aggregated and joined back, so a hot key stays spread."""
    bounds = df.groupBy(*key).agg(F.min(column).alias("_low"), F.max(column).alias("_high"))
    scaled = F.when(F.col("_high") - F.col("_low") < 1e-12, 1.0).otherwise((F.col(column) - F.col("_low")) / (F.col("_high") - F.col("_low")))
    return df.join(bounds, key).withColumn(out, scaled).drop("_low", "_high")


@query("window_min_max", "SELECT event_id, round(CASE WHEN max(value) OVER w - min(value) OVER w < 1e-12 THEN 1.0 ELSE (value - min(value) OVER w) / (max(value) OVER w - min(value) OVER w) END, 6) AS score, round(CASE WHEN max(value) OVER w <= 1e-12 THEN 0.0 ELSE greatest(value, 0.0) / max(value) OVER w END, 6) AS share FROM events WINDOW w AS (PARTITION BY event_type)")
def window_min_max(spark, sf_dir):
    """Min-max and max normalisation of a pool."""
    e = min_max(table(spark, sf_dir, "events", "event_id", "event_type", "value"), ["event_type"], "value", "score")
    top = e.groupBy("event_type").agg(F.max("value").alias("_top"))
    return e.join(top, "event_type").select("event_id", F.round("score", 6).alias("score"), F.round(F.when(F.col("_top") <= 1e-12, 0.0).otherwise(F.greatest("value", F.lit(0.0)) / F.col("_top")), 6).alias("share"))


@query("window_first_seen", "SELECT source, lang, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY fetched_at, doc_id) = 1")
def window_first_seen(spark, sf_dir):
    """The first of each group, by an aggregation that keeps one row a group and task."""
    d = table(spark, sf_dir, "documents", "doc_id", "source", "lang", "fetched_at")
    return d.groupBy("source", "lang").agg(F.min_by("doc_id", F.struct("fetched_at", "doc_id")).alias("doc_id"))


@query("window_margin", "SELECT source, doc_id AS top_id, n_chars AS top_chars, coalesce(n_chars - lead(n_chars) OVER w, n_chars) AS margin FROM documents WINDOW w AS (PARTITION BY source ORDER BY n_chars DESC, doc_id) QUALIFY row_number() OVER w = 1")
def window_margin(spark, sf_dir):
    """The best, and how far it leads the runner-up; both ranks are cut to two rows before the lead is taken."""
    w = Window.partitionBy("source").orderBy(F.desc("n_chars"), "doc_id")
    top = table(spark, sf_dir, "documents", "source", "doc_id", "n_chars").withColumn("rn", F.row_number().over(w)).where("rn <= 2")
    pair = top.groupBy("source").agg(F.max(F.when(F.col("rn") == 1, F.col("doc_id"))).alias("top_id"), F.max(F.when(F.col("rn") == 1, F.col("n_chars"))).alias("top_chars"), F.max(F.when(F.col("rn") == 2, F.col("n_chars"))).alias("second"))
    return pair.select("source", "top_id", "top_chars", F.coalesce(F.col("top_chars") - F.col("second"), F.col("top_chars")).alias("margin"))


@query("window_top3_evidence", "SELECT chapter, rel_path, doc_id, row_number() OVER (PARTITION BY chapter, rel_path ORDER BY n_chars DESC, doc_id) AS place FROM documents QUALIFY place <= 3")
def window_top3(spark, sf_dir):
    """Three pieces of evidence for each key."""
    w = Window.partitionBy("chapter", "rel_path").orderBy(F.desc("n_chars"), "doc_id")
    return table(spark, sf_dir, "documents", "chapter", "rel_path", "doc_id", "n_chars").withColumn("place", F.row_number().over(w)).where("place <= 3").drop("n_chars")


@query("grouping_sets_summary", "SELECT coalesce(l_returnflag, '') AS slice, l_linestatus AS mode, round(avg(l_discount), 6) AS mean_metric, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_linestatus), (l_returnflag, l_linestatus))")
def grouping_sets_summary(spark, sf_dir):
    """Means per mode and per slice and mode in one pass."""
    _views(spark, sf_dir, "lineitem")
    return spark.sql("SELECT coalesce(l_returnflag, '') AS slice, l_linestatus AS mode, round(avg(l_discount), 6) AS mean_metric, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_linestatus), (l_returnflag, l_linestatus))")


@query("scope_accounting", f"""WITH asked AS (SELECT trim(raw_fls_id, {_WS}) AS id FROM guideline_fls_source_mappings WHERE raw_fls_id IS NOT NULL), norm AS (SELECT DISTINCT id FROM asked WHERE id <> ''), have AS (SELECT DISTINCT trim(paragraph_id, {_WS}) AS id FROM paragraphs)
SELECT (SELECT count(*) FROM asked) AS requested, (SELECT count(*) FROM norm) AS normalised, (SELECT count(*) FROM norm JOIN have USING (id)) AS matched, (SELECT count(*) FROM norm) - (SELECT count(*) FROM norm JOIN have USING (id)) AS unmatched""")
def scope_accounting(spark, sf_dir):
    """Asked-for ids, stripped and distinct, against those there are."""
    asked = table(spark, sf_dir, "guideline_fls_source_mappings", "raw_fls_id").where("raw_fls_id IS NOT NULL").select(strip("raw_fls_id").alias("id"))
    have = table(spark, sf_dir, "paragraphs", "paragraph_id").select(strip("paragraph_id").alias("id"), F.lit(1).alias("hit")).distinct()
    norm = asked.groupBy("id").agg(F.count("*").alias("n")).join(have, "id", "left")
    real = F.col("id") != ""
    return norm.agg(F.sum("n").alias("requested"), F.count_if(real).alias("normalised"), F.count_if(real & F.col("hit").isNotNull()).alias("matched"), F.count_if(real & F.col("hit").isNull()).alias("unmatched"))


@query("required_evidence", "SELECT 'quality_label' AS field, max(CASE WHEN quality_label <> '' THEN 1 ELSE 0 END) AS present, count(*) FILTER (WHERE coalesce(quality_label, '') = '') AS blanks FROM guideline_records UNION ALL SELECT 'export_topic', max(CASE WHEN export_topic <> '' THEN 1 ELSE 0 END), count(*) FILTER (WHERE coalesce(export_topic, '') = '') FROM guideline_records UNION ALL SELECT 'source_hash', max(CASE WHEN source_hash <> '' THEN 1 ELSE 0 END), count(*) FILTER (WHERE coalesce(source_hash, '') = '') FROM guideline_records")
def required_evidence(spark, sf_dir):
    """Whether required fields hold anything, all in one scan."""
    fields = ("quality_label", "export_topic", "source_hash")
    r = table(spark, sf_dir, "guideline_records", *fields)
    one = r.agg(*[F.struct(F.lit(f).alias("field"), F.max(F.when(F.col(f) != "", 1).otherwise(0)).alias("present"), F.count_if(F.coalesce(f, F.lit("")) == "").alias("blanks")).alias(f) for f in fields])
    return one.select(F.inline(F.array(*fields)))


@query("windowed_events", "SELECT epoch_us(time_bucket(INTERVAL '1 hour', ts)) // 1000000 AS start_s, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2")
def windowed_events(spark, sf_dir):
    """Beyond the inventory: tumbling windows of an hour; in a session of any time zone, as whole seconds of UTC."""
    e = table(spark, sf_dir, "events", "ts", "event_type", "value")
    second = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01', ts)")
    return e.groupBy((second - F.pmod(second, F.lit(3600))).alias("start_s"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))
