"""From documents to sections, statements, chunks and evidence, and keeping what is derived from them current."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.functions.cleaning import strip
from quarryline.functions.text import MARKUP, STATEMENT_TYPES, clean_markup, jaccard, raw_tokens, sentences, slug, statement_type
from quarryline.operators.relational import full_outer_delta
from quarryline.plans.catalog import query
from quarryline.plans.provenance import identities
from quarryline.plans.stages import table

_WS = r"E' \t\r\n'"
HEADING = r"(?m)^#{1,6}[ \t]+(\S[^\n]*?)[ \t\r]*$"
#: Statements shorter than this are left out. A fixed value.
LEAST_STATEMENT = 30
#: Mechanisms by what their evidence says: id, symbol, family, enforcement, pattern. Fixed values.
MECHANISMS = (
    ("rust.typing.static", "type-system", "typing", "hard", r"\btype(s|d)?\b|\bstruct\b|\benum\b"),
    ("rust.typing.newtype", "newtype", "typing", "hard", r"\bnewtype\b|\btuple struct\b"),
    ("rust.abstraction.traits", "traits", "abstraction", "hard", r"\btrait(s)?\b|\bimpl\b"),
    ("rust.control_flow.match", "match", "control-flow", "hard", r"\bmatch\b|\bpattern\b|\bexhaustive\b"),
    ("rust.defensive.result_option", "result-option", "defensive", "hard", r"\bresult\b|\boption\b|\berror\b"),
    ("rust.memory.borrowing", "ownership-borrowing", "memory-safety", "hard", r"\bborrow(ing)?\b|\blifetime\b|\bownership\b"),
    ("rust.concurrency.send_sync", "send-sync", "concurrency", "hard", r"\bsend\b|\bsync\b|\bthread\b"),
    ("rust.unsafe.boundary", "unsafe-boundary", "unsafe", "process", r"\bunsafe\b|\binvariant\b|\bsafety\b"),
    ("rust.diagnostics.attributes", "diagnostic-attributes", "diagnostics", "lint", r"\blint\b|\battribute\b"),
)
#: Confidence in evidence from a heading alone. A fixed value.
HEADING_CONFIDENCE = 0.64


# --- text ---


def _clean_sql(col: str) -> str:
    out = col
    for p in MARKUP:
        out = f"regexp_replace({out}, '{p}', ' ', 'g')"
    return rf"trim(regexp_replace({out}, '[ \t\n\r\f\x0b]+', ' ', 'g'))"


@query("text_clean_markdown", f"SELECT doc_id, {_clean_sql('text')} AS clean FROM documents")
def clean_documents(spark, sf_dir):
    """Markdown without markup."""
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", clean_markup("text").alias("clean"))


@query("text_slug_anchor", rf"""WITH h AS (SELECT doc_id, unnest(regexp_extract_all(text, '{HEADING}', 1)) AS heading, generate_subscripts(regexp_extract_all(text, '{HEADING}', 1), 1) AS o FROM documents), s AS (SELECT *, coalesce(nullif(trim(regexp_replace(lower(heading), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'section') AS root FROM h),
 n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, root ORDER BY o) AS k FROM s) SELECT doc_id, o AS order_index, heading, CASE WHEN k = 1 THEN root ELSE root || '-' || k END AS anchor FROM n""")
def slug_anchor(spark, sf_dir):
    """Headings with anchors that are unique within their document."""
    h = table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(HEADING), F.lit(1))).alias("o", "heading"))
    rows = h.select("doc_id", (F.col("o") + 1).alias("order_index"), "heading", slug("heading").alias("root"))
    k = F.row_number().over(Window.partitionBy("doc_id", "root").orderBy("order_index"))
    return rows.withColumn("k", k).select("doc_id", "order_index", "heading", F.when(F.col("k") == 1, F.col("root")).otherwise(F.concat_ws("-", "root", "k")).alias("anchor"))


def sections(documents: DataFrame) -> DataFrame:
    """(doc_id, order_index, heading, body): what lies between headings; a text without headings is one section named ``""``.

    documents: (doc_id, text). Text before the first heading belongs to no section.
    """
    parts = F.split(F.concat(F.lit("\n"), "text"), r"\n(?=#{1,6}[ \t]+\S)")
    rows = documents.where("text IS NOT NULL").select("doc_id", "text", F.posexplode(parts).alias("o", "part"))
    headed = F.col("part").rlike(r"^#{1,6}[ \t]+\S")
    heading = F.btrim(F.regexp_extract("part", r"^#{1,6}[ \t]+([^\n]*)", 1))
    bare = F.regexp_replace(heading, r"\s*\{#[A-Za-z0-9_-]+\}\s*$", "")
    body = strip(F.regexp_replace("part", r"^#{1,6}[ \t]+[^\n]*\n?", ""))
    found = rows.select("doc_id", "o", headed.alias("headed"), F.when(headed, bare).otherwise("").alias("heading"), F.when(headed, body).otherwise(strip("part")).alias("body"))
    kept = found.where("headed OR (o = 0 AND body <> '')")
    any_heading = F.max("headed").over(Window.partitionBy("doc_id"))
    kept = kept.withColumn("any", any_heading).where("headed OR NOT any")
    return kept.select("doc_id", F.greatest("o", F.lit(1)).alias("order_index"), "heading", F.when(F.col("body") == "", F.col("heading")).otherwise(F.col("body")).alias("body"))


def statements(parts: DataFrame) -> DataFrame:
    """(doc_id, order_index, sentence_index, text, statement_type, confidence): sentences of LEAST_STATEMENT characters or more, numbered in their section."""
    blocks = F.filter(F.split("body", r"\n[ \t\r]*\n"), lambda b: F.length(F.trim(b)) > 0)
    rows = parts.select("doc_id", "order_index", F.posexplode(blocks).alias("b", "block")).select("doc_id", "order_index", "b", F.posexplode(sentences(clean_markup("block"))).alias("s", "text")).where(F.length("text") >= LEAST_STATEMENT)
    kind, sure = statement_type("text")
    index = F.row_number().over(Window.partitionBy("doc_id", "order_index").orderBy("b", "s"))
    return rows.select("doc_id", "order_index", index.alias("sentence_index"), "text", kind.alias("statement_type"), sure.alias("confidence"))


_SECTIONS_SQL = rf"""cut AS (SELECT doc_id, string_split(regexp_replace(chr(10) || text, '\n(#{{1,6}}[ \t]+\S)', chr(1) || '\1', 'g'), chr(1)) AS parts FROM documents WHERE text IS NOT NULL),
  part AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) - 1 AS o FROM cut), marked AS (SELECT *, regexp_matches(part, '^#{{1,6}}[ \t]+\S') AS headed FROM part),
  held AS (SELECT doc_id, o, headed, CASE WHEN headed THEN regexp_replace(trim(regexp_extract(part, '^#{{1,6}}[ \t]+([^\n]*)', 1)), '\s*\{{#[A-Za-z0-9_-]+\}}\s*$', '') ELSE '' END AS heading,
    trim(CASE WHEN headed THEN regexp_replace(part, '^#{{1,6}}[ \t]+[^\n]*\n?', '') ELSE part END, {_WS}) AS body FROM marked),
  sections AS (SELECT doc_id, greatest(o, 1) AS order_index, heading, CASE WHEN body = '' THEN heading ELSE body END AS body FROM held WHERE headed OR (o = 0 AND body <> '') QUALIFY headed OR NOT bool_or(headed) OVER (PARTITION BY doc_id))"""
#: Sentences in SQL, whose patterns can't look around: a mark is put in every gap first.
_SENTENCES_SQL = r"list_filter(list_transform(string_split(regexp_replace({0}, '([.!?])\s+([A-Z0-9(`\[])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '')"


@query("text_sections", f"WITH {_SECTIONS_SQL} SELECT * FROM sections")
def document_sections(spark, sf_dir):
    """The sections of every document."""
    return sections(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("sentence_split", rf"""WITH {_SECTIONS_SQL}, bl AS (SELECT doc_id, order_index, list_filter(string_split_regex(body, '\n[ \t\r]*\n'), lambda x: length(trim(x)) > 0) AS blocks FROM sections),
  b AS (SELECT doc_id, order_index, unnest(blocks) AS block, generate_subscripts(blocks, 1) AS b FROM bl), c AS (SELECT doc_id, order_index, b, {_SENTENCES_SQL.format(_clean_sql('block'))} AS ss FROM b),
  t AS (SELECT doc_id, order_index, b, unnest(ss) AS text, generate_subscripts(ss, 1) AS s FROM c)
SELECT doc_id, order_index, row_number() OVER (PARTITION BY doc_id, order_index ORDER BY b, s) AS sentence_index, text, CASE WHEN regexp_matches(text, '{STATEMENT_TYPES[0][1]}') THEN 'constraint' WHEN regexp_matches(text, '{STATEMENT_TYPES[1][1]}') THEN 'definition' ELSE 'behavior' END AS statement_type,
  CASE WHEN regexp_matches(text, '{STATEMENT_TYPES[0][1]}') THEN 0.88 WHEN regexp_matches(text, '{STATEMENT_TYPES[1][1]}') THEN 0.76 ELSE 0.68 END::DOUBLE AS confidence FROM t WHERE length(text) >= {LEAST_STATEMENT}""")
def sentence_split(spark, sf_dir):
    """The statements of every document."""
    return statements(sections(table(spark, sf_dir, "documents", "doc_id", "text")))


@query("text_classify_statement", f"""SELECT trim(paragraph_id, {_WS}) AS paragraph_id, CASE WHEN regexp_matches(max(clean_text), '{STATEMENT_TYPES[0][1]}') THEN 'constraint' WHEN regexp_matches(max(clean_text), '{STATEMENT_TYPES[1][1]}') THEN 'definition' ELSE 'behavior' END AS statement_type FROM paragraphs GROUP BY 1""")
def classify_paragraphs(spark, sf_dir):
    """F8: the type of every paragraph."""
    p = table(spark, sf_dir, "paragraphs", "paragraph_id", "clean_text").groupBy(strip("paragraph_id").alias("paragraph_id")).agg(F.max("clean_text").alias("t"))
    return p.select("paragraph_id", statement_type("t")[0].alias("statement_type"))


@query("text_word_counts", "SELECT doc_id, length(trim(text)) - length(replace(trim(text), ' ', '')) + 1 AS words, substr(text, 1, 80) AS excerpt, length(text) AS chars FROM documents")
def word_counts(spark, sf_dir):
    """lengths, excerpts and the word count by spaces."""
    t = F.trim("text")
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", (F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1).alias("words"), F.substring("text", 1, 80).alias("excerpt"), F.length("text").alias("chars"))


# --- packing into chunks ---



def _distinct_tokens(text) -> Column:
    return F.size(F.array_distinct(raw_tokens(text)))


def cut_spans(sizes: Column, most: int, least: int | None = None, full: int | None = None, again: int = 0) -> Column:
    """The spans (from, to; half open) that a row of sizes is cut into, by running sums in one pass.

    With S the running sums, S[0] = 0, a span from b ends before item i if it has items and either i would make it larger than ``most`` or it has ``full``
    already, and it ends after item i once it has ``least``. The next one begins at the last place from which ``again`` is reached, so that much is repeated, but never before b. What
    is left at the end is a span too, unless it is the last one again.
    """
    none = F.array().cast("array<struct<a:int,b:int>>")
    sums = F.aggregate(sizes, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    span = lambda a, b: F.array(F.struct(a.alias("a"), b.alias("b")))

    def spans_of(s: Column) -> Column:
        at = lambda i: F.get(s, i)
        restart = lambda b, e: F.greatest(b, F.size(F.filter(s, lambda x: x <= at(e) - again)) - 1)

        def step(acc: Column, i: Column) -> Column:
            b, held = acc["b"], at(i - 1) - at(acc["b"])
            closed = (i - 1 > b) & ((at(i) - at(b) > most) | (F.lit(False) if full is None else held >= full))
            before = F.struct(F.when(closed, restart(b, i - 1)).otherwise(b).alias("b"), F.when(closed, F.concat(acc["spans"], span(b, i - 1))).otherwise(acc["spans"]).alias("spans"))
            if least is None:
                return before
            return F.get(F.transform(F.array(before), lambda x: F.when(at(i) - at(x["b"]) >= least, F.struct(restart(x["b"], i).alias("b"), F.concat(x["spans"], span(x["b"], i)).alias("spans"))).otherwise(x)), 0)

        n = F.size(s) - 1
        ends = F.aggregate(F.filter(F.sequence(F.lit(0), n), lambda i: i > 0), F.struct(F.lit(0).alias("b"), none.alias("spans")), step)
        last = F.get(F.transform(F.array(ends), lambda x: F.concat(x["spans"], F.filter(span(x["b"], n), lambda y: (y["a"] < n) & ((F.size(x["spans"]) == 0) | (F.try_element_at(x["spans"], F.lit(-1)) != y))))), 0)
        return last

    return F.get(F.transform(F.array(sums), spans_of), 0)


def _joined(items: Column, spans: Callable[[Column], Column], glue: str) -> Column:
    """The texts that items make, put together by the spans of their token counts."""
    both = F.transform(items, lambda p: F.struct(p.alias("t"), _distinct_tokens(p).alias("n")))
    return F.get(F.transform(F.array(both), lambda x: F.transform(spans(x["n"]), lambda y: F.array_join(F.slice(x["t"], y["a"] + 1, y["b"] - y["a"]), glue))), 0)


def chunk_sections(parts: DataFrame, least: int = 80, most: int = 180, overlap: float = 0.1) -> DataFrame:
    """(chunk_uid, doc_id, section, order_index, clean_text, token_len) of sections (doc_id, order_index, body).

    A section's blocks are gathered until a chunk has ``least`` distinct tokens, never beyond ``most`` but by one block; a share of ``most`` is repeated from the end of
    the chunk before. A chunk that is too large by itself is parted between sentences. Bounds: least is 40 or more, overlap at most 0.45. Each section stands for itself
    and nothing leaves the JVM, so there is no exchange. Null bodies and blocks without tokens give nothing.
    """
    least = max(40, least)
    most = max(least, most)
    again = round(most * max(0.0, min(0.45, overlap)))
    blocks = F.filter(F.transform(F.split("body", "\n\n"), lambda b: F.struct(F.trim(F.regexp_replace(clean_markup(b), r"(?U)\s+", " ")).alias("t"))), lambda b: b["t"] != "")
    sized = F.filter(F.transform(blocks, lambda b: F.struct(b["t"].alias("t"), _distinct_tokens(b["t"]).alias("n"))), lambda b: b["n"] > 0)
    staged = parts.select("doc_id", F.col("order_index").alias("section"), sized.alias("blocks"))
    staged = staged.select("doc_id", "section", "blocks", cut_spans(F.col("blocks.n"), most, least=least, again=again).alias("spans"))

    def texts(span: Column) -> Column:
        held = F.slice("blocks", span["a"] + 1, span["b"] - span["a"])
        whole, size = F.array_join(held["t"], " "), F.aggregate(held["n"], F.lit(0), lambda a, x: a + x)
        return F.when(size <= most, F.array(whole)).otherwise(_joined(sentences(whole), lambda x: cut_spans(x, most), " "))

    rows = staged.select("doc_id", "section", F.posexplode(F.flatten(F.transform("spans", texts))).alias("nth", "clean_text"))
    rows = rows.select("doc_id", "section", (F.col("nth") + 1).alias("order_index"), "clean_text", _distinct_tokens("clean_text").alias("token_len"))
    return rows.select(F.concat(F.lit("chunk::"), F.sha2(F.concat_ws("::", "doc_id", "section", "order_index", F.lower("clean_text")), 256)).alias("chunk_uid"), "*")


def pack_paragraphs(text: Column | str, least: int, target: int, most: int) -> Column:
    """Paragraphs gathered up to a target, never beyond ``most`` but by one; a last chunk under ``least`` joins the one before. A blank text is one empty chunk."""
    col = F.col(text) if isinstance(text, str) else text
    paragraphs = F.filter(F.transform(F.split(col, "\n\n"), lambda p: F.btrim(p, F.lit(" \t\r\n"))), lambda p: p != "")

    chunks = _joined(paragraphs, lambda n: cut_spans(n, most, full=target), "\n\n")
    last_two = lambda c: F.concat_ws("\n\n", F.get(c, F.size(c) - 2), F.get(c, F.size(c) - 1))
    short = lambda c: (F.size(c) > 1) & (_distinct_tokens(F.get(c, F.size(c) - 1)) < least)
    return F.get(F.transform(F.array(chunks), lambda c: F.when(short(c), F.concat(F.slice(c, F.lit(1), F.size(c) - 2), F.array(last_two(c)))).when(F.size(c) == 0, F.array(F.lit(""))).otherwise(c)), 0)


def _spans_sql(source: str, out: str, key: str, most: int, least: int = 10**9, again: int = 0, full: int = 10**9) -> str:
    """The spans of cut_spans by a recursion over items; source: (key, sums), the running sums from 0 on."""
    return f"""{out}_w AS (SELECT {key}, sums, 0 AS i, 0 AS b, [{{'a': 0, 'b': 0}}] AS spans FROM {source}
    UNION ALL SELECT {key}, sums, i, CASE WHEN full_ THEN greatest(b, CASE WHEN {again} = 0 THEN i ELSE len(list_filter(sums, lambda x: x <= sums[i + 1] - {again})) - 1 END) ELSE b END, CASE WHEN full_ THEN list_append(spans, {{'a': b, 'b': i}}) ELSE spans END
      FROM (SELECT *, sums[i + 1] - sums[b + 1] >= {least} AS full_ FROM (
        SELECT {key}, sums, i + 1 AS i, CASE WHEN shut THEN greatest(b, CASE WHEN {again} = 0 THEN i ELSE len(list_filter(sums, lambda x: x <= sums[i + 1] - {again})) - 1 END) ELSE b END AS b, CASE WHEN shut THEN list_append(spans, {{'a': b, 'b': i}}) ELSE spans END AS spans
        FROM (SELECT *, i > b AND (sums[i + 2] - sums[b + 1] > {most} OR sums[i + 1] - sums[b + 1] >= {full}) AS shut FROM {out}_w WHERE i + 1 < len(sums))))),
  {out} AS (SELECT {key}, CASE WHEN b < i AND spans[-1] <> {{'a': b, 'b': i}} THEN list_append(spans, {{'a': b, 'b': i}}) ELSE spans END[2:] AS spans FROM {out}_w WHERE i + 1 = len(sums))"""


def _tokens_sql(text: str) -> str:
    return f"len(list_distinct(regexp_extract_all(lower({text}), '[a-z0-9_]+')))"


_SUMS_SQL = "list_transform(range(0, len({0}) + 1), lambda i: coalesce(list_sum(list_transform({0}[1:i], lambda x: x.n)), 0)::INT)"
_CHUNKS_SQL = rf"""WITH RECURSIVE {_SECTIONS_SQL}, bl AS (SELECT doc_id, order_index AS section, list_filter(list_transform(string_split(body, E'\n\n'), lambda x: trim(regexp_replace({_clean_sql('x')}, '[\t\n\x0b\f\r \x{{85}}\p{{Z}}]+', ' ', 'g'))), lambda x: x <> '') AS ts FROM sections),
  bs AS (SELECT doc_id, section, list_filter(list_transform(ts, lambda x: {{'t': x, 'n': {_tokens_sql('x')}}}), lambda x: x.n > 0) AS ts FROM bl), bk AS (SELECT *, {_SUMS_SQL.format('ts')} AS sums FROM bs WHERE len(ts) > 0),
  {_spans_sql('bk', 'one', 'doc_id, section', 180, 80, 18)},
  staged AS (SELECT doc_id, section, nth, array_to_string(list_transform(bk.ts[s.a + 1:s.b], lambda x: x.t), ' ') AS whole, bk.sums[s.b + 1] - bk.sums[s.a + 1] AS size FROM (SELECT doc_id, section, unnest(spans) AS s, generate_subscripts(spans, 1) AS nth FROM one) JOIN bk USING (doc_id, section)),
  pieces AS (SELECT doc_id, section, nth, CASE WHEN size <= 180 THEN [whole] ELSE {_SENTENCES_SQL.format('whole')} END AS ps FROM staged),
  sized AS (SELECT doc_id, section, nth, list_transform(ps, lambda x: {{'t': x, 'n': {_tokens_sql('x')}}}) AS ts, len(ps) AS pieces FROM pieces), sp AS (SELECT *, {_SUMS_SQL.format('ts')} AS sums FROM sized),
  {_spans_sql('sp', 'two', 'doc_id, section, nth', 180)},
  texts AS (SELECT doc_id, section, nth, part, array_to_string(list_transform(sp.ts[s.a + 1:s.b], lambda x: x.t), ' ') AS clean_text FROM (SELECT doc_id, section, nth, unnest(spans) AS s, generate_subscripts(spans, 1) AS part FROM two) JOIN sp USING (doc_id, section, nth)),
  numbered AS (SELECT doc_id, section, row_number() OVER (PARTITION BY doc_id, section ORDER BY nth, part) AS order_index, clean_text FROM texts)
SELECT 'chunk::' || sha256(doc_id || '::' || section || '::' || order_index || '::' || lower(clean_text)) AS chunk_uid, doc_id, section, order_index, clean_text, {_tokens_sql('clean_text')} AS token_len FROM numbered"""


@query("chunk_packing", _CHUNKS_SQL)
def chunk_packing(spark, sf_dir):
    """Chunks of every document's sections."""
    return chunk_sections(sections(table(spark, sf_dir, "documents", "doc_id", "text")))


_API_SQL = rf"""WITH RECURSIVE m AS (SELECT chunk_uid, target_triple, max({{'p': item_path, 'k': item_kind, 's': signature, 'e': example_snippets}}) AS x FROM core_docs_chunk_metadata GROUP BY 1, 2),
  whole AS (SELECT row_number() OVER () AS r, x.p AS item_path, target_triple, concat_ws(E'\n\n', concat_ws(' ', x.k, x.p), x.s, x.e) AS body FROM m),
  ps AS (SELECT r, item_path, target_triple, list_transform(list_filter(list_transform(string_split(body, E'\n\n'), lambda p: trim(p, {_WS})), lambda p: p <> ''), lambda p: {{'t': p, 'n': {_tokens_sql('p')}}}) AS ts FROM whole), sp AS (SELECT *, {_SUMS_SQL.format('ts')} AS sums FROM ps WHERE len(ts) > 0),
  {_spans_sql('sp', 'cut', 'r', 400, full=260)}, made AS (SELECT r, list_transform(spans, lambda s: array_to_string(list_transform(sp.ts[s.a + 1:s.b], lambda x: x.t), E'\n\n')) AS cs FROM cut JOIN sp USING (r)),
  joined AS (SELECT r, CASE WHEN len(cs) > 1 AND {_tokens_sql('cs[-1]')} < 20 THEN list_append(cs[:-3], cs[-2] || E'\n\n' || cs[-1]) ELSE cs END AS cs FROM made), every AS (SELECT w.*, coalesce(j.cs, ['']) AS cs FROM whole w LEFT JOIN joined j USING (r))
SELECT item_path, target_triple, unnest(range(1, len(cs) + 1)) AS order_index, unnest(cs) || E'\n[target: ' || coalesce(target_triple, '') || ']' AS chunk_text FROM every"""


@query("chunk_packing_api", _API_SQL)
def chunk_packing_api(spark, sf_dir):
    """API texts as chunks with a header and the target's name."""
    m = table(spark, sf_dir, "core_docs_chunk_metadata", "chunk_uid", "item_path", "item_kind", "signature", "example_snippets", "target_triple")
    m = m.groupBy("chunk_uid", "target_triple").agg(F.max(F.struct("item_path", "item_kind", "signature", "example_snippets")).alias("x")).select("x.*", "target_triple")
    whole = m.select(F.concat_ws("\n\n", F.concat_ws(" ", "item_kind", "item_path"), "signature", "example_snippets").alias("body"), "item_path", "target_triple")
    rows = whole.select("item_path", "target_triple", F.posexplode(pack_paragraphs("body", 20, 260, 400)).alias("nth", "chunk"))
    return rows.select("item_path", "target_triple", (F.col("nth") + 1).alias("order_index"), F.concat("chunk", F.lit("\n[target: "), F.coalesce("target_triple", F.lit("")), F.lit("]")).alias("chunk_text"))


# --- mechanisms and their evidence ---


def _taxonomy(spark) -> DataFrame:
    return spark.createDataFrame(MECHANISMS, "mechanism_id string, symbol string, family string, enforcement string, pattern string")


def evidence(parts: DataFrame, lines: DataFrame) -> DataFrame:
    """(mechanism_id, section_id, statement_id, excerpt, confidence): per section and mechanism that it speaks of, the first statement that does, else the heading.

    parts: (section_id, heading, body), the body being what isn't among the lines; lines: (section_id, statement_id, position, text, confidence). A section speaks of
    what its heading, body or any line does, so that no section's text has to be put together. The nine patterns are tried in one pass.
    """
    flags = F.array(*[F.when(F.lower("t").rlike(m[4]), F.lit(m[0])) for m in MECHANISMS])
    spoken = lambda df, *cols: df.select(*cols, F.explode(F.array_compact(flags)).alias("mechanism_id"))
    told = spoken(parts.withColumn("t", F.concat_ws("\n", "heading", "body")), "section_id")
    first = spoken(lines.withColumn("t", F.col("text")), "section_id", "statement_id", "position", "text", "confidence").groupBy("section_id", "mechanism_id").agg(F.min_by(F.struct("statement_id", "text", "confidence"), F.struct("position", "statement_id")).alias("s"))
    said = told.unionByName(first.select("section_id", "mechanism_id")).distinct().join(parts.select("section_id", "heading"), "section_id")
    return said.join(first, ["section_id", "mechanism_id"], "left").select("mechanism_id", "section_id", F.col("s.statement_id").alias("statement_id"), F.coalesce("s.text", "heading").alias("excerpt"), F.coalesce("s.confidence", F.lit(HEADING_CONFIDENCE)).alias("confidence"))


def _paragraph_sections(spark, sf_dir):
    p = table(spark, sf_dir, "paragraphs", "paragraph_id", "section_id", "section", "row_no", "clean_text")
    p = p.groupBy(strip("paragraph_id").alias("statement_id")).agg(F.max("section_id").alias("section_id"), F.max("section").alias("heading"), F.max("row_no").alias("position"), F.coalesce(F.max("clean_text"), F.lit("")).alias("text")).where("section_id IS NOT NULL")
    parts = p.groupBy("section_id").agg(F.max("heading").alias("heading")).withColumn("body", F.lit(""))
    return parts, p.withColumn("confidence", statement_type("text")[1])


_PATTERNS = "(VALUES " + ", ".join(f"('{m[0]}', '{m[1]}', '{m[2]}', '{m[4]}')" for m in MECHANISMS) + ") AS m(mechanism_id, symbol, family, pattern)"
_EVIDENCE_SQL = f"""p AS (SELECT trim(paragraph_id, {_WS}) AS statement_id, max(section_id) AS section_id, max(section) AS heading, max(row_no) AS position, coalesce(max(clean_text), '') AS text FROM paragraphs GROUP BY 1 HAVING max(section_id) IS NOT NULL),
  sec AS (SELECT section_id, max(heading) AS heading, string_agg(text, E'\\n' ORDER BY position) AS body FROM p GROUP BY 1), m AS (SELECT * FROM {_PATTERNS}),
  said AS (SELECT section_id, heading, mechanism_id FROM sec JOIN m ON regexp_matches(lower(coalesce(heading || E'\\n', '') || body), m.pattern)),
  fst AS (SELECT section_id, mechanism_id, arg_min({{'i': statement_id, 't': text, 'c': CASE WHEN regexp_matches(text, '{STATEMENT_TYPES[0][1]}') THEN 0.88 WHEN regexp_matches(text, '{STATEMENT_TYPES[1][1]}') THEN 0.76 ELSE 0.68 END}}, {{'p': position, 'i': statement_id}}) AS s FROM p JOIN m ON regexp_matches(lower(text), m.pattern) GROUP BY 1, 2),
  ev AS (SELECT mechanism_id, section_id, s.i AS statement_id, coalesce(s.t, heading) AS excerpt, coalesce(s.c, {HEADING_CONFIDENCE})::DOUBLE AS confidence FROM said LEFT JOIN fst USING (section_id, mechanism_id))"""


@query("evidence_extraction", f"WITH {_EVIDENCE_SQL} SELECT * FROM ev")
def evidence_extraction(spark, sf_dir):
    """Evidence of nine mechanisms in every section."""
    return evidence(*_paragraph_sections(spark, sf_dir))


@query("evidence_best", f"WITH {_EVIDENCE_SQL} SELECT mechanism_id, count(*) AS n, arg_min(section_id, {{'c': -confidence, 's': section_id}}) AS section_id, max(confidence) AS confidence FROM ev GROUP BY 1")
def evidence_best(spark, sf_dir):
    """Each mechanism's surest section, the first of equals."""
    return evidence_extraction(spark, sf_dir).groupBy("mechanism_id").agg(F.count("*").alias("n"), F.min_by("section_id", F.struct(-F.col("confidence"), F.col("section_id"))).alias("section_id"), F.max("confidence").alias("confidence"))


@query("label_mechanism_scores", f"""WITH {_EVIDENCE_SQL}, lab AS (SELECT section_id AS label, list_distinct(regexp_extract_all(lower(max(heading)), '[a-z0-9_]+')) AS t FROM sec GROUP BY 1), n AS (SELECT mechanism_id, count(*) AS n FROM ev GROUP BY 1),
  x AS (SELECT l.label, m.mechanism_id, l.t, list_distinct(regexp_extract_all(lower(m.symbol || ' ' || m.family), '[a-z0-9_]+')) AS mt, list_contains(l.t, m.family) AS fam, coalesce(n.n, 0) AS n FROM lab l, m LEFT JOIN n ON n.mechanism_id = m.mechanism_id),
  s AS (SELECT label, mechanism_id, fam::INT + 0.25 * least(n / 20, 1) AS lexical, least(1.0, len(list_intersect(t, mt)) / len(list_distinct(list_concat(t, mt))) + 0.12 * fam::INT) AS semantic, fam FROM x),
  h AS (SELECT *, 0.20 * lexical + 0.45 * semantic + 0.35 * least(1.0, 0.75 * semantic + 0.25 * fam::INT) AS hybrid FROM s)
SELECT label, mechanism_id, round(lexical, 6) AS lexical, round(semantic, 6) AS semantic, round(hybrid, 6) AS hybrid FROM h QUALIFY fam OR (NOT bool_or(fam) OVER (PARTITION BY label) AND row_number() OVER (PARTITION BY label ORDER BY round(hybrid, 6) DESC, round(semantic, 6) DESC, mechanism_id) <= 3)""")
def label_mechanism_scores(spark, sf_dir):
    """Sections against mechanisms, the nine of which are a fixed table; what matches the family is chosen, else the three best."""
    parts, lines = _paragraph_sections(spark, sf_dir)
    counts = evidence(parts, lines).groupBy("mechanism_id").agg(F.count("*").alias("n"))
    m = _taxonomy(spark).join(counts, "mechanism_id", "left").select("mechanism_id", "symbol", "family", F.coalesce("n", F.lit(0)).alias("n"))
    x = parts.select(F.col("section_id").alias("label"), F.array_distinct(raw_tokens(F.lower("heading"))).alias("t")).crossJoin(F.broadcast(m))
    own = F.array_distinct(raw_tokens(F.concat_ws(" ", "symbol", "family")))
    fam = F.array_contains("t", F.col("family")).cast("int")
    x = x.withColumn("fam", fam).withColumn("lexical", F.col("fam") + 0.25 * F.least(F.col("n") / 20, F.lit(1.0))).withColumn("semantic", F.least(F.lit(1.0), jaccard(F.col("t"), own) + 0.12 * F.col("fam")))
    x = x.withColumn("hybrid", 0.20 * F.col("lexical") + 0.45 * F.col("semantic") + 0.35 * F.least(F.lit(1.0), 0.75 * F.col("semantic") + 0.25 * F.col("fam")))
    x = x.select("label", "mechanism_id", "fam", *[F.round(c, 6).alias(c) for c in ("lexical", "semantic", "hybrid")])
    w = Window.partitionBy("label")
    ranked = x.withColumn("any", F.max("fam").over(w)).withColumn("rn", F.row_number().over(w.orderBy(F.desc("hybrid"), F.desc("semantic"), "mechanism_id")))
    return ranked.where("fam = 1 OR (any = 0 AND rn <= 3)").select("label", "mechanism_id", "lexical", "semantic", "hybrid")


@query("semantic_corpus", f"""WITH {_EVIDENCE_SQL}, top AS (SELECT mechanism_id, excerpt, row_number() OVER (PARTITION BY mechanism_id ORDER BY confidence DESC, section_id) AS k FROM ev)
SELECT 'label' AS kind, section_id AS id, coalesce(heading, '') AS text FROM sec UNION ALL SELECT 'mechanism', mechanism_id, string_agg(excerpt, ' ' ORDER BY k) FROM top WHERE k <= 3 GROUP BY mechanism_id UNION ALL SELECT 'evidence', mechanism_id || '::' || section_id, excerpt FROM ev""")
def semantic_corpus(spark, sf_dir):
    """Labels, mechanisms with their three best excerpts, and evidence, in one list."""
    parts, lines = _paragraph_sections(spark, sf_dir)
    ev = evidence(parts, lines)
    top = ev.withColumn("k", F.row_number().over(Window.partitionBy("mechanism_id").orderBy(F.desc("confidence"), "section_id"))).where("k <= 3")
    profiles = top.groupBy("mechanism_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "excerpt"))), lambda s: s["excerpt"]), " ").alias("text"))
    return parts.select(F.lit("label").alias("kind"), F.col("section_id").alias("id"), F.coalesce("heading", F.lit("")).alias("text")).unionByName(profiles.select(F.lit("mechanism").alias("kind"), F.col("mechanism_id").alias("id"), "text")).unionByName(ev.select(F.lit("evidence").alias("kind"), F.concat_ws("::", "mechanism_id", "section_id").alias("id"), F.col("excerpt").alias("text")))


# --- vectors kept for unchanged texts ---


def _text_keys(spark, sf_dir):
    c = table(spark, sf_dir, "chunks", "chunk_uid", "clean_text").groupBy(strip("chunk_uid").alias("id")).agg(F.sha2(F.lower(F.coalesce(F.max("clean_text"), F.lit(""))), 256).alias("sha"))
    m = table(spark, sf_dir, "core_docs_chunk_metadata", "chunk_uid", "target_triple", "target_env", "cfg_signature_sha256").groupBy(strip("chunk_uid").alias("id")).agg(*[F.coalesce(F.max(x), F.lit("")).alias(x) for x in ("target_triple", "target_env", "cfg_signature_sha256")])
    return c.join(m, "id", "left").na.fill("")


@query("embed_dedup_ratio", f"""WITH c AS (SELECT trim(chunk_uid, {_WS}) AS id, sha256(lower(coalesce(max(clean_text), ''))) AS sha FROM chunks GROUP BY 1), m AS (SELECT trim(chunk_uid, {_WS}) AS id, coalesce(max(target_triple), '') AS a, coalesce(max(target_env), '') AS b, coalesce(max(cfg_signature_sha256), '') AS d FROM core_docs_chunk_metadata GROUP BY 1)
SELECT count(*) AS units, count(DISTINCT (sha, coalesce(a, ''), coalesce(b, ''), coalesce(d, ''))) AS vectors, round(1 - count(DISTINCT (sha, coalesce(a, ''), coalesce(b, ''), coalesce(d, ''))) / count(*), 6) AS saved FROM c LEFT JOIN m USING (id)""")
def embed_dedup_ratio(spark, sf_dir):
    """How many vectors are saved where units share text and target."""
    groups = _text_keys(spark, sf_dir).groupBy("sha", "target_triple", "target_env", "cfg_signature_sha256").agg(F.count("*").alias("n"))
    return groups.agg(F.sum("n").alias("units"), F.count("*").alias("vectors"), F.round(1 - F.count("*") / F.sum("n"), 6).alias("saved"))


@query("cache_validity", f"""WITH c AS (SELECT trim(chunk_uid, {_WS}) AS id, max(order_index) AS o, sha256(lower(coalesce(max(clean_text), ''))) AS sha FROM chunks GROUP BY 1), k AS (SELECT id, CASE WHEN o % 5 = 0 THEN sha256(sha) ELSE sha END AS sha FROM c WHERE o % 7 <> 0)
SELECT c.id, CASE WHEN k.id IS NULL THEN 'missing' WHEN k.sha = c.sha THEN 'valid' ELSE 'stale' END AS state FROM c LEFT JOIN k ON k.id = c.id""")
def cache_validity(spark, sf_dir):
    """Which kept vectors still belong to their texts; the made-up cache lacks some units and has outdated ones."""
    c = table(spark, sf_dir, "chunks", "chunk_uid", "clean_text", "order_index").groupBy(strip("chunk_uid").alias("id")).agg(F.max("order_index").alias("o"), F.sha2(F.lower(F.coalesce(F.max("clean_text"), F.lit(""))), 256).alias("sha"))
    kept = c.where("o % 7 <> 0").select("id", F.when(F.col("o") % 5 == 0, F.sha2("sha", 256)).otherwise(F.col("sha")).alias("kept"))
    return c.join(kept, "id", "left").select("id", F.when(F.col("kept").isNull(), "missing").when(F.col("kept") == F.col("sha"), "valid").otherwise("stale").alias("state"))


def refresh(current: DataFrame, incoming: DataFrame, key: str, digest: str) -> tuple[DataFrame, DataFrame]:
    """The delta of two inventories and the table after it: deleted and updated rows taken out, added and updated ones put in.

    Both frames have the same columns. Unchanged rows come from ``current``, so that what is derived from them need not be made again.
    """
    delta = full_outer_delta(current, incoming, [key], [digest])
    changed = delta.where("delta <> 'unchanged'").select(key)
    fresh = incoming.join(delta.where("delta IN ('added', 'updated')").select(key), key, "left_semi")
    return delta, current.join(changed, key, "left_anti").unionByName(fresh)


@query("incremental_refresh", "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN sha256(sha256(coalesce(text, ''))) ELSE sha256(coalesce(text, '')) END AS h FROM documents WHERE doc_id % 7 <> 1")
def incremental_refresh(spark, sf_dir):
    """A refresh by delta gives what a full rebuild would."""
    d = table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    later = d.where("doc_id % 7 <> 1").withColumn("h", F.when(F.col("doc_id") % 5 == 0, F.sha2("h", 256)).otherwise(F.col("h")))
    return refresh(d.where("doc_id % 7 <> 0"), later, "doc_id", "h")[1]


@query("mapping_validation", f"""WITH c AS (SELECT trim(chunk_uid, {_WS}) AS id, count(*) AS n FROM chunks GROUP BY 1), m AS (SELECT trim(chunk_uid, {_WS}) AS id, count(*) AS n FROM core_docs_chunk_metadata GROUP BY 1)
SELECT (SELECT count(*) FROM c) AS units, (SELECT count(*) FROM m) AS mapped, (SELECT count(*) FROM c WHERE id NOT IN (SELECT id FROM m WHERE id IS NOT NULL)) AS unmapped, (SELECT count(*) FROM m WHERE id NOT IN (SELECT id FROM c WHERE id IS NOT NULL)) AS orphans, (SELECT count(*) FROM c WHERE n > 1) AS repeated_units, (SELECT count(*) FROM m WHERE n > 1) AS repeated_mappings, (SELECT count(*) FROM m WHERE id = '' OR id IS NULL) AS blank""")
def mapping_validation(spark, sf_dir):
    """The defects of a mapping, all counted on one full outer join."""
    c = table(spark, sf_dir, "chunks", "chunk_uid").groupBy(strip("chunk_uid").alias("id")).agg(F.count("*").alias("c"))
    m = table(spark, sf_dir, "core_docs_chunk_metadata", "chunk_uid").groupBy(strip("chunk_uid").alias("id")).agg(F.count("*").alias("m"))
    n = F.count_if
    return c.join(m, "id", "full_outer").agg(F.count("c").alias("units"), F.count("m").alias("mapped"), n(F.col("m").isNull()).alias("unmapped"), n(F.col("c").isNull()).alias("orphans"), n(F.col("c") > 1).alias("repeated_units"), n(F.col("m") > 1).alias("repeated_mappings"), n(F.col("m").isNotNull() & (F.coalesce("id", F.lit("")) == "")).alias("blank"))


@query("corpus_validation", f"""WITH f AS (SELECT (SELECT count(DISTINCT section_id) FROM paragraphs) AS sections, (SELECT count(DISTINCT trim(paragraph_id, {_WS})) FROM paragraphs) AS statements, (SELECT count(*) FROM documents WHERE coalesce(trim(text), '') = '') AS blanks, (SELECT count(*) FROM (SELECT 1 FROM documents GROUP BY doc_id HAVING count(*) > 1)) AS repeats)
SELECT 'sections' AS rule, sections AS value, sections >= 20 AS passed FROM f UNION ALL SELECT 'statements', statements, statements >= 100 FROM f UNION ALL SELECT 'blank_documents', blanks, blanks = 0 FROM f UNION ALL SELECT 'repeated_ids', repeats, repeats = 0 FROM f""")
def corpus_validation(spark, sf_dir):
    """Rules over counts, each with its value and whether it holds."""
    p = table(spark, sf_dir, "paragraphs", "section_id", "paragraph_id").agg(F.countDistinct("section_id").alias("sections"), F.countDistinct(strip("paragraph_id")).alias("statements"))
    d = table(spark, sf_dir, "documents", "doc_id", "text")
    blanks = d.agg(F.count_if(F.coalesce(F.trim("text"), F.lit("")) == "").alias("blanks"))
    repeats = d.groupBy("doc_id").agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("repeats"))
    one = p.crossJoin(blanks).crossJoin(repeats)
    rule = lambda name, c, ok: F.struct(F.lit(name).alias("rule"), F.col(c).alias("value"), ok.alias("passed"))
    return one.select(F.inline(F.array(rule("sections", "sections", F.col("sections") >= 20), rule("statements", "statements", F.col("statements") >= 100), rule("blank_documents", "blanks", F.col("blanks") == 0), rule("repeated_ids", "repeats", F.col("repeats") == 0))))


@query("paragraph_eligibility", f"""SELECT trim(paragraph_id, {_WS}) AS paragraph_id, CASE WHEN max(live_topology_present) = 1 AND coalesce(trim(max(section_id)), '') <> '' THEN 'eligible' WHEN max(live_topology_present) = 1 THEN 'no_section' ELSE 'not_live' END AS state FROM paragraphs GROUP BY 1""")
def paragraph_eligibility(spark, sf_dir):
    """Who can be retrieved: in the live tree and in a section; the two ways not to are told apart."""
    p = table(spark, sf_dir, "paragraphs", "paragraph_id", "live_topology_present", "section_id").groupBy(strip("paragraph_id").alias("paragraph_id")).agg(F.max("live_topology_present").alias("live"), F.max("section_id").alias("s"))
    return p.select("paragraph_id", F.when((F.col("live") == 1) & (F.coalesce(F.trim("s"), F.lit("")) != ""), "eligible").when(F.col("live") == 1, "no_section").otherwise("not_live").alias("state"))


@query("topology_drift", f"""WITH p AS (SELECT DISTINCT trim(paragraph_id, {_WS}) AS id, document_link, paragraph_link, section_link, source_file FROM paragraphs)
SELECT id, 'document_link' AS field, document_link AS have, regexp_extract(source_file, '([^/]*)[.][a-z]+$', 1) || '.html' AS want FROM p WHERE document_link IS DISTINCT FROM regexp_extract(source_file, '([^/]*)[.][a-z]+$', 1) || '.html'
UNION ALL SELECT id, 'paragraph_link', paragraph_link, document_link || '#' || id FROM p WHERE paragraph_link IS DISTINCT FROM document_link || '#' || id UNION ALL SELECT id, 'section_link', split_part(section_link, '#', 1), document_link FROM p WHERE split_part(section_link, '#', 1) IS DISTINCT FROM document_link""")
def topology_drift(spark, sf_dir):
    """Fields that differ from what a paragraph's place says."""
    p = table(spark, sf_dir, "paragraphs", "paragraph_id", "document_link", "paragraph_link", "section_link", "source_file").select(strip("paragraph_id").alias("id"), "document_link", "paragraph_link", "section_link", "source_file").distinct()
    stem = F.concat(F.regexp_extract("source_file", r"([^/]*)\.[a-z]+$", 1), F.lit(".html"))
    check = lambda f, have, want: F.struct(F.lit(f).alias("field"), have.alias("have"), want.alias("want"))
    link = F.concat("document_link", F.lit("#"), "id")
    rows = p.select("id", F.inline(F.array(check("document_link", F.col("document_link"), stem), check("paragraph_link", F.col("paragraph_link"), link), check("section_link", F.split_part("section_link", F.lit("#"), F.lit(1)), F.col("document_link")))))
    return rows.where(~F.col("have").eqNullSafe(F.col("want")))


_ROLES = "dt|t|ds|s|std|p"


@query("role_token_sets", rf"""WITH p AS (SELECT DISTINCT section_id, unnest(regexp_extract_all(raw_text, ':(?:{_ROLES}):`[^`]*`')) AS r FROM paragraphs WHERE retrieval_eligible = 1), x AS (SELECT section_id, regexp_extract(r, '^:([a-z]+):', 1) AS role, regexp_extract(r, '`([^`<]*)', 1) AS t FROM p)
SELECT section_id, role, array_to_string(list_sort(list_distinct(flatten(list(regexp_extract_all(lower(t), '[a-z0-9_]+'))))), ' ') AS tokens FROM x GROUP BY 1, 2""")
def role_token_sets(spark, sf_dir):
    """The tokens that inline roles name, per section and role, from eligible paragraphs."""
    p = table(spark, sf_dir, "paragraphs", "section_id", "raw_text", "retrieval_eligible").where("retrieval_eligible = 1")
    rows = p.select("section_id", F.explode(F.regexp_extract_all("raw_text", F.lit(f":(?:{_ROLES}):`[^`]*`"), F.lit(0))).alias("r"))
    words = rows.select("section_id", F.regexp_extract("r", "^:([a-z]+):", 1).alias("role"), F.explode_outer(raw_tokens(F.regexp_extract("r", "`([^`<]*)", 1))).alias("w")).distinct()
    return words.groupBy("section_id", "role").agg(F.array_join(F.array_sort(F.collect_list("w")), " ").alias("tokens"))  # at most the vocabulary


@query("std_path_lookup", "SELECT list_last(string_split(trim(item_path), '::')) AS short_name, min(trim(item_path)) AS path FROM core_docs_chunk_metadata WHERE item_path IS NOT NULL GROUP BY 1")
def std_path_lookup(spark, sf_dir):
    """The first path of each short name."""
    path = F.trim("item_path")
    return table(spark, sf_dir, "core_docs_chunk_metadata", "item_path").where("item_path IS NOT NULL").groupBy(F.element_at(F.split(path, "::"), -1).alias("short_name")).agg(F.min(path).alias("path"))


@query("corpus_identity", """WITH h AS (SELECT corpus, sha256(coalesce(document_id, '') || '|' || coalesce(content_sha256, '')) AS h FROM source_inventory_documents) SELECT corpus, count(*) AS n, sum(cast('0x' || substr(h, 1, 8) AS BIGINT)) || '-' || sum(cast('0x' || substr(h, 9, 8) AS BIGINT)) AS identity FROM h GROUP BY 1""")
def corpus_identity(spark, sf_dir):
    """Count and digest of each corpus's inventory, to be compared before and after another's refresh."""
    return identities(table(spark, sf_dir, "source_inventory_documents", "corpus", "document_id", "content_sha256"), "corpus", "document_id", "content_sha256")
