"""Plain SQL for problems 1, 3, 4 and 5, in DuckDB's dialect; it shares nothing with the operators."""

from __future__ import annotations

from quarryline.operators.nested import KINDS, MEMBER_KINDS, RECORD

WS = r"E' \t\r\n'"


def trim(col: str) -> str:
    return f"trim({col}, {WS})"


def ident(col: str) -> str:
    return f"nullif({trim(col)}, '')"


_ISO = r"^(\d{4})-(\d{2})-(\d{2})[Tt ](\d{2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?([Zz]|[+-]\d{2}(?::?\d{2})?)?$"


def instant(col: str) -> str:
    """Microseconds since 1970 of an ISO time; null if it is none. The basic form is put into the extended one first."""
    text = rf"regexp_replace(regexp_replace({trim(col)}, '^(\d{{4}})(\d{{2}})(\d{{2}})[Tt](\d{{2}})(\d{{2}})(\d{{2}})', '\1-\2-\3T\4:\5:\6'), '^(\d{{4}})(\d{{2}})(\d{{2}})[Tt](\d{{2}})(\d{{2}})', '\1-\2-\3T\4:\5')"
    g = lambda i: f"regexp_extract({text}, '{_ISO}', {i})"
    stamp = f"try_cast({g(1)} || '-' || {g(2)} || '-' || {g(3)} || ' ' || {g(4)} || ':' || {g(5)} || ':' || coalesce(nullif({g(6)}, ''), '00') AS TIMESTAMP)"
    zone = f"replace({g(8)}, ':', '')"
    minutes = f"(CASE WHEN {zone} LIKE '-%' THEN -1 ELSE 1 END) * (CASE WHEN regexp_matches({zone}, '^[+-]') THEN cast(substr({zone}, 2, 2) AS BIGINT) * 60 + coalesce(try_cast(nullif(substr({zone}, 4, 2), '') AS BIGINT), 0) ELSE 0 END)"
    micros = f"coalesce(try_cast(rpad(substr({g(7)}, 1, 6), 6, '0') AS BIGINT), 0)"
    return f"(CASE WHEN regexp_matches({text}, '{_ISO}') THEN epoch_us({stamp}) + {micros} - ({minutes}) * 60000000 END)"


def utc(col: str) -> str:
    return f"strftime(make_timestamp({col}), '%Y-%m-%dT%H:%M:%SZ')"


_STATES = f"""
  states AS (
    SELECT entity, instant, last_row.f AS effective_fls_id, last_row.s AS resolution_status FROM (
      SELECT {ident('guideline_id')} AS entity, {instant('recorded_at')} AS instant,
        max({{'d': delivered_at, 'f': coalesce({trim('effective_fls_id')}, ''), 's': lower(coalesce({trim('resolution_status')}, ''))}}) AS last_row
      FROM guideline_fls_resolution_history GROUP BY 1, 2)
    WHERE entity IS NOT NULL AND instant IS NOT NULL)"""

_VERSIONS = f"""WITH {_STATES},
  marked AS (SELECT *, lag(effective_fls_id) OVER w AS f0, lag(resolution_status) OVER w AS s0, row_number() OVER w AS rn FROM states WINDOW w AS (PARTITION BY entity ORDER BY instant)),
  starts AS (SELECT * FROM marked WHERE rn = 1 OR f0 <> effective_fls_id OR s0 <> resolution_status)
SELECT entity AS guideline_id, {utc('instant')} AS valid_from, coalesce({utc('lead(instant) OVER (PARTITION BY entity ORDER BY instant)')}, '') AS valid_to"""

P3_LOG = f"""WITH {_STATES},
  long AS (SELECT entity, instant, 'effective_fls_id' AS attribute, effective_fls_id AS value FROM states UNION ALL SELECT entity, instant, 'resolution_status', resolution_status FROM states),
  marked AS (SELECT *, lag(value) OVER w AS v0, row_number() OVER w AS rn FROM long WINDOW w AS (PARTITION BY entity, attribute ORDER BY instant)),
  starts AS (SELECT * FROM marked WHERE rn = 1 OR v0 <> value)
SELECT entity AS guideline_id, attribute, value, {utc('instant')} AS valid_from, coalesce({utc('lead(instant) OVER (PARTITION BY entity, attribute ORDER BY instant)')}, '') AS valid_to FROM starts"""


def _direct(child: str, key: str, reference: str, parent: str, parent_key: str) -> str:
    target = rf"nullif(nullif({trim(f'''regexp_replace({reference}, '^.*#', '', 's')''')}, ''), 'fls_UNRESOLVED')"
    return f"""
  SELECT DISTINCT '{child}' AS source_table, c.k AS row_key,
    CASE WHEN p.ref IS NULL THEN 'missing' WHEN p.gone THEN 'deleted' WHEN p.arrived > f.first THEN 'late' END AS orphan_kind, substr(cast(f.first AS VARCHAR), 1, 7) AS orphan_month
  FROM (SELECT DISTINCT {ident(key)} AS k, {target} AS ref FROM {child}) c
  JOIN (SELECT {ident(key)} AS k, min(delivered_at) AS first FROM {child} GROUP BY 1) f ON f.k = c.k
  LEFT JOIN (SELECT {ident(parent_key)} AS ref, bool_and(removed_at IS NOT NULL) AS gone, min(delivered_at) AS arrived FROM {parent} GROUP BY 1) p ON p.ref = c.ref
  WHERE c.ref IS NOT NULL AND (p.ref IS NULL OR p.gone OR p.arrived > f.first)"""


_ORPHANS = " UNION ALL ".join([
    _direct("guideline_fls_source_mappings", "guideline_id", "raw_fls_id", "paragraphs", "paragraph_id"),
    _direct("core_docs_chunk_metadata", "chunk_uid", "chunk_uid", "chunks", "chunk_uid"),
    _direct("guideline_blocks", "block_id", "guideline_id", "guideline_records", "guideline_id"),
])

P4_REPORT = f"""WITH direct AS ({_ORPHANS}),
  bad AS (SELECT DISTINCT row_key FROM direct WHERE source_table = 'guideline_fls_source_mappings'),
  inherited AS (
    SELECT 'guideline_fls_resolution_history' AS source_table, {ident('guideline_id')} || coalesce('|' || {ident('history_id')}, '') AS k, substr(cast(min(delivered_at) AS VARCHAR), 1, 7) AS m
    FROM guideline_fls_resolution_history WHERE {ident('guideline_id')} IN (SELECT row_key FROM bad) GROUP BY 1, 2
    UNION ALL
    SELECT DISTINCT 'guideline_fls_resolution_candidates', coalesce({ident('audit_run_id')} || '|', '') || {ident('guideline_id')} || coalesce('|' || candidate_rank, ''), ''
    FROM guideline_fls_resolution_candidates WHERE {ident('guideline_id')} IN (SELECT row_key FROM bad))
SELECT source_table, coalesce(orphan_month, '') AS orphan_month, orphan_kind, 0 AS depth, count(*) AS orphans FROM direct GROUP BY 1, 2, 3
UNION ALL SELECT source_table, coalesce(m, ''), 'inherited', 1, count(*) FROM inherited GROUP BY 1, 2"""


P4_CASCADE = f"""WITH bad AS (SELECT DISTINCT row_key FROM ({_ORPHANS}) WHERE source_table = 'guideline_fls_source_mappings'),
  one AS (SELECT concat_ws('|', {ident('guideline_id')}, {ident('audit_run_id')}) AS k, min({ident('guideline_id')}) FILTER (WHERE {ident('guideline_id')} IN (SELECT row_key FROM bad)) AS p, substr(cast(min(delivered_at) AS VARCHAR), 1, 7) AS m FROM guideline_fls_resolution_history GROUP BY 1),
  two AS (SELECT DISTINCT concat_ws('|', {ident('audit_run_id')}, {ident('guideline_id')}, candidate_rank) AS k, concat_ws('|', {ident('guideline_id')}, {ident('audit_run_id')}) AS p FROM guideline_fls_resolution_candidates)
SELECT 'guideline_fls_resolution_history' AS source_table, k AS row_key, coalesce(m, '') AS orphan_month, 1 AS depth, 'guideline_fls_source_mappings' AS inherited_from, p AS inherited_key FROM one WHERE p IS NOT NULL
UNION ALL SELECT 'guideline_fls_resolution_candidates', k, '', 2, 'guideline_fls_resolution_history', min(p) FROM two WHERE p IN (SELECT k FROM one WHERE p IS NOT NULL) GROUP BY k"""


def _digest(col: str) -> str:
    return f"nullif({trim(f'''regexp_replace(lower({trim(col)}), '^sha256:', '')''')}, '')"


_CHANGES = f"""WITH snaps AS (
    SELECT {ident('corpus')} AS corpus, {ident('snapshot_id')} AS snapshot_id, min({instant('fetched_at')}) AS t, min(coalesce(lower({trim('commit_sha')}), '')) AS sha
    FROM snapshots WHERE {instant('fetched_at')} IS NOT NULL GROUP BY 1, 2),
  raw AS (
    SELECT 'source_inventory_documents' AS source_table, {ident('corpus')} AS corpus, {ident('document_id')} AS entity_id, {ident('snapshot_id')} AS snapshot_id, {_digest('content_sha256')} AS digest, {instant('last_materialized_at')} AS at FROM source_inventory_documents
    UNION ALL
    SELECT 'source_inventory_units', {ident('corpus')}, {ident('unit_kind')} || '|' || {ident('unit_id')}, {ident('snapshot_id')}, {_digest('content_sha256')}, {instant('last_materialized_at')} FROM source_inventory_units),
  held AS (SELECT r.source_table, r.corpus, r.entity_id, r.snapshot_id, s.t, r.digest FROM raw r JOIN snaps s USING (corpus, snapshot_id) WHERE r.entity_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY r.source_table, r.corpus, r.entity_id, r.snapshot_id ORDER BY r.at DESC NULLS LAST, r.digest DESC NULLS LAST) = 1),
  orders AS (SELECT source_table, corpus, snapshot_id, row_number() OVER (PARTITION BY source_table, corpus ORDER BY t, snapshot_id) AS o FROM (SELECT DISTINCT source_table, corpus, snapshot_id, t FROM held)),
  lines AS (SELECT h.*, o.o, lag(o.o) OVER w AS o0, lead(o.o) OVER w AS o1 FROM held h JOIN orders o USING (source_table, corpus, snapshot_id) WINDOW w AS (PARTITION BY h.source_table, h.corpus, h.entity_id ORDER BY o.o)),
  lives AS (SELECT *, sum(CASE WHEN o0 IS NULL OR o0 < o - 1 THEN 1 ELSE 0 END) OVER (PARTITION BY source_table, corpus, entity_id ORDER BY o) AS life FROM lines),
  known AS (SELECT *, last_value(digest IGNORE NULLS) OVER (PARTITION BY source_table, corpus, entity_id, life ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM lives)
SELECT source_table, corpus, entity_id, snapshot_id, 'added' AS change_kind FROM lives WHERE o > 1 AND (o0 IS NULL OR o0 < o - 1)
UNION ALL SELECT l.source_table, l.corpus, l.entity_id, n.snapshot_id, 'removed' FROM lives l JOIN orders n ON n.source_table = l.source_table AND n.corpus = l.corpus AND n.o = l.o + 1 WHERE l.o1 IS NULL OR l.o1 > l.o + 1
UNION ALL SELECT source_table, corpus, entity_id, snapshot_id, 'changed' FROM known WHERE o0 = o - 1 AND digest <> before
UNION ALL SELECT 'snapshots', corpus, corpus, snapshot_id, 'changed' FROM (SELECT *, lag(sha) OVER (PARTITION BY corpus ORDER BY t, snapshot_id) AS sha0 FROM snaps) WHERE NOT starts_with(sha, sha0) AND NOT starts_with(sha0, sha)"""

#: Objects in place of arrays, and texts of JSON, are followed as in the statement of problem 1.
_ARRAY_NAMES = "('modes', 'hits', 'spans', 'stages', 'candidates', 'components', 'matches', 'role_rows')"


def _plain(expr: str) -> str:
    """The JSON value itself, or what a string of JSON text of an object or array holds."""
    text = f"({expr} ->> '$')"
    return f"CASE WHEN json_type({expr}) = 'VARCHAR' AND json_valid({text}) AND regexp_matches({text}, '^[ \\t\\r\\n]*[\\[{{]') THEN cast({text} AS JSON) ELSE {expr} END"


_P1_NODES = f"""WITH RECURSIVE raw AS (
    SELECT 'guideline_fls_resolution_candidates' AS source_table, concat_ws('|', {trim('audit_run_id')}, {trim('guideline_id')}, candidate_rank, {trim('paragraph_id')}) AS row_key, evidence_json AS j, false AS listed FROM guideline_fls_resolution_candidates
    UNION ALL SELECT 'guideline_records', {trim('guideline_id')}, metadata_json, false FROM guideline_records
    UNION ALL SELECT 'ws7_mapping_cleanup_tasks', concat_ws('|', {trim('run_id')}, {trim('source_id')}), nearest_candidate_paragraphs_json, true FROM ws7_mapping_cleanup_tasks),
  roots AS (SELECT source_table, row_key, listed, cast(j AS JSON) AS j FROM raw WHERE json_valid(j)),
  node AS (
    SELECT source_table, row_key, '' AS path, listed, {_plain('j')} AS v, -1 AS position, '' AS owner, '' AS label, '' AS id, '' AS owner_id FROM roots
    UNION ALL
    SELECT source_table, row_key, path || step, listed, v, position, owner, label, id || '/' || mark, owner_id FROM (
      SELECT n.source_table, n.row_key, n.path,
        CASE WHEN n.wrapped THEN '[0]' WHEN json_type(n.v) = 'ARRAY' THEN '[' || e.key || ']' WHEN n.path = '' THEN e.key ELSE '.' || e.key END AS step,
        CASE WHEN n.wrapped OR json_type(n.v) = 'ARRAY' THEN false ELSE e.key IN {_ARRAY_NAMES} END AS listed,
        CASE WHEN n.wrapped THEN n.v ELSE {_plain('e.value')} END AS v, CASE WHEN n.wrapped THEN 0 WHEN json_type(n.v) = 'ARRAY' THEN cast(e.key AS INT) ELSE -1 END AS position,
        CASE WHEN n.wrapped OR json_type(n.v) = 'ARRAY' THEN n.owner ELSE n.path END AS owner, CASE WHEN n.wrapped OR json_type(n.v) = 'ARRAY' THEN n.label ELSE e.key END AS label,
        n.id, CASE WHEN n.wrapped THEN '0' ELSE replace(replace(e.key, '~', '~0'), '/', '~1') END AS mark, CASE WHEN n.wrapped OR json_type(n.v) = 'ARRAY' THEN n.owner_id ELSE n.id END AS owner_id
      FROM (SELECT *, listed AND json_type(v) = 'OBJECT' AS wrapped FROM node) n, json_each(CASE WHEN n.wrapped THEN '[0]' WHEN json_type(n.v) IN ('OBJECT', 'ARRAY') THEN n.v ELSE '[]' END) e))"""
P1_FOUND = f"{_P1_NODES} SELECT DISTINCT source_table, row_key, path AS node_path FROM node WHERE position >= 0 AND json_type(v) = 'OBJECT'"


def p1_table(kind: str, columns: tuple[str, ...]) -> str:
    """One kind of object as a flat table."""
    scalars = ", ".join(f"v ->> '$.{c}' AS \"{c}\"" for c in columns)
    return f"{_P1_NODES} SELECT DISTINCT source_table, row_key, path AS node_path, owner AS parent_path, position, {scalars} FROM node WHERE position >= 0 AND json_type(v) = 'OBJECT' AND label = '{kind}'"


P1_OBJECTS = f"""{_P1_NODES} SELECT DISTINCT source_table, row_key, path AS node_path, CASE WHEN path <> '' THEN owner END AS parent_path, CASE WHEN path = '' THEN 'record' ELSE label END AS kind, nullif(position, -1) AS position
FROM node WHERE path = '' OR json_type(v) = 'OBJECT' AND NOT listed"""
P1_NODES = f"""{_P1_NODES} SELECT DISTINCT source_table, row_key, id AS node_id, CASE WHEN path <> '' THEN owner_id END AS parent_id, path AS node_path, CASE WHEN path = '' THEN 'record' ELSE label END AS kind, nullif(position, -1) AS position
FROM node WHERE path = '' OR json_type(v) = 'OBJECT' AND NOT listed"""
P1_MEMBERS = f"""{_P1_NODES} SELECT DISTINCT source_table, row_key, owner AS node_path, CASE WHEN owner = '' THEN path ELSE regexp_replace(substr(path, len(owner) + 1), '^[.]', '') END AS name,
  CASE WHEN json_type(v) = 'NULL' THEN NULL ELSE v ->> '$' END AS value, CASE json_type(v) WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' WHEN 'ARRAY' THEN 'array' ELSE 'number' END AS value_type
FROM node WHERE json_type(v) NOT IN ('OBJECT', 'ARRAY') OR json_type(v) = 'ARRAY' AND json_array_length(v) = 0"""


def p1_member_table(kind: str, columns: tuple[str, ...]) -> str:
    """The records, or the plain members of one name, as a flat table."""
    scalars = ", ".join(f"v ->> '$.{c}' AS \"{c}\"" for c in columns)
    which = "path = ''" if kind == RECORD else f"json_type(v) = 'OBJECT' AND NOT listed AND path <> '' AND label = '{kind}'"
    return f"{_P1_NODES} SELECT DISTINCT source_table, row_key, path AS node_path, CASE WHEN path <> '' THEN owner END AS parent_path, nullif(position, -1) AS position, {scalars} FROM node WHERE {which}"


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": P1_FOUND,
        "p1_objects": P1_OBJECTS,
        "p1_members": P1_MEMBERS,
        "p1_nodes": P1_NODES,
        **{f"p1_table_{kind}": p1_member_table(kind, columns) for kind, columns in MEMBER_KINDS.items()},
        **{f"p1_table_{kind or 'nearest'}": p1_table(kind, columns) for kind, columns in KINDS.items()},
        "p3_found": f"{_VERSIONS} FROM starts",
        "p3_versions": f"{_VERSIONS}, effective_fls_id, resolution_status FROM starts",
        "p3_attribute_log": P3_LOG,
        "p4_found": _ORPHANS,
        "p4_report": P4_REPORT,
        "p4_cascade": P4_CASCADE,
        "p5_found": _CHANGES,
        "p5_report": f"SELECT source_table, corpus, snapshot_id, change_kind, count(*) AS records FROM ({_CHANGES}) GROUP BY 1, 2, 3, 4",
    }
