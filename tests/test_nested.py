"""The structural index against Python's parser, and the cases of problem 1."""

import json
from datetime import datetime
from types import SimpleNamespace

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarryline.operators import nested

NAMES = nested.ARRAY_NAMES


def walk(v, path, listed, out):
    """Brute force: the paths of objects in arrays."""
    if isinstance(v, str) and v.strip(" \t\r\n")[:1] in ("{", "["):
        try:
            v = json.loads(v, parse_constant=lambda c: 1 / 0)
        except (ValueError, ZeroDivisionError):
            return
    if isinstance(v, dict) and listed:
        path, v = path + "[0]", v
        out.append(path)
    if isinstance(v, dict):
        for k, x in v.items():
            walk(x, f"{path}.{k}" if path else k, k in NAMES, out)
    elif isinstance(v, list):
        for i, x in enumerate(v):
            y = x
            if isinstance(x, str) and x.strip(" \t\r\n")[:1] == "{":
                try:
                    y = json.loads(x)
                except ValueError:
                    y = None
            if isinstance(y, dict):
                out.append(f"{path}[{i}]")
            walk(x, f"{path}[{i}]", False, out)


def brute(text, listed):
    try:
        v = json.loads(text, parse_constant=lambda c: 1 / 0)
    except (ValueError, ZeroDivisionError):
        return []
    out = []
    walk(v, "", listed, out)
    return sorted(out)


def listed_columns(columns):
    return SimpleNamespace(**{n: c.to_pylist() for n, c in columns.items()})


names = st.sampled_from(["a", "hits", "modes", "role_rows", "b c", 'q"\\', "naïve"])
leaves = st.none() | st.booleans() | st.integers(-99, 99) | st.floats(allow_nan=False, allow_infinity=False, width=32) | st.text(alphabet='ab"\\{}[]:, \n\té', max_size=8)
values = st.recursive(leaves, lambda c: st.lists(c, max_size=3) | st.dictionaries(names, c, max_size=3) | c.map(json.dumps), max_leaves=12)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(values, st.booleans(), st.integers(0, 60), st.sampled_from(["", "", "cut", "drop", "double"])), max_size=5), st.booleans())
def test_same_objects_as_a_parser(cases, listed):
    texts = []
    for v, wide, at, damage in cases:
        t = json.dumps(v, indent=1 if wide else None, ensure_ascii=not wide)
        at = min(at, len(t))
        texts.append({"": t, "cut": t[:at], "drop": t[:at] + t[at + 1 :], "double": t[:at] + t[at : at + 1] + t[at:]}[damage])
    found = listed_columns(nested.extract([t.encode() for t in texts], listed, NAMES)[0])
    for i, t in enumerate(texts):
        assert sorted(p for p, r in zip(found.path, found.row, strict=True) if r == i) == brute(t, listed), t


def test_strictness():
    good = ['{"a":1}', "[]", " [1, 2.5e-3, -0] ", '"x"', "null", '{"a":{"b":[]}}', '"\\u00e9\\n"', "0"]
    bad = ["", " ", "{", "]", "[1,]", "{,}", '{"a"}', '{"a":}', '{"a":1,}', "[1 2]", "01", "1.", "+1", "NaN", "tru", '"a', '"\\x"', '"\\u12"', '"a\nb"', "[}", "{]", "[[]", "1 2", "{} {}", '{1:2}', "[:]", "{'a':1}", '["a" "b"]', '{"a" "b":1}', "\\", '[1,,2]', '{"a":1 "b":2}', '{"a"::1}', '["a":1]']
    ix = nested.index_texts([t.encode() for t in good + bad])
    assert ix.valid.tolist() == [True] * len(good) + [False] * len(bad)


def test_edge_rows(spark):
    rows = [("k1", None), ("k2", ""), ("k3", " \n"), ("k4", "n/a"), ("k5", '{"modes": {"x": 1}}'), ("k6", '{"modes": "[{\\"hits\\": [null, {\\"a\\": 1}]}]"}'), (None, '{"hits":[{}]}'), ("k5", '{"modes": {"x": 1}}')]
    df = spark.createDataFrame(rows, "key string, text string").withColumns({"row_key": F.lit("clash"), "path": F.lit(1), "body": F.lit(2)})
    got = nested.nested_objects(df, "t", F.col("key"), F.col("text"), False, NAMES)
    assert sorted((r.row_key, r.node_path, r.parent_path, r.kind, r.position) for r in got.distinct().collect()) == [("k5", "modes[0]", "", "modes", 0), ("k6", "modes[0]", "", "modes", 0), ("k6", "modes[0].hits[1]", "modes[0]", "hits", 1)]
    assert nested.nested_objects(df.limit(0), "t", F.col("key"), F.col("text"), False, NAMES).count() == 0


def test_very_long_text():
    many = json.dumps({"hits": [{"n": i, "s": "x" * 50} for i in range(60_000)]}).encode()
    found = listed_columns(nested.extract([many, b'{"hits":[{}]}'], False, NAMES)[0])
    assert len(found.path) == 60_001 and found.path[59_999] == "hits[59999]"


def test_last_of_repeated_names_counts():
    found = listed_columns(nested.extract([b'{"a":[{"x":1}],"a":[0,{"y":[{}]}]}'], False, NAMES)[0])
    assert sorted(found.path) == ["a[1]", "a[1].y[0]"]


def test_flat_table(spark):
    df = spark.createDataFrame([("k", '{"hits":[{"chunk_uid":"c","score":0.5},{"score":null}]}')], "key string, text string")
    objects = nested.nested_objects(df, "t", F.col("key"), F.col("text"), False, NAMES, kind="hits", wanted=("chunk_uid", "score"))
    assert [(r.chunk_uid, r.score) for r in nested.flat_table(objects, ("chunk_uid", "score")).orderBy("position").collect()] == [("c", "0.5"), (None, None)]


def leaves_of(v, path, listed, out):
    """Brute force: the paths and types of all values that are no object and no array with elements."""
    if isinstance(v, str) and v.strip(" \t\r\n")[:1] in ("{", "["):
        try:
            v = json.loads(v, parse_constant=lambda c: 1 / 0)
        except (ValueError, ZeroDivisionError):
            pass
    if isinstance(v, dict):
        path = path + "[0]" if listed else path
        for k, x in v.items():
            leaves_of(x, f"{path}.{k}" if path else k, k in NAMES, out)
    elif isinstance(v, list) and v:
        for i, x in enumerate(v):
            leaves_of(x, f"{path}[{i}]", False, out)
    else:
        out.append((path, "array" if v == [] else "null" if v is None else "boolean" if isinstance(v, bool) else "string" if isinstance(v, str) else "number"))


@settings(max_examples=200, deadline=None)
@given(st.lists(values, max_size=5), st.booleans())
def test_no_value_is_lost_and_every_parent_is_there(cases, listed):
    found, members = map(listed_columns, nested.extract([json.dumps(v).encode() for v in cases], listed, NAMES, True))
    for i in range(len(cases)):
        ids = [(p, o) for r, p, o in zip(found.row, found.pointer, found.parent_pointer, strict=True) if r == i]
        assert len({p for p, _ in ids}) == len(ids) and {o for _, o in ids} - {None} <= {p for p, _ in ids}
    for i, v in enumerate(cases):
        nodes = [(p, o) for r, p, o in zip(found.row, found.path, found.parent_path, strict=True) if r == i]
        assert nodes.count(("", None)) == 1 and {o for _, o in nodes} - {None} <= {p for p, _ in nodes}
        mine = [(o, n, t) for r, o, n, t in zip(members.row, members.path, members.name, members.type, strict=True) if r == i]
        assert {o for o, _, _ in mine} <= {p for p, _ in nodes}
        want = []
        leaves_of(v, "", listed, want)
        assert sorted((o + n if not o or n[:1] == "[" else f"{o}.{n}", t) for o, n, t in mine) == sorted(want), v


def test_roots_and_plain_members(spark):
    text = '{"status":"ok","fls_resolution":{"mode":"staged","stages":[{"stage":"a"}]},"publishability":{"ok":false,"reasons":["x",null]},"n":"\\u00e9\\\\","e":[]}'
    df = spark.createDataFrame([("k", text), ("bad", "{")], "key string, text string")
    nodes = nested.record_objects(df, "t", F.col("key"), F.col("text"), False, NAMES)
    assert sorted((r.node_path, "-" if r.parent_path is None else r.parent_path, r.kind, r.position) for r in nodes.collect()) == [("", "-", "record", None), ("fls_resolution", "", "fls_resolution", None), ("fls_resolution.stages[0]", "fls_resolution", "stages", 0), ("publishability", "", "publishability", None)]
    rows = nested.record_members(df, "t", F.col("key"), F.col("text"), False, NAMES).collect()
    assert sorted((r.node_path, r.name, str(r.value), r.value_type) for r in rows) == sorted([("", "status", "ok", "string"), ("fls_resolution", "mode", "staged", "string"), ("fls_resolution.stages[0]", "stage", "a", "string"), ("publishability", "ok", "false", "boolean"), ("publishability", "reasons[0]", "x", "string"), ("publishability", "reasons[1]", "None", "null"), ("", "n", "é\\", "string"), ("", "e", "[]", "array")])
    one = nested.record_objects(df, "t", F.col("key"), F.col("text"), False, NAMES, kind="fls_resolution", wanted=("mode",))
    assert [r.mode for r in nested.flat_table(one, ("mode",)).collect()] == ["staged"]


def test_paths_that_look_alike_have_ids_of_their_own(spark):
    df = spark.createDataFrame([("k", '{"a.b":[{"x":1}],"a":{"b":[{"x":2}]},"c/d":{"~":[{}]},"modes":{"0":{}}}')], "key string, text string")
    rows = nested.record_objects(df, "t", F.col("key"), F.col("text"), False, NAMES).collect()
    assert sorted((r.node_id, r.parent_id, r.node_path) for r in rows if r.node_id) == [("/a", "", "a"), ("/a.b/0", "", "a.b[0]"), ("/a/b/0", "/a", "a.b[0]"), ("/c~1d", "", "c/d"), ("/c~1d/~0/0", "/c~1d", "c/d.~[0]"), ("/modes/0", "", "modes[0]"), ("/modes/0/0", "/modes/0", "modes[0].0")]


def test_the_last_delivery_counts(spark):
    old, new = datetime(2024, 1, 1), datetime(2024, 2, 1)
    rows = [("k", '{"hits":[{"score":1}]}', new), ("k", '{"hits":[{"score":9},{"score":8}]}', old), ("n", '{"hits":[{"score":3}]}', None), ("n", '{"hits":[{"score":[4, 5]}]}', None)]
    df = spark.createDataFrame(rows, "key string, text string, at timestamp_ntz")
    got = nested.flat_table(nested.nested_objects(df, "t", F.col("key"), F.col("text"), False, NAMES, kind="hits", wanted=("score",), order=F.col("at")), ("score",)).collect()
    assert sorted((r.row_key, r.node_path, r.score) for r in got) == [("k", "hits[0]", "1"), ("k", "hits[1]", "8"), ("n", "hits[0]", "[4,5]")]


def test_deep_nesting_is_linear():
    deep = b'{"a":[' * 300 + b"1" + b"]}" * 300
    nodes, members = nested.extract([deep, b'{"hits":[{}]}'], False, NAMES, True, wanted=("mode",))
    assert len(nodes["path"]) == 300 + 2 and sum(c.nbytes for n, c in nodes.items() if "path" not in n and "pointer" not in n) < 50_000 and members["name"].to_pylist() == ["a[0]"]
