"""Flat tables from nested JSON (problem 1), by vectorised structural indexing.

A batch of texts is one byte buffer. Bitmaps of quotes, brackets and delimiters, prefix sums for what lies inside strings and
for depth, and one sort by depth give every value's span, its parent and its position, without walking any text.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.functions.cleaning import strip
from quarryline.plans.stages import table

#: Bytes of text that are indexed at once; one longer text is a batch by itself.
BATCH_BYTES = 4_000_000

_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\r\n")] = True
_STRUCT = np.zeros(256, bool)
_STRUCT[list(b"{}[],:")] = True
_SCALAR_TEXT = r"^(?:true|false|null|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)$"
_OBJECT, _ARRAY, _STRING, _SCALAR = 0, 1, 2, 3
#: Classes of tokens: what opens, closes or parts values, and values.
_CLASS = np.zeros(256, np.int8)
for _i, _b in enumerate(b"{}[],:"):
    _CLASS[_b] = _i
#: The kind of the node that stands for a whole text.
RECORD = "record"
_T_OPEN_O, _T_CLOSE_O, _T_OPEN_A, _T_CLOSE_A, _T_COMMA, _T_COLON, _T_STRING, _T_SCALAR = range(8)


@dataclass
class Index:
    """The values of a batch of texts, in order of text and place.

    doc: the text's number; kind: object, array, string or scalar; start, stop: the span in buffer; parent: the number of the value that
    holds this one, or -1; name: for a member, its name's span in name_start, name_stop, else -1; position: zero-based, for an
    element. level: how many values hold this one. valid: for each text, whether it is JSON.
    """

    buffer: np.ndarray
    doc: np.ndarray
    kind: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    parent: np.ndarray
    name_start: np.ndarray
    name_stop: np.ndarray
    position: np.ndarray
    level: np.ndarray
    valid: np.ndarray


def _per_doc(total: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A running total made to begin at 0 in each text; total is inclusive."""
    return total - np.repeat(np.concatenate([[0], total])[starts], lengths)


def spans(buffer: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.BinaryArray:
    """The bytes of every span, by one gather."""
    sizes = stop - start
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    at = np.arange(ends[-1]) + np.repeat(start - ends[:-1], sizes)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(buffer[at]))])


def index_texts(texts: Sequence[bytes]) -> Index:
    """The structural index of UTF-8 texts; texts that are no JSON (RFC 8259) have valid False and no values."""
    lengths = np.array([len(t) for t in texts], np.int64)
    b = np.frombuffer(b"".join(texts), np.uint8)
    n = len(b)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(texts) else np.zeros(0, np.int64)
    valid = lengths > 0
    docs = np.repeat(np.arange(len(texts)), lengths)
    at = np.arange(n)
    # escapes: a byte is escaped if an odd number of backslashes runs up to it
    slash = b == 92
    last_other = np.maximum.accumulate(np.where(~slash, at, np.repeat(starts, lengths) - 1)) if n else at
    run = np.where(slash, at - np.maximum(last_other, np.repeat(starts, lengths) - 1), 0)
    escaped = np.zeros(n, bool)
    escaped[1:] = (run[:-1] & 1 == 1) & (docs[1:] == docs[:-1])
    quote = (b == 34) & ~escaped
    inside = _per_doc(np.cumsum(quote), starts, lengths) & 1 == 1  # from an opening quote up to before the closing one
    body = inside & ~quote
    outside = ~inside & ~quote
    bad = np.zeros(len(texts), bool)
    np.logical_or.at(bad, docs[body & (b < 32)], True)
    np.logical_or.at(bad, docs[slash & outside], True)
    bad |= np.bincount(docs[quote], minlength=len(texts)) % 2 == 1
    _bad_escapes(b, escaped & body, docs, bad)
    # tokens: structural bytes, opening quotes, first bytes of scalars
    struct = outside & _STRUCT[b]
    plain = outside & ~struct & ~_SPACE[b]
    first = plain.copy()
    first[1:] &= ~(plain[:-1] & (docs[1:] == docs[:-1]))
    opening = quote & inside
    token = np.flatnonzero(struct | opening | first)
    tdoc = docs[token]
    tclass = np.where(struct[token], _CLASS[b[token]], np.where(opening[token], _T_STRING, _T_SCALAR)).astype(np.int8)
    # spans of strings and scalars
    stop = token + 1
    is_string, is_scalar = tclass == _T_STRING, tclass == _T_SCALAR
    closing = np.flatnonzero(quote & ~inside)
    if is_string.any():
        j = np.searchsorted(closing, token[is_string])
        stop[is_string] = np.where(j < len(closing), closing[np.minimum(j, max(len(closing) - 1, 0))] + 1, n) if len(closing) else n
    if is_scalar.any():
        ends = np.flatnonzero(plain & ~np.concatenate([plain[1:] & (docs[1:] == docs[:-1]), [False]])) + 1
        stop[is_scalar] = ends
        fine = pc.match_substring_regex(spans(b, token[is_scalar], ends), _SCALAR_TEXT).to_numpy(zero_copy_only=False)
        np.logical_or.at(bad, tdoc[is_scalar][~fine], True)
    # depth by prefix sums; brackets of one depth and text come in turns
    step = np.isin(tclass, (_T_OPEN_O, _T_OPEN_A)).astype(np.int64) - np.isin(tclass, (_T_CLOSE_O, _T_CLOSE_A)).astype(np.int64)
    tcount = np.bincount(tdoc, minlength=len(texts)) if len(tdoc) else np.zeros(len(texts), np.int64)
    tstart = np.concatenate([[0], np.cumsum(tcount)[:-1]]).astype(np.int64) if len(texts) else np.zeros(0, np.int64)
    depth = _per_doc(np.cumsum(step), tstart, tcount) if len(token) else np.zeros(0, np.int64)
    np.logical_or.at(bad, tdoc[depth < 0], True)
    has = tcount > 0
    bad |= ~has
    if len(token):
        bad[has] |= depth[(tstart + tcount - 1)[has]] != 0
    keep = ~bad[tdoc]
    token, tdoc, tclass, stop, depth, step = (a[keep] for a in (token, tdoc, tclass, stop, depth, step))
    level = np.where(step == 1, depth - 1, np.where(step == -1, depth, depth))  # the depth of what holds the token
    m = len(token)
    parent = np.full(m, -1, np.int64)
    if m:
        bracket = np.flatnonzero(step != 0)
        order = bracket[np.lexsort((bracket, level[bracket], tdoc[bracket]))]
        opens, closes = order[0::2], order[1::2]
        wrong = (step[opens] != 1) | (step[closes] != -1) | (tclass[closes] != tclass[opens] + 1)
        np.logical_or.at(bad, tdoc[opens[wrong]], True)
        stop[opens] = token[closes] + 1
        # the holder: the last opening of one level less, before; sorted by (text, level), it is the nearest to the left
        place = np.lexsort((np.arange(m), np.where(step == 1, level + 1, level), tdoc))
        is_open = step[place] == 1
        last = np.maximum.accumulate(np.where(is_open, np.arange(m), -1))
        group_ok = last >= 0
        holder = np.where(group_ok, place[np.maximum(last, 0)], -1)
        inner = np.where(step == 1, level + 1, level)
        inner_of = np.full(m, -1, np.int64)
        inner_of[place] = holder  # for an opening: itself; else: what holds it
        same = (inner_of >= 0) & (tdoc[np.maximum(inner_of, 0)] == tdoc) & (inner[np.maximum(inner_of, 0)] == inner)
        parent = np.where(same & (step != 1), inner_of, -1)
        # an opening's own holder: the holder of the token of its level that comes last before it, found among openings of that level
        o = np.flatnonzero(step == 1)
        key = np.concatenate([np.stack([tdoc[o], level[o] + 1, o]), np.stack([tdoc[o], level[o], o])], axis=1)
        asks = np.concatenate([np.zeros(len(o), bool), np.ones(len(o), bool)])
        who = np.concatenate([o, o])
        place2 = np.lexsort((asks, key[2], key[1], key[0]))
        seen = np.maximum.accumulate(np.where(~asks[place2], np.arange(len(place2)), -1))
        answer = who[place2[np.maximum(seen, 0)]]
        asking = asks[place2]
        mine = who[place2][asking]
        held = answer[asking]
        fits = (seen[asking] >= 0) & (tdoc[held] == tdoc[mine]) & (level[held] + 1 == level[mine]) & (held < mine)
        parent[mine] = np.where(fits, held, -1)
        _grammar(tclass, tdoc, parent, bad)
    valid &= ~bad
    value = (tclass == _T_OPEN_O) | (tclass == _T_OPEN_A) | (tclass == _T_STRING) | (tclass == _T_SCALAR)
    name = np.zeros(m, bool)
    if m:
        follows = np.concatenate([tclass[1:] == _T_COLON, [False]]) & np.concatenate([tdoc[1:] == tdoc[:-1], [False]])
        name = (tclass == _T_STRING) & follows
    pick = np.flatnonzero(value & ~name & valid[tdoc]) if m else np.zeros(0, np.int64)
    number = np.full(m + 1, -1, np.int64)
    number[pick] = np.arange(len(pick))
    up = number[parent[pick]]
    member = np.zeros(len(pick), bool)
    if len(pick):
        member = (pick >= 2) & (tclass[np.maximum(pick - 1, 0)] == _T_COLON) & (up >= 0)
    name_token = np.where(member, pick - 2, 0)
    kind = np.select([tclass[pick] == _T_OPEN_O, tclass[pick] == _T_OPEN_A, tclass[pick] == _T_STRING], [_OBJECT, _ARRAY, _STRING], _SCALAR)
    # position: how many elements of the same holder come before
    position = np.full(len(pick), -1, np.int64)
    element = (up >= 0) & ~member
    if element.any():
        e = np.flatnonzero(element)
        e = e[np.argsort(up[e], kind="stable")]
        new = np.concatenate([[True], up[e][1:] != up[e][:-1]])
        begin = np.maximum.accumulate(np.where(new, np.arange(len(e)), 0))
        position[e] = np.arange(len(e)) - begin
    start = token[pick]
    blank = np.full(len(pick), -1, np.int64)
    has_name = member
    return Index(b, tdoc[pick], kind, start, stop[pick], up, np.where(has_name, token[name_token] if m else blank, -1), np.where(has_name, stop[name_token] if m else blank, -1), position, level[pick], valid)


def _bad_escapes(b: np.ndarray, escaped: np.ndarray, docs: np.ndarray, bad: np.ndarray) -> None:
    """Marks texts with an escape that JSON doesn't have."""
    e = np.flatnonzero(escaped)
    if not len(e):
        return
    known = np.isin(b[e], list(b'"\\/bfnrtu'))
    np.logical_or.at(bad, docs[e[~known]], True)
    u = e[b[e] == 117]
    hexa = np.zeros(256, bool)
    hexa[list(b"0123456789abcdefABCDEF")] = True
    for k in range(1, 5):
        w = np.minimum(u + k, len(b) - 1)
        np.logical_or.at(bad, docs[u[~((u + k < len(b)) & (docs[w] == docs[u]) & hexa[b[w]])]], True)


def _grammar(tclass: np.ndarray, tdoc: np.ndarray, parent: np.ndarray, bad: np.ndarray) -> None:
    """Marks texts in which a token may not follow the one before it."""
    m = len(tclass)
    first = np.concatenate([[True], tdoc[1:] != tdoc[:-1]])
    before = np.concatenate([[-1], tclass[:-1]])
    before[first] = -1
    holder = np.where(parent >= 0, tclass[np.maximum(parent, 0)], -1)
    in_object = holder == _T_OPEN_O
    value_start = np.isin(tclass, (_T_OPEN_O, _T_OPEN_A, _T_STRING, _T_SCALAR))
    value_end = np.isin(before, (_T_CLOSE_O, _T_CLOSE_A, _T_STRING, _T_SCALAR))
    wants_name = in_object & np.isin(before, (_T_OPEN_O, _T_COMMA))
    next_colon = np.concatenate([(tclass[1:] == _T_COLON) & ~first[1:], [False]])
    ok = np.zeros(m, bool)
    # a value: alone, after a colon, or first or after a comma in an array; a name: first or after a comma in an object
    ok |= value_start & ((before == -1) | (before == _T_COLON) | (~in_object & np.isin(before, (_T_OPEN_A, _T_COMMA))))
    ok |= wants_name & (tclass == _T_STRING) & next_colon
    two_before = np.concatenate([[-1, -1], tclass[:-2]])[:m]
    name_before = (before == _T_STRING) & np.isin(two_before, (_T_OPEN_O, _T_COMMA)) & in_object
    ok |= (tclass == _T_COLON) & name_before
    ok |= (tclass == _T_COMMA) & value_end & (parent >= 0)
    ok |= (tclass == _T_CLOSE_O) & (value_end | (before == _T_OPEN_O))
    ok |= (tclass == _T_CLOSE_A) & (value_end | (before == _T_OPEN_A))
    np.logical_or.at(bad, tdoc[~ok], True)
    # only one value on the outside
    top = np.bincount(tdoc[value_start & (parent < 0)], minlength=len(bad))
    bad |= top > 1


@dataclass(frozen=True)
class Field:
    """A JSON column: its table, the columns of its rows' keys, whether its whole value stands for an array, and what tells the last delivery."""

    source: str
    keys: tuple[str, ...]
    column: str
    listed: bool = False
    delivered: str | None = None


def _decoded(raw: pa.Array) -> pa.Array:
    """What strings in quotes say; half a surrogate pair becomes a question mark. Only those with a backslash are looked at one by one."""
    inner = pc.binary_slice(raw, 1, -1)
    escaped = np.flatnonzero(pc.find_substring(inner, b"\\").to_numpy(zero_copy_only=False) >= 0)
    plain = pc.cast(inner, pa.large_string(), safe=False)
    if not len(escaped):
        return plain
    said = [json.loads(x).encode("utf-8", "replace").decode() for x in raw.take(pa.array(escaped)).to_pylist()]
    mask = np.zeros(len(raw), bool)
    mask[escaped] = True
    return pc.replace_with_mask(plain, pa.array(mask), pa.array(said, pa.large_string()))


def _glue(*parts) -> pa.Array:
    return pc.binary_join_element_wise(*[pc.cast(x, pa.large_string()) if isinstance(x, pa.Array) else pa.scalar(x, pa.large_string()) for x in (*parts, "")])


def _no(size: int) -> pa.Array:
    return pa.array([""] * size, pa.large_string())


def _some(texts: pa.Array, at: np.ndarray) -> pa.Array:
    return texts.take(pa.array(at))


@dataclass
class _Texts:
    """What a round of texts stands for: rows of the batch, and the places of the strings that held them (for the first round, of whole records)."""

    texts: list[bytes]
    row: np.ndarray
    path: pa.Array
    pointer: pa.Array
    owner: pa.Array
    owner_pointer: pa.Array
    rel: pa.Array
    label: pa.Array
    listed: np.ndarray
    place: np.ndarray
    top: np.ndarray


#: Columns of the objects and of the values without objects in them.
NODE_PARTS = ("row", "path", "pointer", "parent_path", "parent_pointer", "kind", "position")
MEMBER_PARTS = ("row", "path", "name", "value", "type")


class _Found:
    """Columns of what a round gives, gathered over the rounds."""

    def __init__(self, names: Sequence[str]) -> None:
        self.names, self.lots = names, []

    def add(self, *columns) -> None:
        self.lots.append([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns])

    def table(self) -> dict[str, pa.Array]:
        types = {"row": pa.int64(), "position": pa.int64()}
        out = {}
        for i, n in enumerate(self.names):
            parts = [pc.cast(lot[i], types.get(n, pa.large_string())) for lot in self.lots]
            out[n] = pa.concat_arrays(parts) if parts else pa.array([], types.get(n, pa.large_string()))
        return out


class _Round:
    """One round of texts: their index, and by levels, from the outside in, each value's owner, label and place."""

    def __init__(self, t: _Texts, array_names: frozenset[str], whole: bool) -> None:
        self.t, self.whole = t, whole
        self.ix = ix = index_texts(t.texts)
        n = len(ix.doc)
        root = ix.parent < 0
        up = np.maximum(ix.parent, 0)
        named = np.flatnonzero(ix.name_start >= 0)
        coded = spans(ix.buffer, ix.name_start[named], ix.name_stop[named]).dictionary_encode()
        self.names = _decoded(coded.dictionary)
        again = self.names.dictionary_encode()  # names that are spelled apart may say the same
        self.names = again.dictionary
        self.name = np.full(n, -1)
        self.name[named] = again.indices.to_numpy()[coded.indices.to_numpy()] if len(named) else 0
        # of members with one name the last counts; what the others hold is dropped with them
        self.dropped = np.zeros(n, bool)
        order = named[np.lexsort((named, self.name[named], ix.parent[named]))]
        same = (ix.parent[order[1:]] == ix.parent[order[:-1]]) & (self.name[order[1:]] == self.name[order[:-1]])
        self.dropped[order[:-1][same]] = True
        self.levels = np.split(np.argsort(ix.level, kind="stable"), np.cumsum(np.bincount(ix.level))[:-1]) if n else []
        like = np.isin(np.arange(len(self.names)), [i for i, x in enumerate(self.names.to_pylist()) if x in array_names])
        self.listed = np.where(root, t.listed[ix.doc] if n else False, (self.name >= 0) & like[np.maximum(self.name, 0)] if len(like) else False).astype(bool)
        self.wrapped = (ix.kind == _OBJECT) & self.listed
        self.place = np.where(root, t.place[ix.doc] if n else -1, ix.position)
        self.place[self.wrapped] = 0
        # owners are values, or, as -1 - text, what held the text; labels are names, or -1 - text
        self.owner, self.label = np.full(n, 0), np.full(n, 0)
        for at in self.levels:
            self.dropped[at] |= self.dropped[up[at]] & ~root[at]
            outer = -1 - ix.doc[at]
            self.owner[at] = np.where(root[at], outer, np.where(ix.kind[up[at]] == _OBJECT, up[at], self.owner[up[at]]))
            self.label[at] = np.where(root[at], outer, np.where(self.name[at] >= 0, self.name[at], self.label[up[at]]))
        self.kept = ~self.dropped
        self._strings()
        self._paths(root, up)

    def _strings(self) -> None:
        """Which strings may hold JSON of an object or array; these are read and make the next round."""
        ix = self.ix
        strings = np.flatnonzero((ix.kind == _STRING) & self.kept)
        raw = spans(ix.buffer, ix.start[strings], ix.stop[strings])
        maybe = pc.match_substring_regex(raw, r'^"[ \t\r\n]*[{\[\\]').to_numpy(zero_copy_only=False)
        said = [json.loads(x).encode("utf-8", "surrogatepass") for x in raw.filter(pa.array(maybe)).to_pylist()]
        opens = np.array([x.lstrip(b" \t\r\n")[:1] in (b"{", b"[") for x in said], bool)
        self.inner = strings[maybe][opens]
        self.inner_texts = [x for x, o in zip(said, opens, strict=True) if o]

    def _paths(self, root: np.ndarray, up: np.ndarray) -> None:
        """Paths and pointers (RFC 6901) of what needs one, and ways from the owner, level by level: a value's are those of what holds it and a step more."""
        ix, t = self.ix, self.t
        n = len(ix.doc)
        need = (ix.kind <= _ARRAY) & self.kept
        need[self.inner] = True
        if self.whole:
            need = self.kept
        nth = np.full(n, -1)  # where a value stands among those of its level
        self.rows, texts = nth.copy(), {"path": [], "pointer": [], "rel": []}
        escaped = pc.replace_substring(pc.replace_substring(self.names, "~", "~0"), "/", "~1")
        count = 0
        before: dict[str, pa.Array] = {}
        for at in self.levels:
            at = at[need[at]]
            if not len(at):
                continue
            nth[at] = np.arange(len(at))
            self.rows[at] = count + nth[at]
            count += len(at)
            if root[at[0]]:
                now = {c: _some(getattr(t, c), ix.doc[at]) for c in texts}
            else:
                above = {c: _some(v, nth[up[at]]) for c, v in before.items()}
                member = pa.array(self.name[at] >= 0)
                place = pc.cast(pa.array(ix.position[at]), pa.large_string())
                name = _some(self.names, np.maximum(self.name[at], 0)) if len(self.names) else _no(len(at))
                step = _some(escaped, np.maximum(self.name[at], 0)) if len(self.names) else name
                path = pc.if_else(member, pc.if_else(pc.equal(above["path"], ""), name, _glue(above["path"], ".", name)), _glue(above["path"], "[", place, "]"))
                pointer = _glue(above["pointer"], "/", pc.if_else(member, step, place))
                now = {"path": path, "pointer": pointer, "rel": pc.if_else(member, name, _glue(above["rel"], "[", place, "]"))}
            wrapped = pa.array(self.wrapped[at])
            now["path"] = pc.if_else(wrapped, _glue(now["path"], "[0]"), now["path"])
            now["pointer"] = pc.if_else(wrapped, _glue(now["pointer"], "/0"), now["pointer"])
            for c, v in now.items():
                texts[c].append(v)
            before = now
        self.texts = {c: pa.concat_arrays(v) if v else _no(0) for c, v in texts.items()}

    def of(self, column: str, at: np.ndarray) -> pa.Array:
        return _some(self.texts[column], self.rows[at])

    def owners(self, column: str, at: np.ndarray) -> pa.Array:
        """The path or pointer of the objects that hold these values."""
        o = self.owner[at]
        both = pa.concat_arrays([self.texts[column], pc.cast(getattr(self.t, {"path": "owner", "pointer": "owner_pointer"}[column]), pa.large_string())])
        return _some(both, np.where(o >= 0, self.rows[np.maximum(o, 0)] if len(self.rows) else 0, len(self.texts[column]) - 1 - o))

    def labels(self, at: np.ndarray) -> pa.Array:
        both = pa.concat_arrays([pc.cast(self.names, pa.large_string()), self.t.label])
        return _some(both, np.where(self.label[at] >= 0, self.label[at], len(self.names) - 1 - self.label[at]))

    def further(self) -> _Texts:
        """The texts in strings, as the next round."""
        at, ix = self.inner, self.ix
        top = self.t.top[ix.doc[at]] & (ix.parent[at] < 0)
        return _Texts(self.inner_texts, self.t.row[ix.doc[at]], self.of("path", at), self.of("pointer", at), self.owners("path", at), self.owners("pointer", at), self.of("rel", at), self.labels(at), self.listed[at], self.place[at], top)


def extract(texts: Sequence[bytes], listed: bool, array_names: frozenset[str], whole: bool = False, kind: str | None = None, wanted: Sequence[str] = ()) -> tuple[dict[str, pa.Array], dict[str, pa.Array]]:
    """Objects (NODE_PARTS, and of each wanted name its member's JSON as it stands) and values without objects in them (MEMBER_PARTS), as columns.

    Without ``whole``: every object that is an element of an array; with it: every object, and first a node of kind RECORD and path '' for each
    valid text, whatever its value (the kind of a plain member is its name, its position null), and every string, number, boolean, null and empty array
    with the path of the object or record that holds it and its way from there. Texts of JSON inside strings are indexed in turn, as a further batch, with the paths of the
    strings that held them. Of members with the same name the last counts. With ``kind`` only objects of that kind are given. A pointer (RFC 6901) names one object only,
    also where two paths look alike.
    """
    nodes, members = _Found((*NODE_PARTS, *wanted)), _Found(MEMBER_PARTS)
    n = len(texts)
    t = _Texts(list(texts), np.arange(n), _no(n), _no(n), _no(n), _no(n), _no(n), _no(n), np.full(n, listed), np.full(n, -1), np.ones(n, bool))
    first = True
    while t.texts:
        r = _Round(t, array_names, whole)
        ix = r.ix
        if whole and not first:
            _broken(r, nodes, members, kind, wanted)
        first = False
        root = (ix.parent < 0) & (t.top[ix.doc] if len(ix.doc) else False)
        if whole and kind in (None, RECORD):
            records = np.flatnonzero(root & r.kept)
            records = records[~np.isin(records, r.inner)]
            if len(records):
                gone = pa.nulls(len(records), pa.large_string())
                nodes.add(t.row[ix.doc[records]], _no(len(records)), _no(len(records)), gone, gone, pa.array([RECORD] * len(records), pa.large_string()), pa.nulls(len(records), pa.int64()), *_wanted(r, records, wanted))
        objects = np.flatnonzero((ix.kind == _OBJECT) & r.kept & ((r.place >= 0) | (whole & ~root)))
        if kind is not None and len(objects):
            objects = objects[pc.equal(r.labels(objects), kind).to_numpy(zero_copy_only=False)]
        if len(objects):
            place = r.place[objects]
            nodes.add(t.row[ix.doc[objects]], r.of("path", objects), r.of("pointer", objects), r.owners("path", objects), r.owners("pointer", objects), r.labels(objects), pa.array(place, mask=place < 0), *_wanted(r, objects, wanted))
        if whole and kind is None:
            _values(r, members)
        t = r.further()
    return nodes.table(), members.table()


def _wanted(r: _Round, owners: np.ndarray, wanted: Sequence[str]) -> list[pa.Array]:
    """For each name, the JSON of these objects' members of that name, null where there is none. What is inside an inner text belongs to its round."""
    out = []
    known = r.names.to_pylist()
    for name in wanted:
        column = pa.nulls(len(owners), pa.large_string())
        if name in known and len(owners):
            mine = np.flatnonzero((r.name == known.index(name)) & r.kept)
            held_by = np.full(len(r.ix.doc), -1)
            held_by[r.ix.parent[mine]] = mine
            at = held_by[owners]
            has = at >= 0
            column = pc.replace_with_mask(column, pa.array(has), pc.cast(spans(r.ix.buffer, r.ix.start[at[has]], r.ix.stop[at[has]]), pa.large_string(), safe=False))
        out.append(column)
    return out


def _values(r: _Round, members: _Found) -> None:
    ix = r.ix
    held = np.bincount(ix.parent[ix.parent >= 0], minlength=len(ix.doc)) if len(ix.doc) else np.zeros(0, int)
    leaf = r.kept & ((ix.kind >= _STRING) | ((ix.kind == _ARRAY) & (held == 0)))
    leaf[r.inner] = False
    at = np.flatnonzero(leaf)
    if not len(at):
        return
    raw = spans(ix.buffer, ix.start[at], ix.stop[at])
    is_string, is_array = ix.kind[at] == _STRING, ix.kind[at] == _ARRAY
    head = ix.buffer[ix.start[at]]
    is_null, is_bool = (head == 110) & ~is_string, ((head == 116) | (head == 102)) & ~is_string
    value = pc.cast(pc.if_else(pa.array(is_array), pa.scalar(b"[]", pa.large_binary()), raw), pa.large_string(), safe=False)
    value = pc.replace_with_mask(value, pa.array(is_string), _decoded(raw.filter(pa.array(is_string))))
    value = pc.if_else(pa.array(is_null), pa.scalar(None, pa.large_string()), value)
    kinds = pa.array(np.array(["number", "string", "array", "null", "boolean"])[np.select([is_string, is_array, is_null, is_bool], [1, 2, 3, 4], 0)].tolist(), pa.large_string())
    members.add(r.t.row[ix.doc[at]], r.owners("path", at), r.of("rel", at), value, kinds)


def _broken(r: _Round, nodes: _Found, members: _Found, kind: str | None, wanted: Sequence[str]) -> None:
    """A string that only begins like JSON is a string: a value, and a record if it is all there is."""
    t, d = r.t, np.flatnonzero(~r.ix.valid)
    if not len(d):
        return
    value = pa.array([t.texts[i].decode("utf-8", "replace") for i in d.tolist()], pa.large_string())
    if kind is None:
        members.add(t.row[d], _some(t.owner, d), _some(t.rel, d), value, pa.array(["string"] * len(d), pa.large_string()))
    d = d[t.top[d]]
    if kind in (None, RECORD) and len(d):
        gone = pa.nulls(len(d), pa.large_string())
        nodes.add(t.row[d], _no(len(d)), _no(len(d)), gone, gone, pa.array([RECORD] * len(d), pa.large_string()), pa.nulls(len(d), pa.int64()), *[gone] * len(wanted))


NODE_COLUMNS = {"row_key": "string", "node_path": "string", "node_id": "string", "parent_path": "string", "parent_id": "string", "kind": "string", "position": "int"}
MEMBER_COLUMNS = {"row_key": "string", "node_path": "string", "name": "string", "value": "string", "value_type": "string"}


def nested_objects(df: DataFrame, source: str, row_key: Column, text: Column, listed: bool, array_names: frozenset[str], whole: bool = False, kind: str | None = None, wanted: Sequence[str] = (), order: Column | None = None) -> DataFrame:
    """(source_table, row_key, node_path, node_id, parent_path, parent_id, kind, position, wanted...): one row an object in an array or, with ``whole``, every object and record.

    parent_path and parent_id are those of the object that holds the array ('' for the record itself), kind the array's name ('' for
    the whole value). With ``whole`` every parent is a row with the same row_key: the record has path '', kind RECORD and no parent, a plain member no position. Ids are pointers and unique
    within a text; paths may look alike where names hold dots or brackets. Null, blank and broken texts give no rows; repeated rows give repeated objects. order: a column that goes along as ``delivered``.
    """
    columns = NODE_COLUMNS | dict.fromkeys((f"json_{c}" for c in wanted), "string")
    return _mapped(df, source, row_key, text, columns, lambda texts: extract(texts, listed, array_names, whole, kind, wanted)[0], order)


def record_objects(df: DataFrame, source: str, row_key: Column, text: Column, listed: bool, array_names: frozenset[str], **more) -> DataFrame:
    """nested_objects of every object and record."""
    return nested_objects(df, source, row_key, text, listed, array_names, True, **more)


def record_members(df: DataFrame, source: str, row_key: Column, text: Column, listed: bool, array_names: frozenset[str]) -> DataFrame:
    """(source_table, row_key, node_path, name, value, value_type): one row a string, number, boolean, null or empty array.

    node_path is that of the object (or record) that holds the value; name is the path from there, with places for elements ('reasons[0]').
    """
    return _mapped(df, source, row_key, text, MEMBER_COLUMNS, lambda texts: extract(texts, listed, array_names, True)[1])


def _mapped(df: DataFrame, source: str, row_key: Column, text: Column, columns: dict[str, str], find: Callable, order: Column | None = None) -> DataFrame:
    """What ``find`` gives for batches of texts, with the rows' keys and, if there is an order, what they are ordered by."""
    names, types = list(columns), [{"string": pa.string(), "int": pa.int32()}[t] for t in columns.values()]
    along = [] if order is None else [order.alias("delivered")]
    more = ["delivered"] * len(along)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            sizes = np.cumsum(pc.binary_length(texts).to_numpy())
            begin = 0
            while begin < len(texts):
                end = max(begin + 1, int(np.searchsorted(sizes, (sizes[begin - 1] if begin else 0) + BATCH_BYTES, side="right")))
                row, *found = find(texts.slice(begin, end - begin).to_pylist()).values()
                row = pc.add(row, begin)
                out = [c.cast(t) for c, t in zip([batch.column(0).take(row), *found], types, strict=True)]
                yield pa.RecordBatch.from_arrays([*out, *[batch.column(2).take(row) for _ in more]], names=[*names, *more])
                begin = end

    rows = df.select(row_key.alias("row_key"), text.alias("text"), *along).where("text IS NOT NULL AND row_key IS NOT NULL")
    schema = [f"{n} {t}" for n, t in columns.items()] + [f"delivered {rows.schema['delivered'].dataType.simpleString()}" for _ in along]
    return rows.mapInArrow(run, ", ".join(schema)).select(F.lit(source).alias("source_table"), "*")


#: Names that stand for arrays even where one object stands in their place.
ARRAY_NAMES = frozenset({"modes", "hits", "spans", "stages", "candidates", "components", "matches", "role_rows"})
FIELDS = (
    Field("guideline_fls_resolution_candidates", ("audit_run_id", "guideline_id", "candidate_rank", "paragraph_id"), "evidence_json"),
    Field("guideline_records", ("guideline_id",), "metadata_json", delivered="delivered_at"),
    Field("ws7_mapping_cleanup_tasks", ("run_id", "source_id"), "nearest_candidate_paragraphs_json", listed=True),
)
#: The kinds of nested objects of these fields and the scalars that each one's table shows.
KINDS = {
    "modes": ("mode", "rank"), "hits": ("chunk_uid", "score"), "spans": ("anchor", "start", "end"), "stages": ("stage", "accepted"), "candidates": ("paragraph_id", "total_score"),
    "components": ("name", "value"), "matches": ("text", "target"), "role_rows": ("text", "target"), "tags": ("name", "weight"), "": ("paragraph_id", "document_link", "overlap_count"),
}

#: The kinds that are no elements of arrays: the record itself and plain members.
MEMBER_KINDS = {
    RECORD: ("paragraph_id", "document_link", "section_link", "overlap_count", "text_excerpt", "status", "category", "release", "fls", "lineno", "docname", "decidability", "scope"),
    "fls_resolution": ("mode",), "publishability": ("ok",),
}


def _key(names: Sequence[str]) -> Column:
    return F.concat_ws("|", *[strip(F.col(c).cast("string")) for c in names])


def all_objects(spark, sf_dir: str, find: Callable = nested_objects, **more) -> DataFrame:
    parts = [find(table(spark, sf_dir, f.source, *f.keys, f.column), f.source, _key(f.keys), F.col(f.column), f.listed, ARRAY_NAMES, **more) for f in FIELDS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p1_found(spark, sf_dir: str) -> DataFrame:
    return all_objects(spark, sf_dir).select("source_table", "row_key", "node_path").distinct()


def p1_objects(spark, sf_dir: str) -> DataFrame:
    """Every object and record with the way to its parent."""
    return all_objects(spark, sf_dir, record_objects).select("source_table", "row_key", "node_path", "parent_path", "kind", "position").distinct()


def p1_nodes(spark, sf_dir: str) -> DataFrame:
    """The same linked by ids, which are pointers, so that no two objects of a text share one."""
    return all_objects(spark, sf_dir, record_objects).select("source_table", "row_key", "node_id", "parent_id", "node_path", "kind", "position").distinct()


def p1_members(spark, sf_dir: str) -> DataFrame:
    """Every value that is no object, beside the objects of p1_objects and the tables of kinds."""
    return all_objects(spark, sf_dir, record_members).distinct()


def flat_table(objects: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Objects of one kind, with the JSON of the wanted members and maybe ``delivered``, as a flat table: keys, the parent's path, the place, and the members as text, null where absent.

    Of several deliveries of one object the last counts, of those at one time, or without a time, the one with the greatest values.
    """
    last = (["delivered"] if "delivered" in objects.columns else []) + ["node_id", "parent_path", "position", *[f"json_{c}" for c in columns]]
    one = objects.groupBy("source_table", "row_key", "node_path").agg(F.max(F.struct(*last)).alias("x"))
    plain = lambda c: F.get_json_object(F.concat(F.lit('{"v":'), F.col(f"x.json_{c}"), F.lit("}")), "$.v")
    return one.select("source_table", "row_key", "node_path", "x.parent_path", "x.position", *[plain(c).alias(c) for c in columns])


def kind_table(spark, sf_dir: str, kind: str, columns: Sequence[str], whole: bool) -> DataFrame:
    parts = []
    for f in FIELDS:
        order = F.col(f.delivered) if f.delivered else F.lit(None).cast("timestamp_ntz")
        df = table(spark, sf_dir, f.source, *f.keys, f.column, *([f.delivered] if f.delivered else []))
        parts.append(nested_objects(df, f.source, _key(f.keys), F.col(f.column), f.listed, ARRAY_NAMES, whole, kind, columns, order))
    return flat_table(parts[0].unionByName(parts[1]).unionByName(parts[2]), columns)


def queries() -> dict:
    out = {"p1_found": p1_found, "p1_objects": p1_objects, "p1_nodes": p1_nodes, "p1_members": p1_members}
    for kind, columns in KINDS.items():
        out[f"p1_table_{kind or 'nearest'}"] = lambda s, d, k=kind, c=columns: kind_table(s, d, k, c, False)
    for kind, columns in MEMBER_KINDS.items():
        out[f"p1_table_{kind}"] = lambda s, d, k=kind, c=columns: kind_table(s, d, k, c, True)
    return out
