"""Several values packed in one text field -> one row per value, position kept.

The splitter never loops over rows: it scans the raw Arrow string buffer of a
batch, derives quote parity and delimiter masks for all bytes at once, turns the
surviving delimiters into child offsets and flattens the children with the
ordinal of their parent. Cost is linear in the bytes of the column and there is
no shuffle at all.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LF, CR, TAB, SP = 10, 13, 9, 32
# A field of contact values may mix these single-byte delimiters freely.
VALUE_DELIMITERS = b";,|/\n\r\t"
# A field of names uses exactly one of these; the strongest one present wins.
NAME_DELIMITERS = b"\n|;,"
PLACEHOLDERS = ("", "nan", "none", "null", "n/a", "[]", "{}")


def _mask(buf: np.ndarray, chars: bytes) -> np.ndarray:
    lut = np.zeros(256, bool)
    lut[list(chars)] = True
    return lut[buf]


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array with nulls as empty strings."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def _words(buf: np.ndarray, word: bytes) -> np.ndarray:
    """Positions where ` word ` stands between white space (also at the end of the text)."""
    n = len(buf)
    hit = np.ones(n, bool)
    for k, c in enumerate(word):
        hit[: n - k] &= buf[k:] == c
        if k:
            hit[n - k :] = False
    blank = _mask(buf, b" \t\n\r")
    before = np.zeros(n, bool)
    before[1:] = blank[:-1]
    after = np.ones(n, bool)
    if n > len(word):
        after[: n - len(word)] = blank[len(word) :]
    return hit & before & after


def split_buffer(buf: np.ndarray, offsets: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parent, start, stop) of every non-empty child of every row, in order.

    kind: `emails`, `phones` (contact values: every delimiter splits, no value
    holds one) or `names` (one delimiter a field, quoting protects it).
    """
    n, rows = len(buf), len(offsets) - 1
    empty = np.zeros(0, np.int64)
    if n == 0:
        return empty, empty, empty
    parent = np.repeat(np.arange(rows), np.diff(offsets))
    first = offsets[:-1][parent]

    if kind == "names":
        quote = buf == 34
        back = buf == 92
        escaped = np.zeros(n, bool)
        escaped[1:] = back[:-1]
        toggle = quote & ~escaped
        run = np.cumsum(toggle)
        base = np.concatenate([[0], run])[first]
        inside = ((run - base) & 1).astype(bool)
        # Apostrophes quote only inside a bracketed list, at the edge of an item.
        heads = np.zeros(rows, bool)
        filled = np.diff(offsets) > 0
        heads[filled] = buf[offsets[:-1][filled]] == 91
        stripped = heads[parent]
        apos = (buf == 39) & stripped & ~escaped
        if apos.any():
            at = np.arange(n)
            solid = buf != SP
            left = np.maximum.accumulate(np.where(solid, at, -1))
            left = np.concatenate([[-1], left[:-1]])
            right = np.minimum.accumulate(np.where(solid, at, n)[::-1])[::-1]
            right = np.concatenate([right[1:], [n]])
            l_ok = np.where(left >= 0, _mask(buf, b"[,")[np.maximum(left, 0)], True)
            r_ok = np.where(right < n, _mask(buf, b"],")[np.minimum(right, n - 1)], True)
            edge = np.cumsum(apos & ~inside & (l_ok | r_ok))
            base = np.concatenate([[0], edge])[first]
            inside |= ((edge - base) & 1).astype(bool)
        free = ~inside
        left_over = np.full(rows, -1)
        for c in reversed(NAME_DELIMITERS):
            has = np.bincount(parent, weights=(buf == c) & free, minlength=rows) > 0
            left_over[has] = c
        left_over[heads] = 44
        cut = free & (buf == left_over[parent].astype(np.int64))
        cut_len = np.ones(n, np.int64)
    else:
        cut = _mask(buf, VALUE_DELIMITERS)
        cut_len = np.ones(n, np.int64)
        words = [b"et", b"ou"] + ([b"-", "–".encode(), "—".encode()] if kind == "phones" else [])
        for word in words:
            hit = _words(buf, word)
            cut |= hit
            cut_len[hit] = len(word)
        if kind == "emails":
            cut |= buf == SP
            nbsp = np.zeros(n, bool)
            nbsp[:-1] = (buf[:-1] == 0xC2) & (buf[1:] == 0xA0)
            cut |= nbsp
            cut_len[nbsp] = 2

    at = np.flatnonzero(cut)
    starts = np.concatenate([offsets[:-1], at + cut_len[at]])
    owner = np.concatenate([np.arange(rows), parent[at]])
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    stops = np.empty_like(starts)
    ends = np.concatenate([at, offsets[1:]])
    stops[:] = ends[np.lexsort((ends, np.concatenate([parent[at], np.arange(rows)])))]

    # Trim white space, quotes and brackets from both ends until nothing moves.
    soft = _mask(buf, b" \t\r\n")
    hard = _mask(buf, b"\"'<>[]{}") if kind != "names" else np.zeros(n, bool)
    pad = lambda a: np.concatenate([a, [False]])
    soft, hard, big = pad(soft), pad(hard), np.concatenate([buf, [0]])
    while True:
        live = starts < stops
        last = np.maximum(stops - 1, 0)
        wide_l = live & (big[starts] == 0xC2) & (stops - starts > 1) & (big[np.minimum(starts + 1, n)] == 0xA0)
        wide_r = live & (stops - starts > 1) & (big[last] == 0xA0) & (big[np.maximum(stops - 2, 0)] == 0xC2) & ~wide_l
        step_l = live & (soft[starts] | hard[starts])
        step_r = live & ~step_l & (soft[last] | hard[last])
        if not (wide_l | wide_r | step_l | step_r).any():
            break
        starts = starts + step_l + 2 * wide_l
        stops = stops - step_r - 2 * wide_r
    keep = starts < stops
    return owner[keep], starts[keep], stops[keep]


def _unquote(text: str, lone: str) -> str:
    """Value of one name item: outer quotes off, escapes undone."""
    text = text.strip().strip(" ").strip()
    if len(text) >= 2 and text[0] == text[-1] and text[0] in "\"'":
        quote, inner = text[0], text[1:-1]
        if "\\" in inner:
            try:
                inner = json.loads('"' + inner.replace("\\'", "'").replace('"', '\\"').replace('\\\\"', '\\"') + '"')
            except ValueError:
                inner = inner.replace("\\" + quote, quote)
        elif quote == '"':
            inner = inner.replace('""', '"')
        text = inner.strip()
    return text


def _flatten(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(parent ordinal, position from 1, value) for one column of a batch."""
    buf, offsets = _buffer(column)
    if kind == "names":
        # Brackets of a list belong to the field, not to its items.
        texts = pa.array(column, pa.large_string())
        import pyarrow.compute as pc

        texts = pc.replace_substring_regex(pc.fill_null(texts, ""), r"^[\s\x{a0}]+|[\s\x{a0}]+$", "")
        listed = pc.and_(pc.starts_with(texts, "["), pc.ends_with(texts, "]"))
        texts = pc.if_else(listed, pc.utf8_slice_codeunits(texts, 0, -1), texts)
        buf, offsets = _buffer(texts)
    owner, starts, stops = split_buffer(buf, offsets, kind)
    raw = buf.tobytes()
    values = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts.tolist(), stops.tolist())]
    if kind == "names":
        head = set(np.flatnonzero(np.diff(offsets) > 0)[buf[offsets[:-1][np.diff(offsets) > 0]] == 91].tolist())
        values = [_unquote(v[1:] if o in head and s == offsets[o] else v, v) for v, o, s in zip(values, owner.tolist(), starts.tolist())]
    low = [v.lower() for v in values]
    ok = np.array([v not in PLACEHOLDERS and "non renseign" not in v for v in low], bool) if values else np.zeros(0, bool)
    if kind != "names" and len(values):
        # A whole-field placeholder in several words must not leave fragments behind.
        import pyarrow.compute as pc

        gone = pc.match_substring(pc.fill_null(column, ""), "NON RENSEIGN", ignore_case=True)
        ok &= ~np.asarray(gone)[owner]
    owner, values = owner[ok], [v for v, k in zip(values, ok) if k]
    if len(owner):
        change = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        pos = np.arange(len(owner)) - np.repeat(change, np.diff(np.concatenate([change, [len(owner)]]))) + 1
    else:
        pos = np.zeros(0, np.int64)
    return owner, pos, values


def split_packed(df: DataFrame, key: str, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """(field string, row_id long, pos int, item string) for packed text columns.

    columns: column -> (label written to `field`, kind of values: `emails`,
    `phones` or `names`). `pos` counts non-empty values from 1, repeats included.

    Null, blank, `nan`, `[]` and "... NON RENSEIGNE" fields give no row; malformed
    values count. Name fields use one delimiter (line break, bar, semicolon, comma,
    the strongest that stands outside quotes); quotes and brackets protect the
    others. Extra columns are ignored; an empty table gives an empty result.
    """
    use = [F.col(f"`{key}`").cast("long").alias("_k"), *[F.col(f"`{c}`").cast("string").alias(f"_c{i}") for i, c in enumerate(columns)]]
    plan = list(columns.values())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            for i, (label, kind) in enumerate(plan):
                owner, pos, values = _flatten(batch.column(i + 1), kind)
                if not len(values):
                    continue
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label] * len(values), pa.string()), keys.take(pa.array(owner)).cast(pa.int64()), pa.array(pos, pa.int32()), pa.array(values, pa.string())],
                    names=["field", "row_id", "pos", "item"],
                )

    return df.select(*use).mapInArrow(scan, "field string, row_id long, pos int, item string")
