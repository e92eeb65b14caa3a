"""Flat, linked tables from nested JSON by vectorised structural indexing.

A batch of JSON texts is one array of bytes. Bitmaps of quotes, escapes and structural characters come from whole-array
comparisons, string interiors from a prefix sum of quotes, nesting depth from a prefix sum of brackets, and the container
of every token from a running maximum per depth. Paths, places in arrays and value spans follow by gathering; no text is
parsed character by character and no row is visited on its own.

Defined results: a null or blank text gives no rows; so does a damaged one (odd quotes or unbalanced brackets), alone;
a null element of an array gives no row but keeps its place; of a key that occurs twice in an object the last value
counts; JSON null, an absent member and a container where a scalar is expected give null; an object without members is a
row of nulls. Places start at 1; 0 means that no array is passed.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import spread

_STRUCTURAL = np.zeros(256, bool)
_STRUCTURAL[[*b"{}[],:"]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[*b" \t\r\n"]] = True


class Index:
    """Structural index of a batch of JSON texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        quotes = data == 0x22
        slashes = data == 0x5C
        if slashes.any():
            place = np.arange(len(data))
            last = np.maximum.accumulate(np.where(slashes, -1, place))  # last byte that is no backslash
            run = np.zeros(len(data), np.int64)
            run[1:] = place[:-1] - last[:-1]
            quotes &= run % 2 == 0
        inside = np.cumsum(quotes, dtype=np.int32) & 1
        at = np.flatnonzero(_STRUCTURAL[data] & (inside == 0))
        self.at, self.kind = at, data[at]
        self.opens = (self.kind == 0x7B) | (self.kind == 0x5B)
        self.closes = (self.kind == 0x7D) | (self.kind == 0x5D)
        self.depth = np.cumsum(self.opens.astype(np.int32) - self.closes) + self.closes  # of the container a token belongs to
        self.row = np.searchsorted(offsets, at, "right") - 1

    def whole(self) -> np.ndarray:
        """By text: quotes are even and brackets balance; must hold for all before spans are taken."""
        n = len(self.offsets) - 1
        good = np.bincount(self.row, self.opens.astype(float) - self.closes, minlength=n) == 0
        if good.all():  # else depths aren't those of the texts themselves
            good[self.row[self.depth < 1]] = False
        if good.all():
            self.link()
            ends = np.flatnonzero(self.closes)
            good[self.row[ends[self.kind[self.container[ends]] + 2 != self.kind[ends]]]] = False
        return good

    def link(self) -> None:
        """The container, and the place in its array, of every token."""
        n = len(self.at)
        token = np.arange(n, dtype=np.int64)
        self.container = np.full(n, -1, np.int64)
        self.place = np.zeros(n, np.int32)  # of the value that begins after this token, counted within the array
        commas = self.kind == 0x2C
        for d in range(1, int(self.depth.max(initial=0)) + 1):
            here = self.depth == d
            owner = np.maximum.accumulate(np.where(here & self.opens, token, -1))
            self.container[here] = owner[here]
            count = np.cumsum(here & commas)
            mine = here & ~self.closes
            self.place[mine] = (count[mine] - count[owner[mine]]) + 1
        # The parent of a container is what encloses the token before it; -1 for the outermost of a text.
        self.parent = np.where(self.depth > 1, self.container[np.maximum(token - 1, 0)], -1)

    def spans(self, starts: np.ndarray, stops: np.ndarray) -> pa.Array:
        """The bytes of many spans as one binary array."""
        sizes = np.maximum(stops - starts, 0)
        ends = np.cumsum(sizes)
        take = np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(self.data[take])])

    def trim(self, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Spans without the white space around them."""
        starts, stops = starts.copy(), stops.copy()
        while len(move := np.flatnonzero((starts < stops) & _BLANK[self.data[np.minimum(starts, len(self.data) - 1)]])):
            starts[move] += 1
        while len(move := np.flatnonzero((starts < stops) & _BLANK[self.data[np.maximum(stops - 1, 0)]])):
            stops[move] -= 1
        return starts, stops

    def name(self) -> None:
        """Code each container's path: an integer per distinct path of member names and array steps."""
        members = np.flatnonzero(self.kind == 0x3A)
        starts, stops = self.trim(self.at[members - 1] + 1, self.at[members])
        keys = self.spans(starts + 1, stops - 1).dictionary_encode()
        self.keys = [self._text(x.as_py()) for x in keys.dictionary]
        self.key = np.full(len(self.at), -1, np.int64)  # by token: the member name it introduces
        self.key[members] = keys.indices.to_numpy()
        self.paths: list[str] = [""]
        codes: dict[tuple[int, int], int] = {}
        self.path = np.zeros(len(self.at), np.int64)
        before = np.maximum(np.arange(len(self.at)) - 1, 0)
        for d in range(2, int(self.depth.max(initial=0)) + 1):
            new = np.flatnonzero(self.opens & (self.depth == d))
            if len(new):
                self.path[new] = self._coded(self.path[self.parent[new]], self.key[before[new]], codes)
        self.codes = codes

    def _coded(self, above: np.ndarray, key: np.ndarray, codes: dict) -> np.ndarray:
        pairs, back = np.unique(above * (len(self.keys) + 1) + key + 1, return_inverse=True)
        out = np.empty(len(pairs), np.int64)
        for i, pair in enumerate(pairs.tolist()):
            a, k = divmod(pair, len(self.keys) + 1)
            if (a, k) not in codes:
                codes[a, k] = len(self.paths)
                head = self.paths[a]
                self.paths.append(head + "[]" if k == 0 else f"{head}.{self.keys[k - 1]}" if head else self.keys[k - 1])
            out[i] = codes[a, k]
        return out[back]

    @staticmethod
    def _text(raw: bytes) -> str:
        try:
            return json.loads(b'"' + raw + b'"') if b"\\" in raw else raw.decode()
        except ValueError:  # no valid escape: as it stands
            return raw.decode(errors="replace")

    def scalars(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens after which a scalar stands, and the code of its path."""
        nxt = np.minimum(np.arange(len(self.at)) + 1, len(self.at) - 1)
        in_array = self.data[self.at[np.maximum(self.container, 0)]] == 0x5B
        leads = (self.kind == 0x3A) | ((self.kind == 0x5B) | ((self.kind == 0x2C) & in_array))
        leads &= ~self.opens[nxt]
        found = np.flatnonzero(leads)
        owner = np.where(self.opens[found], found, self.container[found])
        return found, self._coded(self.path[owner], self.key[found], self.codes)

    def values(self, tokens: np.ndarray) -> pa.Array:
        """The scalars after the tokens as strings; JSON null and nothing are null."""
        starts, stops = self.trim(self.at[tokens] + 1, self.at[np.minimum(tokens + 1, len(self.at) - 1)])
        size = stops - starts
        quoted = (size > 1) & (self.data[np.minimum(starts, len(self.data) - 1)] == 0x22)
        nothing = (size == 0) | ((size == 4) & ~quoted & (self.data[np.minimum(starts, len(self.data) - 1)] == 0x6E))
        raw = self.spans(starts + quoted, stops - quoted)
        text = raw.cast(pa.large_string())
        escaped = np.flatnonzero(np.asarray(pc.match_substring(text, "\\")) & quoted) if len(text) else []
        if len(escaped):
            fixed = [self._text(raw[int(i)].as_py()).encode("utf-8", "replace").decode() for i in escaped]
            mask = np.zeros(len(text), bool)
            mask[escaped] = True
            text = pc.replace_with_mask(text, pa.array(mask), pa.array(fixed, pa.large_string()))
        return pc.if_else(pa.array(nothing), pa.scalar(None, pa.large_string()), text)


def index_batch(texts: pa.Array) -> tuple[Index, np.ndarray]:
    """The index of the undamaged texts of a batch, and the numbers of their rows."""
    rows = np.flatnonzero(~np.asarray(pc.is_null(texts)))
    while True:
        part = texts.take(pa.array(rows)).cast(pa.large_binary())
        part = pa.concat_arrays([part])
        sizes = np.asarray(pc.binary_length(part)).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        raw = np.frombuffer(part.buffers()[2], np.uint8) if len(part) and offsets[-1] else np.zeros(0, np.uint8)
        start = int(np.frombuffer(part.buffers()[1], np.int64)[part.offset]) if len(part) else 0
        data = raw[start : start + int(offsets[-1])]
        quotes = data == 0x22
        odd = np.zeros(len(rows), bool)
        if len(rows):
            slashes = data == 0x5C
            if slashes.any():
                place = np.arange(len(data))
                last = np.maximum.accumulate(np.where(slashes, -1, place))
                run = np.zeros(len(data), np.int64)
                run[1:] = place[:-1] - last[:-1]
                quotes &= run % 2 == 0
            total = np.concatenate([[0], np.cumsum(quotes)])
            odd = (total[offsets[1:]] - total[offsets[:-1]]) % 2 == 1
        if odd.any():
            rows = rows[~odd]
            continue
        index = Index(data, offsets)
        good = index.whole()
        if good.all():
            return index, rows
        rows = rows[good]


def flatten_batch(batch: pa.Table | pa.RecordBatch, json_col: str, keep: list[str], specs: dict[str, tuple[str, dict[str, str]]]) -> pa.Table:
    """Rows of every container that ``specs`` names: kept columns, child, pos and the fields."""
    fields = list(dict.fromkeys(f for _, wanted in specs.values() for f in wanted))
    index, rows = index_batch(batch.column(json_col))
    pieces = []
    if len(index.at):
        index.name()
        leaf_token, leaf_path = index.scalars()
        codes = {p: i for i, p in enumerate(index.paths)}
        slot = np.full(len(index.at), -1, np.int64)
        for child, (path, wanted) in specs.items():
            if path not in codes:
                continue
            owners = np.flatnonzero(index.opens & (index.path == codes[path]) & (index.kind == 0x7B))
            if path == "":
                owners = owners[index.depth[owners] == 1]
            if not len(owners):
                continue
            slot[owners] = np.arange(len(owners))
            out = {}
            for field in fields:
                at = codes.get(f"{path}.{wanted[field]}" if path else wanted[field]) if field in wanted else None
                column = np.full(len(owners), -1, np.int64)
                if at is not None:
                    tokens = leaf_token[leaf_path == at]
                    holder = index.container[tokens]
                    for _ in range(wanted[field].count(".")):
                        holder = index.parent[holder]
                    column[slot[holder]] = np.arange(len(tokens))
                    values = index.values(tokens)
                    out[field] = values.take(pa.array(column, mask=column < 0))
                else:
                    out[field] = pa.nulls(len(owners), pa.large_string())
            pos = np.where(path.endswith("[]"), index.place[np.maximum(owners - 1, 0)], 0)
            record = rows[index.row[owners]]
            kept = {k: batch.column(k).take(pa.array(record)) for k in keep}
            pieces.append(pa.table(kept | {"child": pa.array([child] * len(owners)), "pos": pa.array(pos, pa.int32())} | {f: out[f].cast(pa.string()) for f in fields}))
    if pieces:
        return pa.concat_tables(pieces)
    kinds = {k: batch.schema.field(k).type for k in keep}
    return pa.table({k: pa.nulls(0, t) for k, t in kinds.items()} | {"child": pa.nulls(0, pa.string()), "pos": pa.nulls(0, pa.int32())} | {f: pa.nulls(0, pa.string()) for f in fields})


def flatten_json(df: DataFrame, json_col: str, keep: list[str], specs: dict[str, tuple[str, dict[str, str]]]) -> DataFrame:
    """Child rows of the JSON in ``json_col``, each with the kept columns of its record.

    ``specs`` names each child table: the path of its objects (members joined by ``.``, ``[]`` for the elements of an
    array) and its columns as paths below the object. Narrow: no shuffle.
    """
    fields = list(dict.fromkeys(f for _, wanted in specs.values() for f in wanted))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema] + ["child string", "pos int"] + [f"`{f}` string" for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from flatten_batch(batch, json_col, keep, specs).to_batches()

    return spread(df.select(*keep, F.col(json_col))).mapInArrow(run, schema)
