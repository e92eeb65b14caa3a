"""Token ids of whole texts by a public byte-level BPE tokenizer.

A text is cut at the tokenizer's own split points. A piece that has none and is longer than a leaf (a run of letters without
spaces, as in many scripts) is encoded as a tree: its leaves, in parallel if it is long, then pairwise up the tree a window
of tokens around each join, encoded again and doubled until its first and last token equal those of the halves. Texts
without such pieces are encoded at once, long ones by stretches in parallel. Byte-pair encoding
is decided by neighbours: a row of tokens is an encoding exactly if each two neighbours are, so agreement at both ends
proves the whole.

Defined results: null and empty texts give the empty list; names of special tokens in a text are ordinary text; repeated
texts are encoded alike; extra columns are untouched, but for one with the name of the result, which is replaced.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame

from ..runtime import spread

#: Where the vocabulary files lie unless told otherwise.
TOKENIZERS = os.environ.get("PAPERLOOM_TOKENIZERS", "/opt/tokenizers")
#: Fixed value: how the tokenizer splits a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Code points of a stretch, bytes of a leaf, tokens of the first window, bytes from which leaves are encoded in parallel.
LONG, LEAF, WINDOW, PARALLEL = 1 << 17, 32, 8, 1 << 14
THREADS = 2


class ByteBpe:
    """Encoder of one vocabulary file."""

    def __init__(self, path: str, long: int = LONG, leaf: int = LEAF, window: int = WINDOW):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.text_of = {rank: token for token, rank in ranks.items()}
        self.splits = regex.compile(PATTERN)
        self.long, self.leaf, self.window = long, leaf, window
        runs = (r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]", r"\s")
        self.runs = regex.compile("|".join(f"{x}{{{max(1, leaf // 4)},}}" for x in runs))  # a code point has four bytes at most
        self.pool = ThreadPoolExecutor(THREADS)

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if len(text) <= self.long and not self.unsplit(text):
            return self.encoding.encode_ordinary(text)
        return self._long(text)

    def unsplit(self, text: str) -> bool:
        """Whether a piece may be longer than a leaf: a run of one kind of characters, before which a space may stand.

        What stands between white space bounds such runs, as does all white space beyond one byte a gap; only where that
        leaves room are the runs looked for.
        """
        words = text.split()
        white = len(text) - sum(map(len, words)) - len(words) + 1  # in the largest gap at most
        largest = max(map(len, text.encode().split()), default=0)
        if largest < self.leaf and 4 * white < self.leaf:
            return False
        return any(len(found.group().encode()) >= self.leaf for found in self.runs.finditer(text))

    def _long(self, text: str) -> list[int]:
        """Stretches between split points, and unsplit pieces as trees, in order."""
        jobs, start, end, blanks = [], 0, 0, []  # [start, end): a stretch that ends in no white space; then single blank pieces
        plain = self.encoding.encode_ordinary if len(text) <= self.long else lambda x: self.pool.submit(self.encoding.encode_ordinary, x)

        def close() -> None:
            if end > start:
                jobs.append(plain(text[start:end]))
            jobs.extend(self.tree(text[i:j].encode()) for i, j in blanks)  # on its own, a stretch would join them

        for found in self.splits.finditer(text):
            i, j = found.span()
            if 4 * (j - i) > self.leaf and len(piece := text[i:j].encode()) > self.leaf:
                close()
                jobs.append(self.tree(piece))
                start, end, blanks = j, j, []
            elif text[i:j].isspace():
                blanks.append((i, j))
            else:
                end, blanks = j, []
                if end - start >= self.long:
                    close()
                    start = end
        close()
        return [token for job in jobs for token in (job if isinstance(job, list) else job.result())]

    def tree(self, piece: bytes) -> list[int]:
        """Ids of one piece: leaves, then joined pairwise up the tree."""
        each = self.pool.map if len(piece) >= PARALLEL else map
        level = list(each(self.encoding._encode_single_piece, (piece[i : i + self.leaf] for i in range(0, len(piece), self.leaf))))
        while len(level) > 1:
            pairs = [level[i : i + 2] for i in range(0, len(level), 2)]
            level = list(each(lambda pair: self.join(*pair) if len(pair) == 2 else pair[0], pairs))
        return level[0]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two encoded neighbours together."""
        size = self.window
        while True:
            a, b = left[-size:], right[:size]
            middle = self.encoding._encode_single_piece(b"".join(self.text_of[t] for t in a + b))
            if (size >= len(left) or middle[0] == a[0]) and (size >= len(right) or middle[-1] == b[-1]):
                return left[: max(0, len(left) - size)] + middle + right[size:]
            size *= 2


@lru_cache(maxsize=4)
def encoder(path: str) -> ByteBpe:
    """One encoder per worker process and vocabulary."""
    return ByteBpe(path)


def vocabulary(name: str = "byte_bpe_50k", folder: str | None = None) -> str:
    return os.path.join(folder or TOKENIZERS, f"{name}.tiktoken")


def encode_texts(df: DataFrame, text: str, out: str = "ids", path: str | None = None) -> DataFrame:
    """``df`` with the token ids of ``text`` in its place. Narrow: no shuffle, batches through Arrow."""
    path = path or vocabulary()
    keep = [c for c in df.columns if c not in (text, out)]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema] + [f"`{out}` array<int>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            ids = pa.array([bpe.encode(x) for x in batch.column(text).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), ids], [*keep, out])

    return spread(df.select(*keep, text)).mapInArrow(run, schema)


def count_tokens(df: DataFrame, text: str, out: str = "n_tokens", path: str | None = None) -> DataFrame:
    """``df`` with the number of tokens of ``text`` in its place; 0 for null and empty texts."""
    path = path or vocabulary()
    keep = [c for c in df.columns if c not in (text, out)]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema] + [f"`{out}` bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            texts = pc.fill_null(batch.column(text), "").to_pylist()
            sizes = pa.array([len(bpe.encode(x)) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), sizes], [*keep, out])

    return spread(df.select(*keep, text)).mapInArrow(run, schema)
