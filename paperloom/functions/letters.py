"""Upper bounds of the letters that two titles share.

Letters fall into 32 classes, which can only raise a bound. Null is taken as the empty text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Numbers of 64 bits that count a title's letters, in 16 bits per class.
BAG = 8
_BAG_TYPE = T.StructType([T.StructField("rest", T.IntegerType()), *(T.StructField(f"b{i}", T.LongType()) for i in range(BAG))])


def _classes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the letters of all texts, 32 beyond their ends, and the lengths."""
    sizes = np.array([len(x) for x in texts], np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.full((len(texts), int(sizes.max(initial=0))), 32, np.uint8)
    out[np.arange(out.shape[1]) < sizes[:, None]] = codes % 32
    return out, sizes


def bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of letters as ones in a row, so that the bits of two titles' conjunction count the letters shared; and how
    many letters found no place."""
    sizes = np.array([len(x) for x in texts], np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = np.bincount(np.repeat(np.arange(len(texts)), sizes) * 32 + codes % 32, minlength=32 * len(texts)).reshape(-1, 32)
    held = np.minimum(counts, 16)
    ones = ((np.uint64(1) << held.astype(np.uint64)) - np.uint64(1)).reshape(len(texts), BAG, 4)
    packed = (ones << (np.arange(4, dtype=np.uint64) * np.uint64(16))).sum(2, dtype=np.uint64)
    return packed.view(np.int64), sizes - held.sum(1)


def blocks(sizes: list[int], cells: int = 1 << 19) -> Iterator[list[int]]:
    """Places of like sizes together, so that no block padded to its longest has more than ``cells`` but for single ones."""
    block: list[int] = []
    for i in sorted(range(len(sizes)), key=sizes.__getitem__):
        if block and (len(block) + 1) * sizes[i] > cells:
            yield block
            block = []
        block.append(i)
    if block:
        yield block


def common(a: list[str], b: list[str]) -> np.ndarray:
    """Lengths of longest common subsequences of classes of letters, all pairs at once (bit-parallel); never below the
    letters that matching blocks share."""
    out = np.zeros(len(a), np.int64)
    for block in blocks([max(len(x), len(y)) for x, y in zip(a, b, strict=True)]):
        (x, sizes), (y, _) = _classes([a[i] for i in block]), _classes([b[i] for i in block])
        line, words = np.arange(len(block)), x.shape[1] // 64 + 1
        places = np.zeros((len(block), 33, words), np.uint64)
        for i in range(x.shape[1]):
            places[line, x[:, i], i // 64] |= np.uint64(1 << (i % 64))
        places[:, 32] = 0
        rows = np.full((words, len(block)), ~np.uint64(0))
        for j in range(y.shape[1]):
            hits, carry = places[line, y[:, j]], np.zeros(len(block), np.uint64)
            for k in range(words):
                v = rows[k]
                u = v & hits[:, k]
                part = v + u
                total = part + carry
                carry = ((part < v) | (total < part)).astype(np.uint64)
                rows[k] = total | (v & ~u)
        ends = np.arange(words)[:, None] * 64
        inside = np.clip(sizes[None, :] - ends, 0, 64)
        within = np.where(inside == 64, ~np.uint64(0), (np.uint64(1) << np.minimum(inside, 63).astype(np.uint64)) - np.uint64(1))
        out[block] = np.bitwise_count(~rows & within).sum(0)
    return out


@F.pandas_udf(_BAG_TYPE)
def bag_udf(text: pd.Series) -> pd.DataFrame:
    packed, rest = bags([x or "" for x in text])
    return pd.DataFrame({"rest": rest.astype(np.int32)} | {f"b{i}": packed[:, i] for i in range(BAG)})


@F.pandas_udf(T.LongType())
def common_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(common(a.tolist(), b.tolist()))


def shared_letters(a: Column, b: Column) -> Column:
    """How many letters two bags share, whatever their order; in generated code."""
    ones = reduce(lambda x, y: x + y, (F.bit_count(a[f"b{i}"].bitwiseAND(b[f"b{i}"])) for i in range(BAG)))
    return ones + F.least(a["rest"], b["rest"])
