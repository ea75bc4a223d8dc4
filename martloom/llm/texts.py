"""Small helpers on UTF-8 bytes and Arrow arrays, shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = b" \t\n\x0b\x0c\r"
# bytes that follow the first byte of a code point
CONTINUATION = bytes(range(0x80, 0xC0))
SHINGLE = 5
SIEVE_BITS = 1 << 25  # a bitmap of 4 MB
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def utf8(texts: pa.Array) -> list[bytes | None]:
    """The texts of an Arrow array as bytes, without decoding them."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()).to_pylist()


def in_slices(values: pa.Array, size: int = 256) -> Iterator:
    """The Python values of an Arrow array, of which only ``size`` exist at a time."""
    for at in range(0, len(values), size):
        yield from values.slice(at, size).to_pylist()


def code_points(raw: bytes) -> int:
    return len(raw.translate(None, CONTINUATION))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """One 64-bit hash per run of ``size`` word hashes, in text order; none for shorter texts."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    rolled = hashes[:n].copy()
    for step in range(1, size):
        rolled = rolled * _MULTIPLIER + hashes[step:step + n]
    return mix(rolled + np.uint64(size))


def shingle_set(raw: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; a shorter word sequence is one shingle as a whole."""
    words = raw.lower().split() if raw else []
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(shingle_hashes(word_hashes(words), min(size, len(words))))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column in any letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sieve(rows: DataFrame, key: str, ids: DataFrame, bits: int = SIEVE_BITS) -> DataFrame:
    """The rows whose ``key`` may be among ``ids`` (one column): all that are, and few others.

    Drops rows where they are read, before an exact join would move them.  The bitmap goes to all tasks as
    at most ``bits / 64`` rows, however many ids there are; with too many ids it lets all rows pass.
    """
    def place(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(bits))

    name, word, mask = ids.columns[0], unused(rows, "_word"), unused(rows, "_mask")
    words = (ids.select(place(name).alias("place")).groupBy(F.shiftright("place", 6).alias(word))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias(mask)))
    marked = rows.withColumn(word, F.shiftright(place(key), 6)).join(F.broadcast(words), word)
    return marked.filter(F.getbit(F.col(mask), (place(key) % 64).cast("int")) == 1).select(*[F.col(f"`{c}`") for c in rows.columns])


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")
