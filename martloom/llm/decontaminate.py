"""Benchmark passages in documents, found by greedy string tiling.

The shingles of the benchmark items are the seeds.  Benchmark items come in blocks of a
bounded number of words, each sent to the tasks as one sorted array, so the texts are never
shuffled and a passage that a third of all documents share is plain local work.  Where a
text and an item share a seed, tiles are laid: the longest common runs of tokens not yet
marked, found by running Karp-Rabin hashes of a falling length, are marked longest first
until none of ``min_match`` tokens is left.  Order plays no part, so moved passages count.
An item is in a document when its tiles cover the ``coverage`` share of its tokens.

Null and empty texts, and items of fewer than ``min_match`` words (too short to tell from
chance), never match.  Repeated rows and items are reported each; rows without an id are
reported with a null id.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.texts import SHINGLE, shingle_hashes, unused, utf8, word_hashes

# Limits of one block of items: its words in one array at every task.
BLOCK_WORDS = 2_000_000
COVERAGE = 0.6
LEAKS = ("array<struct<item_id:bigint,n_item_words:bigint,covered_words:bigint,n_tiles:bigint,coverage:double,"
         "spans:array<struct<start:bigint,words:bigint>>>>")
_MODULUS, _BASE = (1 << 61) - 1, 1_000_003


def _windows(tokens: list[int], marked: bytearray, size: int):
    """``hash, start`` of every unmarked run of ``size`` tokens; the hash is rolled along."""
    lead = pow(_BASE, size - 1, _MODULUS)
    value = length = 0
    for at, token in enumerate(tokens):
        if marked[at]:
            value = length = 0
            continue
        if length == size:
            value -= tokens[at - size] % _MODULUS * lead
        else:
            length += 1
        value = (value * _BASE + token) % _MODULUS
        if length == size:
            yield value, at - size + 1


def _maximal_matches(item, item_marked, text, text_marked, size):
    """Common unmarked runs of at least ``size`` tokens that cannot be extended, as (length, item, text)."""
    places = defaultdict(list)
    for value, start in _windows(item, item_marked, size):
        places[value].append(start)
    reached: dict[int, int] = {}  # by diagonal: where the last run ended in the text
    for value, start in _windows(text, text_marked, size):
        for at in places.get(value, ()):
            if reached.get(at - start, -1) > start or item[at:at + size] != text[start:start + size]:
                continue
            n = size
            while (at + n < len(item) and start + n < len(text) and item[at + n] == text[start + n]
                   and not item_marked[at + n] and not text_marked[start + n]):
                n += 1
            reached[at - start] = start + n
            yield n, at, start


def greedy_tiles(item: list[int], text: list[int], text_marked: bytearray, min_match: int) -> list[tuple[int, int, int]]:
    """Tiles (length, place in the item, place in the text) that do not overlap, longest first.

    ``text_marked`` rules out tokens of the text from the start and is changed.
    """
    item_marked, tiles, size = bytearray(len(item)), [], max(min_match, len(item) // 2)
    while True:
        matches = sorted(_maximal_matches(item, item_marked, text, text_marked, size), key=lambda m: (-m[0], m[1], m[2]))
        while matches:
            later = []
            for n, at, start in matches:
                # what an earlier, longer tile has left of this run
                lost = [k for k in range(n) if item_marked[at + k] or text_marked[start + k]]
                if not lost:
                    item_marked[at:at + n] = text_marked[start:start + n] = b"\1" * n
                    tiles.append((n, at, start))
                    continue
                for low, high in zip([-1, *lost], [*lost, n]):
                    if high - low - 1 >= size:
                        later.append((high - low - 1, at + low + 1, start + low + 1))
            matches = sorted(later, key=lambda m: (-m[0], m[1], m[2]))
        if size == min_match:
            return tiles
        size = max(min_match, size // 2)


class ItemBlock:
    """A bounded block of benchmark items and the seeds they start from."""

    def __init__(self, items: list[tuple[int | None, bytes]], min_match: int):
        kept = [(i, word_hashes(raw.lower().split())) for i, raw in items]
        self.items = [(i, h) for i, h in kept if len(h) >= min_match]
        self.min_match = min_match
        seeds = [shingle_hashes(h, min_match) for _, h in self.items] or [np.empty(0, np.uint64)]
        owners = np.repeat(np.arange(len(seeds)), [len(s) for s in seeds])
        hashes = np.concatenate(seeds)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owners = hashes[order], owners[order]
        # one bit of each seed in 2^20, which rules out nearly all windows of a text at once
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[self.hashes >> np.uint64(44)] = True

    def leaks(self, raw: bytes | None, coverage: float) -> list[dict]:
        hashes = word_hashes(raw.lower().split()) if raw else np.empty(0, np.uint64)
        windows = shingle_hashes(hashes, self.min_match)
        maybe = np.flatnonzero(self.sieve[windows >> np.uint64(44)])
        first = np.searchsorted(self.hashes, windows[maybe], "left")
        last = np.searchsorted(self.hashes, windows[maybe], "right")
        meets = defaultdict(list)
        for start, low, high in zip(maybe.tolist(), first.tolist(), last.tolist()):
            for owner in set(self.owners[low:high].tolist()):
                meets[owner].append(start)
        return [leak for owner, starts in sorted(meets.items()) if (leak := self._tiled(owner, hashes, starts, coverage))]

    def _tiled(self, owner: int, hashes: np.ndarray, starts: list[int], coverage: float) -> dict | None:
        item_id, item = self.items[owner]
        # a tile consists of seeds, so tokens under none of them cannot be part of one
        places = sorted({start + k for start in starts for k in range(self.min_match)})
        tokens, marked, position = [], bytearray(), []
        for place in places:
            if position and place > position[-1] + 1:
                tokens.append(0)
                marked.append(1)
                position.append(-1)
            tokens.append(int(hashes[place]))
            marked.append(0)
            position.append(place)
        tiles = greedy_tiles(item.tolist(), tokens, marked, self.min_match)
        covered = sum(n for n, _, _ in tiles)
        if covered < coverage * len(item):
            return None
        return {"item_id": item_id, "n_item_words": len(item), "covered_words": covered, "n_tiles": len(tiles),
                "coverage": covered / len(item),
                "spans": [{"start": position[start], "words": n} for n, _, start in sorted(tiles, key=lambda t: t[2])]}


def item_blocks(benchmark: DataFrame, min_match: int = SHINGLE, block_words: int = BLOCK_WORDS) -> list[ItemBlock]:
    """The benchmark in blocks of about ``block_words`` words; one block at a time is at the driver while it is built."""
    items = benchmark.select("item_id", "text").filter("text IS NOT NULL")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(chars / 2 / block_words))  # a word is two characters at least, with its space
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [ItemBlock([(r[0], r[1].encode()) for r in items.filter(part == k).collect()], min_match) for k in range(n)]


def leaks_in(benchmark: DataFrame, text: Column, coverage: float = COVERAGE, min_match: int = SHINGLE,
             block_words: int = BLOCK_WORDS) -> Column:
    """Array column: the items whose tiles cover at least ``coverage`` of their tokens in ``text``."""
    def finder(block: ItemBlock):
        @F.arrow_udf(LEAKS)
        def leaks(texts: pa.Array) -> pa.Array:
            return pa.array([block.leaks(raw, coverage) for raw in utf8(texts)], _LEAKS)
        return leaks
    return F.concat(*[finder(block)(text) for block in item_blocks(benchmark, min_match, block_words)])


_LEAKS = pa.list_(pa.struct([
    ("item_id", pa.int64()), ("n_item_words", pa.int64()), ("covered_words", pa.int64()), ("n_tiles", pa.int64()),
    ("coverage", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64())])))]))


def find_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, min_match: int = SHINGLE) -> DataFrame:
    """``doc_id`` and the leak columns, one row per document and benchmark item found in it."""
    leaks = leaks_in(benchmark, F.col("text"), coverage, min_match)
    return docs.select("doc_id", F.explode(leaks).alias("leak")).select("doc_id", "leak.*")


def drop_leaked(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, min_match: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found, unchanged."""
    flag = unused(docs, "_leaks")
    return docs.withColumn(flag, F.size(leaks_in(benchmark, F.col("text"), coverage, min_match))).filter(F.col(flag) == 0).drop(flag)
