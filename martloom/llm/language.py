"""Language identification by prediction by partial matching.

Each language is a context tree over bytes: how often each byte followed each of its last
0 to ``order`` bytes in that language's training texts.  A byte costs -log2(c / (T + d))
bits in the longest context that has it, after an escape of -log2(d / (T + d)) bits for
each longer context that has not (c its count there, T all counts and d distinct bytes of
the context); a byte unknown everywhere costs an escape more than 8 bits.  The counts are
frozen, so the code length of a text is a sum over its distinct (context, byte) pairs, and
the language with the shortest code wins.

Training takes about ``rows_per_language`` labelled texts of each language, chosen by a
hash of their id and counted whole inside the tasks; what reaches the driver is bounded by
that sample.  Every text is scored whole.

Texts that are null or have no letter are ``und`` with score 0, as is everything when there
is nothing to learn from.  Ties go to the first language in code-point order.  Rows without
an id are scored, never learned from, and not held out.  Repeated rows give equal results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.texts import utf8

ORDER = 3
ROWS_PER_LANGUAGE = 1500
UNKNOWN = "und"
_ASCII_LETTER, _LETTER = re.compile(rb"[A-Za-z]"), regex.compile(r"\p{L}")


def has_letter(raw: bytes) -> bool:
    return bool(_ASCII_LETTER.search(raw) or _LETTER.search(raw.decode("utf-8", "replace")))


def context_codes(raw: bytes, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (last ``order`` bytes, byte) of a text as numbers, and their counts; a text starts after zeros."""
    b = np.frombuffer(bytes(order) + raw, np.uint8).astype(np.uint64)
    codes = b[:len(raw)].copy()
    for step in range(1, order + 1):
        codes = (codes << np.uint64(8)) | b[step:step + len(raw)]
    return np.unique(codes, return_counts=True)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class ContextTrees:
    """Frozen code lengths of all languages: per order, the pairs seen in any of them, and the escapes."""

    def __init__(self, counts: dict[str, dict[int, int]], order: int = ORDER):
        self.languages, self.order = sorted(counts), order
        n = len(self.languages)
        if not n:
            return
        keys = np.unique(np.fromiter((c for of in counts.values() for c in of), np.uint64))
        table = np.zeros((len(keys), n))
        for column, language in enumerate(self.languages):
            codes = np.fromiter(counts[language], np.uint64, len(counts[language]))
            table[np.searchsorted(keys, codes), column] = np.fromiter(counts[language].values(), np.float64, len(codes))
        levels = [(keys, table)]
        for k in range(order - 1, -1, -1):  # counts in a shorter context are sums over the longer ones
            longer, of_longer = levels[0]
            keys, back = np.unique(longer & np.uint64((1 << 8 * (k + 1)) - 1), return_inverse=True)
            table = np.zeros((len(keys), n))
            np.add.at(table, back, of_longer)
            levels.insert(0, (keys, table))
        self.keys, self.bits, self.contexts, self.escapes = [], [], [], []
        for k, (keys, table) in enumerate(levels):
            contexts, back = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, distinct = np.zeros((len(contexts), n)), np.zeros((len(contexts), n))
            np.add.at(total, back, table)
            np.add.at(distinct, back, table > 0)
            known = total > 0
            escapes = np.where(known, -np.log2(np.where(known, distinct, 1) / np.where(known, total + distinct, 1)), 0.0)
            if k:
                at, _ = _find(self.keys[-1], keys & np.uint64((1 << 8 * k) - 1))
                shorter = self.bits[-1][at]
            else:
                shorter = np.full((1, n), 8.0)
            whole = np.where(known, total + distinct, 1)[back]
            bits = np.where(table > 0, -np.log2(np.where(table > 0, table, 1) / whole), escapes[back] + shorter)
            self.keys.append(keys), self.bits.append(bits), self.contexts.append(contexts), self.escapes.append(escapes)

    def code_lengths(self, raw: bytes) -> np.ndarray:
        """Bits of the text under each language."""
        codes, counts = context_codes(raw, self.order)
        total = np.zeros(len(self.languages))
        for k in range(self.order, -1, -1):
            at, seen = _find(self.keys[k], codes)
            total += counts[seen] @ self.bits[k][at[seen]]
            codes, counts = codes[~seen], counts[~seen]
            if not len(codes):
                return total
            at, known = _find(self.contexts[k], codes >> np.uint64(8))
            total += counts[known] @ self.escapes[k][at[known]]
            # codes that differ in the byte just dropped are now the same
            codes, back = np.unique(codes & np.uint64((1 << 8 * k) - 1 if k else 255), return_inverse=True)
            counts = np.bincount(back, counts).astype(np.int64)
        return total + counts.sum() * 8.0

    def best(self, raw: bytes | None) -> tuple[str, float]:
        if not raw or not self.languages or not has_letter(raw):
            return UNKNOWN, 0.0
        bits = self.code_lengths(raw)
        at = int(bits.argmin())
        return self.languages[at], float(1.0 / np.exp2(np.maximum(bits[at] - bits, -1000)).sum())


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, order: int = ORDER) -> ContextTrees:
    """Context trees of the languages in ``lang`` from ``doc_id, text, lang``."""
    rows = docs.filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text <> ''").select("doc_id", "lang", "text")
    # by distinct ids, which the hash below picks, so that few ids in many rows are kept whole
    sizes = dict(rows.groupBy("lang").agg(F.count_distinct("doc_id")).collect())
    if not sizes:
        return ContextTrees({}, order)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, rows_per_language / n))])
    chosen = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit("ppm")), F.lit(1_000_000)) < F.element_at(share, F.col("lang")) * 1_000_000)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            texts = utf8(batch.column(1))
            for lang in sorted(set(langs)):
                parts = [context_codes(texts[i], order) for i in np.flatnonzero(langs == lang)]
                codes, back = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
                n = np.bincount(back, np.concatenate([n for _, n in parts]), len(codes))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.view(np.int64)),
                                                  pa.array(n.astype(np.int64))], names=["lang", "code", "n"])

    counted = (chosen.select("lang", "text").mapInArrow(count, "lang string, code bigint, n bigint")
               .groupBy("lang", "code").agg(F.sum("n").alias("n")).toArrow())
    langs = np.array(counted.column("lang").to_pylist(), object)
    codes, n = counted.column("code").to_numpy(), counted.column("n").to_numpy()
    # a language of which no row was picked is not learned
    return ContextTrees({lang: dict(zip(codes[langs == lang].tolist(), n[langs == lang].tolist())) for lang in sorted(set(langs))}, order)


def predict(docs: DataFrame, trees: ContextTrees) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row."""
    @F.arrow_udf("lang_pred string, score double")
    def best(texts: pa.Array) -> pa.Array:
        found = [trees.best(raw) for raw in utf8(texts)]
        return pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                                          names=["lang_pred", "score"])
    return docs.select("doc_id", best("text").alias("b")).select("doc_id", "b.*")
