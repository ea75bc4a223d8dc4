"""Removal of lines that several documents share.

Lines are normalised, hashed to 128 bits and exploded; documents are counted per hash; the
lines over the threshold are taken out of every document but the smallest id that holds
them, and each text is put together again from the lines left, by position.

Only hashes are shuffled for counting, partial counts first, so a line of a third of all
documents is one row per task.  The marked hashes meet the lines in a plain equi-join,
whose hot keys adaptive execution splits.  The texts are shuffled once, by document.

A null text is one empty line, the result of which is an empty text.  Rows without an id
take no part and stay as they are.  Rows that share an id are one document: they are counted
once and lose the same lines.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.texts import SPACE, code_points, unused, utf8
from martloom.session import cut_lineage


def line_hash(line: bytes, min_chars: int) -> bytes | None:
    """Hash of the normalised line; none if it has fewer than ``min_chars`` code points."""
    key = line.strip(SPACE).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and code_points(key) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def shared_lines(docs: DataFrame, min_chars: int = 10, min_documents: int = 2) -> DataFrame:
    """``doc_id, hashes``: what each document has to drop."""
    @F.arrow_udf("array<binary>")
    def hashes(texts: pa.Array) -> pa.Array:
        found = ([line_hash(line, min_chars) for line in raw.split(b"\n")] if raw else [] for raw in utf8(texts))
        return pa.array([list(dict.fromkeys(h for h in row if h)) for row in found], pa.list_(pa.binary()))

    lines = cut_lineage(docs.filter("doc_id IS NOT NULL").select("doc_id", F.explode(hashes("text")).alias("hash")))
    # written, so that the join shuffles both sides and adaptive execution can split a hot hash
    shared = cut_lineage(lines.groupBy("hash").agg(F.count_distinct("doc_id").alias("documents"), F.min("doc_id").alias("keeper"))
                         .filter(F.col("documents") >= min_documents).select("hash", "keeper"))
    return (lines.join(shared, "hash").filter(F.col("doc_id") != F.col("keeper"))
            .groupBy("doc_id").agg(F.collect_set("hash").alias("hashes")))


def drop_shared_lines(docs: DataFrame, min_chars: int = 10, min_documents: int = 2) -> DataFrame:
    """``docs`` with the shared lines taken out of ``text``, plus ``n_lines`` and ``n_dropped``.

    Columns of ``docs`` with these two names are replaced.
    """
    @F.arrow_udf("text string, n_lines bigint, n_dropped bigint")
    def rest(texts: pa.Array, marked: pa.Array) -> pa.Array:
        out, n_lines, n_dropped = [], [], []
        for raw, drop in zip(utf8(texts), marked.to_pylist()):
            lines = (raw or b"").split(b"\n")
            gone = frozenset(drop or ())
            kept = [line for line in lines if line_hash(line, min_chars) not in gone] if gone else lines
            out.append(b"\n".join(kept))
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(kept))
        return pa.StructArray.from_arrays(
            [pa.array(out, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
            names=["text", "n_lines", "n_dropped"])

    source, marks, result = docs.drop("n_lines", "n_dropped"), unused(docs, "_hashes"), unused(docs, "_rest")
    marked = shared_lines(docs, min_chars, min_documents).withColumnRenamed("hashes", marks)
    return (source.join(marked, "doc_id", "left").withColumn(result, rest("text", marks))
            .select(*[F.col(f"{result}.text").alias("text") if c == "text" else F.col(f"`{c}`") for c in source.columns],
                    f"{result}.n_lines", f"{result}.n_dropped"))
