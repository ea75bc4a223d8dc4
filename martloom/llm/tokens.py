"""Token counts kept by digest: what was counted once, by any run, is never encoded again.

The cache is a table of ``version, digest, n_bytes, n_tokens``.  ``version`` is a digest of the
tokenizer's file, its library and the library's version; ``digest`` is the SHA-256 of the normalised
text, where null counts as empty and nothing else is changed, since any other change could change the count.
Texts are joined to the cache by both digests.  Of those that miss, one per digest is encoded, chosen
before the shuffle where copies lie in one task, so a text that a third of all rows share is sent once per
task.  The new counts are appended to the cache and all documents take theirs from it.

A text is encoded word by word where that is provably the same: when no piece of the vocabulary
goes on past a space and the tokenizer does not rewrite its input, a merge never crosses the
start of a word, so a text's count is the sum of its words' counts and the counts of frequent words are remembered.
This also bounds the memory of very long texts.  Other vocabularies encode whole texts.

Defined cases: null and empty texts have 0 bytes and 0 tokens; repeated rows, also with equal ids,
each get their row; an empty table gives an empty result and appends nothing; further columns
are kept unless they bear the name of a result.  Runs that append the same digest at the same time do no
harm, since the cache is read with one row per digest.
"""

from __future__ import annotations

import hashlib
import operator
import re
from collections import Counter
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.texts import unused
from martloom.session import cut_lineage
from martloom.sizing import is_bounded

_WORD = re.compile(" ( *[^ ]*)")
_MARK = "▁"  # what the tokenizer puts for a space
MEMO_WORDS, MEMO_CHARS = 500_000, 48  # words remembered by a task, and the longest of them
CACHE_SCHEMA = "version string, digest binary, n_bytes long, n_tokens long"


class Tokenizer:
    """A tokenizer by its file: ``.json`` for tokenizers, ``.model`` for sentencepiece.  Executors get the file's bytes."""

    def __init__(self, path: str) -> None:
        self.kind = Path(path).suffix
        self.file = Path(path).read_bytes()
        self.by_words = self.kind == ".model" and _words_stand_alone(self.file)
        self._held = None

    def version(self) -> str:
        """Digest of everything that decides a count."""
        library = __import__("sentencepiece" if self.kind == ".model" else "tokenizers")
        named = f"{library.__name__} {library.__version__} no special tokens, no truncation\n".encode()
        return hashlib.sha256(named + self.file).hexdigest()

    def _encoder(self) -> Callable[[list[str]], list[int]]:
        if self.kind == ".model":
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_proto=self.file)
            return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        from tokenizers import Tokenizer as Loaded
        model = Loaded.from_str(self.file.decode())
        model.no_truncation()
        model.no_padding()
        return lambda texts: [len(e.ids) for e in model.encode_batch(texts, add_special_tokens=False)]

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_held": None}

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text as the library gives them."""
        if self._held is None:
            self._held = self._encoder(), {}
        encode, memo = self._held
        if not self.by_words:
            return encode(texts)
        return [encode([t])[0] if _MARK in t else _by_words(t, encode, memo) for t in texts]


def _by_words(text: str, encode: Callable[[list[str]], list[int]], memo: dict[str, int]) -> int:
    if not text:
        return 0
    # a word comes with the spaces in front of it, of which the first is left out here
    words = Counter(m.group(1) for m in _WORD.finditer(" " + text)) if "  " in " " + text else Counter(text.split(" "))
    missing = [w for w in words if w not in memo]
    if missing:
        if len(memo) + len(missing) > MEMO_WORDS:
            missing, _ = list(words), memo.clear()
        # behind a letter, so that the spaces count as inner ones; the letter is one token
        memo.update(zip(missing, (n - 1 for n in encode(["a " + w for w in missing]))))
    tokens = sum(map(operator.mul, map(memo.__getitem__, words), words.values()))
    for word in missing:
        if len(word) > MEMO_CHARS:
            del memo[word]
    return tokens


def _words_stand_alone(file: bytes) -> bool:
    """Whether no merge can cross the start of a word and texts are encoded as they stand."""
    import sentencepiece
    try:
        from sentencepiece import sentencepiece_model_pb2 as formats
        model = formats.ModelProto()
        model.ParseFromString(file)
    except ImportError:
        return False
    rules, normal, special = model.trainer_spec, model.normalizer_spec, formats.ModelProto.SentencePiece
    pieces = [p.piece for p in model.pieces if p.type not in (special.CONTROL, special.UNKNOWN, special.BYTE)]
    loaded = sentencepiece.SentencePieceProcessor(model_proto=file)
    return (rules.model_type == rules.BPE and not normal.precompiled_charsmap and normal.add_dummy_prefix
            and normal.escape_whitespaces and not normal.remove_extra_whitespaces and not rules.treat_whitespace_as_suffix
            and not any(re.search(f"[^{_MARK}]{_MARK}", p) for p in pieces) and len(loaded.encode("a")) == 1)


def _content(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(_content(text), 256))


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """``digest, n_bytes, n_tokens`` of one version, one row per digest; empty where nothing is stored yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], CACHE_SCHEMA).drop("version")
    stored = spark.read.schema(CACHE_SCHEMA).parquet(path).filter(F.col("version") == version)
    return stored.groupBy("digest").agg(F.min("n_bytes").alias("n_bytes"), F.min("n_tokens").alias("n_tokens"))


def add_missing(docs: DataFrame, tokenizer: Tokenizer, cache: str, text: str = "text") -> None:
    """Encode each distinct text that the cache does not hold once, and append the counts.

    A few missing texts are picked out of the scan by their digests; many are shuffled, one per digest and task.
    """
    spark, version = docs.sparkSession, tokenizer.version()
    texts = docs.select(_digest(text).alias("digest"), _content(text).alias("content"))
    known = read_cache(spark, cache, version).select("digest")
    if known.isEmpty():
        missing = texts.dropDuplicates(["digest"])
    else:
        wanted = cut_lineage(texts.select("digest").distinct().join(known, "digest", "left_anti"))
        if is_bounded(wanted):
            missing = texts.join(F.broadcast(wanted), "digest", "left_semi").dropDuplicates(["digest"])
        else:
            missing = texts.dropDuplicates(["digest"]).join(wanted, "digest", "left_semi")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, tokens = batch["content"], []
            for at in range(0, len(texts), 64):  # only so many texts exist as Python strings at a time
                tokens += tokenizer.counts(texts.slice(at, 64).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch["digest"], pc.binary_length(texts).cast(pa.int64()), pa.array(tokens, pa.int64())],
                ["digest", "n_bytes", "n_tokens"])

    counted = missing.mapInArrow(encode, "digest binary, n_bytes long, n_tokens long")
    counted.select(F.lit(version).alias("version"), "digest", "n_bytes", "n_tokens").write.mode("append").parquet(cache)


def count_tokens(docs: DataFrame, tokenizer: Tokenizer, cache: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes`` and ``n_tokens`` of their texts, by way of the cache table at ``cache``."""
    add_missing(docs, tokenizer, cache, text)
    key = unused(docs, "_digest")
    stored = read_cache(docs.sparkSession, cache, tokenizer.version()).withColumnRenamed("digest", key)
    return docs.drop("n_bytes", "n_tokens").withColumn(key, _digest(text)).join(stored, key).drop(key)
