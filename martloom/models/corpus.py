"""Term weights of a text corpus and the toxicity classifier built on them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.joins import lookup_join
from martloom.session import cut_lineage
from martloom.sizing import broadcast_if_bounded

# Frequent English words that carry no topic.
STOP_WORDS = ["a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "from", "has", "have", "he", "in", "is", "it",
              "its", "not", "of", "on", "or", "she", "that", "the", "their", "they", "this", "to", "was", "we", "were", "which",
              "will", "with", "you"]


def term_counts(documents: DataFrame, key: str, text: str, stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """``key, term, n`` over whole texts, stop words left out.

    Terms are counted text by text where the text lies; only texts whose key stands on several rows are shuffled.
    """
    @F.arrow_udf("array<struct<term:string,n:bigint>>")
    def counted(texts: pa.Array) -> pa.Array:
        lists = pc.split_pattern_regex(texts, r"\P{L}+")  # runs of letters, as ``words`` finds them, and empty ends
        found = lists.flatten().dictionary_encode()
        kept = np.flatnonzero(~np.isin(found.indices.to_numpy(zero_copy_only=False), np.flatnonzero(
            pc.is_in(found.dictionary, pa.array(["", *stop_words], found.dictionary.type)).to_numpy(zero_copy_only=False))))
        row = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))[kept]
        size = max(len(found.dictionary), 1)
        pairs, n = np.unique(row * size + found.indices.to_numpy(zero_copy_only=False)[kept], return_counts=True)
        starts = np.searchsorted(pairs // size, np.arange(len(lists) + 1)).astype("int32")
        terms = found.dictionary.take(pa.array(pairs % size)).cast(pa.string())
        return pa.ListArray.from_arrays(pa.array(starts), pa.StructArray.from_arrays([terms, pa.array(n, pa.int64())], ["term", "n"]))

    def by_text(rows: DataFrame) -> DataFrame:
        return rows.select(key, F.inline(counted(F.lower(F.col(text)))))

    repeated = cut_lineage(documents.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1").select(F.col(key).alias("_key")))
    if repeated.isEmpty():
        return by_text(documents)
    same = F.col(key).eqNullSafe(F.col("_key"))
    few = broadcast_if_bounded(repeated)
    merged = by_text(documents.join(few, same, "left_semi")).groupBy(key, "term").agg(F.sum("n").alias("n"))
    return by_text(documents.join(few, same, "left_anti")).unionByName(merged)


def tf_idf(documents: DataFrame, key: str, text: str, stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """``key, term, n, weight``: count times ``ln((documents + 1) / (documents with term + 1))``.

    Term counts are written once and used twice.  The weights of the vocabulary are
    broadcast while it is small; otherwise frequent terms are dealt over salted tasks.
    """
    counts = cut_lineage(term_counts(documents, key, text, stop_words))
    total = documents.agg(F.count("*").alias("n")).scalar()
    # one row per word of the vocabulary, counted for the size check and then joined
    weights = cut_lineage(counts.groupBy("term").agg(F.count("*").alias("df"))
                          .select("term", F.log((total + 1) / (F.col("df") + 1)).alias("idf")))
    return lookup_join(counts, weights, ["term"]).select(key, "term", "n", (F.col("n") * F.col("idf")).alias("weight"))


def text_classifier(text: str = "text", label: str = "label", features: int = 1 << 16, l1: float = 0.0, strength: float = 0.01,
                    iterations: int = 30) -> Pipeline:
    """Tokens, stop words, hashed counts, inverse document frequency, logistic regression.

    Hashing needs no vocabulary on the driver; the rarer class may be weighted by a
    ``weight`` column.
    """
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=r"[^\p{L}]+", toLowercase=True),
        StopWordsRemover(inputCol="_tokens", outputCol="_kept", stopWords=STOP_WORDS),
        HashingTF(inputCol="_kept", outputCol="_counts", numFeatures=features),
        IDF(inputCol="_counts", outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol=label, weightCol="weight", elasticNetParam=l1, regParam=strength, maxIter=iterations)])


def balanced(df: DataFrame, label: str = "label") -> DataFrame:
    """Add a ``weight`` that gives both classes the same total."""
    share = df.agg(F.avg(F.col(label).cast("double")).alias("s")).scalar()
    return df.withColumn("weight", F.when(F.col(label) == 1, 0.5 / share).otherwise(0.5 / (1 - share)))
