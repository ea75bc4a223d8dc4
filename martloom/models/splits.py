"""Exact best splits of a regression tree: every distinct value is a candidate, not only the edges of some bins.

Rows are added up per node, feature and value, with map-side combine, so what is sorted is one row per
distinct value.  A running total over all of them in one order gives the sums left of every candidate;
no task holds a node or a feature.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.ordering import running_totals
from martloom.session import cut_lineage


def best_splits(df: DataFrame, features: list[str], label: str, node: str = "node") -> DataFrame:
    """Per node the split ``feature <= threshold`` that takes most off the squared error.

    Returns ``node, feature, threshold, gain, n_left, n_right``; the gain is per row of the node that
    has the feature.  Equal gains go to the first feature by name, then to the smallest threshold.  Rows without the
    feature or the label do not take part in its candidates; a node whose features have one value each has no split.
    """
    named = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])).alias("_cell")
    cells = df.filter(F.col(label).isNotNull()).select(F.col(node).alias("node"), F.col(label).cast("double").alias("label"), named)
    counted = (cells.filter("_cell.value IS NOT NULL").groupBy("node", "_cell.feature", "_cell.value")
               .agg(F.count("*").alias("n"), F.sum("label").alias("s")))
    upto = cut_lineage(running_totals(counted, [F.col("node"), F.col("feature"), F.col("value")], {"n_upto": F.col("n"), "s_upto": F.col("s")})
                       .select("node", "feature", "value", "n", "s", "n_upto", "s_upto"))
    # one row per node and feature: its totals and what stands before it in the order
    groups = upto.groupBy("node", "feature").agg(
        F.sum("n").alias("n_all"), F.sum("s").alias("s_all"), F.min(F.col("n_upto") - F.col("n")).alias("n_before"),
        F.min_by(F.col("s_upto") - F.col("s"), "n_upto").alias("s_before"))
    sides = upto.join(groups, ["node", "feature"]).withColumns({
        "n_left": F.col("n_upto") - F.col("n_before"), "s_left": F.col("s_upto") - F.col("s_before")})
    n_right, s_right = F.col("n_all") - F.col("n_left"), F.col("s_all") - F.col("s_left")
    gain = (F.col("s_left") ** 2 / F.col("n_left") + s_right ** 2 / n_right - F.col("s_all") ** 2 / F.col("n_all")) / F.col("n_all")
    cuts = sides.filter(n_right > 0).select("node", "feature", F.col("value").alias("threshold"), gain.alias("gain"), "n_left", n_right.alias("n_right"))
    first = F.min(F.struct((-F.col("gain")).alias("loss"), "feature", "threshold", "gain", "n_left", "n_right")).alias("_best")
    return cuts.groupBy("node").agg(first).select("node", *[f"_best.{c}" for c in ("feature", "threshold", "gain", "n_left", "n_right")])


def grown(df: DataFrame, features: list[str], label: str, levels: int) -> DataFrame:
    """The splits of the first levels of a tree: ``level`` from 1 and the columns of ``best_splits``.

    The root is node 1; the sides of node ``k`` are ``2 k`` (up to the threshold) and ``2 k + 1``.  The splits
    of a level are at most ``2 ** (level - 1)`` rows, which become one expression for the next.
    """
    rows, found = df.withColumn("node", F.lit(1).cast("bigint")), []
    for level in range(1, levels + 1):
        splits = cut_lineage(best_splits(rows, features, label))
        found.append(splits.withColumn("level", F.lit(level)))
        if level < levels:
            rows = rows.withColumn("node", _next_node(splits)).filter(F.col("node").isNotNull())
    return reduce(DataFrame.unionByName, found)


def _next_node(splits: DataFrame) -> Column:
    """The node below for a row; none where its node has no split or the row lacks the feature."""
    below = F.lit(None).cast("bigint")
    for split in splits.collect():
        side = F.when(F.col(split.feature) <= split.threshold, 2 * split.node).when(F.col(split.feature) > split.threshold, 2 * split.node + 1)
        below = F.when(F.col("node") == split.node, side).otherwise(below)
    return below
