"""Mixing sources to target weights by Sainte-Lague apportionment.

Sources in code-point order, null last, weigh 1, 2, 3, 1, 2, 3, ... and share all tokens by
weight; no target exceeds ``most_repeats`` times the source's own size, and what is cut off
is shared again among the others.

The corpus is dealt over shards of about ``shard_words`` tokens, so that a source is cut
into cells of bounded size.  Each shard has as many blocks of ``block_words`` tokens as its
cells' shares of the targets add up to, and gives them to its sources by the highest
quotients votes / 1, 3, 5, ...  All quotients up to a divisor that is surely too large, and
none beyond one surely too small, need not be looked at: what is ranked is about two
quotients per source and shard.  A cell then takes its quota of blocks: whole rounds of
its documents first, the rest in seeded order, the last document in part.

Everything is DataFrame code.  Null and empty texts have size 0 and take 0.  Null sources
are one source, the last.  Equal rows are equal in every result.  Where all sizes are 0,
all targets are 0.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.operators.ordering import global_row_number
from martloom.session import cut_lineage

BLOCK_WORDS = 8
SHARD_WORDS = 500_000
MOST_REPEATS = 3
SEED = 17
_SCALE = 1000  # votes are whole thousandths of a token, so that their sums do not depend on order


def place_text(seed: int) -> Column:
    """Hex digest that deals a row to its shard and its turn; a whole row and the seed decide it."""
    return F.md5(F.concat_ws("\x01", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")),
                             F.coalesce("text", F.lit(""))))


def source_targets(sizes: DataFrame, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """``source, source_size, target`` from ``source, size``.

    The level of a weight of 1 is found round by round, as the definition says: share what
    is left by weight, fix the sources above their limit, share again.  Each round is one
    small aggregation with one row for the driver.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = global_row_number(totals, [F.col("source").asc_nulls_last()], "place")
    weighed = cut_lineage(placed.withColumn("weight", F.pmod(F.col("place") - 1, F.lit(3)) + 1).drop("place"))
    limit = (F.col("source_size") * most_repeats).cast("double")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, before = 0.0, -1
    while True:
        over = limit <= F.col("weight") * level
        n, fixed, open_weight = weighed.agg(
            F.count(F.when(over, 1)), F.coalesce(F.sum(F.when(over, F.col("source_size") * most_repeats)), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0))).first()
        if n == before or not open_weight:
            break
        before, level = n, (total - fixed) / open_weight
    return weighed.select("source", "source_size", F.least(limit, F.col("weight") * level).alias("target"))


def quotas(cells: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``shard, source, blocks`` from ``shard, source, votes`` (thousandths of a token).

    Sainte-Lague within each shard.  With n cells and N blocks, the divisor V / (N - n / 2)
    gives no cell too much and V / (N + n / 2) gives none too little; only the quotients
    between the two are ranked.
    """
    shard = Window.partitionBy("shard")
    known = (cells.withColumn("all_votes", F.sum("votes").over(shard)).withColumn("n", F.count("*").over(shard))
             .withColumn("seats", F.floor(F.col("all_votes") / (block_words * _SCALE) + 0.5)))
    per_vote_low = F.greatest(F.col("seats") - F.col("n") / 2, F.lit(0.0)) / F.col("all_votes")
    per_vote_high = (F.col("seats") + F.col("n") / 2) / F.col("all_votes")
    bounded = (known.withColumn("low", F.when(F.col("votes") > 0, F.floor(F.col("votes") * per_vote_low + 0.5)).otherwise(0))
               .withColumn("high", F.when(F.col("votes") > 0, F.floor(F.col("votes") * per_vote_high + 0.5) + 1).otherwise(0)))
    tried = (bounded.withColumn("open", F.col("seats") - F.sum("low").over(shard))
             .filter("high > low").withColumn("seat", F.explode(F.sequence("low", F.col("high") - 1)))
             .withColumn("quotient", F.col("votes") / (2 * F.col("seat") + 1)))
    turn = shard.orderBy(F.desc("quotient"), F.col("source").asc_nulls_last())
    won = (tried.withColumn("turn", F.row_number().over(turn)).filter(F.col("turn") <= F.col("open"))
           .groupBy("shard", F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("unnamed"))
           .agg(F.count("*").alias("won")))
    return (bounded.withColumn("name", F.coalesce("source", F.lit(""))).withColumn("unnamed", F.col("source").isNull())
            .join(won, ["shard", "name", "unnamed"], "left")
            .select("shard", "source", "name", "unnamed", (F.col("low") + F.coalesce("won", F.lit(0))).alias("blocks")))


def mix_sources(docs: DataFrame, seed: int = SEED, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
                most_repeats: int = MOST_REPEATS) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every row."""
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")
    sizes = cut_lineage(docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"), place_text(seed).alias("place")))
    targets = source_targets(sizes, most_repeats)
    total = targets.agg(F.sum("source_size")).first()[0] or 0
    shards = max(1, round(total / shard_words))
    named = {"name": F.coalesce("source", F.lit("")), "unnamed": F.col("source").isNull()}
    dealt = sizes.withColumn("shard", F.conv(F.substring("place", 1, 8), 16, 10).cast("bigint") % shards).withColumns(named)
    of_source = targets.withColumns(named).drop("source")
    cells = (dealt.groupBy("shard", "name", "unnamed").agg(F.max("source").alias("source"), F.sum("size").alias("words"))
             .join(of_source, ["name", "unnamed"])
             .withColumn("votes", F.when(F.col("words") > 0, F.floor(F.col("target") * F.col("words") / F.col("source_size") * _SCALE)).otherwise(0)))
    # one row for each shard and source, with its size, target and quota
    cells = cut_lineage(cells)
    quota = cut_lineage(cells.drop("source").join(quotas(cells.select("shard", "source", "votes"), block_words).drop("source"),
                                                  ["shard", "name", "unnamed"]))
    wanted = F.least(F.col("blocks") * block_words, F.col("words") * most_repeats)
    rounds = F.when(F.col("words") > 0, F.floor(wanted / F.col("words"))).otherwise(0)
    before = F.coalesce(F.sum("size").over(
        Window.partitionBy("shard", "name", "unnamed").orderBy("place", "size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.least(F.greatest(F.col("wanted") - F.col("rounds") * F.col("words") - F.col("before"), F.lit(0)), F.col("size"))
    return (dealt.withColumn("before", before).join(quota, ["shard", "name", "unnamed"])
            .withColumn("wanted", wanted).withColumn("rounds", rounds)
            .select("doc_id", "source", "size", "source_size", "target", (F.col("rounds") * F.col("size") + rest).cast("bigint").alias("taken")))


MIX_SQL = """
WITH RECURSIVE sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('{seed}' || chr(1) || coalesce(doc_id::VARCHAR, '-') || chr(1) || coalesce(text, '')) AS place
  FROM {documents}),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighed AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM totals),
total AS (SELECT sum(source_size)::BIGINT AS t FROM weighed),
levels(level, step) AS (
  SELECT 0.0::DOUBLE, 0
  UNION ALL
  SELECT (SELECT CASE WHEN coalesce(sum(CASE WHEN {repeats} * source_size <= weight * level THEN 0 ELSE weight END), 0) = 0 THEN level
          ELSE ((SELECT t FROM total) - coalesce(sum(CASE WHEN {repeats} * source_size <= weight * level THEN {repeats} * source_size END), 0))::DOUBLE
               / sum(CASE WHEN {repeats} * source_size <= weight * level THEN 0 ELSE weight END)::DOUBLE END FROM weighed), step + 1
  FROM levels WHERE step <= (SELECT count(*) FROM weighed)),
targets AS (SELECT source, source_size, least({repeats} * source_size::DOUBLE, weight * (SELECT max(level) FROM levels)) AS target FROM weighed),
shards AS (SELECT greatest(1, round(t / {shard_words}.0))::BIGINT AS n FROM total),
dealt AS (SELECT *, ('0x' || substr(place, 1, 8))::BIGINT % (SELECT n FROM shards) AS shard FROM sizes),
cells AS (SELECT shard, d.source, sum(size)::BIGINT AS words, any_value(source_size) AS source_size, any_value(target) AS target
  FROM dealt d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source GROUP BY ALL),
voted AS (SELECT *, CASE WHEN words > 0 THEN floor(target * words / source_size * 1000)::BIGINT ELSE 0 END AS votes FROM cells),
known AS (SELECT *, (sum(votes) OVER (PARTITION BY shard))::BIGINT AS all_votes, count(*) OVER (PARTITION BY shard) AS n FROM voted),
seated AS (SELECT *, floor(all_votes / {block}000.0::DOUBLE + 0.5)::BIGINT AS seats FROM known),
bounded AS (SELECT *,
  CASE WHEN votes > 0 THEN floor(votes * (greatest(seats - n / 2.0::DOUBLE, 0.0::DOUBLE) / all_votes) + 0.5)::BIGINT ELSE 0 END AS low,
  CASE WHEN votes > 0 THEN floor(votes * ((seats + n / 2.0::DOUBLE) / all_votes) + 0.5)::BIGINT + 1 ELSE 0 END AS high FROM seated),
opened AS (SELECT *, seats - sum(low) OVER (PARTITION BY shard) AS open FROM bounded),
tried AS (SELECT shard, source, open, votes / (2 * seat + 1)::DOUBLE AS quotient
  FROM (SELECT *, unnest(range(low, high)) AS seat FROM opened WHERE high > low)),
won AS (SELECT shard, source, count(*) AS won FROM (
  SELECT *, row_number() OVER (PARTITION BY shard ORDER BY quotient DESC, source NULLS LAST) AS turn FROM tried) WHERE turn <= open GROUP BY ALL),
quota AS (SELECT b.*, least((low + coalesce(won, 0)) * {block}, words * {repeats}) AS wanted
  FROM bounded b LEFT JOIN won w ON b.shard = w.shard AND b.source IS NOT DISTINCT FROM w.source),
placed AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY shard, source ORDER BY place, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM dealt)
SELECT doc_id, size, source_size, target,
  (CASE WHEN words > 0 THEN wanted // words ELSE 0 END * size
   + least(greatest(wanted - CASE WHEN words > 0 THEN wanted // words ELSE 0 END * words - before, 0), size))::BIGINT AS taken
FROM placed p JOIN quota q ON p.shard = q.shard AND p.source IS NOT DISTINCT FROM q.source
"""


def mix_sql(documents: str = "documents", seed: int = SEED, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
            most_repeats: int = MOST_REPEATS) -> str:
    """The same mix in DuckDB SQL, over the table of the given name."""
    return MIX_SQL.format(documents=documents, seed=seed, block=block_words, shard_words=shard_words, repeats=most_repeats)
