"""Mixing sources to target weights by systematic sampling.

A document's size is its number of words (runs of characters that aren't ASCII white space). The mix takes `share` times
all sizes; sources, by code point and null last, get the weights in turn; a source's target stops at `most` times its
size, and the excess is shared again by weight until no source is above. Each document of a source expects
target / size of the source copies of itself; over the source's documents in order of size these expectations are summed,
one random offset (a hash of seed and source) is added, and a document is emitted once for each integer boundary its
interval crosses: at most ceil(most) times. The order by size makes the words taken follow the target closely.

The sums run over ranges dealt to many tasks (common.ranked), so a source may hold any share of the rows. All that
reaches the driver is the level of the weights, one number.

Defined results: a null text has size 0; sources without words have target 0 and are never taken; an empty table gives
no rows; rows of one source and size are taken in order of their id, then of a hash of the whole row, so that reruns agree however
rows are dealt to tasks; repeated rows are documents of their own. The numbering samples the order of the narrow rows for its ranges: what that sends to the driver grows with the number of
tasks (some 100 rows a range), not of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ranked, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(df: DataFrame, seed: int = 0) -> Column:
    """A hash of all columns of a row and of which of them are null."""
    every = [F.col(f"`{c}`") for c in df.columns]
    return F.xxhash64(F.lit(seed), *every, *[c.isNull() for c in every])


def _offset(seed: int, source: str) -> Column:
    """In [0, 1): the first 52 bits of the md5 of seed and source."""
    named = F.when(F.col(source).isNull(), F.lit(str(seed))).otherwise(F.concat(F.lit(f"{seed}:"), F.col(source)))
    return F.conv(F.substring(F.md5(named), 1, 13), 16, 10).cast("long") / F.lit(2.0**52)


def targets(sized: DataFrame, share: float, most: float, weights: tuple[float, ...]) -> DataFrame:
    """(source, source_size, target) of sized (source, size)."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = ranked(sums, [], ["source"], "place", "sources")
    turn = F.pmod("place", F.lit(len(weights)))
    weight = F.lit(float(weights[0]))
    for i, w in enumerate(weights):
        weight = F.when(turn == i, F.lit(float(w))).otherwise(weight)
    placed = stored(placed.withColumn("weight", weight), "weights")
    everything, heaviness = placed.agg(F.sum("source_size"), F.sum("weight")).first()
    total = share * (everything or 0)
    level, full = total / heaviness if heaviness else 0.0, 0
    while True:  # the level rises, and sources that reach their bound leave it to the others
        over = F.lit(level) * F.col("weight") > most * F.col("source_size")
        n, held, rest = placed.agg(F.count_if(over), F.coalesce(F.sum(F.when(over, most * F.col("source_size"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0))).first()
        if n == full or not rest:
            break
        level, full = (total - held) / rest, n
    return placed.select("source", "source_size", F.least(F.lit(level) * F.col("weight"), most * F.col("source_size")).cast("double").alias("target"))


def copies(docs: DataFrame, keep: list[str], source_col: str = "source", share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = WEIGHTS, seed: int = 9) -> DataFrame:
    """Of docs with columns keep (they order the rows of one size), source and size: these, source_size, target, copies."""
    narrow = stored(docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{source_col}`").alias("source"), "size"), "sizes")
    goal = targets(narrow, share, most, weights).select(F.col("source").alias("of"), "source_size", "target")
    place = ranked(narrow, ["source"], ["size", *keep], "place", "places")
    held = place.join(goal, F.col("source").eqNullSafe(F.col("of")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    held = held.withColumn("rate", rate).withColumn("offset", _offset(seed, "source"))
    crossed = F.floor((F.col("place") + 1) * F.col("rate") + F.col("offset")) - F.floor(F.col("place") * F.col("rate") + F.col("offset"))
    return held.select(*keep, "source", "size", "source_size", "target", crossed.cast("long").alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """docs as the mix takes them: each row as often as it is emitted, with its own columns."""
    every = [F.col(f"`{c}`") for c in docs.columns]
    # Rows that are alike in all columns are one row with a count: a row that is repeated without end isn't gathered, and its copies need no sharing out.
    tagged = docs.select(row_hash(docs).alias("mix__a"), row_hash(docs, 1).alias("mix__b"), F.struct(*every).alias("mix__row"))
    sized = docs.select(F.col(f"`{id_col}`").alias("mix__id"), row_hash(docs).alias("mix__a"), row_hash(docs, 1).alias("mix__b"), F.col(f"`{source_col}`").alias("source"), size_of(text_col).alias("size"))
    taken = copies(sized, ["mix__id", "mix__a", "mix__b"], "source", **how)
    taken = taken.groupBy("mix__a", "mix__b").agg(F.sum("copies").cast("int").alias("mix__n")).filter("mix__n > 0")
    single = tagged.groupBy("mix__a", "mix__b").agg(F.first("mix__row").alias("mix__row"))
    again = single.join(taken, ["mix__a", "mix__b"]).withColumn("mix__copy", F.explode(F.array_repeat(F.lit(0), F.col("mix__n"))))
    return again.select(*[F.col("mix__row")[c].alias(c) for c in docs.columns])


#: DuckDB SQL for the rows of the query.
SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM d GROUP BY source
), level AS (
  SELECT 0 AS i, 1.5::DOUBLE * (SELECT sum(source_size) FROM s)::DOUBLE / (SELECT sum(weight) FROM s) AS x
  UNION ALL
  SELECT i + 1, (SELECT (1.5::DOUBLE * sum(source_size)::DOUBLE - coalesce(sum(2.0::DOUBLE * source_size) FILTER (level.x * weight > 2.0::DOUBLE * source_size), 0))
                   / sum(weight) FILTER (level.x * weight <= 2.0::DOUBLE * source_size) FROM s)
  FROM level WHERE i < 40
), t AS (
  SELECT source, source_size, least((SELECT x FROM level WHERE i = 40) * weight, 2.0::DOUBLE * source_size) AS target FROM s
), p AS (
  SELECT doc_id, size, source_size, target,
         (row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id) - 1)::DOUBLE AS place,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         ('0x' || substr(md5(CASE WHEN d.source IS NULL THEN '9' ELSE '9:' || d.source END), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, ((floor((place + 1) * rate + u) - floor(place * rate + u)) * size)::BIGINT AS taken FROM p
"""
