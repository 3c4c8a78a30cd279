"""Sweeps over sampling parameters, and merges of rows with defaults and registries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def axis(spark: SparkSession, name: str, values: list) -> DataFrame:
    kind = "string" if values and isinstance(values[0], str) else "double"
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"{name}_i int, {name} {kind}")


def expand(rows: DataFrame, axes: dict[str, list], order: str = "ord") -> DataFrame:
    """rows times the axes given, in row-major order (variant_no within a row); an axis not given keeps the row's value.

    The axes are literals of the call, exploded within the row, so nothing is joined.
    """
    out, place = rows, F.lit(0)
    for name, values in axes.items():
        if not values:
            continue
        out = out.drop(name).select("*", F.posexplode(F.array(*[F.lit(v) for v in values])).alias(f"{name}_i", name))
        place = place * len(values) + F.col(f"{name}_i")
    return out.withColumn("variant_no", place).drop(*[f"{n}_i" for n in axes])


def merge_defaults(rows: DataFrame, defaults: dict[str, float], has_tools: Column, tool_penalty: float | None = None, penalty: str = "repetition_penalty") -> DataFrame:
    """Each parameter of the row, else the default; the penalty for tools holds where the row has tools and none of its own."""
    fills = {k: F.coalesce(F.col(k), F.when(has_tools, F.lit(tool_penalty)) if k == penalty and tool_penalty is not None else F.lit(None), F.lit(v)) for k, v in defaults.items()}
    return rows.withColumns(fills)


def resolve_domain(rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """rows with domain: their own, else their category's; of repeated aliases the later wins. aliases (category, domain, pos)."""
    last = aliases.groupBy("category").agg(F.max_by("domain", "pos").alias("alias_domain"))
    return rows.join(last, "category", "left").withColumn("domain", F.coalesce("domain", "alias_domain")).drop("alias_domain")


def domain_gap(rows: DataFrame, domains: DataFrame) -> DataFrame:
    """(domain, target, have, gap, ratio, done) for every domain; done: at least 0.8 of the target."""
    have = rows.groupBy("domain").agg(F.count(F.lit(1)).alias("h"))
    out = domains.join(have, "domain", "left").withColumn("have", F.coalesce("h", F.lit(0)).cast("long"))
    return out.select("domain", "target", "have", F.greatest(F.lit(0), F.col("target") - F.col("have")).cast("long").alias("gap"), F.bround(F.try_divide("have", "target"), 4).alias("ratio"), (F.col("have") >= 0.8 * F.col("target")).alias("done"))


def scale_targets(domains: DataFrame, total: int) -> DataFrame:
    """domains with their targets scaled to a total, rounded half to even, one at least."""
    now = domains.agg(F.sum("target")).first()[0] or 1
    return domains.withColumn("target", F.greatest(F.lit(1), F.bround(F.col("target") * (total / now))).cast("long"))


def merge_by_name(left: DataFrame, right: DataFrame, name: str = "name", order: str = "ord") -> DataFrame:
    """The union by name: the right side's entry wins, the first-seen position stays."""
    rest = [c for c in left.columns if c not in (name, order)]
    both = reduce(DataFrame.unionByName, [left.withColumn("side", F.lit(0)), right.withColumn("side", F.lit(1))])
    agg = both.groupBy(name).agg(F.max_by(F.struct(*rest), F.struct("side", order)).alias("x"), F.min(F.struct("side", order)).alias("p"))
    return agg.select(name, "x.*", F.col("p.side").alias("first_side"), F.col(f"p.{order}").alias("first_ord"))


def presets(asked: DataFrame, known: DataFrame, key: str = "style_id") -> DataFrame:
    """asked with the presets of their ids; an unknown id is an error when its row is computed."""
    met = asked.join(known.withColumn("preset__known", F.lit(True)), key, "left")
    checked = F.when(F.col("preset__known"), F.col(key)).otherwise(F.raise_error(F.concat(F.lit("unknown style "), F.coalesce(F.col(key), F.lit("null")))))
    return met.withColumn(key, checked).drop("preset__known")


def open_domains(domains: DataFrame, counts: DataFrame, share: float = 0.8) -> DataFrame:
    """domains (domain, target) that counts (domain, have) hold less than share of."""
    return domains.join(counts, "domain", "left").withColumn("have", F.coalesce("have", F.lit(0))).filter(F.col("have") < F.col("target") * share)


def seed_rows(rows: DataFrame, prompt: str = "prompt", domain: str = "domain") -> DataFrame:
    """rows with an id in the form of a UUID, made from prompt and domain, so that a rerun gives the same."""
    h = F.md5(F.concat_ws("\n", F.col(domain), F.col(prompt)))
    return rows.withColumn("id", F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]))
