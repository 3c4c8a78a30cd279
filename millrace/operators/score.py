"""Composition of signal scores, and the decisions made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BELOW = "BELOW_THRESHOLD"


def mean_score(signals: Column) -> Column:
    """The plain mean of the signals' scores; 0 without signals."""
    total = F.aggregate(signals["score"], F.lit(0.0), lambda a, x: a + x)
    return F.coalesce(F.try_divide(total, F.size(signals)), F.lit(0.0))


def hard_codes(signals: Column) -> Column:
    return F.transform(F.filter(signals, lambda s: s["hard"]), lambda s: s["code"])


def compose(stat: Column, llm: Column, w_stat: float = 0.4, w_llm: float = 0.6) -> Column:
    """Weighted mean; the stat score alone without an llm score; 0 if the weights aren't positive."""
    total = w_stat + w_llm
    both = (stat * w_stat + llm * w_llm) / total if total > 0 else F.lit(0.0)
    return F.when(llm.isNull(), stat).otherwise(both)


def maps(signals: Column) -> list[Column]:
    """versions, scores and raw values by code."""
    by = lambda field: F.map_from_entries(F.transform(signals, lambda s: F.struct(s["code"], s[field])))
    return [by("version").alias("signal_versions"), by("score").alias("signal_scores"), by("raw").alias("signal_raw")]


def composite(evaluated: DataFrame, llm: Column | None = None, w_stat: float = 0.4, w_llm: float = 0.6) -> DataFrame:
    """What evaluate() gives, with stat_score, final_score, hard and the maps in place of the signals."""
    s = F.col("signals")
    out = evaluated.withColumn("stat_score", mean_score(s)).withColumn("llm_score", llm if llm is not None else F.lit(None).cast("double"))
    out = out.withColumn("final_score", compose(F.col("stat_score"), F.col("llm_score"), w_stat, w_llm)).withColumn("hard", hard_codes(s))
    return out.select("*", *maps(s)).drop("signals")


def select(scored: DataFrame, threshold: float | None = None, top_k: int | None = None, keep_rate: float | None = None, score: str = "final_score", order: str = "ord") -> DataFrame:
    """scored with accepted and rejected_by. keep_rate goes before top_k, and that before threshold.

    Only rows without hard reasons compete; ties go to the earlier. The k best are found by sorting, not by a window
    over all rows: what goes on is one boundary row.
    """
    alive = F.size("hard") == 0
    if keep_rate is None and top_k is None:
        wins = alive & (F.col(score) >= (threshold or 0.0))
    else:
        rivals = scored.filter(alive)
        k = top_k if keep_rate is None else rivals.agg(F.bround(F.lit(keep_rate) * F.count(F.lit(1))).cast("int")).first()[0]
        if k <= 0:
            wins = F.lit(False)
        else:
            best = rivals.select(score, order).orderBy(F.desc(score), F.asc(order)).limit(k)
            edge = best.orderBy(F.asc(score), F.desc(order)).limit(1).select(F.col(score).alias("edge_score"), F.col(order).alias("edge_order"))
            scored = scored.join(F.broadcast(edge), how="left", on=F.lit(True))  # one row
            wins = alive & ((F.col(score) > F.col("edge_score")) | ((F.col(score) == F.col("edge_score")) & (F.col(order) <= F.col("edge_order"))))
    wins = F.coalesce(wins, F.lit(False))
    reasons = F.when(wins, F.array().cast("array<string>")).when(alive, F.array(F.lit(BELOW))).otherwise(F.col("hard"))
    return scored.withColumn("accepted", wins).withColumn("rejected_by", reasons).drop("edge_score", "edge_order")


def screening_label(final: Column, hard: Column, ok_min: float = 0.75, review_min: float = 0.4) -> Column:
    return F.when(F.size(hard) > 0, "NG").when(final >= ok_min, "OK").when(final >= review_min, "REVIEW").otherwise("NG")


def review_quota(labelled: DataFrame, max_rate: float, score: str = "final_score", order: str = "ord", label: str = "screening_label") -> DataFrame:
    """labelled with at most floor(max_rate * rows) REVIEW rows; the lowest scores are demoted to NG, earlier ones first."""
    total, held = labelled.agg(F.count(F.lit(1)), F.count_if(F.col(label) == "REVIEW")).first()
    over = held - int(max_rate * total)
    if over <= 0:
        return labelled
    edge = labelled.filter(F.col(label) == "REVIEW").select(score, order).orderBy(score, order).limit(over).orderBy(F.desc(score), F.desc(order)).limit(1)
    edge = edge.select(F.col(score).alias("edge_score"), F.col(order).alias("edge_order"))
    low = (F.col(score) < F.col("edge_score")) | ((F.col(score) == F.col("edge_score")) & (F.col(order) <= F.col("edge_order")))
    out = labelled.join(F.broadcast(edge), on=F.lit(True), how="left")  # one row
    return out.withColumn(label, F.when((F.col(label) == "REVIEW") & low, "NG").otherwise(F.col(label))).drop("edge_score", "edge_order")


def sample_outliers(scored: DataFrame, z_min: float = -2.0, least: int = 5, by: tuple[str, ...] = ("temperature", "top_p"), score: str = "final_score") -> DataFrame:
    """scored with SAMP-OUT among the hard reasons of rows far below their sampling bucket; all rows count in a bucket.

    Buckets are few and large, so their figures are aggregated and joined, not computed by a window over their rows.
    """
    stats = scored.groupBy(*by).agg(F.count(F.lit(1)).alias("bucket_n"), F.avg(score).alias("bucket_mean"), F.stddev_pop(score).alias("bucket_sd"))
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by]
    met = scored.alias("a").join(stats.alias("b"), on).select("a.*", "bucket_n", "bucket_mean", "bucket_sd")
    z = F.when((F.col("bucket_n") >= least) & (F.col("bucket_sd") > 0), F.try_divide(F.col(score) - F.col("bucket_mean"), F.col("bucket_sd")))
    out = met.withColumn("z_score", z)
    return out.withColumn("hard", F.when(F.coalesce(z < z_min, F.lit(False)), F.array_append("hard", F.lit("SAMP-OUT"))).otherwise(F.col("hard"))).drop("bucket_n", "bucket_mean", "bucket_sd")


def best_of_n(scored: DataFrame, by: tuple[str, ...] = ("prompt", "mode"), score: Column | None = None, name: str = "record_hash") -> DataFrame:
    """scored with BEST-OF-N among the hard reasons of all but the best surviving row of each group.

    The best has the highest score, then the least name. Its key is found by aggregation, so a large group isn't gathered.
    """
    score = F.col("stat_score") if score is None else score
    rank = F.struct((-score).alias("s"), F.col(name).alias("n"))
    winners = scored.filter(F.size("hard") == 0).groupBy(*by).agg(F.min(rank).alias("win"), F.count(F.lit(1)).alias("group_size"))
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by]
    met = scored.alias("a").join(winners.alias("b"), on, "left").select("a.*", "win", "group_size")
    lost = (F.size("hard") == 0) & (F.col(name) != F.col("win.n"))
    return met.withColumn("hard", F.when(F.coalesce(lost, F.lit(False)), F.array_append("hard", F.lit("BEST-OF-N"))).otherwise(F.col("hard"))).drop("win")


def pair_win_rate(rows: DataFrame, by: tuple[str, ...], order: str, winner) -> DataFrame:
    """rows' order with win_rate: wins over all pairs of the group, a tie counting half for both; 1 for a row alone.

    winner(a, b) is 'a', 'b' or 'tie'. Every pair is judged, as a tournament asks: groups are the few answers to one prompt.
    """
    a, b = rows.alias("a"), rows.alias("b")
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by]
    duels = a.join(b, [*on, F.col(f"a.{order}") < F.col(f"b.{order}")])
    said = winner("a", "b")
    points = F.when(said == "a", 1.0).when(said == "b", 0.0).otherwise(0.5)
    each = duels.select(F.explode(F.array(F.struct(F.col(f"a.{order}").alias(order), points.alias("p")), F.struct(F.col(f"b.{order}").alias(order), (1 - points).alias("p")))).alias("x")).select("x.*")
    rate = each.groupBy(order).agg((F.sum("p") / F.count(F.lit(1))).alias("win_rate"))
    return rows.select(order).join(rate, order, "left").withColumn("win_rate", F.coalesce("win_rate", F.lit(1.0)))


def value_win_rate(rows: DataFrame, by: tuple[str, ...], order: str, value: str, width: int = 256) -> DataFrame:
    """pair_win_rate() where the higher whole number wins and a null ties with all, without making the pairs: a row has beaten what lies below it.

    Rows are counted by value, and the counts summed up within ranges of `width` values and then over the ranges, so that no
    window reads more of a group than its ranges.
    """
    same = lambda a, b, names: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in names]
    counts = rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("same_n")).withColumn("range", F.floor(F.col(value) / width))
    ranges = counts.groupBy(*by, "range").agg(F.sum("same_n").alias("range_n"))
    group = Window.partitionBy(*by)
    before = Window.unboundedPreceding, -1
    ranges = ranges.select(*by, "range", F.coalesce(F.sum(F.when(F.col("range").isNotNull(), F.col("range_n"))).over(group.orderBy("range").rowsBetween(*before)), F.lit(0)).alias("ranges_below"), F.sum("range_n").over(group).alias("group_n"), F.coalesce(F.sum(F.when(F.col("range").isNull(), F.col("range_n"))).over(group), F.lit(0)).alias("null_n"))
    within = counts.withColumn("below", F.coalesce(F.sum("same_n").over(Window.partitionBy(*by, "range").orderBy(value).rowsBetween(*before)), F.lit(0)))
    placed = within.alias("a").join(ranges.alias("b"), same("a", "b", (*by, "range"))).select("a.*", "ranges_below", "group_n", "null_n")
    won = F.when(F.col(value).isNull(), 0.5 * (F.col("group_n") - 1)).otherwise(F.col("ranges_below") + F.col("below") + 0.5 * (F.col("same_n") - 1 + F.col("null_n")))
    rates = placed.select(*by, value, F.when(F.col("group_n") > 1, F.try_divide(won, F.col("group_n") - 1)).otherwise(1.0).alias("win_rate"))
    return rows.alias("a").join(rates.alias("b"), same("a", "b", (*by, value))).select(f"a.{order}", "win_rate")


def seeded_sample(rows: DataFrame, n: int, seed: int, key: Column, strata: list[str] | None = None) -> DataFrame:
    """n rows, of each stratum if strata are named: those with the least md5 of "seed:key", ties by key. The same rows for a seed, however rows are dealt; rows beyond n go before anything moves."""
    order = [F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary")), key]
    if not strata:
        return rows.orderBy(*order).limit(n)
    nth = F.row_number().over(Window.partitionBy(*strata).orderBy(*order))
    return rows.withColumn("sample__nth", nth).filter(F.col("sample__nth") <= n).drop("sample__nth")
