"""Histograms, counters, cross tabs and rollups for dataset reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t


def bins(rows: DataFrame, value: Column, edges: list[float]) -> DataFrame:
    """(lo, hi, n): counts of values in [lo, hi), the last bin open; empty bins stay, values below the first edge don't count."""
    ends = [*edges[1:], None]
    which = [(value >= lo) & (value < hi if hi is not None else F.lit(True)) for lo, hi in zip(edges, ends, strict=True)]
    counts = rows.agg(*[F.count_if(w).alias(f"b{i}") for i, w in enumerate(which)])
    cells = F.array(*[F.struct(F.lit(lo).alias("lo"), F.lit(hi).cast(_kind(edges)).alias("hi"), F.col(f"b{i}").alias("n")) for i, (lo, hi) in enumerate(zip(edges, ends, strict=True))])
    return counts.select(F.explode(cells).alias("x")).select("x.*")


def _kind(edges: list[float]) -> str:
    return "int" if all(isinstance(e, int) for e in edges) else "double"


def summary(rows: DataFrame, value: Column) -> DataFrame:
    """One row: n, mean, max and min; zeros without rows."""
    z = lambda c: F.coalesce(c, F.lit(0))
    return rows.agg(F.count(value).alias("n"), F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"), z(F.max(value)).alias("max"), z(F.min(value)).alias("min"))


def counts_by(rows: DataFrame, dims: list[str]) -> DataFrame:
    """(dim, key, n) for each dimension, in one pass (grouping sets); empty keys don't count."""
    sets = rows.select(*[t.full(F.col(d).cast("string")).alias(d) for d in dims]).groupingSets([[d] for d in dims], *dims).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))
    which = F.lit(None).cast("string")
    for i, d in enumerate(dims):
        mask = (1 << len(dims)) - 1 ^ (1 << (len(dims) - 1 - i))
        which = F.when(F.col("g") == mask, d).otherwise(which)
    return sets.select(which.alias("dim"), F.coalesce(*dims).alias("key"), "n").filter("key IS NOT NULL")


def top(counts: DataFrame, n: int, key: str = "key") -> DataFrame:
    return counts.orderBy(F.desc("n"), F.asc(key)).limit(n)


def curation_totals(scores: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    kept = F.count_if("accepted")
    return scores.agg(n.alias("total"), kept.alias("accepted"), (n - kept).alias("rejected"), F.coalesce(F.bround(F.try_divide(kept, n), 4), F.lit(0.0)).alias("keep_rate"))


def keep_by(scores: DataFrame, keys: list[str]) -> DataFrame:
    n, kept = F.count(F.lit(1)), F.count_if("accepted")
    return scores.groupBy(*keys).agg(n.alias("total"), kept.alias("kept"), F.bround(kept / n, 4).alias("keep_rate"))


def keep_cube(scores: DataFrame, keys: list[str]) -> DataFrame:
    """keep_by over every subset of keys; 'all' where a key is summed over."""
    n, kept = F.count(F.lit(1)), F.count_if("accepted")
    cube = scores.cube(*keys).agg(n.alias("total"), kept.alias("kept"), F.bround(kept / n, 4).alias("keep_rate"), *[F.grouping(k).alias(f"g_{k}") for k in keys])
    return cube.select(*[F.when(F.col(f"g_{k}") == 1, "all").otherwise(F.col(k)).alias(k) for k in keys], "total", "kept", "keep_rate")


def reasons(scores: DataFrame, n: int = 10, order: str = "ord") -> DataFrame:
    """(key, n) of the n most frequent reasons; of equally frequent ones the one that was seen first."""
    each = scores.select(order, F.posexplode("rejected_by").alias("place", "key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(order, "place")).alias("first"))
    return each.orderBy(F.desc("n"), "first").limit(n).select("key", "n")


def exact_sum(c: Column) -> Column:
    """The sum of doubles by their decimal values, rounded once, so that the order of rows doesn't matter; a plain sum where a value has more than 12 places or 26 digits before them."""
    d = c.try_cast("decimal(38,12)")
    odd = F.count_if(c.isNotNull() & F.coalesce(d.cast("double") != c, F.lit(True)))
    return F.coalesce(F.when(odd == 0, F.try_sum(d).cast("double")), F.sum(c))


def score_bin(score: Column) -> Column:
    """The lower end, in per cent, of a score's ten-point bin; 100 counts in the last."""
    pct = F.bround(score * 100)
    return F.least(F.lit(90), F.floor(pct / 10) * 10).cast("int")


def rule_rates(scores: DataFrame, rules: dict[str, str]) -> DataFrame:
    """(rule, n, rate): how many codes of each rule are violated, by a rejection or a score below 0.5, over all rows.

    Codes count, not rows, so a rate can exceed 1.
    """
    codes = F.array(*map(F.lit, rules))
    broken = F.filter(codes, lambda c: F.array_contains(F.col("rejected_by"), c) | F.coalesce(F.try_element_at("signal_scores", c) < 0.5, F.lit(False)))
    rule = F.create_map(*[F.lit(x) for kv in rules.items() for x in kv])
    named = F.transform(broken, lambda c: F.element_at(rule, c))
    total = scores.count()
    return scores.select(F.explode(named).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n")).withColumn("rate", F.bround(F.col("n") / max(total, 1), 4))


def label_rates(scores: DataFrame, labels: tuple[str, ...] = ("OK", "REVIEW", "NG"), column: str = "screening_label") -> DataFrame:
    """(label, n, rate); the named labels are always there."""
    found = scores.groupBy(F.coalesce(column, F.lit("UNKNOWN")).alias("label")).agg(F.count(F.lit(1)).alias("m"))
    always = scores.sparkSession.createDataFrame([(x,) for x in labels], "label string")
    total = scores.count()
    both = always.join(found, "label", "full").select("label", F.coalesce("m", F.lit(0)).alias("n"))
    return both.withColumn("rate", F.bround(F.col("n") / max(total, 1), 4))


def export_summary(rows: DataFrame, order: str = "ord") -> DataFrame:
    """One row: count; first model and config in file order; first and last created_at in file order, not least and greatest."""
    first = lambda c: F.min_by(F.col(c), F.when(t.full(F.col(c)).isNotNull(), F.col(order))).alias(f"first_{c}")
    return rows.agg(F.count(F.lit(1)).alias("n"), first("model"), first("config_hash"), first("created_at"), F.max_by("created_at", F.when(t.full(F.col("created_at")).isNotNull(), F.col(order))).alias("last_created_at"))


def style_format(rows: DataFrame, style: str = "style_id", answer: str = "answer") -> DataFrame:
    a = F.col(answer)
    return rows.groupBy(style).agg(
        F.count(F.lit(1)).alias("n"), F.avg(t.has_markdown(a).cast("double")).alias("markdown_rate"), F.avg(t.sentence_count(a).cast("double")).alias("mean_sentences"), F.avg(F.length(t.text(a)).cast("double")).alias("mean_chars")
    )


def outputs_tree(rows: DataFrame, no_category: str = "(未分類)", no_style: str = "(default)") -> DataFrame:
    """(level, category, style_id, n, truncated, thinking, latest) rolled up from styles to categories to all."""
    named = rows.select(F.coalesce(t.full(F.col("category")), F.lit(no_category)).alias("category"), F.coalesce(t.full(F.col("style_id")), F.lit(no_style)).alias("style_id"), "truncated", "has_thinking", "created_at")
    rolled = named.rollup("category", "style_id").agg(F.grouping_id().alias("g"), F.count(F.lit(1)).alias("n"), F.count_if("truncated").alias("truncated"), F.count_if("has_thinking").alias("thinking"), F.max("created_at").alias("latest"))
    level = F.when(F.col("g") == 0, "style").when(F.col("g") == 1, "category").otherwise("all")
    return rolled.select(level.alias("level"), "category", "style_id", "n", "truncated", "thinking", "latest")


def tool_metrics(rows: DataFrame) -> DataFrame:
    """One row: records with tools, with calls, all calls, planned but never called, and rates."""
    has, called = F.coalesce(F.size("tools"), F.lit(0)) > 0, F.coalesce(F.size("tool_calls"), F.lit(0)) > 0
    n = F.count_if(has)
    return rows.agg(
        n.alias("with_tools"), F.count_if(has & called).alias("with_calls"), F.sum(F.greatest(F.lit(0), F.coalesce(F.size("tool_calls"), F.lit(0)))).cast("long").alias("calls"), F.count_if(has & ~called & F.col("planned")).alias("planned_not_called"),
        F.coalesce(F.bround(F.try_divide(F.count_if(has & called), n), 4), F.lit(0.0)).alias("call_rate"),
    )


def calibrate(pairs: DataFrame, score: str = "final_score", good: str = "good", thresholds: tuple[float, ...] = tuple(round(0.5 + 0.05 * i, 2) for i in range(10))) -> DataFrame:
    """(threshold, tp, fp, fn, tn, precision, recall, f1, best): best marks the first threshold of the highest F1.

    Each row counts in one pass; the thresholds are columns, not a join.
    """
    s, y = F.col(score), F.col(good)
    sums = []
    for i, th in enumerate(thresholds):
        hit = s >= th
        sums += [F.count_if(hit & y).alias(f"tp{i}"), F.count_if(hit & ~y).alias(f"fp{i}"), F.count_if(~hit & y).alias(f"fn{i}"), F.count_if(~hit & ~y).alias(f"tn{i}")]
    wide = pairs.agg(*sums)
    cell = lambda i: F.struct(F.lit(thresholds[i]).alias("threshold"), *[F.col(f"{k}{i}").alias(k) for k in ("tp", "fp", "fn", "tn")])
    long = wide.select(F.explode(F.array(*map(cell, range(len(thresholds))))).alias("x")).select("x.*")
    p = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    out = long.withColumn("precision", p).withColumn("recall", r)
    out = out.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))
    best = out.agg(F.max(F.struct(F.col("f1").alias("f"), (-F.col("threshold")).alias("t"))).alias("b")).select((-F.col("b.t")).alias("best_at"))  # one row
    return out.join(F.broadcast(best), F.lit(True)).withColumn("best", F.col("threshold") == F.col("best_at")).drop("best_at")


def judge_bias(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """One row: n, Pearson r (0 where undefined), mean difference."""
    r = F.corr(a, b)
    return pairs.agg(F.count(F.lit(1)).alias("n"), F.when(r.isNull() | F.isnan(r), 0.0).otherwise(r).alias("r"), F.avg(F.col(a) - F.col(b)).alias("mean_diff"))


def judge_bias_by(pairs: DataFrame, aspect: str, a: str, b: str) -> DataFrame:
    """judge_bias for each aspect: (aspect, n, r, mean_diff)."""
    r = F.corr(a, b)
    return pairs.groupBy(aspect).agg(F.count(F.lit(1)).alias("n"), F.when(r.isNull() | F.isnan(r), 0.0).otherwise(r).alias("r"), F.avg(F.col(a) - F.col(b)).alias("mean_diff"))
