"""Reuse of earlier results: caches, resumption, run keys, latest-wins tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The row of each key that comes last by order."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("x")).select(*keys, "x.*")


def merge_caches(sources: list[DataFrame], key: str = "record_hash", order: str = "ord") -> DataFrame:
    """Score tables as one cache; later tables, and later rows in one, win."""
    tagged = [s.withColumn("src_ord", F.lit(i)) for i, s in enumerate(sources)]
    out = tagged[0]
    for s in tagged[1:]:
        out = out.unionByName(s)
    return latest(out, [key], F.struct("src_ord", order)).drop("src_ord")


def lookup(rows: DataFrame, cache: DataFrame, expected: dict[str, str], key: str = "record_hash") -> DataFrame:
    """rows with known, reusable and stale: the expected signal codes whose cached version is, or isn't, the expected one."""
    want = F.create_map(*[F.lit(x) for kv in expected.items() for x in kv])
    codes = F.array(*map(F.lit, expected))
    met = rows.join(cache.select(key, F.col("signal_versions").alias("cached_versions"), F.lit(True).alias("hit")), key, "left")
    same = F.filter(codes, lambda c: F.coalesce(F.try_element_at("cached_versions", c) == F.element_at(want, c), F.lit(False)))
    return met.withColumns({"known": F.coalesce("hit", F.lit(False)), "reusable": same, "stale": F.array_except(codes, same)}).drop("hit", "cached_versions")


def counters(looked: DataFrame) -> DataFrame:
    """One row: full (known, nothing stale), partial (known, some stale), new, and evaluations saved."""
    some = F.size("stale") > 0
    return looked.agg(
        F.count_if(F.col("known") & ~some).alias("full"),
        F.count_if(F.col("known") & some).alias("partial"),
        F.count_if(~F.col("known")).alias("new"),
        F.sum(F.when(F.col("known"), F.size("reusable")).otherwise(0)).cast("long").alias("saved"),
    )


def resume_state(scores: DataFrame, key: str = "record_hash") -> DataFrame:
    """One row: distinct evaluated keys, kept and rejected rows."""
    return scores.agg(F.countDistinct(key).alias("evaluated"), F.count_if("accepted").alias("kept"), F.count_if(~F.col("accepted")).alias("rejected"))


def pending(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """rows whose keys aren't done; null keys are equal to each other."""
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    return rows.alias("a").join(done.select(*keys).distinct().alias("b"), on, "left_anti")


def done_keys(records: DataFrame, keys: list[str], order: str, truncated: Column) -> DataFrame:
    """Keys whose latest record is whole."""
    marked = records.withColumn("cut", truncated)
    return marked.groupBy(*keys).agg(F.max_by("cut", order).alias("cut")).filter(~F.col("cut")).drop("cut")


def truncated_keys(records: DataFrame, keys: list[str], truncated: Column) -> DataFrame:
    return records.filter(truncated).select(*keys).distinct()


def merge_signals(rows: DataFrame, cache: DataFrame, key: str = "record_hash") -> DataFrame:
    """rows' fresh scores by code, where missing the cached ones."""
    met = rows.join(cache.select(key, F.col("signal_scores").alias("cached_scores")), key, "left")
    merged = F.map_zip_with("signal_scores", F.coalesce("cached_scores", F.create_map().cast("map<string,double>")), lambda k, fresh, old: F.coalesce(fresh, old))
    return met.withColumn("signal_scores", merged).drop("cached_scores")


def upsert(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """table with changes put in; a change wins over what it meets."""
    rest = [c for c in table.columns if c != key]
    both = table.withColumn("v", F.lit(0)).unionByName(changes.withColumn("v", F.lit(1)))
    return latest(both, [key], F.col("v")).select(key, *rest)


def gate(scored: DataFrame, cached: DataFrame, key: str = "ord", hard: str = "hard") -> DataFrame:
    """scored with gate: rejected (a hard reason: no judge is asked), saved (the judge's result is cached) or judge."""
    met = scored.join(cached.select(key).distinct().withColumn("gate__hit", F.lit(True)), key, "left")
    return met.withColumn("gate", F.when(F.size(hard) > 0, "rejected").when(F.col("gate__hit"), "saved").otherwise("judge")).drop("gate__hit")


def gate_counters(gated: DataFrame) -> DataFrame:
    """One row: records, rejected ones, judge calls and calls saved."""
    return gated.agg(F.count(F.lit(1)).alias("records"), *[F.count_if(F.col("gate") == x).alias(y) for x, y in (("rejected", "rejected"), ("judge", "judge_calls"), ("saved", "judge_saved"))])


def alerts(reports: DataFrame, key: str = "run_key", order: str = "ord", least: int = 3) -> DataFrame:
    """The open alerts of reports (key, order, attempts, cleared, prompt): of each key the last report of at least so many attempts, unless it was cleared since."""
    counted = reports.filter("cleared OR attempts >= %d" % least)
    last = counted.groupBy(key).agg(F.max_by(F.struct("cleared", "attempts", "prompt", order), order).alias("x")).filter("NOT x.cleared")
    return last.select(key, F.when(F.length("x.prompt") > 80, F.concat(F.left("x.prompt", F.lit(80)), F.lit("…"))).otherwise(F.col("x.prompt")).alias("prompt_preview"), "x.attempts")


def attach_live(stats: DataFrame, active: DataFrame, open_alerts: DataFrame) -> DataFrame:
    """stats, one row, with live (active, retries): null unless a run is active or an alert is open. active: one row (active)."""
    live = active.crossJoin(open_alerts.agg(F.count(F.lit(1)).alias("retries")))  # one row each
    return stats.crossJoin(live).withColumn("live", F.when(F.col("active") | (F.col("retries") > 0), F.struct("active", "retries"))).drop("active", "retries")


def filled(stats: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """stats with every column of defaults, in its order, its value where it is missing or null; further columns stay."""
    have = set(stats.columns)
    known = [F.coalesce(F.col(k), F.lit(x)).alias(k) if k in have else F.lit(x).alias(k) for k, x in defaults.items()]
    return stats.select(*known, *[c for c in stats.columns if c not in defaults])


def resolve_browse(asked: DataFrame, tree: DataFrame, page_size: int = 50) -> DataFrame:
    """asked (category, style_id, page) with level and the nearest place that exists in tree (category, style_id, n): unknown parts fall away, pages are clamped."""
    by_style = tree.select(F.col("category").alias("t__c"), F.col("style_id").alias("t__s"), F.col("n").alias("t__n"))
    by_category = tree.select(F.col("category").alias("t__k")).distinct()
    met = asked.join(by_category, F.col("category") == F.col("t__k"), "left").join(by_style, (F.col("category") == F.col("t__c")) & (F.col("style_id") == F.col("t__s")), "left")
    last = F.greatest(F.lit(0), F.ceil(F.col("t__n") / page_size) - 1)
    found = met.withColumn("level", F.when(F.col("t__k").isNull(), "categories").when(F.col("t__s").isNull(), "styles").otherwise("records"))
    page = F.when(F.col("t__s").isNull(), 0).otherwise(F.least(F.greatest(F.lit(0), F.col("page")), last)).cast("long")
    return found.withColumns({"to_category": F.col("t__k"), "to_style": F.col("t__s"), "to_page": page}).drop("t__k", "t__c", "t__s", "t__n")
