"""Queries: histograms, counters, rollups, calibration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import signals as sg
from ..functions import text as t
from ..operators import aggregates as ag
from ..operators import score as sc
from ..operators import variants as va
from ..sources import sinks
from . import views as v
from .catalogue import query
from .q_signals import KEPT, LABELLED, kept, labelled

DOCS, RESPONSES = v.DOCS, v.RESPONSES
EDGES = [0, 100, 500, 1000, 2000, 5000, 10000, 1000000]


@query(
    f"""WITH {DOCS}, e AS (SELECT unnest([0, 100, 500, 1000, 2000, 5000, 10000, 1000000]) AS lo, unnest([100, 500, 1000, 2000, 5000, 10000, 1000000, NULL]) AS hi)
    SELECT lo, hi, count(ord) AS n FROM e LEFT JOIN docs ON length(answer) >= lo AND (hi IS NULL OR length(answer) < hi) GROUP BY lo, hi"""
)
def length_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.bins(v.docs(spark, sf_dir), F.length("answer"), EDGES)


@query(f"WITH {DOCS} SELECT count(*) AS n, round(avg(length(answer)), 6) AS mean, max(length(answer)) AS max, min(length(answer)) AS min FROM docs")
def length_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.summary(v.docs(spark, sf_dir), F.length("answer")).withColumn("mean", v.r6("mean"))


@query(
    f"""WITH {DOCS} SELECT 'mode' AS dim, mode AS key, count(*) AS n FROM docs GROUP BY mode UNION ALL SELECT 'category', category, count(*) FROM docs GROUP BY category
    UNION ALL SELECT 'style_id', style_id, count(*) FROM docs GROUP BY style_id UNION ALL SELECT 'finish_reason', finish_reason, count(*) FROM docs WHERE finish_reason IS NOT NULL GROUP BY finish_reason"""
)
def counts_by_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.counts_by(v.docs(spark, sf_dir), ["mode", "category", "style_id", "finish_reason"])


@query(f"WITH {DOCS} SELECT 'temperature' AS dim, temperature::VARCHAR AS key, count(*) AS n FROM docs GROUP BY temperature UNION ALL SELECT 'top_p', top_p::VARCHAR, count(*) FROM docs GROUP BY top_p")
def counts_by_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounded = v.docs(spark, sf_dir).select(*[F.bround(c, 4).cast("string").alias(c) for c in ("temperature", "top_p")])
    return ag.counts_by(rounded, ["temperature", "top_p"])


@query("SELECT substr(ts::VARCHAR, 1, 10) AS day, count(*) AS n FROM events GROUP BY 1")
def timeline_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = v.table(spark, sf_dir, "events").select(F.col("ts").cast("string").alias("created_at"))
    return text.filter(F.length("created_at") >= 10).groupBy(F.substring("created_at", 1, 10).alias("day")).agg(F.count(F.lit(1)).alias("n"))


RECORD_CUT = f"(CASE WHEN finish_reason = 'length' THEN true WHEN finish_reason IN ('stop', 'tool_loop_exhausted') THEN false ELSE {v.truncated('answer')} END)"


@query(f"WITH {DOCS} SELECT count(*) AS n, count(*) FILTER ({RECORD_CUT}) AS truncated, round_even(count(*) FILTER ({RECORD_CUT}) / count(*), 4) AS rate FROM docs")
def truncated_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = F.count_if(t.record_truncated(F.col("finish_reason"), F.col("answer")))
    n = F.count(F.lit(1))
    return v.docs(spark, sf_dir).agg(n.alias("n"), cut.alias("truncated"), F.coalesce(F.bround(F.try_divide(cut, n), 4), F.lit(0.0)).alias("rate"))


@query(
    f"""WITH {DOCS}, x AS (SELECT ord, ord % 2 = 0 AS has, (ord % 4)::BIGINT AS calls, ord % 3 = 0 AS planned FROM docs)
    SELECT count(*) FILTER (has) AS with_tools, count(*) FILTER (has AND calls > 0) AS with_calls, sum(calls)::BIGINT AS calls, count(*) FILTER (has AND calls = 0 AND planned) AS planned_not_called,
    round_even(count(*) FILTER (has AND calls > 0) / count(*) FILTER (has), 4) AS call_rate FROM x"""
)
def tool_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("ord")
    rows = v.docs(spark, sf_dir).select(F.when(o % 2 == 0, F.array(F.lit("search"))).alias("tools"), F.array_repeat(F.lit("search"), (o % 4).cast("int")).alias("tool_calls"), (o % 3 == 0).alias("planned"))
    return ag.tool_metrics(rows)


@query(f"WITH {DOCS} SELECT name, count(*) AS n FROM (SELECT unnest(CASE ord % 3 WHEN 0 THEN ['search', 'calc'] WHEN 1 THEN ['search'] ELSE [] END) AS name FROM docs) GROUP BY name")
def tool_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("ord")
    calls = F.when(o % 3 == 0, F.array(F.lit("search"), F.lit("calc"))).when(o % 3 == 1, F.array(F.lit("search"))).otherwise(F.array().cast("array<string>"))
    return v.docs(spark, sf_dir).select(F.explode(calls).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query(f"{KEPT} SELECT count(*) AS total, count(*) FILTER (accepted) AS accepted, count(*) FILTER (NOT accepted) AS rejected, round_even(count(*) FILTER (accepted) / count(*), 4) AS keep_rate FROM kept")
def curation_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.curation_totals(kept(spark, sf_dir))


@query(f"{KEPT}, e AS (SELECT ord, unnest(rejected_by) AS key, generate_subscripts(rejected_by, 1) AS place FROM kept) SELECT key, count(*) AS n FROM e GROUP BY key ORDER BY n DESC, min(ord * 100 + place) LIMIT 10")
def reasons_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.reasons(kept(spark, sf_dir))


SAMPLING = "'t=' || temperature::VARCHAR || ',p=' || top_p::VARCHAR"


def _sampling() -> Column:
    plain = lambda c: F.regexp_replace(F.col(c).cast("string"), r"\.0$", "")
    return F.concat(F.lit("t="), plain("temperature"), F.lit(",p="), plain("top_p"))


@query(f"WITH {DOCS} SELECT ord, {SAMPLING} AS sampling FROM docs")
def sampling_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.docs(spark, sf_dir).select("ord", _sampling().alias("sampling"))


@query(f"{KEPT} SELECT {SAMPLING} AS sampling, count(*) AS total, count(*) FILTER (accepted) AS kept, round_even(count(*) FILTER (accepted) / count(*), 4) AS keep_rate FROM kept GROUP BY 1")
def keep_by_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.keep_by(kept(spark, sf_dir).withColumn("sampling", _sampling()), ["sampling"])


@query(
    f"""{KEPT}, k AS (SELECT *, {SAMPLING} AS sampling FROM kept) SELECT coalesce(sampling, 'all') AS sampling, coalesce(style_id, 'all') AS style_id, count(*) AS total, count(*) FILTER (accepted) AS kept,
    round_even(count(*) FILTER (accepted) / count(*), 4) AS keep_rate FROM k GROUP BY CUBE (sampling, style_id)"""
)
def keep_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.keep_cube(kept(spark, sf_dir).withColumn("sampling", _sampling()), ["sampling", "style_id"])


@query(
    f"""{KEPT} SELECT {SAMPLING} AS sampling, {", ".join(f"round_even(count(*) FILTER (accepted AND style_id = '{s}') / nullif(count(*) FILTER (style_id = '{s}'), 0), 4) AS {s}" for s in ("de", "en", "es", "fr"))} FROM kept GROUP BY 1"""
)
def keep_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = ag.keep_by(kept(spark, sf_dir).withColumn("sampling", _sampling()), ["sampling", "style_id"])
    return cells.groupBy("sampling").pivot("style_id", ["de", "en", "es", "fr"]).agg(F.first("keep_rate"))


@query(f"{KEPT} SELECT mode, round(round_even(count(*) FILTER (accepted) / count(*), 4) * 100, 1) AS percent FROM kept GROUP BY mode")
def keep_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.keep_by(kept(spark, sf_dir), ["mode"]).select("mode", F.round(F.col("keep_rate") * 100, 1).alias("percent"))


@query(f"{KEPT} SELECT mode, least(90, (floor(round_even(final_score * 100, 0) / 10) * 10)::INT) AS bin, count(*) AS n FROM kept GROUP BY 1, 2")
def score_hist_by_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept(spark, sf_dir).groupBy("mode", ag.score_bin(F.col("final_score")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query(f"{KEPT} SELECT ord, record_hash FROM kept WHERE NOT accepted ORDER BY md5('42:' || record_hash), record_hash LIMIT 20")
def rejected_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty rejected rows, the same ones each time."""
    return sc.seeded_sample(kept(spark, sf_dir).filter("NOT accepted"), 20, 42, F.col("record_hash")).select("ord", "record_hash")


@query(f"{LABELLED} SELECT label, count(ord) AS n, round_even(count(ord) / (SELECT count(*) FROM labelled), 4) AS rate FROM (SELECT unnest(['OK', 'REVIEW', 'NG']) AS label) LEFT JOIN labelled ON label = screening_label GROUP BY label")
def screening_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.label_rates(labelled(spark, sf_dir))


RULED = """broken AS (SELECT unnest(list_filter([
    CASE WHEN list_contains(hard, 'LEN-A') OR s1 < 0.5 THEN 'R-06' END, CASE WHEN list_contains(hard, 'TRUNC') OR s2 < 0.5 THEN 'R-02' END, CASE WHEN list_contains(hard, 'LANG-JA') OR s3 < 0.5 THEN 'R-05' END,
    CASE WHEN list_contains(hard, 'REPEAT-NG') OR s4 < 0.5 THEN 'R-03' END, CASE WHEN list_contains(hard, 'END-WELL') OR s5 < 0.5 THEN 'R-02' END], lambda x: x IS NOT NULL)) AS rule FROM labelled)"""


@query(f"{LABELLED}, {RULED} SELECT rule, count(*) AS n, round_even(count(*) / (SELECT count(*) FROM labelled), 4) AS rate FROM broken GROUP BY rule")
def rule_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.rule_rates(labelled(spark, sf_dir).withColumn("rejected_by", F.col("hard")), sg.RULES)


@query(
    f"""{LABELLED}, {RULED} SELECT 'rule' AS section, rule AS key, count(*) AS n, round_even(count(*) / (SELECT count(*) FROM labelled), 4) AS rate FROM broken GROUP BY rule
    UNION ALL SELECT 'label', label, count(ord), round_even(count(ord) / (SELECT count(*) FROM labelled), 4) FROM (SELECT unnest(['OK', 'REVIEW', 'NG']) AS label) LEFT JOIN labelled ON label = screening_label GROUP BY label"""
)
def screening_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labelled(spark, sf_dir).withColumn("rejected_by", F.col("hard"))
    return sinks.screening_report(ag.label_rates(rows), ag.rule_rates(rows, sg.RULES))


@query(
    """WITH e AS (SELECT event_id AS ord, CASE WHEN event_id % 7 > 2 THEN event_type END AS model, CASE WHEN event_id % 5 > 1 THEN 'c' || user_id END AS config, CASE WHEN event_id % 11 <> 0 THEN ts::VARCHAR ELSE '' END AS made FROM events)
    SELECT count(*) AS n, arg_min(model, ord) AS first_model, arg_min(config, ord) AS first_config_hash, arg_min(made, ord) FILTER (made <> '') AS first_created_at, arg_max(made, ord) FILTER (made <> '') AS last_created_at FROM e"""
)
def export_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    rows = v.table(spark, sf_dir, "events").select(
        i.alias("ord"), F.when(i % 7 > 2, F.col("event_type")).alias("model"), F.when(i % 5 > 1, F.concat(F.lit("c"), F.col("user_id"))).alias("config_hash"),
        F.when(i % 11 != 0, F.col("ts").cast("string")).otherwise("").alias("created_at"),
    )
    return ag.export_summary(rows)


DOMAINS = [(f"src{i}", 40 + 5 * i) for i in range(25)]
DOMAIN_SQL = "domains AS (SELECT 'src' || i AS domain, 40 + 5 * i AS target FROM range(25) r(i))"


@query(
    f"""WITH {DOCS}, {DOMAIN_SQL} SELECT domain, target, count(ord) AS have, greatest(0, target - count(ord))::BIGINT AS gap, round_even(count(ord) / target, 4) AS ratio, count(ord) >= 0.8::DOUBLE * target AS done
    FROM domains LEFT JOIN docs ON category = domain GROUP BY domain, target"""
)
def domain_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    domains = spark.createDataFrame(DOMAINS, "domain string, target long")
    return va.domain_gap(v.docs(spark, sf_dir).withColumnRenamed("category", "domain"), domains)


@query("WITH d AS (SELECT source AS domain, count(*) AS target FROM documents GROUP BY source) SELECT domain, greatest(1, round_even(target * (1000::DOUBLE / (SELECT sum(target) FROM d)), 0))::BIGINT AS target FROM d")
def scale_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each source has, scaled to a thousand in all."""
    d = v.table(spark, sf_dir, "documents").groupBy(F.col("source").alias("domain")).agg(F.count(F.lit(1)).alias("target"))
    return va.scale_targets(d, 1000)


MARKDOWN = r"""(trim(answer) <> '' AND (regexp_matches(answer, '(?m)^#{1,6}\s+\S') OR regexp_matches(answer, '(?m)^\s*[-*+]\s+\S') OR regexp_matches(answer, '(?m)^\s*\d+\.\s+\S')
  OR regexp_matches(answer, '\*\*.+?\*\*|__.+?__') OR regexp_matches(answer, '\|.+\|') OR regexp_matches(answer, '(?m)^\s*---+\s*$')))"""
SENTENCES = rf"len(list_filter(list_transform(regexp_split_to_array(answer, '[。！？\n]'), lambda x: {v.strip('x')}), lambda x: x <> ''))"


@query(f"WITH {DOCS} SELECT style_id, count(*) AS n, round(avg({MARKDOWN}::INT), 6) AS markdown_rate, round(avg({SENTENCES}), 6) AS mean_sentences, round(avg(length(answer)), 6) AS mean_chars FROM docs GROUP BY style_id")
def format_by_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ag.style_format(v.docs(spark, sf_dir))
    return out.select("style_id", "n", *[v.r6(c).alias(c) for c in ("markdown_rate", "mean_sentences", "mean_chars")])


@query(
    f"""WITH {RESPONSES}, a AS (SELECT style_id, avg({MARKDOWN}::INT) AS m, avg({SENTENCES}) AS s, avg(length(answer)) AS c FROM responses GROUP BY style_id)
    SELECT style_id, CASE style_id WHEN 'prose' THEN m <= 0.05 WHEN 'qa_short' THEN c <= 200 WHEN 'dialog' THEN s >= 1 ELSE true END AS passed FROM a"""
)
def style_criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = ag.style_format(v.responses(spark, sf_dir))
    s = F.col("style_id")
    return a.select(s, F.when(s == "prose", F.col("markdown_rate") <= 0.05).when(s == "qa_short", F.col("mean_chars") <= 200).when(s == "dialog", F.col("mean_sentences") >= 1).otherwise(True).alias("passed"))


@query(
    f"""WITH {DOCS}, b AS (SELECT category, style_id, (CASE WHEN finish_reason = 'length' THEN true WHEN finish_reason = 'stop' THEN false ELSE {v.truncated('answer')} END) AS cut, thinking_trace <> '' AS thinks, substr((DATE '2024-01-01' + (ord % 90)::INT)::VARCHAR, 1, 10) AS made FROM docs)
    SELECT CASE WHEN grouping(style_id) = 0 THEN 'style' WHEN grouping(category) = 0 THEN 'category' ELSE 'all' END AS level, category, style_id, count(*) AS n, count(*) FILTER (cut) AS truncated, count(*) FILTER (thinks) AS thinking, max(made) AS latest
    FROM b GROUP BY ROLLUP (category, style_id)"""
)
def outputs_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = v.docs(spark, sf_dir)
    at = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("ord") % 90).cast("int")).cast("string")
    rows = d.select("category", "style_id", t.record_truncated(F.col("finish_reason"), F.col("answer"), loop_counts=False).alias("truncated"), (F.col("thinking_trace") != "").alias("has_thinking"), at.alias("created_at"))
    return ag.outputs_tree(rows)


@query(f"WITH {DOCS} SELECT DISTINCT category FROM docs WHERE category <> ''")
def distinct_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.docs(spark, sf_dir).filter("category <> ''").select("category").distinct()


@query("SELECT conv_id, coalesce(max(turn), 0) AS turns FROM conversations GROUP BY conv_id")
def turn_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.coalesce(F.max("turn"), F.lit(0)).alias("turns"))


@query(
    """WITH e AS (SELECT user_id, count(*) AS done, sum(value) AS spent FROM events GROUP BY user_id)
    SELECT user_id, floor(100 * done / (done + 7))::BIGINT AS percent, floor(spent / done * 7)::BIGINT AS remaining FROM e"""
)
def progress_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percent done, and seconds left at the mean pace, with seven to go."""
    e = v.table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("done"), ag.exact_sum(F.col("value")).alias("spent"))
    return e.select("user_id", F.floor(100 * F.col("done") / (F.col("done") + 7)).alias("percent"), F.floor(F.col("spent") / F.col("done") * 7).alias("remaining"))


@query(
    """WITH p AS (SELECT *, CASE event_type WHEN 'error' THEN 3 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 1 ELSE 0 END AS prio FROM events)
    SELECT user_id, event_type AS status FROM p QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY prio DESC, event_id DESC) = 1"""
)
def mcp_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gravest status of each user; of equally grave ones the newest."""
    e = F.col("event_type")
    prio = F.when(e == "error", 3).when(e == "purchase", 2).when(e == "signup", 1).otherwise(0)
    return v.table(spark, sf_dir, "events").groupBy("user_id").agg(F.max_by("event_type", F.struct(prio, "event_id")).alias("status"))


CAL = f"""WITH {v.SCORED}, p AS (SELECT final_score, quality = 1 AND toxic = 0 AS good FROM scored JOIN labels ON ord = doc_id),
th AS (SELECT unnest([0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]::DOUBLE[]) AS threshold),
c AS (SELECT threshold, count(*) FILTER (final_score >= threshold AND good) AS tp, count(*) FILTER (final_score >= threshold AND NOT good) AS fp, count(*) FILTER (final_score < threshold AND good) AS fn, count(*) FILTER (final_score < threshold AND NOT good) AS tn FROM p, th GROUP BY threshold),
m AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall FROM c),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM m)
SELECT threshold, tp, fp, fn, tn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, row_number() OVER (ORDER BY f1 DESC, threshold) = 1 AS best FROM f"""


@query(CAL)
def calibrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = v.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("ord"), ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))
    out = ag.calibrate(v.scored(spark, sf_dir).join(truth, "ord"))
    return out.select("threshold", "tp", "fp", "fn", "tn", *[v.r6(c).alias(c) for c in ("precision", "recall", "f1")], "best")


@query(f"WITH {v.SCORED}, p AS (SELECT s1 AS a, s4 AS b FROM scored) SELECT count(*) AS n, round(corr(a, b), 6) AS r, round(avg(a - b), 6) AS mean_diff FROM p")
def judge_bias(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = v.scored(spark, sf_dir).select(F.col("signal_scores")["LEN-A"].alias("a"), F.col("signal_scores")["REPEAT-NG"].alias("b"))
    return ag.judge_bias(s, "a", "b").select("n", v.r6("r").alias("r"), v.r6("mean_diff").alias("mean_diff"))


@query(
    f"""WITH {v.SCORED}, p AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY style_id ORDER BY md5('42:' || record_hash), record_hash) <= 200),
    a AS (SELECT final_score, unnest(['LEN-A', 'TRUNC', 'LANG-JA', 'REPEAT-NG', 'END-WELL']) AS aspect, unnest([s1, s2, s3, s4, s5]) AS s FROM p)
    SELECT aspect, count(*) AS n, round(CASE WHEN stddev_pop(s) > 0 AND stddev_pop(final_score) > 0 THEN corr(s, final_score) ELSE 0 END, 6) AS r, round(avg(s - final_score), 6) AS mean_diff FROM a GROUP BY aspect"""
)
def judge_bias_by_aspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each signal against the composite, over a seeded sample of 200 rows a style."""
    some = sc.seeded_sample(v.scored(spark, sf_dir), 200, 42, F.col("record_hash"), ["style_id"])
    long = some.select("final_score", F.explode("signal_scores").alias("aspect", "s"))
    return ag.judge_bias_by(long, "aspect", "s", "final_score").select("aspect", "n", v.r6("r").alias("r"), v.r6("mean_diff").alias("mean_diff"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type LIMIT 20")
def sort_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.top(v.table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("key")).agg(F.count(F.lit(1)).alias("n")), 20).withColumnRenamed("key", "event_type")
