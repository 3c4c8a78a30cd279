"""Queries: quality signals, composition and selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse
from ..functions import signals as sg
from ..functions import text as t
from ..operators import aggregates as ag
from ..operators import score as sc
from ..sources.readers import schema_ok
from ..sources.scratch import stored
from . import views as v
from .catalogue import query

DOCS, SCORED = v.DOCS, v.SCORED


def _one(spark: SparkSession, sf_dir: str, code: str, limits: sg.Limits | None = None) -> DataFrame:
    found = sg.evaluate(v.docs(spark, sf_dir), [code], limits)
    return found.select("ord", v.r6(F.col("signals")[0]["score"]).alias("score"), F.col("signals")[0]["hard"].alias("hard"))


@query(f"WITH {DOCS} SELECT ord, round(greatest(0::DOUBLE, 1 - abs(length(answer)::DOUBLE - 2015) / 1985), 6) AS score, length(answer) < 30 OR length(answer) > 4000 AS hard FROM docs")
def signal_len_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one(spark, sf_dir, "LEN-A")


@query(
    f"""WITH {DOCS} SELECT ord, CASE WHEN mode = 'thinking' THEN round(greatest(0::DOUBLE, 1 - abs(length(thinking_trace)::DOUBLE - 4010) / 3990), 6) ELSE 1 END AS score,
    mode = 'thinking' AND (length(thinking_trace) < 20 OR length(thinking_trace) > 8000) AS hard FROM docs"""
)
def signal_len_t(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one(spark, sf_dir, "LEN-T")


@query(
    f"""WITH {DOCS}, r AS (SELECT *, length(thinking_trace) / length(answer) AS r FROM docs)
    SELECT ord, CASE WHEN mode <> 'thinking' THEN 1 WHEN answer = '' THEN 0 WHEN r BETWEEN 0.5 AND 3 THEN 1 ELSE 0.5 END::DOUBLE AS score, mode = 'thinking' AND (answer = '' OR r < 0.05 OR r > 10) AS hard FROM r"""
)
def signal_ratio_ta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one(spark, sf_dir, "RATIO-TA")


@query(f"WITH {DOCS} SELECT ord, CASE WHEN {v.CUT} THEN 0::DOUBLE ELSE 1 END AS score, {v.CUT} AS hard FROM docs")
def signal_trunc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one(spark, sf_dir, "TRUNC")


@query(
    f"""WITH {DOCS}, b AS (SELECT *, {v.count_of("(answer || thinking_trace)", "<think>")} AS a, {v.count_of("(answer || thinking_trace)", "</think>")} AS c FROM docs)
    SELECT ord, CASE WHEN mode <> 'thinking' OR a = c THEN 1::DOUBLE ELSE 0 END AS score, mode = 'thinking' AND a <> c AS hard FROM b"""
)
def signal_think_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one(spark, sf_dir, "THINK-TAG")


@query(f"WITH {SCORED} SELECT ord, round(s3, 6) AS score, bare = 0 OR s3 < 0.6 AS hard FROM scored")
def signal_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one(spark, sf_dir, "LANG-JA", v.LATIN)


@query(f"WITH {SCORED} SELECT ord, round(s4, 6) AS score, n >= 8 AND share > 0.6 AS hard FROM scored")
def signal_repeat_ng(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one(spark, sf_dir, "REPEAT-NG", v.LATIN)


@query(
    f"""WITH {DOCS}, c AS (SELECT ord, unnest(string_split(answer, '')) AS ch, unnest(range(length(answer))) AS i FROM docs),
    r AS (SELECT ord, max(n) AS run FROM (SELECT ord, count(*) AS n FROM (SELECT ord, ch, i - row_number() OVER (PARTITION BY ord, ch ORDER BY i) AS g FROM c) GROUP BY ord, ch, g) GROUP BY ord)
    SELECT ord, round(CASE WHEN coalesce(run, 0) <= 5 THEN 1 ELSE greatest(0::DOUBLE, 1 - (run - 5)::DOUBLE / 50) END, 6) AS score, coalesce(run, 0) > 30 AS hard FROM docs LEFT JOIN r USING (ord)"""
)
def signal_repeat_char(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one(spark, sf_dir, "REPEAT-CHAR")


RULE = {"endings": [r"\.$"], "keywords": ("the", "and", "der"), "least": 0.3}


@query(
    rf"""WITH {DOCS}, s AS (SELECT *, list_filter(list_transform(regexp_split_to_array(answer, '[。！？\n]'), lambda x: {v.strip("x")}), lambda x: x <> '') AS p FROM docs),
    q AS (SELECT *, CASE WHEN len(p) = 0 THEN 0 ELSE 0.7::DOUBLE * (len(list_filter(p, lambda x: regexp_matches(x, '\.$'))) / len(p)) + 0.3::DOUBLE * least(1::DOUBLE, (contains(answer, 'the')::INT + contains(answer, 'and')::INT + contains(answer, 'der')::INT) / 3) END AS own FROM s)
    SELECT ord, round(CASE WHEN style_id = 'en' THEN own ELSE 1 END, 6) AS score, style_id = 'en' AND own < 0.3 AS hard FROM q"""
)
def signal_style_adh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one(spark, sf_dir, "STYLE-ADH", sg.Limits(style_rules={"en": RULE}))


@query(rf"WITH {DOCS} SELECT ord, CASE WHEN regexp_matches(answer, '\d+\s*℃|\d+\s*度|\d+\s*mm|\d+\s*%|\d{{1,2}}:\d{{2}}') THEN 0::DOUBLE ELSE 1 END AS score, regexp_matches(answer, '\d+\s*℃|\d+\s*度|\d+\s*mm|\d+\s*%|\d{{1,2}}:\d{{2}}') AS hard FROM docs")
def signal_fact_hall(spark: SparkSession, sf_dir: str) -> DataFrame:
    tools = v.docs(spark, sf_dir).withColumn("tools", F.array(F.lit("search")))
    return sg.evaluate(tools, ["FACT-HALL"]).select("ord", F.col("signals")[0]["score"].alias("score"), F.col("signals")[0]["hard"].alias("hard"))


@query(f"WITH {DOCS} SELECT ord, regexp_matches(answer, '仮想データ|架空|推測値|（例）|\\(例\\)|サンプルデータ|ダミーデータ') AS hard FROM docs")
def signal_virt_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one(spark, sf_dir, "VIRT-DATA").select("ord", "hard")


@query(f"WITH {DOCS} SELECT ord, CASE WHEN {v.ENDS} THEN 1::DOUBLE ELSE 0 END AS score, NOT {v.ENDS} AS hard FROM docs")
def signal_end_well(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one(spark, sf_dir, "END-WELL")


@query(rf"WITH {DOCS} SELECT ord, regexp_matches(answer, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{{9f}}\x{{fffd}}\x{{e000}}-\x{{f8ff}}]') AS hard FROM docs")
def signal_ctrl_char(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one(spark, sf_dir, "CTRL-CHAR").select("ord", "hard")


@query(rf"WITH {DOCS} SELECT ord, regexp_matches(answer, '(?i)<\|im_start\|>|<\|redacted_im_end\|>|<\|endoftext\|>|<\|im_end\|>|\nim_start\||\nassistant\n|\nuser\n') AS hard FROM docs")
def signal_tpl_leak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one(spark, sf_dir, "TPL-LEAK").select("ord", "hard")


@query()
def signal_style_fmt(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sg.evaluate(v.responses(spark, sf_dir), ["STYLE-FMT"])
    return found.select("ord", F.col("signals")[0]["raw"].alias("raw"), F.col("signals")[0]["hard"].alias("hard"))


@query()
def signal_syntax_break(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.docs(spark, sf_dir).select("ord", parse.syntax_break(F.col("answer")).alias("issue"))


@query()
def signals_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule signal over every document."""
    found = sg.evaluate(v.docs(spark, sf_dir), list(sg.SIGNALS), v.LATIN)
    return found.select("ord", sc.mean_score(F.col("signals")).alias("stat_score"), F.array_join(sc.hard_codes(F.col("signals")), ",").alias("hard"))


@query(f"WITH {SCORED} SELECT ord, round(final_score, 6) AS stat_score FROM scored")
def stat_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.scored(spark, sf_dir).select("ord", v.r6("stat_score").alias("stat_score"))


@query(f"WITH {SCORED} SELECT ord, array_to_string(hard, ',') AS reasons, len(hard)::INT AS n FROM scored")
def hard_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.scored(spark, sf_dir).select("ord", F.array_join("hard", ",").alias("reasons"), F.size("hard").alias("n"))


@query(f"WITH {SCORED} SELECT ord, round(CASE WHEN ord % 4 = 0 THEN final_score ELSE (final_score * 0.4::DOUBLE + (ord % 5 + 1) / 5::DOUBLE * 0.6::DOUBLE) / 1.0::DOUBLE END, 6) AS final_score FROM scored")
def compose_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stat scores with a judge's mark for three rows of four."""
    llm = F.when(F.col("ord") % 4 != 0, (F.col("ord") % 5 + 1) / F.lit(5.0))
    return v.scored(spark, sf_dir).select("ord", v.r6(sc.compose(F.col("stat_score"), llm)).alias("final_score"))


@query(
    f"""WITH {DOCS} SELECT ord, round(((1 + ord % 5)::DOUBLE + (1 + ord % 3)::DOUBLE + 3::DOUBLE) / 3 / 5, 6) AS score FROM docs"""
)
def rubric_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A judge's text with two of three marks."""
    said = F.format_string('marks: {"a": %d, "b": %d} done', F.col("ord") % 5 + 1, F.col("ord") % 3 + 1)
    keys = ["a", "b", "c"]
    return v.docs(spark, sf_dir).select("ord", v.r6(sg.rubric_mean(sg.parse_rubric(said, keys), keys)).alias("score"))


@query(f"WITH {SCORED} SELECT ord, len(hard) = 0 AND final_score >= 0.7 AS accepted, array_to_string(CASE WHEN len(hard) > 0 THEN hard WHEN final_score >= 0.7 THEN [] ELSE ['BELOW_THRESHOLD'] END, ',') AS reasons FROM scored")
def select_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _picked(sc.select(v.scored(spark, sf_dir), threshold=0.7))


def _picked(rows: DataFrame) -> DataFrame:
    return rows.select("ord", "accepted", F.array_join("rejected_by", ",").alias("reasons"))


RANK = f"""WITH {SCORED}, r AS (SELECT *, CASE WHEN len(hard) = 0 THEN row_number() OVER (PARTITION BY len(hard) = 0 ORDER BY final_score DESC, ord) END AS rn, count(*) FILTER (len(hard) = 0) OVER () AS alive FROM scored)
SELECT ord, coalesce(rn <= LIMIT_K, false) AS accepted, array_to_string(CASE WHEN len(hard) > 0 THEN hard WHEN rn <= LIMIT_K THEN [] ELSE ['BELOW_THRESHOLD'] END, ',') AS reasons FROM r"""


@query(RANK.replace("LIMIT_K", "100"))
def select_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _picked(sc.select(narrow(spark, sf_dir), top_k=100))


@query(RANK.replace("LIMIT_K", "round_even(0.5 * alive, 0)"))
def select_keep_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _picked(sc.select(narrow(spark, sf_dir), keep_rate=0.5))


KEPT = f"""WITH {SCORED}, r AS (SELECT *, CASE WHEN len(hard) = 0 THEN row_number() OVER (PARTITION BY len(hard) = 0 ORDER BY final_score DESC, ord) END AS rn, count(*) FILTER (len(hard) = 0) OVER () AS alive FROM scored),
kept AS (SELECT *, coalesce(rn <= round_even(0.5 * alive, 0), false) AS accepted, CASE WHEN len(hard) > 0 THEN hard WHEN rn <= round_even(0.5 * alive, 0) THEN [] ELSE ['BELOW_THRESHOLD'] END AS rejected_by FROM r)"""


def narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composites without the texts, computed once: selection looks at them several times."""
    return stored(v.scored(spark, sf_dir).drop("answer", "thinking_trace", "signal_raw", "signal_versions"), "scored")


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sc.select(narrow(spark, sf_dir), keep_rate=0.5)


@query(f"{KEPT} SELECT style_id, count(*) AS total, count(*) FILTER (accepted) AS kept, round_even(count(*) FILTER (accepted) / count(*), 4) AS keep_rate FROM kept GROUP BY style_id")
def keep_by_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: signals, composite, the better half of the survivors, summed up by style."""
    return ag.keep_by(kept(spark, sf_dir), ["style_id"])


LABEL = "CASE WHEN len(hard) > 0 THEN 'NG' WHEN final_score >= 0.75 THEN 'OK' WHEN final_score >= 0.4 THEN 'REVIEW' ELSE 'NG' END"
LABELLED = f"WITH {SCORED}, labelled AS (SELECT *, {LABEL} AS screening_label FROM scored)"


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = narrow(spark, sf_dir)
    return s.withColumn("screening_label", sc.screening_label(F.col("final_score"), F.col("hard")))


@query(f"{LABELLED} SELECT ord, screening_label FROM labelled")
def screening_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).select("ord", "screening_label")


@query(
    f"""{LABELLED}, q AS (SELECT ord, screening_label, row_number() OVER (PARTITION BY screening_label ORDER BY final_score, ord) AS rn, count(*) FILTER (screening_label = 'REVIEW') OVER () AS held, floor(0.05 * count(*) OVER ()) AS quota FROM labelled)
    SELECT ord, CASE WHEN screening_label = 'REVIEW' AND rn <= held - quota THEN 'NG' ELSE screening_label END AS screening_label FROM q"""
)
def review_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sc.review_quota(labelled(spark, sf_dir), 0.05).select("ord", "screening_label")


@query(
    f"""WITH {SCORED}, z AS (SELECT *, count(*) OVER w AS bn, avg(final_score) OVER w AS m, stddev_pop(final_score) OVER w AS s FROM scored WINDOW w AS (PARTITION BY temperature, top_p))
    SELECT ord, round(CASE WHEN bn >= 5 AND s > 0 THEN (final_score - m) / s END, 6) AS z_score, coalesce(bn >= 5 AND s > 0 AND (final_score - m) / s < -2, false) AS outlier FROM z"""
)
def samp_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sc.sample_outliers(narrow(spark, sf_dir))
    return out.select("ord", v.r6("z_score").alias("z_score"), F.array_contains("hard", "SAMP-OUT").alias("outlier"))


@query(
    f"""WITH {SCORED}, g AS (SELECT *, split_part(answer, ' ', 1) AS prompt FROM scored), w AS (SELECT *, CASE WHEN len(hard) = 0 THEN row_number() OVER (PARTITION BY prompt, mode, len(hard) = 0 ORDER BY final_score DESC, record_hash) END AS rn FROM g)
    SELECT ord, coalesce(rn > 1, false) AS lost, (CASE WHEN count(*) FILTER (len(hard) = 0) OVER (PARTITION BY prompt, mode) > 0 THEN count(*) FILTER (len(hard) = 0) OVER (PARTITION BY prompt, mode) END)::BIGINT AS group_size FROM w"""
)
def best_of_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(v.scored(spark, sf_dir).select("ord", "mode", "hard", "stat_score", "record_hash", F.substring_index("answer", " ", 1).alias("prompt")), "scored")
    out = sc.best_of_n(rows)
    return out.select("ord", F.array_contains("hard", "BEST-OF-N").alias("lost"), "group_size")


@query(
    f"""WITH {DOCS}, g AS (SELECT ord, style_id, category, mode, length(answer) AS n FROM docs),
    d AS (SELECT a.ord AS x, b.ord AS y, CASE WHEN a.n > b.n THEN 1 WHEN a.n < b.n THEN 0 ELSE 0.5 END::DOUBLE AS p FROM g a JOIN g b ON a.style_id IS NOT DISTINCT FROM b.style_id AND a.category IS NOT DISTINCT FROM b.category AND a.mode = b.mode AND a.ord < b.ord),
    e AS (SELECT x AS ord, p FROM d UNION ALL SELECT y, 1 - p FROM d)
    SELECT ord, round(coalesce(avg(p), 1), 6) AS win_rate FROM g LEFT JOIN e USING (ord) GROUP BY ord"""
)
def pair_winrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tournament of all documents within their groups, by counts of lengths."""
    rows = v.docs(spark, sf_dir).select("ord", "style_id", "category", "mode", F.length("answer").alias("n"))
    return sc.value_win_rate(rows, ("style_id", "category", "mode"), "ord", "n").select("ord", v.r6("win_rate").alias("win_rate"))


@query(f"WITH {DOCS} SELECT count(*) AS n, count(*) FILTER (answer IS NOT NULL AND mode IS NOT NULL AND finish_reason IS NOT NULL) AS ok FROM docs")
def schema_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = schema_ok(("answer", "mode", "finish_reason"))
    return v.docs(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("ok"))


@query(f"WITH {DOCS} SELECT ord, {v.truncated('answer')} AS truncated FROM docs")
def truncation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.docs(spark, sf_dir).select("ord", t.looks_truncated(F.col("answer")).alias("truncated"))
