"""Queries: scalar text functions, search, parsers, sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import parse
from ..functions import text as t
from ..operators import search as se
from ..operators.dedup import cosine
from ..sources import readers, sinks
from ..sources.scratch import scratch
from . import views as v
from .catalogue import query
from .q_reports import MARKDOWN, SENTENCES

DOCS, RESPONSES = v.DOCS, v.RESPONSES


@query(f"WITH {DOCS} SELECT ord, {MARKDOWN} AS markdown FROM docs")
def has_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.docs(spark, sf_dir).select("ord", t.has_markdown(F.col("answer")).alias("markdown"))


@query(f"WITH {DOCS} SELECT ord, {SENTENCES}::INT AS n FROM docs")
def sentence_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.docs(spark, sf_dir).select("ord", t.sentence_count(F.col("answer")).alias("n"))


THOUGHT = "'a <think> ' || thinking_trace || chr(10) || '</think> ' || answer || ' <think>x</think> end'"


def _thought(answer: Column) -> Column:
    return F.concat(F.lit("a <think> "), "thinking_trace", F.lit("\n</think> "), answer, F.lit(" <think>x</think> end"))


def _stripped(docs: DataFrame, answer: Column) -> DataFrame:
    c = F.concat(F.lit("</think>"), _thought(answer), F.when(F.col("ord") % 2 == 0, " <think> open").otherwise(""))
    return docs.select("ord", t.strip_think(c).alias("body"))


@query(rf"WITH {DOCS}, x AS (SELECT ord, {THOUGHT} AS c FROM docs) SELECT ord, {v.strip("regexp_extract(c, '(?s)<think>(.*?)</think>', 1)")} AS thinking, {v.strip("regexp_replace(c, '(?s)<think>.*?</think>', '', 'g')")} AS body FROM x")
def extract_thinking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of whole answers."""
    return v.docs(spark, sf_dir).select("ord", t.extract_thinking(_thought(F.col("answer"))).alias("x")).select("ord", "x.*")


@query(rf"WITH {DOCS}, x AS (SELECT ord, '</think>' || {THOUGHT} || CASE WHEN ord % 2 = 0 THEN ' <think> open' ELSE '' END AS c FROM docs) SELECT ord, {v.strip("regexp_replace(replace(regexp_replace(c, '(?s)<think>.*?</think>', '', 'g'), '</think>', ''), '(?s)<think>.*$', '')")} AS body FROM x")
def strip_think(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of whole answers."""
    return _stripped(v.docs(spark, sf_dir), F.col("answer"))


@query(f"WITH {DOCS} SELECT ord, CASE WHEN length(answer) <= 1000 THEN answer ELSE left(answer, 500) || chr(10) || '...' || chr(10) || right(answer, 500) END AS clipped, CASE WHEN length(answer) > 200 THEN left(answer, 200) || '…' ELSE answer END AS preview FROM docs")
def clip_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.docs(spark, sf_dir).select("ord", t.clip_middle(F.col("answer")).alias("clipped"), t.clip(F.col("answer"), 200).alias("preview"))


@query(f"WITH {DOCS} SELECT ord, array_to_string(regexp_extract_all(lower(answer), '[a-z0-9]+'), ' ') AS tokens FROM docs")
def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of whole answers."""
    return v.docs(spark, sf_dir).select("ord", F.array_join(t.tokenize(F.col("answer")), " ").alias("tokens"))


SNIP = """p AS (SELECT ord, answer, length(answer) AS n, instr(lower(answer), 'tion') - 1 AS place FROM docs),
s AS (SELECT *, greatest(0, place - 100) AS s0, least(n, greatest(0, place - 100) + 200) AS e FROM p), u AS (SELECT *, CASE WHEN e - s0 < 200 THEN greatest(0, e - 200) ELSE s0 END AS b FROM s)"""


@query(f"WITH {DOCS}, {SNIP} SELECT ord, CASE WHEN n <= 200 THEN answer ELSE CASE WHEN b > 0 THEN '…' ELSE '' END || substr(answer, b + 1, e - b) || CASE WHEN e < n THEN '…' ELSE '' END END AS snippet FROM u WHERE place >= 0")
def snippet(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = v.docs(spark, sf_dir).filter(F.contains(F.lower(F.col("answer")), F.lit("tion")))
    return d.select("ord", t.snippet(F.col("answer"), "tion").alias("snippet"))


@query(f"WITH {DOCS} SELECT ord FROM docs WHERE contains(lower(answer), 'the th') AND mode = 'thinking'")
def keyword_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return se.keyword(v.docs(spark, sf_dir).filter("mode = 'thinking'"), "The TH", ["answer", "thinking_trace"]).select("ord")


TOKENS = "tok AS (SELECT ord, unnest(regexp_extract_all(lower(answer), '[a-z0-9]+')) AS term FROM docs)"
BM = f"""WITH {DOCS}, {TOKENS}, dl AS (SELECT ord, len(regexp_extract_all(lower(answer), '[a-z0-9]+')) AS dl FROM docs), post AS (SELECT term, ord, count(*) AS tf FROM tok GROUP BY ALL),
raw AS (SELECT term, count(*) AS df, ln((SELECT count(*) FROM docs) - count(*) + 0.5) - ln(count(*) + 0.5) AS raw FROM post GROUP BY term),
terms AS (SELECT term, df, CASE WHEN raw < 0 THEN 0.25::DOUBLE * (SELECT avg(raw) FROM raw) ELSE raw END AS idf FROM raw)"""


@query(f"{BM} SELECT term, df, round(idf, 6) AS idf FROM terms")
def bm25_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = se.build(v.docs(spark, sf_dir), text="answer")
    return index.terms.select("term", "df", v.r6("idf").alias("idf"))


@query(
    f"""{BM}, q AS (SELECT 'of' AS term, 2 AS times UNION ALL SELECT 'idiot', 1), sc AS (SELECT ord, sum(times * idf * (tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / (SELECT avg(dl) FROM dl))))) AS score FROM post JOIN q USING (term) JOIN terms USING (term) JOIN dl USING (ord) GROUP BY ord)
    SELECT ord, round(coalesce(score, 0), 4) AS score FROM docs LEFT JOIN sc USING (ord) WHERE style_id = 'en' ORDER BY round(coalesce(score, 0), 9) DESC, ord LIMIT 50"""
)
def bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = v.docs(spark, sf_dir)
    index = se.build(d, text="answer")
    return se.search(index, d.filter("style_id = 'en'"), "Of idiot of").select("ord", "score")


GUARDED = """u AS (SELECT page_id, url FROM pages UNION ALL SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'http://172.' || length(html) % 40 || '.0.1/a#b' WHEN 1 THEN 'http://localhost' || CASE WHEN length(html) % 2 = 0 THEN '.example.org' ELSE '' END || '/x'
WHEN 2 THEN 'https://192.168.' || length(html) % 256 || '.7:8080/#top' ELSE 'ftp://10.0.0.' || length(html) % 256 || '/f' END FROM pages)"""


@query(
    rf"""WITH {GUARDED} SELECT page_id, split_part(url, '#', 1) AS page, starts_with(url, 'https://') AS secure, regexp_extract(url, '^https?://([^/?#:]+)', 1) AS host,
    regexp_matches(url, '^https?://(localhost([/?#:]|$)|127\.|10\.|192\.168\.|172\.(1[6-9]|2[0-9]|3[01])\.)') AS private FROM u"""
)
def url_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of pages, and addresses of private networks made of their lengths: without anchors, whether they are secure, and whether they must not be fetched."""
    p = v.table(spark, sf_dir, "pages")
    d, n = F.col("page_id"), F.length("html")
    made = F.when(d % 4 == 0, F.concat(F.lit("http://172."), n % 40, F.lit(".0.1/a#b"))).when(d % 4 == 1, F.concat(F.lit("http://localhost"), F.when(n % 2 == 0, ".example.org").otherwise(""), F.lit("/x")))
    made = made.when(d % 4 == 2, F.concat(F.lit("https://192.168."), n % 256, F.lit(".7:8080/#top"))).otherwise(F.concat(F.lit("ftp://10.0.0."), n % 256, F.lit("/f")))
    u = F.col("url")
    host = F.regexp_extract(u, r"^https?://([^/?#:]+)", 1)
    private = host.rlike(r"^(localhost$|127\.|10\.|192\.168\.|172\.(1[6-9]|2\d|3[01])\.)")
    return p.select("page_id", "url").union(p.select("page_id", made)).select("page_id", F.substring_index("url", "#", 1).alias("page"), u.startswith("https://").alias("secure"), host.alias("host"), private.alias("private"))


@query()
def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.table(spark, sf_dir, "pages").select("page_id", parse.html_text(F.col("html")).alias("text"))


@query("SELECT page_id, regexp_replace(replace(replace(html || chr(13) || chr(10) || chr(7) || 'x' || chr(13), chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[\\x00-\\x08\\x0b-\\x1f]', '', 'g') AS html FROM pages")
def sanitize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.clean_strings(v.table(spark, sf_dir, "pages").select("page_id", F.concat("html", F.lit("\r\n\x07x\r")).alias("html")))


@query("SELECT doc_id AS ord, 'think tag in answer' AS problem FROM documents WHERE doc_id % 9 = 4 UNION ALL SELECT doc_id, 'invalid JSON' FROM documents WHERE doc_id % 9 = 5 UNION ALL SELECT doc_id, 'not an object' FROM documents WHERE doc_id % 9 = 6")
def lint_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    good = F.to_json(F.struct(F.col("text").alias("answer")))
    bad = F.to_json(F.struct(F.concat(F.lit("<think>"), "text").alias("answer")))
    value = F.when(d % 9 == 4, bad).when(d % 9 == 5, "{oops").when(d % 9 == 6, "[1]").when(d % 9 == 7, "  ").otherwise(good)
    return readers.lint(v.table(spark, sf_dir, "documents").select(d.alias("ord"), value.alias("value")))


@query("SELECT doc_id, text AS prompt, lang AS category FROM documents")
def scan_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as JSON Lines with broken lines among them, and read back."""
    path = scratch(spark, "jsonl")
    d = v.table(spark, sf_dir, "documents")
    sinks.append_jsonl(d.select(F.col("text").alias("prompt"), F.col("lang").alias("category"), F.col("doc_id").cast("string").alias("session_id")), path, "gzip")
    d.limit(3).select(F.lit("{broken").alias("value")).write.mode("append").text(path)
    return readers.prompt_rows(spark, path).select(F.col("session_id").cast("long").alias("doc_id"), "prompt", "category")


@query("SELECT source AS prompt, lang AS category, count(*) AS n FROM documents GROUP BY ALL")
def csv_to_bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "csv")
    v.table(spark, sf_dir, "documents").select(F.col("lang").alias("分野"), F.concat(F.lit(" "), "source", F.lit(" ")).alias("プロンプト")).write.option("header", True).csv(path)
    return readers.csv_bank(spark, path).groupBy("prompt", "category").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id % 4 AS part, CASE doc_id % 4 WHEN 0 THEN 'high_quality' ELSE 'rejected' END AS name, count(*) AS n FROM documents GROUP BY ALL UNION ALL SELECT doc_id % 4, 'scores', count(*) FROM documents GROUP BY ALL")
def curate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    scores = v.table(spark, sf_dir, "documents").select((d % 4).alias("part"), (d % 4 == 0).alias("accepted"), F.array(F.lit("X")).alias("rejected_by"), F.lit(0.5).alias("final_score"))
    parts = sinks.split_curated(scores)
    out = [p.select("part", F.lit(n).alias("name")) for n, p in parts.items()]
    return out[0].union(out[1]).union(out[2]).groupBy("part", "name").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT unnest(['ok', 'high_quality']) AS name, count(*) AS n FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT 'review', count(*) FROM documents WHERE doc_id % 3 = 1 UNION ALL SELECT unnest(['ng', 'rejected']), count(*) FROM documents WHERE doc_id % 3 = 2 UNION ALL SELECT 'scores', count(*) FROM documents")
def screening_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every output of a screening run, written and counted again."""
    path = scratch(spark, "screening")
    d = F.col("doc_id")
    label = F.when(d % 3 == 0, "OK").when(d % 3 == 1, "REVIEW").otherwise("NG")
    sinks.write_split(sinks.split_screened(v.table(spark, sf_dir, "documents").select("doc_id", label.alias("screening_label"))), path)
    files = spark.read.text(f"{path}/*.jsonl").select(F.regexp_extract(F.input_file_name(), r"/(\w+)\.jsonl/", 1).alias("name"))
    return files.groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {RESPONSES} SELECT ord, '## Prompt' || chr(10) || chr(10) || prompt || chr(10) || chr(10) || '## Answer' || chr(10) || chr(10) || answer AS markdown FROM responses")
def record_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.responses(spark, sf_dir).withColumn("system_prompt", F.lit("")).withColumn("thinking_trace", F.lit(None).cast("string"))
    return rows.select("ord", sinks.record_markdown().alias("markdown"))


@query(f"WITH {RESPONSES} SELECT ord, CASE WHEN ord % 2 = 0 THEN 'system,user,assistant' ELSE 'user,assistant' END AS roles, 0 AS problems FROM responses")
def to_chatml(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.responses(spark, sf_dir).withColumn("system_prompt", F.when(F.col("ord") % 2 == 0, "Be brief."))
    return rows.select("ord", F.array_join(sinks.chat_messages()["role"], ",").alias("roles"), F.size(sinks.replay_problems()).alias("problems"))


@query(f"WITH {RESPONSES} SELECT ord, CASE WHEN ord % 2 = 0 THEN 'Base.' || chr(10) || chr(10) ELSE '' END || 'Style ' || style_id || '.' AS system_prompt FROM responses")
def compose_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.when(F.col("ord") % 2 == 0, "Base.  ")
    parts = F.concat_ws("\n\n", t.full(F.rtrim(t.text(base))), F.format_string("Style %s.", "style_id"))
    return v.responses(spark, sf_dir).select("ord", parts.alias("system_prompt"))


@query("SELECT doc_id, least(2048, greatest(64, 8192 - (n_chars // 3) - 32))::BIGINT AS max_tokens, (greatest(0, 8192 - 2048) * 128)::BIGINT AS budget, least(greatest(floor(n_chars * 1.5)::BIGINT, n_chars + 1), 4096)::BIGINT AS bumped, least(60, 2::DOUBLE ^ (doc_id % 10)) AS delay FROM documents")
def token_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_chars")
    return v.table(spark, sf_dir, "documents").select(
        "doc_id",
        t.effective_max_tokens(F.lit(2048), F.lit(8192), F.floor(n / 3)).cast("long").alias("max_tokens"),
        t.input_char_budget(F.lit(8192), F.lit(2048)).cast("long").alias("budget"),
        t.bumped_max_tokens(n, F.lit(4096)).cast("long").alias("bumped"),
        t.backoff_delay(F.col("doc_id") % 10).alias("delay"),
    )


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN n_chars WHEN 1 THEN n_chars END AS chars, CASE doc_id % 4 WHEN 2 THEN n_chars END AS tokens, doc_id % 4 <> 3 AS overflow FROM documents")
def context_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, n = F.col("doc_id"), F.col("n_chars")
    said = F.when(d % 4 == 0, F.format_string("Prompt contains %d characters", n)).when(d % 4 == 1, F.format_string('{"parameter": "input_text", "value": %d}', n)).when(d % 4 == 2, F.format_string("prompt contains at least %d input tokens", n)).otherwise("timeout")
    return v.table(spark, sf_dir, "documents").select("doc_id", t.overflow_characters(said).alias("chars"), t.overflow_tokens(said).alias("tokens"), t.is_overflow(said).alias("overflow"))


@query(
    """SELECT event_id, '今日は ' || strftime(ts + INTERVAL 9 HOUR, '%Y年%m月%d日') || ' (' || ['日', '月', '火', '水', '木', '金', '土'][(dayofweek(ts + INTERVAL 9 HOUR) + 1)::INT] || ') です。タイムゾーンは Asia/Tokyo です。' AS sentence FROM events"""
)
def date_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.table(spark, sf_dir, "events").select("event_id", t.date_context(F.col("ts")).alias("sentence"))


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN doc_id * 3600 + 30 * 60 WHEN 1 THEN doc_id END AS seconds FROM documents")
def parse_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    said = F.when(d % 3 == 0, F.format_string("%dh30m", d)).when(d % 3 == 1, F.format_string("%d s", d)).otherwise("soon")
    return v.table(spark, sf_dir, "documents").select("doc_id", t.parse_duration(said).alias("seconds"))


@query(
    """SELECT doc_id, CASE WHEN n_chars // 3600 > 0 THEN (n_chars // 3600) || 'h' ELSE '' END || CASE WHEN (n_chars // 60) % 60 > 0 THEN ((n_chars // 60) % 60) || 'm' ELSE '' END || CASE WHEN n_chars % 60 > 0 OR n_chars = 0 THEN (n_chars % 60) || 's' ELSE '' END AS said FROM documents"""
)
def format_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.table(spark, sf_dir, "documents").select("doc_id", t.format_duration(F.col("n_chars")).alias("said"))


@query("SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity FROM embeddings a, embeddings b WHERE b.vec_id = 0")
def cosine_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = v.table(spark, sf_dir, "embeddings")
    one = e.filter("vec_id = 0").select(F.col("embedding").alias("o"))
    return e.join(F.broadcast(one), F.lit(True)).select("vec_id", v.r6(cosine(F.col("embedding"), F.col("o"))).alias("similarity"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN (doc_id + 1) * 2.0::DOUBLE END AS value FROM documents")
def calc_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    return v.table(spark, sf_dir, "documents").select("doc_id", parse.calc(F.when(d % 2 == 0, F.format_string("(%d + 1) * 2", d)).otherwise("__import__('os')")).alias("value"))


@query(f"WITH {RESPONSES}, c AS (SELECT ord, unnest(CASE WHEN answer = '' THEN [0] ELSE range((length(answer) + 7) // 8) END) AS i, answer FROM responses) SELECT ord, i::INT AS pos, substr(answer, i * 8 + 1, 8) AS chunk FROM c")
def chunk_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of eight characters; an empty text gives one empty piece."""
    cut = F.when(F.col("answer") == "", F.array(F.lit(""))).otherwise(F.regexp_extract_all(F.col("answer"), F.lit("(?s).{1,8}"), F.lit(0)))
    return v.responses(spark, sf_dir).select("ord", F.posexplode(cut).alias("pos", "chunk"))


@query(f"WITH {RESPONSES} SELECT ord, CASE WHEN ord % 3 = 0 THEN false WHEN trim(answer) = '' THEN true ELSE {v.truncated('answer')} END AS retry FROM responses")
def needs_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers to ask for again: none after a tool loop that ran out."""
    return v.responses(spark, sf_dir).select("ord", F.when(F.col("ord") % 3 == 0, False).when(t.strip(F.col("answer")) == "", True).otherwise(t.looks_truncated(F.col("answer"))).alias("retry"))


@query("SELECT doc_id, 'search' AS name, '{\"q\": \"' || lang || '\"}' AS arguments, 'before  after' AS cleaned, 0 AS hints FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id, 'calc', '{}', 'x', 0 FROM documents WHERE doc_id % 3 = 1 UNION ALL SELECT doc_id, NULL, NULL, 'tail <tool_call> {\"name\": 1}', 1 FROM documents WHERE doc_id % 3 = 2")
def tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls in tags, in bare JSON, and a tag that nothing closes."""
    d = F.col("doc_id")
    said = (
        F.when(d % 3 == 0, F.concat(F.lit('before <tool_call>{"name": "search", "arguments": {"q": "'), "lang", F.lit('"}}</tool_call> after')))
        .when(d % 3 == 1, 'x {"name": "calc", "arguments": {}}')
        .otherwise('tail <tool_call> {"name": 1}')
    )
    found = v.table(spark, sf_dir, "documents").select("doc_id", parse.tool_calls(said, ["search", "calc"]).alias("x"))
    return found.select("doc_id", F.get("x.calls", F.lit(0))["name"].alias("name"), F.get("x.calls", F.lit(0))["arguments"].alias("arguments"), "x.cleaned", F.size("x.hints").alias("hints"))


@query()
def tool_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of conversations as calls and results, each result with the number of its call."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = v.table(spark, sf_dir, "conversations")
    calls = F.sum((F.col("role") == "user").cast("int")).over(w)
    return c.select("conv_id", "turn", F.when(F.col("role") == "user", "call").otherwise("result").alias("kind"), calls.alias("call_no"))


@query("WITH c AS (SELECT conv_id, turn, role, sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS call_no FROM conversations) SELECT conv_id, call_no FROM c GROUP BY ALL HAVING count(*) FILTER (role <> 'user') = 0")
def pending_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = tool_timeline(spark, sf_dir)
    calls, results = line.filter("kind = 'call'"), line.filter("kind = 'result'")
    return calls.join(results, ["conv_id", "call_no"], "left_anti").select("conv_id", "call_no")


@query()
def record_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.responses(spark, sf_dir).select("ord", t.fnv_key(F.col("prompt"), F.col("style_id"), F.lit("m"), F.lit("c"), F.lit(""), F.col("ord").cast("string")).alias("record_id"))


@query()
def record_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = v.docs(spark, sf_dir)
    sampling = F.to_json(F.struct("temperature", "top_p"))
    return d.select("ord", parse.record_hash(F.col("style_id"), F.col("answer"), F.col("mode"), sampling, F.lit(""), F.lit("c1"), F.col("thinking_trace")).alias("record_hash"))


@query("SELECT doc_id, 'a|b|c' AS names, 1.5::DOUBLE AS numbers FROM documents")
def parse_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma lists: trimmed names without empty ones, and the sum of numbers."""
    names = F.filter(F.transform(F.split(F.lit(" a, b,,c "), ","), lambda x: F.trim(x)), lambda x: x != "")
    numbers = F.transform(F.filter(F.split(F.lit("0.5, 1.0"), ","), lambda x: F.trim(x) != ""), lambda x: F.trim(x).try_cast("double"))
    return v.table(spark, sf_dir, "documents").select("doc_id", F.array_join(names, "|").alias("names"), F.aggregate(numbers, F.lit(0.0), lambda a, x: a + x).alias("numbers"))
