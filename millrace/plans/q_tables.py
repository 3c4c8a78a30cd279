"""Queries: joins, incremental runs, dedup, windows, sorts, pages, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import aggregates as ag
from ..operators import dedup as dd
from ..operators import incremental as inc
from ..operators import metric, segments, setjoin
from ..operators import variants as va
from ..sources import readers
from ..sources.scratch import stored
from . import views as v
from .catalogue import query
from .q_signals import narrow

DOCS, SCORED = v.DOCS, v.SCORED


@query("SELECT count(*) AS n FROM documents")
def count_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.docs(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH s AS (SELECT 'h' || doc_id % 500 AS record_hash, doc_id AS ord, (doc_id % 2)::INT AS src, doc_id / 1000 AS final_score FROM documents)
    SELECT record_hash, arg_max(ord, (src, ord)) AS ord, round(arg_max(final_score, (src, ord)), 6) AS final_score FROM s GROUP BY record_hash"""
)
def cache_merge_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    rows = v.table(spark, sf_dir, "documents").select(F.concat(F.lit("h"), d % 500).alias("record_hash"), d.alias("ord"), (d % 2).alias("src"), (d / 1000).alias("final_score"))
    out = inc.merge_caches([rows.filter(F.col("src") == i).drop("src") for i in (0, 1)])
    return out.select("record_hash", "ord", v.r6("final_score").alias("final_score"))


@query(f"WITH {SCORED} SELECT count(DISTINCT record_hash) AS evaluated, count(*) FILTER (len(hard) = 0) AS kept, count(*) FILTER (len(hard) > 0) AS rejected FROM scored")
def resume_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.resume_state(narrow(spark, sf_dir).withColumn("accepted", F.size("hard") == 0))


@query(f"WITH {DOCS} SELECT ord, record_hash FROM docs WHERE ord % 2 = 1")
def resume_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.docs(spark, sf_dir).select("ord", "record_hash")
    return inc.pending(rows, rows.filter("ord % 2 = 0"), ["record_hash"])


VERSIONS = {"LEN-A": "v1", "TRUNC": "v2", "END-WELL": "v1"}


def _cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier run: the even rows, of which every third has an old TRUNC."""
    trunc = F.when(F.col("ord") % 3 == 0, "v1").otherwise("v2")
    return v.docs(spark, sf_dir).filter("ord % 2 = 0").select("record_hash", F.create_map(F.lit("LEN-A"), F.lit("v1"), F.lit("TRUNC"), trunc, F.lit("END-WELL"), F.lit("v1")).alias("signal_versions"), F.create_map(F.lit("LEN-A"), F.lit(0.25), F.lit("OLD"), F.lit(0.5)).alias("signal_scores"))


@query(
    f"""WITH {DOCS} SELECT ord, ord % 2 = 0 AS known, CASE WHEN ord % 2 = 1 THEN '' WHEN ord % 3 = 0 THEN 'LEN-A,END-WELL' ELSE 'LEN-A,TRUNC,END-WELL' END AS reusable,
    CASE WHEN ord % 2 = 1 THEN 'LEN-A,TRUNC,END-WELL' WHEN ord % 3 = 0 THEN 'TRUNC' ELSE '' END AS stale FROM docs"""
)
def cache_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = inc.lookup(v.docs(spark, sf_dir).select("ord", "record_hash"), _cache(spark, sf_dir), VERSIONS)
    return out.select("ord", "known", F.array_join("reusable", ",").alias("reusable"), F.array_join("stale", ",").alias("stale"))


@query(
    f"""WITH {DOCS} SELECT count(*) FILTER (ord % 2 = 0 AND ord % 3 <> 0) AS "full", count(*) FILTER (ord % 2 = 0 AND ord % 3 = 0) AS partial, count(*) FILTER (ord % 2 = 1) AS "new",
    sum(CASE WHEN ord % 2 = 1 THEN 0 WHEN ord % 3 = 0 THEN 2 ELSE 3 END)::BIGINT AS saved FROM docs"""
)
def incremental_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.counters(inc.lookup(v.docs(spark, sf_dir).select("ord", "record_hash"), _cache(spark, sf_dir), VERSIONS))


@query(f"WITH {SCORED} SELECT ord, round(s1, 6) AS len_a, CASE WHEN ord % 2 = 0 THEN 0.5::DOUBLE END AS old FROM scored")
def cache_merge_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = inc.merge_signals(narrow(spark, sf_dir), _cache(spark, sf_dir))
    return out.select("ord", v.r6(F.col("signal_scores")["LEN-A"]).alias("len_a"), F.try_element_at("signal_scores", F.lit("OLD")).alias("old"))


@query(f"WITH {SCORED} SELECT ord, round(CASE WHEN ord % 2 = 0 THEN final_score ELSE 0 END, 6) AS final_score, CASE WHEN ord % 2 = 0 THEN array_to_string(hard, ',') ELSE 'rescore_miss' END AS reasons FROM scored")
def rescore_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cached rows composed anew; the others marked as missed."""
    cached = narrow(spark, sf_dir).filter("ord % 2 = 0").select("record_hash", "final_score", F.array_join("hard", ",").alias("reasons"))
    out = v.docs(spark, sf_dir).select("ord", "record_hash").join(cached, "record_hash", "left")
    return out.select("ord", v.r6(F.coalesce("final_score", F.lit(0.0))).alias("final_score"), F.coalesce("reasons", F.lit("rescore_miss")).alias("reasons"))


@query(f"WITH {DOCS} SELECT style_id, mode, temperature, top_p FROM docs GROUP BY ALL HAVING NOT arg_max({v.truncated('answer')}, ord)")
def done_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.done_keys(v.docs(spark, sf_dir), ["style_id", "mode", "temperature", "top_p"], "ord", t.looks_truncated(F.col("answer")))


@query(f"WITH {DOCS} SELECT DISTINCT style_id, mode, temperature, top_p FROM docs WHERE {v.truncated('answer')}")
def truncated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.truncated_keys(v.docs(spark, sf_dir), ["style_id", "mode", "temperature", "top_p"], t.looks_truncated(F.col("answer")))


@query(
    f"""WITH {DOCS}, done AS (SELECT DISTINCT style_id, mode, temperature, top_p FROM docs WHERE ord % 7 = 0), cut AS (SELECT DISTINCT style_id, mode, temperature, top_p FROM docs WHERE ord % 7 = 1)
    SELECT * FROM done EXCEPT SELECT * FROM cut"""
)
def redo_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = v.docs(spark, sf_dir).select("ord", "style_id", "mode", "temperature", "top_p")
    part = lambda i: keys.filter(F.col("ord") % 7 == i).drop("ord").distinct()
    return part(0).subtract(part(1))


def _sweep(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", F.col("lang").alias("style_id"))
    return va.expand(rows, {"style_id": ["plain", "formal"], "temperature": [0.2, 0.7], "top_p": [0.8, 0.9, 1.0]}, "doc_id").withColumn("variant_no", F.col("variant_no").cast("int"))


@query(
    """WITH s AS (SELECT unnest(['plain', 'formal']) AS style_id, unnest([0, 1]) AS i), a AS (SELECT unnest([0.2, 0.7]::DOUBLE[]) AS temperature, unnest([0, 1]) AS j),
    p AS (SELECT unnest([0.8, 0.9, 1.0]::DOUBLE[]) AS top_p, unnest([0, 1, 2]) AS k) SELECT doc_id, style_id, temperature, top_p, (i * 6 + j * 3 + k)::INT AS variant_no FROM documents, s, a, p"""
)
def expand_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sweep of all documents."""
    return _sweep(v.table(spark, sf_dir, "documents"))


@query(
    """WITH v AS (SELECT doc_id, temperature, top_p FROM documents, (SELECT unnest([0.2, 0.7]::DOUBLE[]) AS temperature), (SELECT unnest([0.8, 0.9]::DOUBLE[]) AS top_p))
    SELECT * FROM v WHERE NOT (doc_id % 3 = 0 AND temperature = 0.2)"""
)
def pending_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = va.expand(v.table(spark, sf_dir, "documents").select("doc_id"), {"temperature": [0.2, 0.7], "top_p": [0.8, 0.9]}, "doc_id").drop("variant_no")
    return inc.pending(every, every.filter((F.col("doc_id") % 3 == 0) & (F.col("temperature") == 0.2)), ["doc_id", "temperature", "top_p"])


@query(
    """SELECT doc_id, coalesce(CASE WHEN doc_id % 3 = 0 THEN 0.1::DOUBLE * (doc_id % 10) END, 0.7::DOUBLE) AS temperature, coalesce(CASE WHEN doc_id % 4 = 0 THEN 1.3::DOUBLE END, CASE WHEN doc_id % 2 = 0 THEN 1.05::DOUBLE END, 1.1::DOUBLE) AS repetition_penalty FROM documents"""
)
def merge_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    rows = v.table(spark, sf_dir, "documents").select(d, F.when(d % 3 == 0, F.lit(0.1) * (d % 10)).alias("temperature"), F.when(d % 4 == 0, F.lit(1.3)).alias("repetition_penalty"))
    return va.merge_defaults(rows, {"temperature": 0.7, "repetition_penalty": 1.1}, d % 2 == 0, 1.05)


@query("""WITH a AS (SELECT 'src' || i AS category, 'd' || i % 4 AS domain FROM range(15) r(i) UNION ALL SELECT 'src3', 'late') SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'own' WHEN source = 'src3' THEN 'late' ELSE domain END AS domain FROM documents LEFT JOIN (SELECT DISTINCT category, domain FROM a WHERE domain <> 'late') ON source = category""")
def domain_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = spark.createDataFrame([(f"src{i}", f"d{i % 4}", i) for i in range(15)] + [("src3", "late", 99)], "category string, domain string, pos int")
    rows = v.table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("category"), F.when(F.col("doc_id") % 10 == 0, "own").alias("domain"))
    return va.resolve_domain(rows, aliases).select("doc_id", "domain")


@query("""WITH d AS (SELECT doc_id, unnest([doc_id % 5, doc_id % 7]) AS tool FROM documents) SELECT doc_id, 't' || tool AS name, tool < 6 AS known FROM d""")
def resolve_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tools that rows ask for, and whether the registry knows them."""
    registry = spark.createDataFrame([(f"t{i}", f"tool {i}") for i in range(6)], "name string, description string")
    d = F.col("doc_id")
    asked = v.table(spark, sf_dir, "documents").select(d, F.explode(F.array(d % 5, d % 7)).alias("tool")).select("doc_id", F.concat(F.lit("t"), "tool").alias("name"))
    return asked.join(registry, "name", "left").select("doc_id", "name", F.col("description").isNotNull().alias("known"))


@query(
    """WITH l AS (SELECT source AS name, min(doc_id) AS ord FROM documents WHERE lang = 'en' GROUP BY source), r AS (SELECT source AS name, min(doc_id) AS ord FROM documents WHERE lang = 'de' AND length(text) > 3000 GROUP BY source)
    SELECT name, CASE WHEN r.ord IS NULL THEN 'registry' ELSE 'adhoc' END AS origin, CASE WHEN l.ord IS NULL THEN 1 ELSE 0 END AS first_side, coalesce(l.ord, r.ord) AS first_ord FROM l FULL JOIN r USING (name)"""
)
def merge_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources of English documents as a registry, those of long German ones over it."""
    d = v.table(spark, sf_dir, "documents")
    make = lambda rows, origin: rows.groupBy(F.col("source").alias("name")).agg(F.lit(origin).alias("origin"), F.min("doc_id").alias("ord"))
    return va.merge_by_name(make(d.filter("lang = 'en'"), "registry"), make(d.filter("lang = 'de' AND length(text) > 3000"), "adhoc"))


@query(f"WITH {DOCS}, f AS (SELECT ord, min(ord) OVER (PARTITION BY {v.strip('answer')}) AS first_ord FROM docs) SELECT ord, first_ord, ord > first_ord AS is_dup FROM f")
def dup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.docs(spark, sf_dir).select("ord", F.sha1(t.strip(F.col("answer")).cast("binary")).alias("k"))
    return dd.mark_repeats(rows, F.col("k")).select("ord", "first_ord", "is_dup")


@query("SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY lower(split_part(text, ' ', 1)) ORDER BY doc_id) = 1")
def prompt_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), F.lower(F.substring_index("text", " ", 1)).alias("k"))
    return dd.mark_repeats(rows, F.col("k")).filter("NOT is_dup").select(F.col("ord").alias("doc_id"))


@query("SELECT doc_id, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id)::INT AS nth FROM documents QUALIFY nth <= 5")
def cap_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), "source", "lang")
    return dd.cap_per_key(rows, [F.col("source"), F.col("lang")]).select(F.col("ord").alias("doc_id"), "nth")


@query()
def near_dup_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What sequential insertion into a MinHash index keeps."""
    return dd.insert_in_order(dd.signatures(v.docs(spark, sf_dir), "answer"))[0]


@query()
def near_dup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each row meets when it is inserted into a MinHash index: the kept rows before it that share a bucket."""
    return dd.insert_in_order(dd.signatures(v.docs(spark, sf_dir), "answer"))[1]


SH = r"""list_distinct(CASE WHEN length(x) < 5 THEN [x] ELSE list_transform(range(length(x) - 4), lambda i: substr(x, (i + 1)::BIGINT, 5)) END)"""


@query(
    rf"""WITH b AS (SELECT item_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS x FROM benchmark), s AS (SELECT item_id, {SH} AS g FROM b), e AS (SELECT item_id, len(g) AS n, unnest(g) AS w FROM s),
    p AS (SELECT a.item_id AS u, c.item_id AS v, any_value(a.n) AS na, any_value(c.n) AS nc, count(*) AS k FROM e a JOIN e c ON a.w = c.w AND a.item_id < c.item_id GROUP BY 1, 2)
    SELECT u, v, round(k / (na + nc - k), 6) AS jaccard FROM p WHERE k / (na + nc - k) >= 0.1"""
)
def jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact Jaccard of the character shingles of benchmark items, by their shared shingles."""
    rows = v.table(spark, sf_dir, "benchmark").select("item_id", dd.shingles(F.col("text")).alias("g"))
    e = rows.select("item_id", F.size("g").alias("n"), F.explode("g").alias("w"))
    a, b = e.select(F.col("item_id").alias("u"), F.col("n").alias("na"), "w"), e.select(F.col("item_id").alias("v"), F.col("n").alias("nb"), "w")
    shared = a.join(b, "w").filter("u < v").groupBy("u", "v").agg(F.first("na").alias("na"), F.first("nb").alias("nb"), F.count(F.lit(1)).alias("k"))
    j = F.col("k") / (F.col("na") + F.col("nb") - F.col("k"))
    return shared.filter(j >= 0.1).select("u", "v", v.r6(j).alias("jaccard"))


@query(
    r"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' ')) END)) AS g FROM w),
    c AS (SELECT doc_id, g, CASE WHEN len(g) > 0 THEN min(doc_id) OVER (PARTITION BY g) ELSE doc_id END AS class_id, CASE WHEN len(g) > 0 THEN count(*) OVER (PARTITION BY g) ELSE 1 END AS members FROM s),
    e AS (SELECT doc_id, members, len(g) AS n, unnest(g) AS x FROM c WHERE doc_id = class_id),
    p AS (SELECT a.doc_id AS u, b.doc_id AS v, any_value(b.members) AS m FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL HAVING count(*) >= 0.8 * (any_value(a.n) + any_value(b.n) - count(*)))
    SELECT doc_id, class_id, (members - 1 + coalesce((SELECT sum(m) FROM p WHERE u = class_id), 0))::BIGINT AS n_links FROM c"""
)
def jaccard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact Jaccard of 0.8 and more on five-word shingles: the class of each document and its links."""
    return setjoin.linked(v.spread(v.table(spark, sf_dir, "documents")), "doc_id", "text")


@query("SELECT a.vec_id AS u, b.vec_id AS v FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.4")
def semantic_dup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric.pairs(v.table(spark, sf_dir, "embeddings"), 0.4).select("u", "v")


@query(
    """WITH p AS (SELECT a.vec_id AS vec_id, b.vec_id AS other FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.5)
    SELECT vec_id, min(vec_id) OVER (PARTITION BY embedding) AS class_id, coalesce(n, 0) AS n_links FROM embeddings LEFT JOIN (SELECT vec_id, count(*) AS n FROM p GROUP BY vec_id) USING (vec_id)"""
)
def semantic_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many vectors are like each vector; equal ones are a class."""
    return metric.neighbours(v.table(spark, sf_dir, "embeddings"), 0.5)


@query()
def semantic_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors kept in order, each unlike all kept before it."""
    rows = v.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("ord"), "embedding")
    return dd.greedy_keep(rows.select("ord"), metric.pairs(rows, 0.4, "ord")).select("ord", "kept")


@query(
    """WITH c AS (SELECT event_id, user_id, event_type, (value::INT % 3) AS arg FROM events), k AS (SELECT *, min(event_id) OVER (PARTITION BY user_id, event_type, arg) AS original FROM c)
    SELECT event_id, event_id > original AS deduped, original AS original_call FROM k"""
)
def tool_call_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls by user, name and argument: the first runs, later ones reuse it."""
    c = v.table(spark, sf_dir, "events").select(F.col("event_id").alias("ord"), "user_id", "event_type", (F.rint("value").cast("int") % 3).alias("arg"))
    out = dd.mark_repeats(c, F.struct("user_id", "event_type", "arg"))
    return out.select(F.col("ord").alias("event_id"), F.col("is_dup").alias("deduped"), F.col("first_ord").alias("original_call"))


@query("""WITH c AS (SELECT user_id, event_type, (value::INT % 3) AS arg FROM events) SELECT user_id, count(*) AS calls, count(DISTINCT (event_type, arg)) AS unique_calls, count(*) - count(DISTINCT (event_type, arg)) AS skipped FROM c GROUP BY user_id""")
def tool_dedupe_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = v.table(spark, sf_dir, "events").select("user_id", F.struct("event_type", F.rint("value").cast("int") % 3).alias("k"))
    n, u = F.count(F.lit(1)), F.countDistinct("k")
    return c.groupBy("user_id").agg(n.alias("calls"), u.alias("unique_calls"), (n - u).alias("skipped"))


@query(
    """WITH i AS (SELECT *, event_type = 'view' AS empty, sum((event_type <> 'view')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM events)
    SELECT event_id, CASE WHEN empty THEN sum(empty::INT) OVER (PARTITION BY user_id, g ORDER BY ts, event_id) ELSE 0 END::BIGINT AS streak FROM i"""
)
def streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = v.table(spark, sf_dir, "events")
    return segments.streaks(e, F.col("event_type") == "view", ["user_id"], ["ts", "event_id"]).select("event_id", "streak")


@query("SELECT event_id, count(*) OVER (PARTITION BY user_id, event_type ORDER BY event_id) >= 2 AS aborts FROM events WHERE event_type = 'error'")
def error_circuit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second error of a kind in a user's calls ends them, so all but the first."""
    e = v.table(spark, sf_dir, "events").filter("event_type = 'error'").select(F.col("event_id").alias("ord"), "user_id", "event_type")
    return dd.mark_repeats(e, F.struct("user_id", "event_type")).select(F.col("ord").alias("event_id"), F.col("is_dup").alias("aborts"))


@query("SELECT event_id, user_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) <= 5")
def last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy(F.desc("event_id"))
    return v.table(spark, sf_dir, "events").withColumn("i", F.row_number().over(w)).filter("i <= 5").select("event_id", "user_id")


@query("SELECT event_id, coalesce(event_type <> lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id), true) AS changed FROM events")
def changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = v.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return segments.changed(e, F.col("event_type"), ["user_id"], ["event_id"]).select("event_id", "changed")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 50")
def page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(50).limit(25)


@query(
    """WITH o AS (SELECT o_orderkey, o_orderdate FROM orders), c AS (SELECT * FROM o ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1 OFFSET 99), p AS (SELECT o.* FROM o, c WHERE o.o_orderdate < c.o_orderdate OR (o.o_orderdate = c.o_orderdate AND o.o_orderkey < c.o_orderkey) ORDER BY o.o_orderdate DESC, o.o_orderkey DESC LIMIT 20)
    SELECT o_orderkey, o_orderdate, true AS has_more FROM p"""
)
def sessions_keyset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page of 20 that follows the first 100."""
    o = v.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    last = o.orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).offset(99).limit(1).first()
    return readers.keyset_page(o, "o_orderdate", "o_orderkey", (last.o_orderdate, last.o_orderkey), 20)


@query(
    """WITH c AS (SELECT user_id AS total, count(*) AS accepted, max(event_id) AS generated_at FROM events GROUP BY user_id) SELECT total, accepted, generated_at FROM c ORDER BY total DESC, accepted DESC, generated_at DESC LIMIT 1"""
)
def pick_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = v.table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("total")).agg(F.count(F.lit(1)).alias("accepted"), F.max("event_id").alias("generated_at"))
    return readers.pick_newest(c, ["total", "accepted", "generated_at"])


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer UNION ALL SELECT c_custkey + 1000000, c_acctbal FROM customer WHERE c_custkey % 7 = 0")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = v.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    changes = c.filter("c_custkey % 3 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1).union(c.filter("c_custkey % 7 = 0").withColumn("c_custkey", F.col("c_custkey") + 1000000))
    return inc.upsert(c, changes, "c_custkey")


@query("SELECT doc_id FROM documents WHERE doc_id <> 17")
def delete_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.table(spark, sf_dir, "documents").filter("doc_id <> 17").select("doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def anti_join_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = v.table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id")
    return v.table(spark, sf_dir, "documents").select("doc_id").join(gone, "doc_id", "left_anti")


@query("""WITH n AS (SELECT 'src' || (i % 30) AS domain, 'p' || i AS prompt FROM range(60) r(i)) SELECT n.* FROM n SEMI JOIN (SELECT DISTINCT source FROM documents) d ON n.domain = d.source WHERE prompt NOT IN (SELECT 'p' || doc_id FROM documents WHERE doc_id % 2 = 0)""")
def insert_if_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual prompts of known domains that the bank doesn't hold."""
    new = spark.createDataFrame([(f"src{i % 30}", f"p{i}") for i in range(60)], "domain string, prompt string")
    d = v.table(spark, sf_dir, "documents")
    held = d.filter("doc_id % 2 = 0").select(F.concat(F.lit("p"), "doc_id").alias("prompt"))
    return new.join(d.select(F.col("source").alias("domain")).distinct(), "domain", "left_semi").join(held, "prompt", "left_anti").select("domain", "prompt")


@query("SELECT doc_id, [0.7::DOUBLE, 0.8, 0.9][(doc_id % 3 + 1)::INT] AS temperature, [0.9::DOUBLE, 0.95][(doc_id % 2 + 1)::INT] AS top_p FROM documents")
def rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    turn = lambda values: F.element_at(F.array(*map(F.lit, values)), (d % len(values) + 1).cast("int"))
    return v.table(spark, sf_dir, "documents").select(d, turn([0.7, 0.8, 0.9]).alias("temperature"), turn([0.9, 0.95]).alias("top_p"))


@query()
def locale_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that documents begin with, in the order of a language; DuckDB has no collations here."""
    names = v.table(spark, sf_dir, "documents").select(F.substring_index("text", " ", 1).alias("name")).distinct()
    return names.orderBy(F.collate("name", "fr"), "name")


@query("SELECT source AS category, lang AS style_id, count(*) AS n FROM documents GROUP BY ALL ORDER BY category, style_id LIMIT 25 OFFSET 25")
def browse_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of styles; a page beyond the last shows the last."""
    tree = v.table(spark, sf_dir, "documents").groupBy(F.col("source").alias("category"), F.col("lang").alias("style_id")).agg(F.count(F.lit(1)).alias("n"))
    last = max(0, -(-tree.count() // 25) - 1)
    return tree.orderBy("category", "style_id").offset(25 * min(1, last)).limit(25)


@query("SELECT conv_id, nullif(left(trim(arg_min(text, turn)), 30), '') AS title FROM conversations WHERE role = 'user' GROUP BY conv_id")
def session_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = v.table(spark, sf_dir, "conversations").filter("role = 'user'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("p"))
    return first.select("conv_id", t.full(F.left(t.strip(F.col("p")), F.lit(30))).alias("title"))
