"""The registered queries of the operators, over whole tables, and the SQL that checks them where SQL can."""
from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from llm import decontaminate, languages, near_dedup, packing, runs, sharding, token_counts, token_files, token_windows, topk, urls, warc, wrappers
from llm.common import stored, table, vocabulary
from tidemart.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return register


@query("op1_sharding")
def op1(spark, d):
    return sharding.shard(table(spark, d, "documents"), shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: Fixed values of the contract: host, path, verdict.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


@query("op2_url_filters", """
WITH u AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '^[\\s\\S]*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^[\\s\\S]*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block'))
SELECT page_id, host, path,
  (SELECT h || p FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) ORDER BY length(h || p) DESC, length(h) DESC LIMIT 1) AS rule,
  coalesce((SELECT v FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) ORDER BY length(h || p) DESC, length(h) DESC LIMIT 1), 'allow') AS verdict
FROM u""")
def op2(spark, d):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return urls.verdicts(table(spark, d, "pages"), rules)


@query("op4_packing")
def op4(spark, d):
    return packing.pack(table(spark, d, "documents"), vocabulary("word_bpe_49k.json"), end_id=2).drop("ids")


@query("op9_token_counts")
def op9(spark, d):
    return token_counts.counts(table(spark, d, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


@query("op10_token_files")
def op10(spark, d):
    blocks = token_files.tokens(table(spark, d, "documents"), vocabulary("byte_bpe_50k.json"), keeps_space=True, end_id=0)
    file, lengths = token_files.write(blocks, token_files.learn_code(blocks))
    return token_files.digests(token_files.read(file, lengths), file)


@query("op7_topk_search")
def op7(spark, d):
    return topk.search(table(spark, d, "embeddings"), F.col("id") % 50 == 0)


@query("op6_language_id")
def op6(spark, d):
    docs = table(spark, d, "documents")
    out = languages.predict(docs, *languages.fit(docs))
    return out.select("doc_id", languages.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op5_near_dedup")
def op5(spark, d):
    return near_dedup.near_duplicates(table(spark, d, "documents"), similarity=85).drop("text_key", "component")


_WORDS_SQL = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query("op3_decontamination", f"""
WITH d AS (SELECT doc_id, text, {_WORDS_SQL} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS_SQL} AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, list_slice(ws, i, i + 12) AS g FROM (SELECT item_id, ws, unnest(generate_series(1, greatest(len(ws) - 12, 1))) AS i FROM b WHERE len(ws) > 0)),
n AS (SELECT DISTINCT len(g) AS n FROM win),
p AS (SELECT doc_id, text, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM d, n WHERE len(ws) >= n),
h AS (SELECT doc_id, text, i, n, item_id FROM (SELECT doc_id, text, i, n, list_slice(ws, i, i + n - 1) AS g FROM p) JOIN win USING (g)),
c AS (SELECT doc_id, text, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, text, unnest(generate_series(i, i + n - 1)) AS x FROM h) GROUP BY ALL),
t AS (SELECT doc_id, text, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s FROM h GROUP BY ALL)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN c ON d.doc_id IS NOT DISTINCT FROM c.doc_id AND d.text IS NOT DISTINCT FROM c.text
LEFT JOIN t ON d.doc_id IS NOT DISTINCT FROM t.doc_id AND d.text IS NOT DISTINCT FROM t.text""")
def op3(spark, d):
    return decontaminate.contamination(table(spark, d, "documents"), table(spark, d, "benchmark")).drop("hits", "key")


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, d):
    return corpus_pipeline.run(spark, d)


@query("op8_html_text")
def op8(spark, d):
    return wrappers.main_text(table(spark, d, "pages"))


#: Fixed values of the contract: a tenth of the documents, by the checksum of the id, repeat a stretch of their own words to the end.
REPEATED_SQL = r"""
CASE WHEN crc32(CAST(doc_id AS STRING)) % 10 = 0 AND size(w) > 0
     THEN array_join(transform(w, (x, i) -> if(i < a, x, w[a + (i - a) % p])), ' ') ELSE text END"""


@query("op13_periodic_runs")
def op13(spark, d):
    g = F.expr("crc32(CAST(doc_id AS STRING)) div 10")
    words = F.when(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)")))
    docs = (table(spark, d, "documents").select("doc_id", "text", g.alias("g"), words.alias("w"))
            .withColumn("a", F.expr("CAST(CASE WHEN size(w) > 0 THEN g % size(w) END AS INT)")).withColumn("p", F.expr("CAST(1 + (size(w) - a) div (3 + g % 8) AS INT)"))
            .select("doc_id", F.expr(REPEATED_SQL).alias("text")))
    found = runs.periodic_runs(docs, least=12)
    longest = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start AS back, -r.period AS short)))")
    lines = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')")
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.short")).alias("period"), F.expr("1000 * best.length div -best.short").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))


@query("op12_token_alignment")
def op12(spark, d):
    aligned = token_windows.alignments(table(spark, d, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    # the groups are long: only their digest is kept
    aligned = stored(aligned.withColumn("groups_sha256", F.when(F.col("n_a") > 0, F.sha2(F.col("groups"), 256)).otherwise("")).drop("groups"), "aligned")
    scores = token_windows.link_scores(aligned, stored(token_windows.pair_counts(aligned), "aligned-counts"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return aligned.drop("pairs").join(scores, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")


_BASE32_SQL = f"""array_to_string(list_transform(range(0, 32), lambda i: substr('{warc.ALPHABET}', 1 + ((('0x' || substr(sha1(p), (i // 4) * 5 + 1, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '')"""


@query("op11_warc", f"""
WITH r AS (SELECT page_id, coalesce(html, '') AS p FROM pages),
f AS (SELECT page_id, p, min(coalesce(page_id, {warc.NO_ID})) OVER (PARTITION BY p) AS f FROM r)
SELECT page_id, strlen(p)::BIGINT AS payload_bytes, {_BASE32_SQL} AS payload_digest,
       CASE WHEN f = coalesce(page_id, {warc.NO_ID}) THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f <> coalesce(page_id, {warc.NO_ID}) THEN f END AS refers_to
FROM f""")
def op11(spark, d):
    pages = table(spark, d, "pages")
    folder = warc.write(warc.records(pages, min_bytes=0))
    index = warc.build_index(warc.captures(spark, folder))
    found = warc.read_ranges(warc.lookup(index, pages.select(warc.capture_key(F.col("url"), F.col("page_id")).alias("key"))), folder)
    # of what was read: a response's digest and size from its payload, a revisit's from its record
    return found.select(F.col("id").alias("page_id"), F.coalesce(F.octet_length("payload").cast("long"), F.col("payload_bytes")).alias("payload_bytes"),
                        F.coalesce(warc.base32(F.sha1("payload")), F.col("digest")).alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to")
