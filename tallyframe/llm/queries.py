"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import (ann, decontaminate, line_crf, lm, packing, periodic_runs, pii, quality, sharding, simhash,
                            source_audit, suffix_dedup, url_filter)
from tallyframe.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql.strip()
        return fn
    return deco


@query("op1_sharding")
def op1_sharding(spark, sf_dir):
    out = sharding.kd_shards(read_table(spark, sf_dir, "documents"), n_shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query("op2_nearest")
def op2_nearest(spark, sf_dir):
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), k=20, query_mod=20)


@query("op4_simhash")
def op4_simhash(spark, sf_dir):
    return simhash.simhash_groups(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


OP6_SQL = """
WITH rules(rh, rp, rv) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
     ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
u AS (SELECT page_id, row_number() OVER () AS k,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
      FROM pages),
fit AS (SELECT k, rh || rp AS rule, rv,
               row_number() OVER (PARTITION BY k ORDER BY length(rh || rp) DESC, length(rh) DESC) AS r
        FROM u JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(rv, 'allow') AS verdict
FROM u LEFT JOIN (SELECT * FROM fit WHERE r = 1) USING (k)
"""


@query("op6_url_filter", OP6_SQL)
def op6_url_filter(spark, sf_dir):
    return url_filter.url_filter(read_table(spark, sf_dir, "pages"), url_filter.rules_table(spark))


@query("op7_quality")
def op7_quality(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return quality.quality_scores(docs, model).select(
        "doc_id", F.coalesce(quality.held_out("doc_id"), F.lit(False)).alias("held_out"), "score", "predicted")


def tokenizer_paths() -> tuple[str, str, str]:
    import public_tokenizers as public
    return public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN


@query("op9_packing")
def op9_packing(spark, sf_dir):
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_paths())


@query("op8_lm")
def op8_lm(spark, sf_dir):
    return lm.lm_scores(read_table(spark, sf_dir, "documents"))


@query("op3_suffix_dedup")
def op3_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), length=100, with_text=False)


@query("op5_decontaminate")
def op5_decontaminate(spark, sf_dir):
    leaks = decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return leaks.withColumn("contaminated", F.lit(True))


@query("op10_pii")
def op10_pii(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_personal_data(docs)


OP11_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
              FROM documents),
words AS (SELECT k, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
vocabulary AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT k) >= 30),
sizes AS (SELECT lang, count(*) AS v FROM vocabulary GROUP BY lang),
held AS (SELECT lang, source, term, count(*) AS n FROM words JOIN vocabulary USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
filled AS (SELECT lang, source, term, coalesce(n, 0) AS n
           FROM groups JOIN vocabulary USING (lang) LEFT JOIN held USING (lang, source, term)),
shares AS (SELECT lang, source, term, n, CAST(1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS BIGINT) AS p
           FROM filled JOIN sizes USING (lang)),
whole AS (SELECT lang, term, CAST(1 + (1000000000::HUGEINT * (sum(n) + 5)) // (sum(sum(n)) OVER (PARTITION BY lang) + 5 * any_value(v)) AS BIGINT) AS q
          FROM filled JOIN sizes USING (lang) GROUP BY lang, term),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                 coalesce((SELECT sum(abs(x.p - y.p)) FROM shares x JOIN shares y USING (lang, term)
                           WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source != b.source),
marks AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value
          FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM marks)
QUALIFY part = 'pair' OR rank <= 50
"""


@query("op11_source_audit", OP11_SQL)
def op11_source_audit(spark, sf_dir):
    return source_audit.source_audit(read_table(spark, sf_dir, "documents"))


@query("op12_line_crf")
def op12_line_crf(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    model = line_crf.fit_line_crf(docs, read_table(spark, sf_dir, "labels"))
    return line_crf.judge_lines(docs, model, with_content=False).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the texts of ids whose crc32 ends in 0 become periodic from a word on, as the contract of op13 says."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    planted = """
        transform(w, (x, i) -> if(i < a, x, get(w, cast(a + (i - a) % p as int))))"""
    rewritten = (docs.select("doc_id", "text", h.alias("h"))
                 .withColumn("w", F.when(F.col("h") % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda x: x != "")))
                 .withColumn("g", F.expr("h div 10")).withColumn("n", F.size("w"))
                 .withColumn("a", F.expr("if(n > 0, g % n, 0)"))
                 .withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)")))
    return rewritten.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), F.array_join(F.expr(planted), " "))
                            .otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark, sf_dir):
    found = periodic_runs.periodic_runs(with_planted_periods(read_table(spark, sf_dir, "documents")))
    # runs come by start, then period: a later one is best only if its length/period is strictly greater
    best = F.expr("reduce(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>), (m, r) -> "
                  "if(m is null or r.length * m.period > m.length * r.period, r, m))")
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                   r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("m", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "m.start", "m.length", "m.period",
        F.expr("1000 * m.length div m.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
