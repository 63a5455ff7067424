"""URL filter: blocked Bloom filter of listed rules, then an exact hash join.

Every listed (host, path) becomes one canonical key.  A page url is expanded
to the keys that could cover it: each suffix of its host (as many labels as a listed host
has at most) with each prefix of its path that is as long as some listed path.  Keys that the Bloom
filter rules out end there; the rest meet the listed keys in an exact
join, which removes false positives, and the longest rule wins.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.bloom import BlockedBloom

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _key_hash(host: Column, path: Column) -> Column:
    return F.xxhash64(host, path)


def url_filter(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) for every row of ``pages``.

    ``rules`` has (host, path, verdict), path starting with ``/``.  A rule fits its host and all
    subdomains where the url's path starts with the rule's; the longest host
    plus path wins.  Urls that no rule lists get ``default`` and a null rule.
    Null urls and urls without ``://`` have an empty host and path, which no
    rule fits.  Rules with a null part are ignored, of rules repeated for
    one host and path ``block`` wins.  Rows are kept one for one, repeated rows
    too; an empty table gives no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    listed = (rules.where("host is not null and path is not null and verdict is not null")
              .select(F.translate("host", UPPER, LOWER).alias("_rh"), F.col("path").alias("_rp"),
                      F.col("verdict").alias("_rv"))
              .groupBy("_rh", "_rp").agg(F.max("_rv").alias("_rv"))
              .withColumn("_kh", _key_hash(F.col("_rh"), F.col("_rp"))))
    facts = listed.agg(F.max(F.size(F.split("_rh", r"\."))).alias("labels"),
                       F.collect_set(F.length("_rp")).alias("lens")).first()
    base = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"))
    base = base.withColumn("host", url_host(F.col("_url"))).withColumn("path", url_path(F.col("_url")))
    if not facts["lens"]:
        return base.select(F.col("_id").alias(id_col), "host", "path", F.lit(None).cast("string").alias("rule"),
                           F.lit(default).alias("verdict"))
    bloom = spark.sparkContext.broadcast(BlockedBloom.build(listed.select("_kh"), "_kh"))

    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        return pd.Series(bloom.value.probe(h.to_numpy()))

    # candidates of each distinct (host, path): every other url part is irrelevant to the verdict
    labels = F.split("host", r"\.")
    n = F.size("_labels")
    lens = F.array(*[F.lit(int(x)) for x in sorted(facts["lens"])])
    spots = (base.select("host", "path").where("host != ''").distinct().withColumn("_labels", labels)
             .withColumn("_hs", F.transform(F.sequence(F.lit(1), F.least(n, F.lit(facts["labels"]))),
                                            lambda k: F.array_join(F.slice("_labels", n - k + 1, k), ".")))
             .withColumn("_ps", F.transform(F.filter(lens, lambda x: x <= F.length("path")),
                                            lambda x: F.substring(F.col("path"), F.lit(1), x)))
             .withColumn("_h", F.explode("_hs")).withColumn("_p", F.explode("_ps"))
             .select("host", "path", "_h", "_p", _key_hash(F.col("_h"), F.col("_p")).alias("_kh")))
    hits = spots.where(maybe("_kh"))
    found = (hits.join(listed, (hits["_kh"] == listed["_kh"]) & (F.col("_h") == F.col("_rh")) & (F.col("_p") == F.col("_rp")))
             .groupBy("host", "path")
             .agg(F.max(F.struct(F.length(F.concat("_rh", "_rp")).alias("n"), F.length("_rh").alias("hn"),
                                 F.concat("_rh", "_rp").alias("rule"), F.col("_rv").alias("verdict"))).alias("x")))
    return (base.join(found, ["host", "path"], "left")
            .select(F.col("_id").alias(id_col), "host", "path", F.col("x.rule").alias("rule"),
                    F.coalesce("x.verdict", F.lit(default)).alias("verdict")))


#: The rules of the registered query (fixed values).
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
                     + " AS r(host, path, verdict)")
