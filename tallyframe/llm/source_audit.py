"""Source divergence audit: how far the word use of each source lies from the others of its language.

1. Texts become terms once, written to the shared folder.  A term carries its
   language, so one ``CountVectorizer`` with ``minDF`` and the largest integer as
   ``vocabSize`` holds the vocabularies of all languages, each with the terms in at least
   ``min_docs`` of its own documents.
2. Its sparse document vectors are summed by source: index and value pairs, added up
   before and after one shuffle, exact as counts stay below 2**53.
3. Pairs of sources are compared on the sums that exist.  Smoothed shares are
   integers and depend on a term's count alone, so terms that only one of two sources holds enter
   by their counts of counts, terms that neither holds by one product, and only shared
   terms are joined.

The vocabulary passes the driver in parts: a count of the terms in 1/64 of
the hash space sets the number of parts, of about ``part_terms`` terms each, and results do not
depend on it.
"""

from __future__ import annotations

from zlib import crc32

import pyarrow as pa
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyframe.llm.common import materialise
from tallyframe.session import scratch_path

LARGEST = 2**31 - 1
SAMPLE = 64            # share of the hash space whose terms are counted to choose the number of parts
SALTS = 16
#: A-Z to a-z; any other ASCII sign but a-z to a blank; bytes beyond ASCII stay.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def _tagged(batches):
    """Terms of each text, every one behind a blank and its language (in hexadecimal signs behind % if not ASCII letters).

    ``kinds`` holds each term of the document once, ``some`` those in 1/SAMPLE of the hash space.
    """
    def column(b, name):
        return [x or b"" for x in b.column(name).cast(pa.binary()).to_pylist()]

    for b in batches:
        langs, terms, kinds, some = column(b, "lang"), [], [], []
        for lang, text in zip(langs, column(b, "text")):
            words = text.translate(TABLE).split()
            once = set(words)
            tag = b" " + (lang if lang.isalpha() else b"%" + lang.hex().encode()) + b":"
            few = [w for w in once if crc32(w) % SAMPLE == 0]
            for out, w in ((terms, words), (kinds, once), (some, few)):
                out.append(tag + tag.join(w) if w else b"")
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.binary()).cast(pa.string()) for x in (langs, column(b, "source"), terms, kinds, some)],
            names=["lang", "source", "terms", "kinds", "some"])


def _terms(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    named = zip(("text", "lang", "source"), (text_col, lang_col, source_col))
    rows = docs.select(*[F.col("`" + c.replace("`", "``") + "`").cast("string").alias(n) for n, c in named])
    return rows.mapInArrow(_tagged, "lang string, source string, terms string, kinds string, some string")


def _parts(terms: DataFrame, min_docs: int, part_terms: int) -> int:
    kept = (terms.where("some != ''").select(F.explode(F.split("some", " ")).alias("t")).where("t != ''")
            .groupBy("t").count().where(F.col("count") >= min_docs).count())
    return max(1, -(-kept * SAMPLE // part_terms))


def _untag(df: DataFrame) -> DataFrame:
    """lang and term of a tagged term."""
    return (df.withColumn("term", F.substring_index("t", ":", -1))
            .withColumn("lang", F.substring_index("t", ":", 1)).drop("t")
            .withColumn("lang", F.when(F.col("lang").startswith("%"), F.decode(F.unhex(F.expr("substring(lang, 2)")), "UTF-8"))
                        .otherwise(F.col("lang"))))


def _group_sums(terms: DataFrame, min_docs: int, part: int, parts: int) -> tuple[DataFrame, DataFrame]:
    """(lang, term) of one part of the vocabulary, and (lang, source, term, n) sums of its document vectors."""
    spark = terms.sparkSession

    def bag(name):
        # what is before the first blank is the empty term: every document holds it, so the vocabulary is never empty
        every = F.split(name, " ")
        return every if parts == 1 else F.filter(every, lambda t: (t == "") | (F.pmod(F.xxhash64(t), F.lit(parts)) == part))

    # documents per term decide, so each document may name a term once
    model = CountVectorizer(inputCol="bag", outputCol="vector", minDF=float(min_docs), vocabSize=LARGEST).fit(
        terms.select(bag("kinds").alias("bag")))
    path = scratch_path(spark, "audit-vocabulary")
    model.save(path)
    words = (spark.read.parquet(path + "/data").select(F.posexplode("vocabulary").alias("i", "t"))
             .where("t != ''"))
    vectors = model.transform(terms.select("source", bag("terms").alias("bag"))).select("source", F.unwrap_udt("vector").alias("v"))
    sums = (vectors.select("source", F.explode(F.arrays_zip("v.indices", "v.values")).alias("x"))
            .groupBy("source", F.col("x.indices").alias("i")).agg(F.sum("x.values").cast("long").alias("n")))
    counts = _untag(sums.join(words, "i").drop("i"))
    return _untag(words).select("lang", "term"), materialise(counts.select("lang", "source", "term", "n"), "audit-counts")


def _share(n: str, total: str, vocabulary: str, smooth: int, scale: int):
    """1 + floor(scale (n + smooth) / (total + smooth vocabulary)), exact in 38 digits."""
    return F.expr(f"1 + ({scale}BD * cast({n} + {smooth} as decimal(26,0))) div "
                  f"cast({total} + {smooth} * {vocabulary} as decimal(28,0))")


def source_audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                 min_docs: int = 30, smooth: int = 5, scale: int = 1_000_000_000, top_terms: int = 50,
                 part_terms: int = 1 << 20) -> DataFrame:
    """(lang, source, part, item, value, rank): distances between sources, and the terms that mark each source.

    Part ``pair``: every other source of the language with the summed distance of shares over all its kept
    terms (0 without any).  Part ``term``: the ``top_terms`` terms of the source whose share lies furthest
    above the language's own.  Ranks go by falling value, then item.  Null text, language or source is the empty
    string; groups without terms are compared too, a language with one source has no pairs.  Whole texts of any length
    are counted, repeated rows each time.  An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    terms = materialise(_terms(docs, text_col, lang_col, source_col), "audit-terms")
    groups = terms.select("lang", "source").distinct()
    vocabulary = spark.createDataFrame([], "lang string, term string")
    counts = spark.createDataFrame([], "lang string, source string, term string, n long")
    if terms.count() >= min_docs:
        parts = _parts(terms, min_docs, part_terms)
        for part in range(parts):
            words, sums = _group_sums(terms, min_docs, part, parts)
            vocabulary, counts = vocabulary.unionByName(words), counts.unionByName(sums)
    sizes = vocabulary.groupBy("lang").agg(F.count("*").alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("held"))
    groups = (groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
              .select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "held", "v")])
              .withColumn("p0", F.when(F.col("v") > 0, _share("0", "total", "v", smooth, scale)).otherwise(0)))
    groups = materialise(groups, "audit-groups")
    shares = materialise(counts.join(groups, ["lang", "source"]).withColumn("p", _share("n", "total", "v", smooth, scale))
                         .select("lang", "source", "term", "n", "p", "p0"), "audit-shares")
    return _pairs(groups, shares).union(_marks(groups, shares, smooth, scale, top_terms))


def _marks(groups: DataFrame, shares: DataFrame, smooth: int, scale: int, top: int) -> DataFrame:
    whole = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("v").alias("v"))
    of_lang = (shares.groupBy("lang", "term").agg(F.sum("n").alias("n")).join(whole, "lang")
               .select("lang", "term", _share("n", "total", "v", smooth, scale).alias("q")))
    above = (shares.join(of_lang, ["lang", "term"]).where("p > q")
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    a = groups.select("lang", F.col("source").alias("a"), F.col("held").alias("a_held"), F.col("p0").alias("a0"), "v",
                      F.pmod(F.xxhash64("source"), F.lit(SALTS)).cast("int").alias("salt"))
    b = groups.select("lang", F.col("source").alias("b"), F.col("held").alias("b_held"), F.col("p0").alias("b0"),
                      F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    pairs = a.join(b, ["lang", "salt"]).where("a != b").drop("salt")
    # terms that a holds, against b's share of a term it does not hold: by a's counts of counts
    same = shares.groupBy("lang", F.col("source").alias("a"), "p").agg(F.count("*").alias("f"))
    own = (pairs.join(same, ["lang", "a"]).groupBy("lang", "a", "b")
           .agg(F.sum(F.col("f") * F.abs(F.col("p") - F.col("b0"))).alias("own")))
    # terms that both hold: what they count, less what the two sums above count for them
    left = shares.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("p0").alias("a0"))
    right = shares.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("p0").alias("b0"))
    both = (left.join(right, ["lang", "term"]).where("a < b").groupBy("lang", "a", "b")
            .agg(F.count("*").alias("m"), F.sum(F.expr("abs(pa - pb) - abs(pa - b0) - abs(a0 - pb)")).alias("s")))
    both = both.union(both.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "m", "s"))
    back = own.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), F.col("own").alias("back"))
    key = ["lang", "a", "b"]
    value = F.expr("coalesce(own, 0) + coalesce(back, 0) + coalesce(s, 0) "
                   "+ (v - a_held - b_held + coalesce(m, 0)) * abs(a0 - b0)")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (pairs.join(own, key, "left").join(back, key, "left").join(both, key, "left")
            .select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), value.alias("value"))
            .withColumn("rank", F.row_number().over(order)))
