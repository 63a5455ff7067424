import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators.profile import ProfileOptions, profile
from tallyframe.operators.shaping import nulls_from_codes
from tallyframe.sources import files, writers

ORD = "/root/testdata/sf0.001/orders.parquet"


def _csv(spark, tmp_path, sep=",", header=True):
    o = spark.read.parquet(ORD).orderBy("o_orderkey")
    p = str(tmp_path / f"orders_{'h' if header else 'n'}{ord(sep)}")
    o.coalesce(1).write.option("header", header).option("sep", sep).csv(p)
    return o, p


def test_csv_variants(spark, tmp_path):
    o, p = _csv(spark, tmp_path)
    inferred = files.read_csv(spark, p)
    assert dict(inferred.dtypes)["o_totalprice"] == "double"
    text = files.read_csv(spark, p, infer=False)
    assert set(dict(text.dtypes).values()) == {"string"}
    # all-string read profiles the same numeric summary as the typed read
    a = profile(inferred.select("o_totalprice"), "x", options=ProfileOptions(sketches=False)).first()
    b = profile(text.select("o_totalprice"), "x", options=ProfileOptions(sketches=False)).first()
    assert (a["n"], a["min"], a["max"]) == (b["n"], b["min"], b["max"])
    assert b["type_fractional"] + b["type_integral"] == b["count"]
    _, ps = _csv(spark, tmp_path, sep=";")
    assert files.read_csv(spark, ps, sep=";").count() == o.count()
    _, pn = _csv(spark, tmp_path, header=False)
    named = files.read_csv(spark, pn, header=False, names=o.columns)
    assert named.count() == o.count() and named.columns == o.columns   # no row lost


def test_csv_nulls_and_dates(spark, tmp_path):
    p = tmp_path / "calls.csv"
    p.write_text("Call Date,City,Priority\n01/02/2020,SF,\n03/04/2021,,2\n?,LA,3\n")
    df = files.read_csv(spark, str(p), infer=False, null_value="")
    assert df.filter(F.col("City").isNull()).count() == 1
    fixed = nulls_from_codes(df, "?", ["Call Date"])
    ts = fixed.select(F.try_to_timestamp(F.col("`Call Date`"), F.lit("MM/dd/yyyy")).alias("t"))
    assert ts.filter(F.col("t").isNotNull()).count() == 2
    schema = T.StructType([T.StructField("d", T.DateType()), T.StructField("v", T.DoubleType())])
    q = tmp_path / "weeks.csv"
    q.write_text("d,v\n2020-01-06,1.5\n2020-01-13,2.5\n")
    w = files.read_csv(spark, str(q), schema=schema, date_format="yyyy-MM-dd")
    assert dict(w.dtypes)["d"] == "date"


def test_batch_files(spark, tmp_path):
    o = spark.read.parquet(ORD)
    for i in range(1, 4):
        d = tmp_path / f"b{i}"
        o.filter(F.col("o_orderkey") % 3 == i - 1).coalesce(1).write.option("header", True).csv(str(d))
        src = [f for f in os.listdir(d) if f.endswith(".csv")][0]
        os.link(d / src, tmp_path / f"input_batch_{i}.csv")
    b = files.read_batches(spark, str(tmp_path / "input_batch_*.csv"))
    assert sorted(r[0] for r in b.select("batch").distinct().collect()) == [1, 2, 3]
    assert b.count() == o.count()


def test_writers_and_latest(spark, tmp_path):
    o = spark.read.parquet(ORD)
    p = profile(o, "orders", time_column="o_orderdate", grain="year")
    cfg = [writers.WriterConfig(str(tmp_path / "out"), ["flat", "json", "parquet"],
                                "$name/$dataset_timestamp", "profile_$name")]
    out = writers.write_all(p, cfg, "orders", "2024")
    assert all(os.path.exists(x) for x in out)
    flat_dir = [x for x in out if "/flat/" in x][0]
    s = files.read_flat_summary(spark, os.path.join(flat_dir, writers.FLAT_FILES["summary"]))
    assert s.count() == p.count()
    writers.write_profile(p, str(tmp_path / "store"))
    stored = files.read_profiles(spark, str(tmp_path / "store"), name="orders")
    last = files.latest(stored)
    assert last.count() == len(o.columns) - 1
    writers.write_by_bucket(p, str(tmp_path / "years"))
    years = spark.read.parquet(str(tmp_path / "years"))
    assert years.select("year").distinct().count() == p.select("dataset_timestamp").distinct().count()
