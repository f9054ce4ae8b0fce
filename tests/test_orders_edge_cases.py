"""Edge cases of the order questions: NULL handling, dirty scores,
labels, shares, CSV dialect, schema/sample inspection."""

from pyspark.sql import functions as F

from tessera.functions.casts import in_closed_range, tolerant_cast
from tessera.functions.scalars import (
    format2,
    format_thousands,
    frame_file_name,
    in_year,
    label_or_default,
    pad_left,
    pad_right,
    percent_of,
)
from tessera.operators.aggregate import (
    count_by,
    distinct_count,
    exact_sum,
    quality_split,
    top_n,
    with_rank,
)
from tessera.operators.inspect import sample_rows, schema_rows
from tessera.sources.csv import read_csv, write_csv


def test_distinct_counts_null_as_value(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "x int")
    assert distinct_count(df, "x").first()[0] == 2


def test_count_column_skips_null(spark):
    df = spark.createDataFrame([("a", 1), ("a", None)], "k string, v int")
    assert count_by(df, ["k"], "v", "n").first().n == 1


def test_month_order_year_asc_month_desc(spark):
    rows = [("1999-03-01",), ("1999-11-01",), ("1998-05-01",), ("1999-11-02",)]
    df = spark.createDataFrame(rows, "d string").select(F.to_timestamp("d").alias("ts"), F.lit(1).alias("id"))
    res = count_by(df, [F.year("ts").alias("y"), F.month("ts").alias("m")], "id", "n").orderBy(
        F.asc("y"), F.desc("m")
    )
    assert [(r.y, r.m, r.n) for r in res.collect()] == [(1998, 5, 1), (1999, 11, 2), (1999, 3, 1)]


def test_review_score_parsing_and_split(spark):
    raw = ["5", "x", "", "9", "0", "4.0", " 4 ", None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(raw)], "review_id int, score string")
    scored = df.withColumn("score", tolerant_cast("score", "int"))
    valid = scored.filter(in_closed_range("score", 1, 5))
    assert sorted(r.score for r in valid.collect()) == [4, 5]
    split = quality_split(scored, in_closed_range("score", 1, 5)).first()
    assert (split.total_rows, split.valid_rows, split.invalid_rows) == (8, 2, 6)


def test_no_valid_reviews_gives_null_average_and_share(spark):
    v = spark.createDataFrame([], "review_id int, score int")
    avg = v.agg(F.try_divide(F.sum("score").cast("double"), F.count("score").cast("double")).alias("a"))
    assert avg.first().a is None
    assert v.agg(percent_of(F.count(F.lit(1)), F.lit(0)).alias("p")).first().p is None


def test_null_freight_revenue_null_but_price_summed(spark):
    df = spark.createDataFrame([("c", 10.0, None), ("c", 5.0, 1.0)], "category string, price double, freight double")
    r = df.groupBy("category").agg(
        exact_sum(F.col("price") + F.col("freight"), 2).alias("rev"), exact_sum("price", 2).alias("p")
    ).first()
    assert float(r.rev) == 6.0 and float(r.p) == 15.0


def test_category_labels_after_grouping(spark):
    df = spark.createDataFrame([(None, 1.0), ("", 2.0), ("#N/A", 3.0)], "category string, v double")
    g = df.groupBy("category").agg(F.sum("v").alias("v"))
    labels = sorted(r.l for r in g.select(label_or_default("category").alias("l")).collect())
    assert labels == ["#N/A", "Unknown", "Unknown"]


def test_shares_sum_to_100_and_rank(spark):
    df = spark.createDataFrame([(c, float(v)) for c, v in zip("abcdefghijkl", range(1, 13))], "c string, v double")
    shares = df.withColumn("pct", percent_of("v", df.select(F.sum("v")).scalar()))
    assert abs(sum(r.pct for r in shares.collect()) - 100.0) < 1e-9
    top = with_rank(top_n(shares, 3, [F.desc("v"), F.asc("c")]), [F.desc("v"), F.asc("c")], "rank")
    assert [(r.rank, r.c) for r in top.orderBy("rank").collect()] == [(1, "l"), (2, "k"), (3, "j")]


def test_year_filter_pushed_to_parquet(spark, scratch):
    df = spark.createDataFrame([("1999-06-01 10:00:00",), ("2000-01-01 00:00:00",)], "s string").select(
        F.to_timestamp_ntz("s").alias("ts")
    )
    df.write.parquet(f"{scratch}/t")
    q = spark.read.parquet(f"{scratch}/t").filter(in_year("ts", 1999))
    assert q.count() == 1
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_formatting_matches_python(spark):
    vals = [4.125, 2.675, 1234567.125, 0.0, -3.14159]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.f for r in df.select(format2("x").alias("f")).collect()]
    assert got == [f"{v:.2f}" for v in vals]
    got = [r.f for r in df.select(format_thousands("x", 2).alias("f")).collect()]
    assert got == [f"{v:,.2f}" for v in vals]
    n = spark.createDataFrame([(1234567,)], "n long").select(format_thousands("n").alias("f")).first().f
    assert n == f"{1234567:,}"


def test_padding_never_truncates(spark):
    df = spark.createDataFrame([("abc",), ("abcdefgh",)], "s string")
    got = [(r.l, r.r) for r in df.select(pad_left("s", 5).alias("l"), pad_right("s", 5).alias("r")).collect()]
    assert got == [(f"{'abc':>5}", f"{'abc':<5}"), ("abcdefgh", "abcdefgh")]


def test_frame_file_names(spark):
    df = spark.createDataFrame([(7,), (12345,)], "id long")
    assert [r.f for r in df.select(frame_file_name("id").alias("f")).collect()] == [
        "frame_0007.jpg", "frame_12345.jpg"
    ]


def test_csv_dialect_keeps_text_whole(spark, scratch):
    texts = ['a;b', 'line1\nline2', 'say ""hi""'.replace('""', '"'), '  padded  ', '', None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    write_csv(df, f"{scratch}/csv")
    back = read_csv(spark, f"{scratch}/csv", "id long, text string", keep_empty_strings=True)
    assert sorted(back.collect()) == sorted(df.collect())
    default = {r.id: r.text for r in read_csv(spark, f"{scratch}/csv", "id long, text string").collect()}
    assert default[4] is None and default[5] is None  # default reader: empty -> NULL


def test_csv_inference_option(spark, scratch):
    with open(f"{scratch}/x.csv", "w") as f:
        f.write('a;b\n1;"x\ny"\n2;z\n')
    df = read_csv(spark, f"{scratch}/x.csv", infer=True)
    assert dict(df.dtypes) == {"a": "int", "b": "string"}
    assert sorted(tuple(r) for r in df.collect()) == [(1, "x\ny"), (2, "z")]


def test_schema_rows_and_sample(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "id int, name string")
    rows = schema_rows(spark, {"t": df}).collect()
    assert [(r.pos, r.column, r.type) for r in rows] == [(1, "id", "int"), (2, "name", "string")]
    assert [r.id for r in sample_rows(df, 2, ["id"]).collect()] == [1, 2]


def test_declared_schemas_match_files(spark):
    from tessera.sources.tables import TABLES, read_table

    for t in TABLES:
        declared = read_table(spark, "/root/testdata/sf0.001", t).schema
        inferred = read_table(spark, "/root/testdata/sf0.001", t, infer=True).schema
        assert [(f.name, f.dataType) for f in declared] == [(f.name, f.dataType) for f in inferred], t


def test_land_csv_as_parquet(spark, scratch):
    from tessera.sources.csv import land_csv_as_parquet

    df = spark.createDataFrame([(1, "a;b\nc"), (2, "plain")], "id long, text string")
    write_csv(df, f"{scratch}/csv")
    landed = land_csv_as_parquet(spark, f"{scratch}/csv", f"{scratch}/pq", "id long, text string")
    assert sorted(landed.collect()) == sorted(df.collect())
    q = landed.filter("id = 2").select("text")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,2)]" in plan
    assert q.first().text == "plain"


def test_csv_schema_inference_query(spark):
    from tessera.plans.registry import load_all

    rows = load_all()["csv_schema_inference"].fn(spark, "/root/testdata/sf0.001").collect()
    got = {r.column: r.type for r in rows}
    assert list(got) == ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    assert got["o_orderstatus"] == "string" and got["o_totalprice"] == "double"
    assert got["o_orderkey"] in ("int", "bigint") and got["o_orderdate"].startswith("timestamp")
