"""A key holding a third of all rows: results stay exact and whole, and
the plan does not funnel raw rows of the hot key through one task."""

import random

from pyspark.sql import functions as F

from tessera.operators.aggregate import average_by, pivot_average
from tessera.operators.frames import latest_per_id
from tessera.operators.join import join_dimension
from tessera.operators.partitioning import sized_partitions


def _skewed_ratings(spark, n=30_000, hot_user=7, hot_movie=3):
    """Every third row has the hot user; every third (other) row the hot
    movie.  Other columns stay random so the hot shuffle blocks do not
    compress away."""
    rnd = random.Random(42)
    rows = []
    for i in range(n):
        rows.append((
            hot_user if i % 3 == 0 else rnd.randrange(1, 500),
            hot_movie if i % 3 == 1 else rnd.randrange(1, 300),
            rnd.randrange(1, 100_000_000) / 10_000.0,
        ))
    return spark.createDataFrame(rows, "user_id long, movie_id long, rating double").repartition(8)


def _exact_means(pdf, key):
    """Brute force: exact fractions of the doubles as written, four decimals."""
    out = {}
    for k, g in pdf.groupby(key):
        units = sum(int(round(v * 10_000)) for v in g["rating"])
        out[k] = (units / 10_000.0 / len(g), len(g))
    return out


def test_hot_key_average_exact(spark):
    r = _skewed_ratings(spark)
    got = {x.movie_id: (x.avg, x.n) for x in average_by(r, ["movie_id"], "rating", "avg", "n", scale=4).collect()}
    want = _exact_means(r.toPandas(), "movie_id")
    assert len(got) == len(want)
    for movie, (mean, n) in want.items():
        assert got[movie] == (mean, n)


def test_hot_key_partial_aggregation_in_plan(spark):
    r = _skewed_ratings(spark)
    plan = average_by(r, ["movie_id"], "rating", "avg", "n")._jdf.queryExecution().executedPlan().toString()
    # the exchange sits between a partial and a final aggregate
    assert "partial_sum" in plan and plan.index("partial_sum") > plan.index("Exchange hashpartitioning")


def test_hot_join_key_split_by_adaptive_skew_join(spark):
    r = _skewed_ratings(spark, n=60_000)
    users = spark.range(1, 500).select(
        F.col("id").alias("user_id"), F.when(F.col("id") % 2 == 0, "M").otherwise("F").alias("gender")
    ).repartition(8)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        joined = join_dimension(r, users, "user_id")
        piv = pivot_average(joined, ["movie_id"], "gender", {"M": "m", "F": "f"}, "rating", scale=4)
        rows = piv.collect()
        plan = piv._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and "skew=true" in plan
    pdf = r.toPandas().merge(users.toPandas(), on="user_id")
    want = _exact_means(pdf[pdf.gender == "M"], "movie_id")
    got = {x.movie_id: x.m for x in rows}
    assert len(got) == pdf.movie_id.nunique()
    for movie, (mean, _) in want.items():
        assert got[movie] == mean


def test_hot_frame_id_latest_wins(spark):
    rows = [(1 if i % 3 == 0 else i, i, f"v{i}") for i in range(30_000)]
    df = spark.createDataFrame(rows, "id long, t long, v string").repartition(8)
    got = {x.id: x.v for x in latest_per_id(df, "id", "t", ["v"]).collect()}
    assert got[1] == "v29997"
    assert len(got) == len({r[0] for r in rows})


def test_sized_partitions(spark):
    df = spark.range(0, 1000)
    assert sized_partitions(df, 100).rdd.getNumPartitions() == 10
    assert sized_partitions(df.limit(3), 100).rdd.getNumPartitions() == 1
