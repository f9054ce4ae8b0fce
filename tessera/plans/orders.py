"""Order questions: totals, orders per country and per month, review
quality and distribution, yearly revenue per category, top-10 share.

Plan notes:
* Counts per country are computed per customer first, so the join with the
  customer dimension sees one row per customer, not one per order.
* Revenue per category is summed per product first (after the year filter
  and the order join), so the join with products sees one row per product.
* The year filter is a half-open range on the timestamp and reaches the
  parquet scan as pushed filters.
* Shares use the grand total as a scalar subquery (one small job, then a
  literal): no cross join and no single-partition window over raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera import questions as Q
from tessera.functions.casts import in_closed_range
from tessera.functions.scalars import label_or_default, percent_of
from tessera.operators.aggregate import (
    conditional_counts,
    count_by,
    distinct_count,
    quality_split,
    row_count,
    top_n,
    with_rank,
)
from tessera.operators.bucketing import bucket_count, land_bucketed
from tessera.operators.join import union_all
from tessera.operators.partitioning import input_bytes, materialize
from tessera.plans.registry import query
from tessera.questions import SCORE_MAX, SCORE_MIN
from tessera.sources import tables as T

TOP_N = 10

# SQL stand-ins, mirroring tessera.sources.tables
SQL_CUSTOMERS = (
    "SELECT c.c_custkey AS customer_id, n.n_name AS country "
    "FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"
)
SQL_ORDERS = "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS purchase_ts FROM orders"
SQL_ITEMS = (
    "SELECT l_orderkey AS order_id, l_linenumber AS item_id, l_partkey AS product_id, "
    f"l_suppkey AS seller_id, l_extendedprice AS price, round(l_extendedprice * l_tax, {T.MONEY_SCALE}) AS freight "
    "FROM lineitem"
)
SQL_PRODUCTS = "SELECT p_partkey AS product_id, p_brand AS category FROM part"
SQL_REVIEWS = (
    f"SELECT event_id AS review_id, CASE WHEN event_type = '{T.JUNK_EVENT_TYPE}' THEN '{T.JUNK_SCORE_TEXT}' "
    "ELSE CAST(CAST(floor(value / 10) AS INTEGER) AS VARCHAR) END AS score FROM events"
)
Y0, Y1 = f"TIMESTAMP '{T.TARGET_YEAR}-01-01'", f"TIMESTAMP '{T.TARGET_YEAR + 1}-01-01'"
_WITH = (
    f"WITH c AS ({SQL_CUSTOMERS}), o AS ({SQL_ORDERS}), i AS ({SQL_ITEMS}), p AS ({SQL_PRODUCTS}), "
    f"rv AS ({SQL_REVIEWS}), "
    f"v AS (SELECT review_id, s AS score FROM (SELECT review_id, TRY_CAST(score AS INTEGER) AS s FROM rv) "
    f"WHERE s IS NOT NULL AND s >= {SCORE_MIN} AND s <= {SCORE_MAX}), "
    f"oy AS (SELECT order_id FROM o WHERE purchase_ts >= {Y0} AND purchase_ts < {Y1}), "
    "iy AS (SELECT i.*, p.category FROM i JOIN oy ON i.order_id = oy.order_id "
    "       JOIN p ON i.product_id = p.product_id), "
    f"cat AS (SELECT category, SUM(CAST(price AS DECIMAL(18,{T.MONEY_SCALE})) "
    f"         + CAST(freight AS DECIMAL(18,{T.MONEY_SCALE}))) AS revenue, "
    f"         SUM(CAST(price AS DECIMAL(18,{T.MONEY_SCALE}))) AS price_total, "
    f"         SUM(CAST(freight AS DECIMAL(18,{T.MONEY_SCALE}))) AS freight_total, "
    "         COUNT(item_id) AS item_count FROM iy GROUP BY category)"
)


# ------------------------------------------------------------------- builders
def scored_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.scored_reviews(T.reviews(spark, sf_dir))


def valid_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.valid_reviews(T.reviews(spark, sf_dir))


def orders_in_year(spark: SparkSession, sf_dir: str, year: int = T.TARGET_YEAR) -> DataFrame:
    return Q.orders_in_year(T.orders(spark, sf_dir), year)


def category_revenue(spark: SparkSession, sf_dir: str, year: int = T.TARGET_YEAR) -> DataFrame:
    return Q.category_revenue(T.order_items(spark, sf_dir), T.orders(spark, sf_dir), T.products(spark, sf_dir), year,
                              scale=T.MONEY_SCALE)


def orders_by_country_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.orders_by_country(T.orders(spark, sf_dir), T.customers(spark, sf_dir))


def orders_by_year_month_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.orders_by_year_month(T.orders(spark, sf_dir))


def revenue_order():
    """Revenue descending, category as tie-break (NULL first)."""
    return [F.desc("revenue"), F.asc("category")]


def _metric(df: DataFrame, name: str, value_col: str) -> DataFrame:
    return df.select(F.lit(name).alias("metric"), F.col(value_col).cast("bigint").alias("value"))


# -------------------------------------------------------------------- queries
@query(
    "table_totals",
    f"""{_WITH}
SELECT 'orders' AS metric, COUNT(*) AS value FROM orders
UNION ALL SELECT 'customers', COUNT(*) FROM customer
UNION ALL SELECT 'sellers', COUNT(*) FROM (SELECT DISTINCT seller_id FROM i)""",
    "AGG5 AGG6 SET2 SNK1",
)
def table_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all(
        _metric(row_count(T.read_table(spark, sf_dir, "orders")), "orders", "row_count"),
        _metric(row_count(T.read_table(spark, sf_dir, "customer")), "customers", "row_count"),
        _metric(distinct_count(T.order_items(spark, sf_dir), "seller_id"), "sellers", "distinct_count"),
    )


@query(
    "distinct_sellers_null_counts",
    f"""{_WITH}
SELECT 'sellers_distinct' AS metric, COUNT(*) AS value FROM (SELECT DISTINCT seller_id FROM i)
UNION ALL SELECT 'scores_distinct_with_null', COUNT(*) FROM (SELECT DISTINCT TRY_CAST(score AS INTEGER) FROM rv)
UNION ALL SELECT 'scores_count_distinct', COUNT(DISTINCT TRY_CAST(score AS INTEGER)) FROM rv""",
    "SET2 AGG6",
)
def distinct_sellers_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``distinct().count()`` counts NULL as a value, ``count(distinct)``
    does not; the review score (junk -> NULL) shows the difference.  Both
    come from one distinct pass: rows of the distinct set, and its non-NULL
    values."""
    scores = scored_reviews(spark, sf_dir).select("score").distinct().agg(
        F.count(F.lit(1)).alias("with_null"), F.count("score").alias("without_null")
    )
    long = scores.unpivot([], ["with_null", "without_null"], "kind", "value").select(
        F.when(F.col("kind") == "with_null", F.lit("scores_distinct_with_null"))
        .otherwise(F.lit("scores_count_distinct")).alias("metric"),
        F.col("value").cast("bigint").alias("value"),
    )
    return union_all(
        _metric(distinct_count(T.order_items(spark, sf_dir), "seller_id"), "sellers_distinct", "distinct_count"),
        long,
    )


@query(
    "orders_by_country",
    f"""{_WITH}
SELECT c.country, COUNT(o.order_id) AS order_count
FROM o JOIN c ON o.customer_id = c.customer_id
GROUP BY c.country ORDER BY order_count DESC, country""",
    "PRJ1 JOI5 AGG7 SRT1 PRJ6",
)
def orders_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_by_country_frame(spark, sf_dir).orderBy(F.desc("order_count"), "country")


@query(
    "orders_by_year_month",
    f"""{_WITH}
SELECT CAST(year(purchase_ts) AS INTEGER) AS year, CAST(month(purchase_ts) AS INTEGER) AS month,
       COUNT(order_id) AS order_count
FROM o GROUP BY 1, 2 ORDER BY year ASC, month DESC""",
    "SCA5 SCA6 AGG8 SRT3",
)
def orders_by_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_by_year_month_frame(spark, sf_dir).orderBy(F.asc("year"), F.desc("month"))


@query(
    "review_quality_split",
    f"""{_WITH}
SELECT COUNT(*) AS total_rows,
       COUNT(*) FILTER (WHERE s IS NOT NULL AND s >= {SCORE_MIN} AND s <= {SCORE_MAX}) AS valid_rows,
       COUNT(*) - COUNT(*) FILTER (WHERE s IS NOT NULL AND s >= {SCORE_MIN} AND s <= {SCORE_MAX}) AS invalid_rows
FROM (SELECT TRY_CAST(score AS INTEGER) AS s FROM rv)""",
    "PRJ5 PRJ7 FIL2 AGG15",
)
def review_quality_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_split(scored_reviews(spark, sf_dir), in_closed_range("score", SCORE_MIN, SCORE_MAX))


@query(
    "review_average",
    f"""{_WITH}
SELECT CAST(SUM(score) AS DOUBLE) / CAST(COUNT(score) AS DOUBLE) AS avg_score, COUNT(*) AS valid_rows FROM v""",
    "FIL2 AGG9",
)
def review_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = valid_reviews(spark, sf_dir)
    return v.agg(
        F.try_divide(F.sum("score").cast("double"), F.count("score").cast("double")).alias("avg_score"),
        F.count(F.lit(1)).alias("valid_rows"),
    )


@query(
    "review_score_distribution",
    f"""{_WITH}
SELECT score, COUNT(review_id) AS review_count,
       CAST(COUNT(review_id) AS DOUBLE) * 100.0 / CAST((SELECT COUNT(*) FROM v) AS DOUBLE) AS pct
FROM v GROUP BY score ORDER BY score""",
    "AGG7 AGG13 SRT2 SCA20 WIN2",
)
def review_score_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    # At most SCORE_MAX - SCORE_MIN + 1 groups survive the validity filter, so
    # the grand total is a window over those few rows (no second scan).
    counts = count_by(valid_reviews(spark, sf_dir), ["score"], "review_id", "review_count")
    total = F.sum("review_count").over(Window.partitionBy())
    return counts.withColumn("pct", percent_of("review_count", total)).orderBy("score")


@query(
    "review_sentiment_counts",
    f"""{_WITH},
k AS (SELECT COUNT(*) FILTER (WHERE score >= 4) AS positive, COUNT(*) FILTER (WHERE score = 3) AS neutral,
             COUNT(*) FILTER (WHERE score <= 2) AS negative, COUNT(*) AS valid_rows FROM v)
SELECT 'positive' AS sentiment, positive AS review_count, CAST(positive AS DOUBLE) * 100.0 / CAST(valid_rows AS DOUBLE) AS pct FROM k
UNION ALL SELECT 'neutral', neutral, CAST(neutral AS DOUBLE) * 100.0 / CAST(valid_rows AS DOUBLE) FROM k
UNION ALL SELECT 'negative', negative, CAST(negative AS DOUBLE) * 100.0 / CAST(valid_rows AS DOUBLE) FROM k""",
    "FIL4 AGG12 AGG13",
)
def review_sentiment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = valid_reviews(spark, sf_dir)
    s = F.col("score")
    counts = conditional_counts(
        v, {"positive": s >= 4, "neutral": s == 3, "negative": s <= 2, "valid_rows": F.lit(True)}
    )
    long = counts.unpivot(["valid_rows"], ["positive", "neutral", "negative"], "sentiment", "review_count")
    return long.select("sentiment", "review_count", percent_of("review_count", "valid_rows").alias("pct"))


@query(
    "revenue_by_category_year",
    f"""{_WITH}
SELECT category, COALESCE(NULLIF(category, ''), 'Unknown') AS category_label,
       CAST(revenue AS DOUBLE) AS total_revenue, CAST(price_total AS DOUBLE) AS total_price,
       CAST(freight_total AS DOUBLE) AS total_freight, item_count
FROM cat ORDER BY revenue DESC, category NULLS FIRST""",
    "FIL3 JOI6 PRJ3 AGG11 SRT1 SCA11",
)
def revenue_by_category_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        category_revenue(spark, sf_dir)
        .orderBy(*revenue_order())
        .select(
            "category",
            label_or_default("category").alias("category_label"),
            F.col("revenue").cast("double").alias("total_revenue"),
            F.col("price_total").cast("double").alias("total_price"),
            F.col("freight_total").cast("double").alias("total_freight"),
            F.col("item_count").cast("bigint").alias("item_count"),
        )
    )


def bucketed_facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Items and orders landed in buckets of the order key."""
    items, orders = T.order_items(spark, sf_dir), T.orders(spark, sf_dir)
    buckets = bucket_count(input_bytes(items), spark.sparkContext.defaultParallelism)
    return (land_bucketed(items, "order_items", ["order_id"], buckets),
            land_bucketed(orders, "orders", ["order_id"], buckets))


@query(
    "revenue_bucketed_facts",
    f"""{_WITH}
SELECT category, CAST(revenue AS DOUBLE) AS total_revenue, item_count FROM cat""",
    "JOI6 AGG11",
)
def revenue_bucketed_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly revenue from facts landed once in buckets: their join needs no
    exchange, however often it is asked."""
    items, orders = bucketed_facts(spark, sf_dir)
    cats = Q.category_revenue(items, orders, T.products(spark, sf_dir), T.TARGET_YEAR, T.MONEY_SCALE)
    return cats.select("category", F.col("revenue").cast("double").alias("total_revenue"),
                       F.col("item_count").cast("bigint").alias("item_count"))


@query(
    "revenue_total_year",
    f"""{_WITH}
SELECT (SELECT COUNT(*) FROM oy) AS orders_in_year, CAST((SELECT SUM(revenue) FROM cat) AS DOUBLE) AS total_revenue""",
    "AGG10 AGG5",
)
def revenue_total_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = category_revenue(spark, sf_dir).select(F.sum("revenue")).scalar()
    return row_count(orders_in_year(spark, sf_dir), "orders_in_year").select(
        "orders_in_year", total.cast("double").alias("total_revenue")
    )


@query(
    "top10_categories_share",
    f"""{_WITH}
SELECT CAST(row_number() OVER (ORDER BY revenue DESC, category NULLS FIRST) AS INTEGER) AS rank,
       COALESCE(NULLIF(category, ''), 'Unknown') AS category,
       CAST(revenue AS DOUBLE) AS total_revenue,
       CAST(revenue AS DOUBLE) * 100.0 / CAST((SELECT SUM(revenue) FROM cat) AS DOUBLE) AS pct
FROM cat ORDER BY revenue DESC, category NULLS FIRST LIMIT {TOP_N}""",
    "SRT5 WIN1 WIN2 AGG13",
)
def top10_categories_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    cats = materialize(category_revenue(spark, sf_dir))
    total = cats.select(F.sum("revenue")).scalar()
    top = with_rank(top_n(cats, TOP_N, revenue_order()), revenue_order(), "rank")
    return top.select(
        "rank",
        label_or_default("category").alias("category"),
        F.col("revenue").cast("double").alias("total_revenue"),
        percent_of(F.col("revenue").cast("double"), total.cast("double")).alias("pct"),
    ).orderBy("rank")


@query(
    "top10_subtotal_share",
    f"""{_WITH},
t AS (SELECT revenue FROM cat ORDER BY revenue DESC, category NULLS FIRST LIMIT {TOP_N})
SELECT CAST(SUM(revenue) AS DOUBLE) AS top_revenue,
       CAST(SUM(revenue) AS DOUBLE) * 100.0 / CAST((SELECT SUM(revenue) FROM cat) AS DOUBLE) AS top_pct,
       (SELECT COUNT(*) FROM cat) AS category_count
FROM t""",
    "AGG14 AGG18",
)
def top10_subtotal_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    cats = materialize(category_revenue(spark, sf_dir))
    total = cats.select(F.sum("revenue")).scalar()
    n_groups = cats.select(F.count(F.lit(1))).scalar()
    return top_n(cats, TOP_N, revenue_order()).agg(F.sum("revenue").alias("top")).select(
        F.col("top").cast("double").alias("top_revenue"),
        percent_of(F.col("top").cast("double"), total.cast("double")).alias("top_pct"),
        n_groups.alias("category_count"),
    )


@query(
    "result_group_counts",
    f"""{_WITH}
SELECT 'orders_by_country' AS result, COUNT(*) AS group_count
  FROM (SELECT c.country FROM o JOIN c ON o.customer_id = c.customer_id GROUP BY c.country)
UNION ALL SELECT 'orders_by_year_month', COUNT(*) FROM (SELECT 1 FROM o GROUP BY year(purchase_ts), month(purchase_ts))
UNION ALL SELECT 'revenue_by_category_year', COUNT(*) FROM cat""",
    "AGG18",
)
def result_group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    def n(df: DataFrame, name: str) -> DataFrame:
        return row_count(df, "group_count").select(F.lit(name).alias("result"), "group_count")

    return union_all(
        n(orders_by_country_frame(spark, sf_dir), "orders_by_country"),
        n(orders_by_year_month_frame(spark, sf_dir), "orders_by_year_month"),
        n(category_revenue(spark, sf_dir), "revenue_by_category_year"),
    )
