"""Parquet tables and the stand-in views the queries run on.

The reference reads movie-rating text files and e-commerce CSV exports that
are not shipped.  The queries run on the generated star-schema tables
through the stand-ins below (one mapping per source, kept in one place so
that the SQL oracle can mirror it exactly).  Each stand-in is a projection
of one scan: column pruning and filters reach the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.scalars import gender_from_key

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed values of the stand-in mapping.
# Order year standing in for the reference's "2024" revenue report.
TARGET_YEAR = 1999
# Base age and age span used to give each stand-in user an age.
AGE_BASE = 10
AGE_SPAN = 60
# Review score text for an event of this type is junk ('n/a').
JUNK_EVENT_TYPE = "error"
JUNK_SCORE_TEXT = "n/a"


# Declared schemas of the input tables.  Declaring them skips
# the footer-reading job that schema inference runs on every read.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str, infer: bool = False) -> DataFrame:
    """Parquet table ``name`` under ``sf_dir`` with its declared schema
    (``infer=True`` reads the schema from the files instead)."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if infer:
        return spark.read.parquet(path)
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(path)


# ----------------------------------------------------------------- ratings side
def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, movie_id, rating double, ts bigint epoch seconds)."""
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("user_id"),
        F.col("l_partkey").alias("movie_id"),
        F.col("l_quantity").alias("rating"),
        # TIMESTAMP_NTZ -> epoch seconds, read as UTC wall clock
        F.unix_timestamp("l_shipdate").alias("ts"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(movie_id, title, genres '|'-joined)."""
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_name").alias("title"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit("|")).alias("genres"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, gender, age int, occupation_id)."""
    k = F.col("s_suppkey")
    return read_table(spark, sf_dir, "supplier").select(
        k.alias("user_id"),
        gender_from_key(k).alias("gender"),
        (F.lit(AGE_BASE) + k % AGE_SPAN).cast("int").alias("age"),
        F.col("s_nationkey").alias("occupation_id"),
    )


def occupations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(occupation_id, occupation)."""
    return read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("occupation_id"), F.col("n_name").alias("occupation")
    )


# ------------------------------------------------------------------ orders side
def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(customer_id, country).  Country names come from the 25-row nation
    table, which the planner broadcasts by its size."""
    nation = read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")
    )
    return (
        read_table(spark, sf_dir, "customer")
        .select(F.col("c_custkey").alias("customer_id"), "c_nationkey")
        .join(nation, "c_nationkey", "inner")
        .select("customer_id", "country")
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_id, customer_id, purchase_ts)."""
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("purchase_ts"),
    )


#: Decimals of prices and freights.
MONEY_SCALE = 4


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_id, item_id, product_id, seller_id, price, freight)."""
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").alias("price"),
        F.round(F.col("l_extendedprice") * F.col("l_tax"), MONEY_SCALE).alias("freight"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(product_id, category)."""
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("category")
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(review_id, score string): raw score text with junk, zeros, 1-5 and
    out-of-range values."""
    return read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("review_id"),
        F.when(F.col("event_type") == JUNK_EVENT_TYPE, F.lit(JUNK_SCORE_TEXT))
        .otherwise(F.floor(F.col("value") / 10).cast("int").cast("string"))
        .alias("score"),
    )
