"""The original rating and order files as the questions' columns.

Declared schemas, so reading needs no inference pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.csv import read_csv
from tessera.sources.text import parse_delimited, read_lines

# Field positions of the headerless comma files ...
RATING_FIELDS = {0: "user_id", 1: "movie_id", 2: "rating", 3: "ts"}
MOVIE_FIELDS = {0: "movie_id", 1: "title", 2: "genres"}
USER_FIELDS = {0: "user_id", 1: "gender", 2: "age", 3: "occupation_id"}
OCCUPATION_FIELDS = {0: "occupation_id", 1: "occupation"}
# ... and the columns of the ';' files with a header, in file order
CUSTOMER_SCHEMA = (
    "Customer_Trx_ID string, Subscriber_ID string, Subscribe_Date date, First_Order_Date date, "
    "Customer_Postal_Code string, Customer_City string, Customer_Country string, Customer_Country_Code string, "
    "Age int, Gender string"
)
ORDER_SCHEMA = (
    "Order_ID string, Customer_Trx_ID string, Order_Status string, Order_Purchase_Timestamp timestamp, "
    "Order_Approved_At timestamp, Order_Delivered_Carrier_Date timestamp, Order_Delivered_Customer_Date timestamp, "
    "Order_Estimated_Delivery_Date timestamp"
)
ITEM_SCHEMA = (
    "Order_ID string, Order_Item_ID int, Product_ID string, Seller_ID string, Shipping_Limit_Date timestamp, "
    "Price double, Freight_Value double"
)
REVIEW_SCHEMA = (
    "Review_ID string, Order_ID string, Review_Score string, Review_Comment_Title_En string, "
    "Review_Comment_Message_En string, Review_Creation_Date timestamp, Review_Answer_Timestamp timestamp"
)
PRODUCT_SCHEMA = (
    "Product_ID string, Product_Category_Name string, Product_Weight_Gr int, Product_Length_Cm int, "
    "Product_Height_Cm int, Product_Width_Cm int"
)


def ratings(spark: SparkSession, paths: str | Sequence[str], strict: bool = True) -> DataFrame:
    """Rating files (bag union of their lines)."""
    return parse_delimited(read_lines(spark, paths), RATING_FIELDS, {"rating": "double", "ts": "bigint"}, strict=strict)


def movies(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return parse_delimited(read_lines(spark, path), MOVIE_FIELDS, strict=strict)


def users(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return parse_delimited(read_lines(spark, path), USER_FIELDS, {"age": "int"}, strict=strict)


def occupations(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return parse_delimited(read_lines(spark, path), OCCUPATION_FIELDS, strict=strict)


def customers(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, CUSTOMER_SCHEMA).select(
        F.col("Customer_Trx_ID").alias("customer_id"), F.col("Customer_Country").alias("country"))


def orders(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, ORDER_SCHEMA).select(
        F.col("Order_ID").alias("order_id"), F.col("Customer_Trx_ID").alias("customer_id"),
        F.col("Order_Purchase_Timestamp").alias("purchase_ts"))


def order_items(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, ITEM_SCHEMA).select(
        F.col("Order_ID").alias("order_id"), F.col("Order_Item_ID").alias("item_id"),
        F.col("Product_ID").alias("product_id"), F.col("Seller_ID").alias("seller_id"), F.col("Price").alias("price"),
        F.col("Freight_Value").alias("freight"))


def reviews(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, REVIEW_SCHEMA).select(
        F.col("Review_ID").alias("review_id"), F.col("Review_Score").alias("score"))


def products(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, PRODUCT_SCHEMA).select(
        F.col("Product_ID").alias("product_id"), F.col("Product_Category_Name").alias("category"))
