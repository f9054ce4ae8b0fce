"""The rating and order questions on the caller's own DataFrames.

Columns, whatever the source (``sources/files.py`` reads the original files,
``sources/tables.py`` derives stand-ins): ratings (user_id, movie_id, rating,
ts), movies (movie_id, title, genres), users (user_id, gender, age,
occupation_id), occupations (occupation_id, occupation); orders (order_id,
customer_id, purchase_ts), customers (customer_id, country), order items
(order_id, item_id, product_id, price, freight), products (product_id,
category), reviews (review_id, score).

Shape shared by all of them: the large fact is aggregated to the coarsest key
the question allows before a dimension is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.casts import in_closed_range, tolerant_cast
from tessera.functions.scalars import AGE_LABELS, GENDER_LABELS, age_bucket, epoch_year, explode_delimited, in_year
from tessera.operators.aggregate import (
    as_decimal,
    average_by,
    best_with_support,
    checked_sum,
    combine_sums,
    count_by,
    finish_average,
    partial_sums,
    pivot_average,
)
from tessera.operators.join import join_dimension

MIN_SUPPORT = 5
SCORE_MIN, SCORE_MAX = 1, 5
GENDER_COLUMNS = dict(zip(GENDER_LABELS, ("male_avg", "female_avg")))
AGE_COLUMNS = dict(zip(AGE_LABELS, ("avg_0_18", "avg_18_35", "avg_35_50", "avg_50_plus")))


# --------------------------------------------------------------------- ratings
def movie_stats(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    """(movie_id, title, avg_rating, total_ratings): aggregate, then join."""
    stats = average_by(ratings, ["movie_id"], "rating", "avg_rating", "total_ratings")
    return join_dimension(movies.select("movie_id", "title"), stats, "movie_id").select(
        "movie_id", "title", "avg_rating", "total_ratings"
    )


def best_movie(movies: DataFrame, ratings: DataFrame, min_support: int = MIN_SUPPORT) -> DataFrame:
    """The best average among movies with enough ratings; empty if none has."""
    return best_with_support(
        movie_stats(movies, ratings), "total_ratings", min_support,
        [F.desc("avg_rating"), F.asc("title"), F.asc("movie_id")],
    )


def genre_averages(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    """(genre, avg_rating, total_ratings).  Summed per movie first: the join
    and explode then see one row per movie."""
    per_movie = partial_sums(ratings, ["movie_id"], "rating")
    exploded = join_dimension(movies.select("movie_id", "genres"), per_movie, "movie_id").select(
        explode_delimited("genres", "|").alias("genre"), "value_sum", "value_count"
    )
    return finish_average(combine_sums(exploded, ["genre"]), "avg_rating", "total_ratings")


def ratings_with_users(ratings: DataFrame, users: DataFrame, user_cols: list[str]) -> DataFrame:
    """Rating rows joined to user attributes (inner)."""
    return join_dimension(
        ratings.select("user_id", "movie_id", "rating"), users.select("user_id", *user_cols), "user_id")


def movie_gender_averages(movies: DataFrame, ratings: DataFrame, users: DataFrame) -> DataFrame:
    j = ratings_with_users(ratings, users, ["gender"])
    piv = pivot_average(j, ["movie_id"], "gender", GENDER_COLUMNS, "rating")
    return join_dimension(piv, movies.select("movie_id", "title"), "movie_id").select(
        "movie_id", "title", *GENDER_COLUMNS.values())


def movie_age_averages(movies: DataFrame, ratings: DataFrame, users: DataFrame) -> DataFrame:
    j = ratings_with_users(ratings, users, ["age"]).withColumn("age_group", age_bucket("age"))
    piv = pivot_average(j, ["movie_id"], "age_group", AGE_COLUMNS, "rating")
    return join_dimension(piv, movies.select("movie_id", "title"), "movie_id").select(
        "movie_id", "title", *AGE_COLUMNS.values())


def occupation_averages(ratings: DataFrame, users: DataFrame, occupations: DataFrame) -> DataFrame:
    """(occupation_id, occupation, avg_rating, total_ratings).  (sum, count)
    per user first: the join then sees one row per user."""
    per_user = partial_sums(ratings, ["user_id"], "rating")
    per_occ = combine_sums(
        join_dimension(per_user, users.select("user_id", "occupation_id"), "user_id"), ["occupation_id"])
    return finish_average(join_dimension(occupations, per_occ, "occupation_id"), "avg_rating", "total_ratings")


def year_averages(ratings: DataFrame) -> DataFrame:
    """(year, avg_rating, total_ratings), years in UTC."""
    return average_by(
        ratings.select(epoch_year("ts").alias("year"), "rating"), ["year"], "rating", "avg_rating", "total_ratings")


# ---------------------------------------------------------------------- orders
def orders_by_country(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """(country, order_count), counted per customer before the join."""
    per_customer = count_by(orders, ["customer_id"], "order_id", "order_count")
    with_country = join_dimension(per_customer, customers, "customer_id")
    return with_country.groupBy("country").agg(F.sum("order_count").alias("order_count"))


def orders_by_year_month(orders: DataFrame) -> DataFrame:
    return count_by(
        orders, [F.year("purchase_ts").alias("year"), F.month("purchase_ts").alias("month")], "order_id", "order_count")


def scored_reviews(reviews: DataFrame) -> DataFrame:
    """Reviews with the score text replaced in place by ``try_cast`` (bad
    text -> NULL)."""
    return reviews.withColumn("score", tolerant_cast("score", "int"))


def valid_reviews(reviews: DataFrame) -> DataFrame:
    return scored_reviews(reviews).filter(in_closed_range("score", SCORE_MIN, SCORE_MAX))


def orders_in_year(orders: DataFrame, year: int) -> DataFrame:
    return orders.filter(in_year("purchase_ts", year))


def category_revenue(
    items: DataFrame, orders: DataFrame, products: DataFrame, year: int, scale: int | None = None,
) -> DataFrame:
    """(category, revenue, price_total, freight_total, item_count) of the items
    of orders placed in ``year``; a row without freight adds to the price total
    only.  Double sums, or exact decimal ones where the scale is known."""
    def value(c: str) -> Column:
        return F.col(c) if scale is None else as_decimal(c, scale)

    total = F.sum if scale is None else checked_sum
    joined = join_dimension(items, orders_in_year(orders, year).select("order_id"), "order_id")
    # per product first: the join with products sees one row per product
    per_product = joined.groupBy("product_id").agg(
        total(value("price") + value("freight")).alias("revenue"),
        total(value("price")).alias("price_total"),
        total(value("freight")).alias("freight_total"),
        F.count("item_id").alias("item_count"),
    )
    return join_dimension(per_product, products, "product_id").groupBy("category").agg(
        *[total(F.col(c)).alias(c) for c in ("revenue", "price_total", "freight_total")],
        F.sum("item_count").alias("item_count"),
    )
