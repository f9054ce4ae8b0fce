"""Rating questions: averages per movie, genre, gender, age group,
occupation and year; best movie with minimum support.

Shape shared by all of them: aggregate the large rating fact to the
coarsest key the question allows *before* joining a dimension (the join key
is part of the group key, so this is exact), then join the much smaller
aggregate.  Partial aggregation happens before every shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import questions as Q
from tessera.functions.scalars import map_lookup
from tessera.operators.aggregate import average_by
from tessera.operators.join import join_dimension
from tessera.plans.registry import query
from tessera.questions import AGE_COLUMNS, MIN_SUPPORT  # noqa: F401  (AGE_COLUMNS: also for the reports)
from tessera.sources import tables as T

# SQL stand-ins, mirroring tessera.sources.tables
SQL_RATINGS = (
    "SELECT l_suppkey AS user_id, l_partkey AS movie_id, l_quantity AS rating, "
    "CAST(floor(epoch(l_shipdate)) AS BIGINT) AS ts FROM lineitem"
)
SQL_MOVIES = (
    "SELECT p_partkey AS movie_id, p_name AS title, replace(p_name, ' ', '|') AS genres FROM part"
)
SQL_USERS = (
    "SELECT s_suppkey AS user_id, CASE WHEN s_suppkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender, "
    f"CAST({T.AGE_BASE} + s_suppkey % {T.AGE_SPAN} AS INTEGER) AS age, s_nationkey AS occupation_id "
    "FROM supplier"
)
SQL_OCCUPATIONS = "SELECT n_nationkey AS occupation_id, n_name AS occupation FROM nation"
SQL_AVG = "SUM({v}) / CAST(COUNT({v}) AS DOUBLE)"


def _avg_sql(v: str, where: str | None = None) -> str:
    if where is None:
        return SQL_AVG.format(v=v)
    return (
        f"SUM({v}) FILTER (WHERE {where}) / "
        f"CAST(COUNT({v}) FILTER (WHERE {where}) AS DOUBLE)"
    )


_WITH = f"WITH r AS ({SQL_RATINGS}), m AS ({SQL_MOVIES}), u AS ({SQL_USERS}), o AS ({SQL_OCCUPATIONS})"


# ------------------------------------------- the questions on the stand-ins
def movie_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.movie_stats(T.movies(spark, sf_dir), T.ratings(spark, sf_dir))


def movie_gender_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.movie_gender_averages(T.movies(spark, sf_dir), T.ratings(spark, sf_dir), T.users(spark, sf_dir))


def movie_age_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.movie_age_averages(T.movies(spark, sf_dir), T.ratings(spark, sf_dir), T.users(spark, sf_dir))


# -------------------------------------------------------------------- queries
@query(
    "avg_rating_by_movie",
    f"""{_WITH},
s AS (SELECT movie_id, SUM(rating) AS sm, COUNT(rating) AS n FROM r GROUP BY movie_id)
SELECT m.movie_id, m.title, CAST(s.sm AS DOUBLE) / CAST(s.n AS DOUBLE) AS avg_rating, s.n AS total_ratings
FROM m JOIN s ON m.movie_id = s.movie_id
ORDER BY avg_rating DESC, title, movie_id""",
    "AGG1 JOI1 SRT1 PRJ2 PRJ8 UDF2",
)
def avg_rating_by_movie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movie_stats(spark, sf_dir).orderBy(F.desc("avg_rating"), "title", "movie_id")


@query(
    "best_movie_min_support",
    f"""{_WITH},
s AS (SELECT movie_id, SUM(rating) AS sm, COUNT(rating) AS n FROM r GROUP BY movie_id)
SELECT m.movie_id, m.title, CAST(s.sm AS DOUBLE) / CAST(s.n AS DOUBLE) AS avg_rating, s.n AS total_ratings
FROM m JOIN s ON m.movie_id = s.movie_id
WHERE s.n >= {MIN_SUPPORT}
ORDER BY avg_rating DESC, title, movie_id
LIMIT 1""",
    "AGG16 FIL1 SRT4",
)
def best_movie_min_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.best_movie(T.movies(spark, sf_dir), T.ratings(spark, sf_dir), MIN_SUPPORT)


@query(
    "best_movie_out_of_reach",
    f"""{_WITH},
s AS (SELECT movie_id, SUM(rating) AS sm, COUNT(rating) AS n FROM r GROUP BY movie_id)
SELECT m.movie_id, m.title, s.sm / CAST(s.n AS DOUBLE) AS avg_rating, s.n AS total_ratings
FROM m JOIN s ON m.movie_id = s.movie_id
WHERE s.n > (SELECT COUNT(*) FROM r)""",
    "AGG17 FIL1",
)
def best_movie_out_of_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No movie has more ratings than there are: the empty result."""
    ratings = T.ratings(spark, sf_dir)
    return Q.best_movie(T.movies(spark, sf_dir), ratings, ratings.count() + 1)


@query(
    "avg_rating_by_genre",
    f"""{_WITH},
s AS (SELECT movie_id, SUM(rating) AS sm, COUNT(rating) AS n FROM r GROUP BY movie_id),
g AS (SELECT unnest(string_split(m.genres, '|')) AS genre, s.sm, s.n FROM m JOIN s ON m.movie_id = s.movie_id)
SELECT genre, CAST(SUM(sm) AS DOUBLE) / CAST(SUM(n) AS DOUBLE) AS avg_rating, CAST(SUM(n) AS BIGINT) AS total_ratings
FROM g GROUP BY genre
ORDER BY avg_rating DESC, genre""",
    "JOI2 SCA2 UDF3 AGG1",
)
def avg_rating_by_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.genre_averages(T.movies(spark, sf_dir), T.ratings(spark, sf_dir)).orderBy(F.desc("avg_rating"), "genre")


@query(
    "avg_rating_by_movie_gender",
    f"""{_WITH},
j AS (SELECT r.movie_id, u.gender, r.rating FROM r JOIN u ON r.user_id = u.user_id),
a AS (SELECT movie_id, {_avg_sql('rating', "gender = 'M'")} AS male_avg,
             {_avg_sql('rating', "gender = 'F'")} AS female_avg
      FROM j GROUP BY movie_id)
SELECT a.movie_id, m.title, a.male_avg, a.female_avg FROM a JOIN m ON a.movie_id = m.movie_id
ORDER BY title, movie_id""",
    "JOI3 AGG2 AGG4 JOI4",
)
def avg_rating_by_movie_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movie_gender_pivot(spark, sf_dir).orderBy("title", "movie_id")


@query(
    "avg_rating_by_movie_age_group",
    f"""{_WITH},
j AS (SELECT r.movie_id, CASE WHEN u.age <= 18 THEN '0-18' WHEN u.age <= 35 THEN '18-35'
                              WHEN u.age <= 50 THEN '35-50' ELSE '50+' END AS age_group, r.rating
      FROM r JOIN u ON r.user_id = u.user_id),
a AS (SELECT movie_id,
             {_avg_sql('rating', "age_group = '0-18'")} AS avg_0_18,
             {_avg_sql('rating', "age_group = '18-35'")} AS avg_18_35,
             {_avg_sql('rating', "age_group = '35-50'")} AS avg_35_50,
             {_avg_sql('rating', "age_group = '50+'")} AS avg_50_plus
      FROM j GROUP BY movie_id)
SELECT a.movie_id, m.title, avg_0_18, avg_18_35, avg_35_50, avg_50_plus
FROM a JOIN m ON a.movie_id = m.movie_id
ORDER BY title, movie_id""",
    "SCA7 AGG2 AGG4 UDF1",
)
def avg_rating_by_movie_age_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movie_age_pivot(spark, sf_dir).orderBy("title", "movie_id")


@query(
    "movie_gender_avg_list",
    f"""{_WITH},
j AS (SELECT r.movie_id, u.gender, r.rating FROM r JOIN u ON r.user_id = u.user_id),
per AS (SELECT movie_id, gender, {_avg_sql('rating')} AS avg_rating FROM j GROUP BY movie_id, gender),
lst AS (SELECT movie_id, string_agg(gender, ',' ORDER BY gender) AS genders,
               max(avg_rating) FILTER (WHERE gender = 'M') AS male_avg,
               max(avg_rating) FILTER (WHERE gender = 'F') AS female_avg
        FROM per GROUP BY movie_id)
SELECT lst.movie_id, m.title, genders, male_avg, female_avg FROM lst JOIN m ON lst.movie_id = m.movie_id
ORDER BY title, movie_id""",
    "AGG3 SCA22",
)
def movie_gender_avg_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group-to-list form: per movie the sorted list of (gender, average),
    then dictionary lookups into it.  The list per movie is bounded by the
    number of gender labels."""
    j = Q.ratings_with_users(T.ratings(spark, sf_dir), T.users(spark, sf_dir), ["gender"])
    per = average_by(j, ["movie_id", "gender"], "rating", "avg_rating", "n")
    lists = per.groupBy("movie_id").agg(
        F.sort_array(F.collect_list(F.struct("gender", "avg_rating"))).alias("pairs")
    )
    keyed = F.filter("pairs", lambda p: p["gender"].isNotNull())
    titles = T.movies(spark, sf_dir).select("movie_id", "title")
    return (
        join_dimension(lists, titles, "movie_id")
        .select(
            "movie_id",
            "title",
            F.array_join(F.transform("pairs", lambda p: p["gender"]), ",").alias("genders"),
            map_lookup(keyed, "M").alias("male_avg"),
            map_lookup(keyed, "F").alias("female_avg"),
        )
        .orderBy("title", "movie_id")
    )


@query(
    "avg_rating_by_occupation",
    f"""{_WITH},
j AS (SELECT u.occupation_id, r.rating FROM r JOIN u ON r.user_id = u.user_id),
a AS (SELECT occupation_id, SUM(rating) AS sm, COUNT(rating) AS n FROM j GROUP BY occupation_id)
SELECT o.occupation_id, o.occupation, CAST(a.sm AS DOUBLE) / CAST(a.n AS DOUBLE) AS avg_rating, a.n AS total_ratings
FROM o JOIN a ON o.occupation_id = a.occupation_id
ORDER BY avg_rating DESC, occupation""",
    "JOI3 JOI1 AGG1",
)
def avg_rating_by_occupation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = Q.occupation_averages(T.ratings(spark, sf_dir), T.users(spark, sf_dir), T.occupations(spark, sf_dir))
    return found.orderBy(F.desc("avg_rating"), "occupation")


@query(
    "avg_rating_by_year",
    f"""{_WITH}
SELECT CAST(year(make_timestamp(ts * 1000000)) AS INTEGER) AS year,
       {_avg_sql('rating')} AS avg_rating, COUNT(rating) AS total_ratings
FROM r GROUP BY 1
ORDER BY year""",
    "SCA4 AGG1 SRT2",
)
def avg_rating_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.year_averages(T.ratings(spark, sf_dir)).orderBy("year")
