"""Edge cases of the rating questions (text parsing, joins, averages,
pivots, buckets, years) on small hand-made inputs."""

import pytest
from pyspark.errors.exceptions.base import PySparkException
from pyspark.sql import functions as F

from tessera.functions.scalars import age_bucket, epoch_year, explode_delimited
from tessera.operators.aggregate import average_by, best_with_support, pivot_average
from tessera.operators.join import join_dimension, union_all
from tessera.sources.text import parse_delimited, read_lines


def _write(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def _lines(spark, scratch, name, lines):
    return read_lines(spark, _write(f"{scratch}/{name}.txt", lines))


MOVIE_FIELDS = {0: "movie_id", 1: "title", 2: "genres"}
RATING_FIELDS = {0: "user_id", 1: "movie_id", 2: "rating", 3: "ts"}


def test_title_with_comma_splits_literally(spark, scratch):
    df = parse_delimited(_lines(spark, scratch, "m", ["7,Good, The,Drama"]), MOVIE_FIELDS)
    row = df.first()
    assert (row.movie_id, row.title, row.genres) == ("7", "Good", " The")


def test_short_line_strict_fails_tolerant_null(spark, scratch):
    lines = _lines(spark, scratch, "m", ["7"])
    with pytest.raises(PySparkException):
        parse_delimited(lines, MOVIE_FIELDS).collect()
    row = parse_delimited(lines, MOVIE_FIELDS, strict=False).first()
    assert row.movie_id == "7" and row.title is None and row.genres is None


def test_bad_number_fails_fast(spark, scratch):
    lines = _lines(spark, scratch, "r", ["1,7,x,0"])
    with pytest.raises(PySparkException):
        parse_delimited(lines, RATING_FIELDS, {"rating": "double"}).collect()
    assert parse_delimited(lines, RATING_FIELDS, {"rating": "double"}, strict=False).first().rating is None


def test_ids_stay_text(spark, scratch):
    r = parse_delimited(_lines(spark, scratch, "r", ["1,01,4.0,0"]), RATING_FIELDS, {"rating": "double"})
    m = parse_delimited(_lines(spark, scratch, "m", ["1,One,Drama"]), MOVIE_FIELDS)
    assert join_dimension(m, r, "movie_id").count() == 0  # "01" != "1"


def test_duplicate_rows_across_files_counted_twice(spark, scratch):
    p1 = _write(f"{scratch}/r1.txt", ["1,7,4.0,0"])
    p2 = _write(f"{scratch}/r2.txt", ["1,7,4.0,0"])
    r = parse_delimited(read_lines(spark, [p1, p2]), RATING_FIELDS, {"rating": "double"})
    row = average_by(r, ["movie_id"], "rating", "avg", "n").first()
    assert row.n == 2 and row.avg == 4.0


def test_inner_join_drops_unmatched_and_fans_out_duplicates(spark):
    movies = spark.createDataFrame([("1", "A"), ("1", "A2"), ("2", "B")], "movie_id string, title string")
    stats = spark.createDataFrame([("1", 3.0, 2), ("9", 1.0, 1)], "movie_id string, avg double, n long")
    rows = sorted(tuple(r) for r in join_dimension(movies, stats, "movie_id").collect())
    assert rows == [("1", "A", 3.0, 2), ("1", "A2", 3.0, 2)]


def test_null_keys_never_match(spark):
    a = spark.createDataFrame([(None, 1)], "k string, x int")
    b = spark.createDataFrame([(None, 2)], "k string, y int")
    assert join_dimension(a, b, "k").count() == 0


def test_support_threshold(spark):
    rows = [("a", 5.0)] * 4 + [("b", 3.0)] * 5
    r = spark.createDataFrame(rows, "movie_id string, rating double")
    stats = average_by(r, ["movie_id"], "rating", "avg_rating", "total_ratings")
    best = best_with_support(stats, "total_ratings", 5, [F.desc("avg_rating"), F.asc("movie_id")]).collect()
    assert [(b.movie_id, b.total_ratings) for b in best] == [("b", 5)]


def test_nobody_reaches_support_gives_empty(spark):
    r = spark.createDataFrame([("a", 5.0)] * 4, "movie_id string, rating double")
    stats = average_by(r, ["movie_id"], "rating", "avg_rating", "total_ratings")
    assert best_with_support(stats, "total_ratings", 5, [F.desc("avg_rating")]).count() == 0


def test_genre_list_with_repeats_and_trailing_empty(spark):
    df = spark.createDataFrame([("Drama|Drama|", 4.0)], "genres string, rating double")
    g = df.select(explode_delimited("genres", "|").alias("genre"), "rating")
    out = {r.genre: r.n for r in average_by(g, ["genre"], "rating", "avg", "n").collect()}
    assert out == {"Drama": 2, "": 1}


def test_empty_genres_gives_one_empty_genre(spark):
    df = spark.createDataFrame([("",)], "genres string")
    assert [r.g for r in df.select(explode_delimited("genres", "|").alias("g")).collect()] == [""]


def test_gender_pivot_missing_sides(spark):
    rows = [("m1", "M", 4.0), ("f1", "F", 2.0), ("x1", "X", 5.0), ("both", "M", 3.0), ("both", "F", 5.0)]
    df = spark.createDataFrame(rows, "movie_id string, gender string, rating double")
    out = {r.movie_id: (r.male_avg, r.female_avg) for r in
           pivot_average(df, ["movie_id"], "gender", {"M": "male_avg", "F": "female_avg"}, "rating").collect()}
    assert out == {"m1": (4.0, None), "f1": (None, 2.0), "x1": (None, None), "both": (3.0, 5.0)}


def test_age_buckets(spark):
    df = spark.createDataFrame([(a,) for a in (18, 19, 35, 36, 50, 51)], "age int")
    got = [r.b for r in df.select(age_bucket("age").alias("b")).collect()]
    assert got == ["0-18", "18-35", "18-35", "35-50", "35-50", "50+"]


def test_age_bucket_bad_text_fails(spark):
    df = spark.createDataFrame([("abc",)], "age string")
    with pytest.raises(PySparkException):
        df.select(age_bucket("age")).collect()


def test_epoch_year_is_utc_regardless_of_session_zone(spark):
    df = spark.createDataFrame([("978307199",), ("978307200",)], "ts string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert [r.y for r in df.select(epoch_year("ts").alias("y")).collect()] == [2000, 2001]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_union_all_keeps_duplicates(spark):
    a = spark.createDataFrame([(1,)], "x int")
    assert union_all(a, a, a).count() == 3


def test_average_keeps_all_decimals(spark):
    df = spark.createDataFrame([("a", 0.004), ("a", 0.004), ("b", 1.005), ("c", 3.333), ("c", 3.333)], "k string, v double")
    for ansi in ("true", "false"):
        old = spark.conf.get("spark.sql.ansi.enabled")
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            got = {r.k: r.a for r in average_by(df, ["k"], "v", "a", "n").collect()}
            odd = spark.createDataFrame([(float("nan"),), (1.0,)], "v double").selectExpr("1 AS k", "v")
            big = spark.createDataFrame([(1e18,), (1.0,)], "v double").selectExpr("1 AS k", "v")
            assert average_by(odd, ["k"], "v", "a", "n").selectExpr("isnan(a) AS x").first().x
            assert average_by(big, ["k"], "v", "a", "n").first().a == (1e18 + 1.0) / 2
        finally:
            spark.conf.set("spark.sql.ansi.enabled", old)
        assert got == {"a": 0.004, "b": 1.005, "c": 3.333}


def test_exact_average_is_the_true_mean_for_any_partitioning(spark):
    from decimal import Decimal

    vals = [(i % 7, round(0.0001 * (i * 37 % 9973), 4)) for i in range(2000)]
    df = spark.createDataFrame(vals, "k int, v double")
    want = {}
    for k, v in vals:
        total, n = want.get(k, (Decimal(0), 0))
        want[k] = (total + Decimal(str(v)), n + 1)
    for parts in (1, 13):
        got = {r.k: r.a for r in average_by(df.repartition(parts), ["k"], "v", "a", "n", scale=4).collect()}
        assert got == {k: float(t) / n for k, (t, n) in want.items()}


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("value", [0.12345, float("nan"), 1e17])
def test_exact_sum_fails_on_a_value_that_does_not_fit(spark, ansi, value):
    df = spark.createDataFrame([(1, value)], "k int, v double")
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="does not fit scale"):
            average_by(df, ["k"], "v", "a", "n", scale=4).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_quoted_mode_keeps_comma_titles_whole(spark, scratch):
    from tessera.sources.text import read_delimited_quoted

    path = _write(f"{scratch}/m.txt", ['7,"Good, The",Drama', "8,Plain,Comedy|Drama"])
    rows = read_delimited_quoted(spark, path, "movie_id string, title string, genres string").collect()
    assert sorted(tuple(r) for r in rows) == [("7", "Good, The", "Drama"), ("8", "Plain", "Comedy|Drama")]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_fields_fail_and_null_fields_keep_their_place(spark, ansi):
    from tessera.sources.text import parse_delimited, to_delimited_line

    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        fields, types = {0: "a", 1: "b", 2: "c"}, {"c": "double"}
        for bad in ("1,2,x", "1,2"):
            lines = spark.createDataFrame([(bad,)], "value string")
            with pytest.raises(Exception):
                parse_delimited(lines, fields, types).collect()
            assert parse_delimited(lines, fields, types, strict=False).first().c is None
        df = spark.createDataFrame([(None, 7, 4.0)], "user long, movie long, rating double")
        line = df.select(to_delimited_line(["user", "movie", "rating"]).alias("value"))
        assert line.first().value == ",7,4.0"
        assert parse_delimited(line, {0: "user", 1: "movie"}, {"movie": "long"}).first().movie == 7
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
