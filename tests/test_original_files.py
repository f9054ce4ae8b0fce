"""Each question from small files in the original formats."""

import os

import pytest

from tessera import questions as Q
from tessera.sources import files as S


def write(folder, name, lines):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


@pytest.fixture
def rating_files(spark, scratch):
    movies = S.movies(spark, write(scratch, "movies.txt", ["1,Alpha,Drama|War", "2,Beta,Drama", "3,Gamma,War"]))
    users = S.users(spark, write(scratch, "users.txt", ["u1,M,18,o1,x", "u2,F,19,o2,x", "u3,X,51,o1,x"]))
    occupations = S.occupations(spark, write(scratch, "occupation.txt", ["o1,doctor", "o2,artist"]))
    one = write(scratch, "ratings_1.txt", ["u1,1,4.5,946684800", "u1,1,4.5,946684800", "u2,1,3.004,978307200"])
    two = write(scratch, "ratings_2.txt", ["u3,2,5.0,946684799", "u1,9,1.0,946684800", "u2,1,2,978307200", "u2,1,2,978307200"])
    return movies, S.ratings(spark, [one, two]), users, occupations


def test_rating_questions(rating_files):
    movies, ratings, users, occupations = rating_files
    alpha = (4.5 + 4.5 + 3.004 + 2 + 2) / 5
    stats = {r.movie_id: (r.avg_rating, r.total_ratings) for r in Q.movie_stats(movies, ratings).collect()}
    assert stats == {"1": (pytest.approx(alpha), 5), "2": (5.0, 1)}
    assert [r.title for r in Q.best_movie(movies, ratings).collect()] == ["Alpha"]
    assert Q.best_movie(movies, ratings, 6).count() == 0
    genres = {r.genre: (r.avg_rating, r.total_ratings) for r in Q.genre_averages(movies, ratings).collect()}
    assert genres == {"Drama": (pytest.approx((5 * alpha + 5) / 6), 6), "War": (pytest.approx(alpha), 5)}
    by_gender = {r.movie_id: (r.male_avg, r.female_avg) for r in Q.movie_gender_averages(movies, ratings, users).collect()}
    assert by_gender == {"1": (4.5, pytest.approx(7.004 / 3)), "2": (None, None)}
    ages = {r.movie_id: (r.avg_0_18, r.avg_18_35, r.avg_35_50, r.avg_50_plus)
            for r in Q.movie_age_averages(movies, ratings, users).collect()}
    assert ages == {"1": (4.5, pytest.approx(7.004 / 3), None, None), "2": (None, None, None, 5.0)}
    jobs = {r.occupation: (r.avg_rating, r.total_ratings) for r in Q.occupation_averages(ratings, users, occupations).collect()}
    assert jobs == {"doctor": (15.0 / 4, 4), "artist": (pytest.approx(7.004 / 3), 3)}
    years = {r.year: r.total_ratings for r in Q.year_averages(ratings).collect()}
    assert years == {1999: 1, 2000: 3, 2001: 3}


def test_order_questions(spark, scratch):
    customers = S.customers(spark, write(scratch, "Customer_List.csv", [
        S.CUSTOMER_SCHEMA.replace(" string", "").replace(" date", "").replace(" int", "").replace(", ", ";"),
        'c1;s1;2020-01-01;2020-01-02;0123;"A; ""B""\nC";France;FR;30;Male', "c2;s2;2020-01-01;;9;X;Spain;ES;40;Female"]))
    orders = S.orders(spark, write(scratch, "Orders.csv", [
        S.ORDER_SCHEMA.replace(" string", "").replace(" timestamp", "").replace(", ", ";"),
        "o1;c1;done;2024-01-05 10:00:00;;;;", "o2;c1;done;2024-02-01 00:00:00;;;;", "o3;c2;done;2023-12-31 23:59:59;;;;"]))
    items = S.order_items(spark, write(scratch, "Order_Items.csv", [
        S.ITEM_SCHEMA.replace(" string", "").replace(" timestamp", "").replace(" int", "").replace(" double", "").replace(", ", ";"),
        "o1;1;p1;x;;10.005;1.5", "o1;2;p2;x;;20;", "o2;1;p1;y;;1.25;0.25", "o3;1;p1;x;;99;9"]))
    products = S.products(spark, write(scratch, "Products.csv", [
        S.PRODUCT_SCHEMA.replace(" string", "").replace(" int", "").replace(", ", ";"), "p1;toys;1;1;1;1", "p2;;1;1;1;1"]))
    reviews = S.reviews(spark, write(scratch, "Order_Reviews.csv", [
        S.REVIEW_SCHEMA.replace(" string", "").replace(" timestamp", "").replace(", ", ";"),
        'r1;o1;5;;"two\nlines";;', "r2;o1;n/a;;;;", "r3;o2;0;;;;", "r4;o2;3;;;;"]))
    assert {r.country: r.order_count for r in Q.orders_by_country(orders, customers).collect()} == {"France": 2, "Spain": 1}
    assert {(r.year, r.month): r.order_count for r in Q.orders_by_year_month(orders).collect()} == {
        (2024, 1): 1, (2024, 2): 1, (2023, 12): 1}
    assert sorted(r.score for r in Q.valid_reviews(reviews).collect()) == [3, 5]
    for scale in (None, 4):
        rows = Q.category_revenue(items, orders, products, 2024, scale=scale).collect()
        got = {r.category: (r.revenue, r.price_total, r.freight_total, r.item_count) for r in rows}
        assert [float(x) for x in got["toys"]] == pytest.approx([13.005, 11.255, 1.75, 2])
        assert got[None][0] is None and float(got[None][1]) == 20.0 and got[None][2] is None
