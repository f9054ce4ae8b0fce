"""Property tests: the column helpers that mimic Python behaviour, checked
against Python itself on generated inputs (one Spark job per property)."""

import base64
import binascii

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions.scalars import (
    b64_decode,
    format2,
    format_thousands,
    pad_left,
    pad_right,
    split_first,
    split_literal,
)

SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))

DATA = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")
FOREIGN = [" ", "\n", "%", "|", "-", "é"]
# data and foreign characters, then a tail of '=' and foreign characters:
# every '=' comes after the last data character
B64_TEXT = st.builds(
    lambda body, tail: body + tail,
    st.text(st.sampled_from(DATA + FOREIGN), max_size=24),
    st.text(st.sampled_from(["="] + FOREIGN), max_size=5),
)


def _python_decode(s: str):
    try:
        out = base64.b64decode(s)
    except (binascii.Error, ValueError):
        return None
    return out


@SETTINGS
@given(st.lists(st.one_of(
    st.binary(max_size=40).map(lambda b: base64.b64encode(b).decode()),
    B64_TEXT,
), min_size=200, max_size=200))
def test_b64_decode_matches_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: (None if r.d is None else bytes(r.d)) for r in df.select("i", b64_decode("t").alias("d")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == _python_decode(t), repr(t)


def test_b64_decode_inner_padding_follows_python(spark):
    # an '=' before more data is skipped, or ends the text where it completes a quad
    cases = {"0000=": b"\xd3M4", "YQ===": b"a", "YQ= =": b"a", "AB==CD==": b"\x00", "A=BCD": b"\x00\x10\x83"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: (None if r.d is None else bytes(r.d)) for r in df.select("t", b64_decode("t").alias("d")).collect()}
    for k, want in cases.items():
        assert got[k] == want == _python_decode(k), k


@SETTINGS
@given(st.lists(st.floats(min_value=-1e12, max_value=1e12, allow_nan=False), min_size=300, max_size=300))
def test_two_decimal_formats_match_python(spark, xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    rows = df.select("i", format2("x").alias("a"), format_thousands("x", 2).alias("b")).collect()
    for r in rows:
        x = xs[r.i]
        assert r.a == f"{x:.2f}", x
        assert r.b == f"{x:,.2f}", x


@SETTINGS
@given(st.lists(st.text(st.sampled_from(list("ab|,. ")), max_size=12), min_size=200, max_size=200))
def test_split_helpers_match_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    head, tail = split_first("t", "|")
    rows = df.select("i", split_literal("t", "|").alias("parts"), head.alias("h"), tail.alias("tl")).collect()
    for r in rows:
        t = texts[r.i]
        assert r.parts == t.split("|"), repr(t)
        if "|" in t:
            h, tl = t.split("|", 1)
            assert (r.h, r.tl) == (h, tl), repr(t)


@SETTINGS
@given(st.lists(st.text(st.sampled_from(list("abc xyz")), max_size=15), min_size=100, max_size=100))
def test_padding_matches_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", pad_left("t", 8).alias("l"), pad_right("t", 8).alias("r")).collect()
    for r in rows:
        t = texts[r.i]
        assert (r.l, r.r) == (f"{t:>8}", f"{t:<8}"), repr(t)


@SETTINGS
@given(st.lists(st.one_of(
    st.integers(min_value=-2_000_000_000, max_value=4_000_000_000),
    st.builds(lambda d, off: d * 86_400 + off, st.integers(min_value=-20_000, max_value=40_000),
              st.sampled_from([-1, 0, 1])),
), min_size=300, max_size=300))
def test_epoch_year_matches_python_utc(spark, secs):
    import datetime as dt

    from tessera.functions.scalars import epoch_year

    df = spark.createDataFrame([(i, str(s)) for i, s in enumerate(secs)], "i int, ts string")
    got = {r.i: r.y for r in df.select("i", epoch_year("ts").alias("y")).collect()}
    for i, s in enumerate(secs):
        assert got[i] == dt.datetime.fromtimestamp(s, dt.timezone.utc).year, s


@SETTINGS
@given(st.lists(st.integers(min_value=-5, max_value=120), min_size=200, max_size=200))
def test_age_bucket_matches_rule(spark, ages):
    from tessera.functions.scalars import age_bucket

    def python_rule(a):
        return "0-18" if a <= 18 else "18-35" if a <= 35 else "35-50" if a <= 50 else "50+"

    df = spark.createDataFrame([(i, str(a)) for i, a in enumerate(ages)], "i int, age string")
    got = {r.i: r.b for r in df.select("i", age_bucket("age").alias("b")).collect()}
    assert all(got[i] == python_rule(a) for i, a in enumerate(ages))


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from(list('ab ;"\n\r\t,é') + ["\\"]), max_size=20)),
                min_size=150, max_size=150))
def test_csv_round_trip_keeps_any_text(spark, tmp_path_factory, texts):
    from tessera.sources.csv import read_csv, write_csv

    path = str(tmp_path_factory.mktemp("csvprop"))
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    write_csv(df, f"{path}/csv")
    back = {r.id: r.text for r in read_csv(spark, f"{path}/csv", "id long, text string", keep_empty_strings=True).collect()}
    assert len(back) == len(texts)
    for i, t in enumerate(texts):
        assert back[i] == t, repr(t)


@settings(max_examples=2, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(list("|.,;*+?$^()[]{}\\-#&~ ") + ["::", "a|"]),
                          st.text(st.sampled_from(list("ab|.,;*+?$^()[]{}\\-#&~ :")), max_size=12)),
                min_size=150, max_size=150))
def test_split_literal_any_delimiter(spark, cases):
    rows = [(i, d, t) for i, (d, t) in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, d string, t string")
    for delim in sorted({d for d, _ in cases}):
        sub = df.filter(F.col("d") == delim).select("i", split_literal("t", delim).alias("parts")).collect()
        for r in sub:
            t = cases[r.i][1]
            assert r.parts == t.split(delim), (delim, t)
