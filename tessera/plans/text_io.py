"""Text and CSV round trips, samples, and formatted report lines.

The round-trip queries first write data derived from the tables to a fresh
folder under the shared checkpoint root (``spark.checkpoint.dir``), then read
it back through the delimited / CSV readers, so the readers run over the
whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.scalars import (
    AGE_LABELS,
    bracket_list,
    format2,
    format_or_missing,
    format_thousands,
    label_or_default,
    pad_left,
    pad_right,
    percent_of,
)
from tessera.operators.aggregate import average_by, count_by, top_n, with_rank
from tessera.operators.inspect import sample_rows as _sample
from tessera.operators.inspect import schema_rows
from tessera.operators.join import join_dimension, union_all
from tessera.operators.partitioning import materialize
from tessera.plans import orders as O
from tessera.plans import ratings as R
from tessera.plans.registry import query
from tessera.session import scratch_dir
from tessera.sources import tables as T
from tessera.sources.csv import read_csv, write_csv
from tessera.sources.csv_ranges import read_csv_ranges
from tessera.sources.text import parse_delimited, read_lines, to_delimited_line, write_lines

# Column widths of the category report lines.
CATEGORY_WIDTH, MONEY_WIDTH, COUNT_WIDTH = 30, 15, 10
RANK_WIDTH, TOP_MONEY_WIDTH, PCT_WIDTH = 5, 20, 14
SCORE_WIDTH, SCORE_COUNT_WIDTH = 15, 25
# Labels of the closing lines.
TOTAL_LABEL, TOP10_LABEL = "Tong cong", "Tong Top 10"

DOCUMENT_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


# ----------------------------------------------------------- text round trip
def write_rating_files(spark: SparkSession, sf_dir: str) -> dict[str, object]:
    """Write ``movies`` and two ``ratings`` line files; return their paths."""
    base = scratch_dir(spark, "rating-text")
    li = T.read_table(spark, sf_dir, "lineitem")
    rating_lines = li.select(
        F.when(F.col("l_linenumber") <= 3, F.lit("ratings_1")).otherwise(F.lit("ratings_2")).alias("file"),
        to_delimited_line(
            ["l_suppkey", "l_partkey", "l_quantity", F.unix_timestamp("l_shipdate")]
        ).alias("value"),
    )
    write_lines(rating_lines, f"{base}/ratings", "value", partition_by="file")
    movie_lines = T.movies(spark, sf_dir).select(
        to_delimited_line(["movie_id", "title", "genres"]).alias("value")
    )
    write_lines(movie_lines, f"{base}/movies")
    return {
        "movies": f"{base}/movies",
        "ratings": [f"{base}/ratings/file=ratings_1", f"{base}/ratings/file=ratings_2"],
    }


@query(
    "delimited_parse",
    f"""{R._WITH},
s AS (SELECT movie_id, SUM(rating) AS sm, COUNT(rating) AS n FROM r GROUP BY movie_id)
SELECT CAST(m.movie_id AS VARCHAR) AS movie_id, m.title,
       CAST(s.sm AS DOUBLE) / CAST(s.n AS DOUBLE) AS avg_rating, s.n AS total_ratings
FROM m JOIN s ON m.movie_id = s.movie_id
ORDER BY avg_rating DESC, title, movie_id""",
    "SRC1 SRC2 SCA1 PRJ4 SET1",
)
def delimited_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average rating per movie from headerless comma-separated text files:
    two rating files read as one union, fields by position, ids kept as
    text, ratings cast fail-fast."""
    paths = write_rating_files(spark, sf_dir)
    ratings = parse_delimited(
        read_lines(spark, paths["ratings"]),
        {0: "user_id", 1: "movie_id", 2: "rating", 3: "ts"},
        {"rating": "double"},
    )
    movies = parse_delimited(read_lines(spark, paths["movies"]), {0: "movie_id", 1: "title"})
    stats = average_by(ratings, ["movie_id"], "rating", "avg_rating", "total_ratings")
    return join_dimension(movies, stats, "movie_id").orderBy(
        F.desc("avg_rating"), "title", "movie_id"
    )


@query(
    "csv_roundtrip",
    "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "SRC3 SNK5",
)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as ``;``-separated CSV with a header (quotes,
    separators and line breaks inside fields), read back with an explicit
    schema; every text comes back whole."""
    path = scratch_dir(spark, "documents-csv")
    write_csv(T.read_table(spark, sf_dir, "documents").select(*DOCUMENT_COLUMNS), path)
    return read_csv(spark, path, DOCUMENT_SCHEMA, keep_empty_strings=True)


@query(
    "csv_parallel_ranges",
    "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "SRC3",
)
def csv_parallel_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same CSV in files of any size, each read by as many tasks as it has
    byte ranges, wherever the cuts fall."""
    path = scratch_dir(spark, "documents-csv-ranges")
    write_csv(T.read_table(spark, sf_dir, "documents").select(*DOCUMENT_COLUMNS), path, records_per_file=0)
    return read_csv_ranges(spark, path, DOCUMENT_SCHEMA, keep_empty_strings=True)


def _inferred_int(column: str) -> str:
    return f"(SELECT CASE WHEN max({column}) > 2147483647 THEN 'bigint' ELSE 'int' END FROM orders)"


@query(
    "csv_schema_inference",
    "SELECT 'orders' AS \"table\", CAST(pos AS INTEGER) AS pos, name AS \"column\", type, true AS nullable FROM (VALUES "
    f"(1, 'o_orderkey', {_inferred_int('o_orderkey')}), (2, 'o_custkey', {_inferred_int('o_custkey')}), "
    "(3, 'o_orderstatus', 'string'), (4, 'o_totalprice', 'double'), (5, 'o_orderdate', 'timestamp'), "
    "(6, 'o_orderpriority', 'string')) AS t(pos, name, type)",
    "SRC3 SNK4",
)
def csv_schema_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as ``;`` CSV with a header, read back with type
    inference (a full pass over the data), and the inferred schema as rows:
    what ``printSchema`` shows.  Whole numbers are ``int`` while they fit."""
    path = scratch_dir(spark, "orders-csv")
    write_csv(T.read_table(spark, sf_dir, "orders"), path)
    return schema_rows(spark, {"orders": read_csv(spark, path, infer=True)})


#: Sources of the order questions: their tables and the stand-in columns' SQL.
_SOURCES = {
    "customers": (T.customers, O.SQL_CUSTOMERS, {"customer_id": None, "country": "string"}),
    "orders": (T.orders, O.SQL_ORDERS, {"order_id": None, "customer_id": None, "purchase_ts": "timestamp"}),
    "order_items": (T.order_items, O.SQL_ITEMS, {"order_id": None, "item_id": None, "product_id": None, "seller_id": None,
                                                 "price": "double", "freight": "double"}),
    "reviews": (T.reviews, O.SQL_REVIEWS, {"review_id": None, "score": "string"}),
    "products": (T.products, O.SQL_PRODUCTS, {"product_id": None, "category": "string"}),
}


def _source_schema_sql() -> str:
    rows = []
    for table, (_, sql, columns) in _SOURCES.items():
        for pos, (name, kind) in enumerate(columns.items(), 1):
            type_sql = f"'{kind}'" if kind else (
                f"(SELECT CASE WHEN max({name}) > 2147483647 THEN 'bigint' ELSE 'int' END FROM ({sql}))")
            rows.append(f"SELECT '{table}' AS \"table\", CAST({pos} AS INTEGER) AS pos, '{name}' AS \"column\", "
                        f"{type_sql} AS type, true AS nullable")
    return " UNION ALL ".join(rows)


@query("source_schema_rows", _source_schema_sql(), "SRC3 SNK4")
def source_schema_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five order sources as ``;`` CSV files, read back with type inference,
    and what ``printSchema`` shows of each, as rows."""
    frames = {}
    for table, (make, _, _) in _SOURCES.items():
        path = scratch_dir(spark, f"{table}-csv")
        write_csv(make(spark, sf_dir), path)
        frames[table] = read_csv(spark, path, infer=True)
    return schema_rows(spark, frames)


_SAMPLES = {  # key columns and the fields of a sample line, in Spark and in SQL
    "customers": (["customer_id"], ["customer_id", "country"]),
    "orders": (["order_id"], ["order_id", "customer_id"]),
    "order_items": (["order_id", "item_id", "product_id", "seller_id", "price"],  # items may repeat a number
                    ["order_id", "item_id", "product_id", "seller_id", "price", "freight"]),
    "reviews": (["review_id"], ["review_id", "score"]),
    "products": (["product_id"], ["product_id", "category"]),
}
_MONEY = ("price", "freight")


def _source_samples_sql() -> str:
    parts = []
    for table, (keys, fields) in _SAMPLES.items():
        line = " || ';' || ".join(f"printf('%.4f', {f})" if f in _MONEY else f"CAST({f} AS VARCHAR)" for f in fields)
        parts.append(f"(SELECT '{table}' AS \"table\", CAST(row_number() OVER (ORDER BY {', '.join(keys)}) AS INTEGER) AS pos, "
                     f"{line} AS line FROM (SELECT * FROM ({_SOURCES[table][1]}) ORDER BY {', '.join(keys)} LIMIT 5))")
    return " UNION ALL ".join(parts)


@query("source_samples", _source_samples_sql(), "SNK5 SRT5")
def source_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five rows by key of every order source, as text lines."""
    parts = []
    for table, (keys, fields) in _SAMPLES.items():
        top = with_rank(_sample(_SOURCES[table][0](spark, sf_dir), 5, keys), keys, "pos")
        line = F.concat_ws(";", *[F.format_string("%.4f", F.col(f)) if f in _MONEY else F.col(f).cast("string") for f in fields])
        parts.append(top.select(F.lit(table).alias("table"), "pos", line.alias("line")))
    return union_all(*parts)


@query(
    "sample_rows",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority "
    "FROM orders ORDER BY o_orderkey LIMIT 5",
    "SNK5",
)
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample(T.read_table(spark, sf_dir, "orders"), 5, ["o_orderkey"])


# ------------------------------------------------------------ report lines
def _fmt_sql(x: str) -> str:
    return f"format('{{:.2f}}', {x})"


def _pad_sql(s: str, n: int, side: str) -> str:
    fn = "rpad" if side == "right" else "lpad"
    return f"(CASE WHEN length({s}) >= {n} THEN {s} ELSE {fn}({s}, {n}, ' ') END)"


@query(
    "gender_report_text",
    f"""{R._WITH},
j AS (SELECT r.movie_id, u.gender, r.rating FROM r JOIN u ON r.user_id = u.user_id),
a AS (SELECT movie_id, {R._avg_sql('rating', "gender = 'M'")} AS male_avg,
             {R._avg_sql('rating', "gender = 'F'")} AS female_avg FROM j GROUP BY movie_id)
SELECT a.movie_id, m.title || ' - ' || CASE WHEN male_avg IS NULL AND female_avg IS NULL THEN 'No data'
       ELSE 'Male_Avg: ' || COALESCE({_fmt_sql('male_avg')}, 'NA') || ', Female_Avg: ' || COALESCE({_fmt_sql('female_avg')}, 'NA') END AS line
FROM a JOIN m ON a.movie_id = m.movie_id
ORDER BY m.title, a.movie_id""",
    "SNK1 SCA8 SCA12 SCA13",
)
def gender_report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = R.movie_gender_pivot(spark, sf_dir)
    stats = F.when(
        F.col("male_avg").isNull() & F.col("female_avg").isNull(), F.lit("No data")
    ).otherwise(
        F.concat(
            F.lit("Male_Avg: "), format_or_missing("male_avg"),
            F.lit(", Female_Avg: "), format_or_missing("female_avg"),
        )
    )
    return p.orderBy("title", "movie_id").select(
        "movie_id", F.concat(F.col("title"), F.lit(" - "), stats).alias("line")
    )


@query(
    "age_report_text",
    f"""{R._WITH},
j AS (SELECT r.movie_id, CASE WHEN u.age <= 18 THEN '0-18' WHEN u.age <= 35 THEN '18-35'
                              WHEN u.age <= 50 THEN '35-50' ELSE '50+' END AS age_group, r.rating
      FROM r JOIN u ON r.user_id = u.user_id),
a AS (SELECT movie_id,
             {R._avg_sql('rating', "age_group = '0-18'")} AS a1, {R._avg_sql('rating', "age_group = '18-35'")} AS a2,
             {R._avg_sql('rating', "age_group = '35-50'")} AS a3, {R._avg_sql('rating', "age_group = '50+'")} AS a4
      FROM j GROUP BY movie_id)
SELECT a.movie_id, m.title || ' - [0-18: ' || COALESCE({_fmt_sql('a1')}, 'NA') || ', 18-35: ' || COALESCE({_fmt_sql('a2')}, 'NA')
       || ', 35-50: ' || COALESCE({_fmt_sql('a3')}, 'NA') || ', 50+: ' || COALESCE({_fmt_sql('a4')}, 'NA') || ']' AS line
FROM a JOIN m ON a.movie_id = m.movie_id
ORDER BY m.title, a.movie_id""",
    "SNK1 SCA8 SCA12 SCA13",
)
def age_report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = R.movie_age_pivot(spark, sf_dir)
    items = [
        F.concat(F.lit(f"{label}: "), format_or_missing(col))
        for label, col in zip(AGE_LABELS, R.AGE_COLUMNS.values())
    ]
    return p.orderBy("title", "movie_id").select(
        "movie_id", F.concat(F.col("title"), F.lit(" - "), bracket_list(items)).alias("line")
    )


@query(
    "category_report_text",
    f"""{O._WITH}
SELECT COALESCE(NULLIF(category, ''), 'Unknown') AS category,
       {_pad_sql("COALESCE(NULLIF(category, ''), 'Unknown')", CATEGORY_WIDTH, 'right')} || ' ' ||
       {_pad_sql("format('{:,.2f}', CAST(revenue AS DOUBLE))", MONEY_WIDTH, 'left')} || ' ' ||
       {_pad_sql("format('{:,.2f}', CAST(price_total AS DOUBLE))", MONEY_WIDTH, 'left')} || ' ' ||
       {_pad_sql("format('{:,.2f}', CAST(freight_total AS DOUBLE))", MONEY_WIDTH, 'left')} || ' ' ||
       {_pad_sql("format('{:,}', item_count)", COUNT_WIDTH, 'left')} AS line
FROM cat ORDER BY revenue DESC, cat.category NULLS FIRST""",
    "SNK1 SCA9 SCA10 SCA11",
)
def category_report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    cats = O.category_revenue(spark, sf_dir)
    label = label_or_default("category")
    line = F.concat_ws(
        " ",
        pad_right(label, CATEGORY_WIDTH),
        pad_left(format_thousands(F.col("revenue").cast("double"), 2), MONEY_WIDTH),
        pad_left(format_thousands(F.col("price_total").cast("double"), 2), MONEY_WIDTH),
        pad_left(format_thousands(F.col("freight_total").cast("double"), 2), MONEY_WIDTH),
        pad_left(format_thousands("item_count", 0), COUNT_WIDTH),
    )
    return cats.orderBy(*O.revenue_order()).select(label.alias("category"), line.alias("line"))


@query(
    "top10_report_text",
    f"""{O._WITH},
t AS (SELECT row_number() OVER (ORDER BY revenue DESC, category NULLS FIRST) AS rank, category, revenue
      FROM cat ORDER BY revenue DESC, category NULLS FIRST LIMIT {O.TOP_N})
SELECT CAST(rank AS INTEGER) AS rank,
       {_pad_sql('CAST(rank AS VARCHAR)', RANK_WIDTH, 'left')} || ' ' ||
       {_pad_sql("COALESCE(NULLIF(category, ''), 'Unknown')", CATEGORY_WIDTH, 'right')} || ' ' ||
       {_pad_sql("format('{:,.2f}', CAST(revenue AS DOUBLE))", TOP_MONEY_WIDTH, 'left')} || ' ' ||
       {_pad_sql("format('{:.2f}', CAST(revenue AS DOUBLE) * 100.0 / CAST((SELECT SUM(revenue) FROM cat) AS DOUBLE))", PCT_WIDTH, 'left')} || '%' AS line
FROM t""",
    "SNK1 WIN1 SCA8 SCA9 SCA10",
)
def top10_report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    cats = materialize(O.category_revenue(spark, sf_dir))
    total = cats.select(F.sum("revenue")).scalar()
    top = with_rank(top_n(cats, O.TOP_N, O.revenue_order()), O.revenue_order(), "rank")
    line = F.concat(
        F.concat_ws(
            " ",
            pad_left(F.col("rank"), RANK_WIDTH),
            pad_right(label_or_default("category"), CATEGORY_WIDTH),
            pad_left(format_thousands(F.col("revenue").cast("double"), 2), TOP_MONEY_WIDTH),
            pad_left(format2(percent_of(F.col("revenue").cast("double"), total.cast("double"))), PCT_WIDTH),
        ),
        F.lit("%"),
    )
    return top.orderBy("rank").select("rank", line.alias("line"))


@query(
    "score_report_text",
    f"""{O._WITH},
s AS (SELECT score, COUNT(*) AS n FROM v GROUP BY score), t AS (SELECT COUNT(*) AS total FROM v),
r AS (SELECT score AS pos, {_pad_sql('CAST(score AS VARCHAR)', SCORE_WIDTH, 'left')} AS label, n, CAST(n AS DOUBLE) * 100.0 / CAST(total AS DOUBLE) AS pct
      FROM s, t
      UNION ALL SELECT {O.SCORE_MAX + 1}, {_pad_sql(f"'{TOTAL_LABEL}'", SCORE_WIDTH, 'left')}, total, 100.0 FROM t)
SELECT CAST(pos AS INTEGER) AS pos, label || ' ' || {_pad_sql("format('{:,}', n)", SCORE_COUNT_WIDTH, 'left')} || ' ' ||
       {_pad_sql(_fmt_sql('pct'), PCT_WIDTH, 'left')} || '%' AS line
FROM r ORDER BY pos""",
    "SNK1 SCA9 SCA10 AGG13",
)
def score_report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report lines of the review scores, closed by their total."""
    counts = materialize(count_by(O.valid_reviews(spark, sf_dir), ["score"], "review_id", "n"))  # at most five rows
    total = counts.agg(F.sum("n").alias("n"))
    rows = union_all(
        counts.select(F.col("score").alias("pos"), F.col("score").cast("string").alias("label"), "n"),
        total.select(F.lit(O.SCORE_MAX + 1).alias("pos"), F.lit(TOTAL_LABEL).alias("label"), "n"))
    share = percent_of(F.col("n"), counts.select(F.sum("n")).scalar())
    line = F.concat(F.concat_ws(" ", pad_left("label", SCORE_WIDTH), pad_left(format_thousands("n", 0), SCORE_COUNT_WIDTH),
                                pad_left(format2(share), PCT_WIDTH)), F.lit("%"))
    return rows.select(F.col("pos").cast("int").alias("pos"), line.alias("line")).orderBy("pos")


@query(
    "top10_subtotal_text",
    f"""{O._WITH},
t AS (SELECT revenue FROM cat ORDER BY revenue DESC, category NULLS FIRST LIMIT {O.TOP_N}),
s AS (SELECT CAST(SUM(revenue) AS DOUBLE) AS top, CAST((SELECT SUM(revenue) FROM cat) AS DOUBLE) AS total FROM t)
SELECT repeat(' ', {RANK_WIDTH}) || ' ' || {_pad_sql(f"'{TOP10_LABEL}'", CATEGORY_WIDTH, 'right')} || ' ' ||
       {_pad_sql("format('{:,.2f}', top)", TOP_MONEY_WIDTH, 'left')} || ' ' ||
       {_pad_sql(_fmt_sql('top * 100.0 / total'), PCT_WIDTH, 'left')} || '%' AS line
FROM s""",
    "SNK1 AGG14 SCA9 SCA10",
)
def top10_subtotal_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closing line of the top-10 report: its subtotal and share."""
    row = O.top10_subtotal_share(spark, sf_dir)
    return row.select(F.concat(
        F.concat_ws(" ", pad_left(F.lit(""), RANK_WIDTH), pad_right(F.lit(TOP10_LABEL), CATEGORY_WIDTH),
                    pad_left(format_thousands("top_revenue", 2), TOP_MONEY_WIDTH), pad_left(format2("top_pct"), PCT_WIDTH)),
        F.lit("%")).alias("line"))
