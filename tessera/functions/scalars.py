"""Column expressions.  Every helper returns a ``Column`` built from
``pyspark.sql.functions`` only, so it stays inside whole-stage codegen."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- fixed values
# Age buckets: upper bound (inclusive) -> label, then the label above the last
# bound.  Labels and bounds must stay as they are for results to match.
AGE_BOUNDS = ((18, "0-18"), (35, "18-35"), (50, "35-50"))
AGE_TOP_LABEL = "50+"
AGE_LABELS = ("0-18", "18-35", "35-50", "50+")

# Gender labels used by the gender pivot, in output order.
GENDER_LABELS = ("M", "F")

# Label shown for a missing or empty category, and for a missing average.
UNKNOWN_LABEL = "Unknown"
MISSING_VALUE_TEXT = "NA"

# Frame replacement: background colour channel value and mask threshold.
BACKGROUND_VALUE = 192
MASK_THRESHOLD = 0.2

# Output file name pattern of a frame (zero padded to 4, never truncated).
FRAME_FILE_PATTERN = "frame_%04d.jpg"
# -----------------------------------------------------------------------------


def in_year(c: ColumnOrName, year: int) -> Column:
    """``year(c) == year`` written as a half-open range.

    The range form reaches the parquet reader as ``GreaterThanOrEqual`` /
    ``LessThan`` pushed filters (row-group skipping); ``year(c) == y`` does not.
    Date literals compare to both TIMESTAMP and TIMESTAMP_NTZ columns.
    """
    c = _col(c)
    return (c >= F.lit(_dt.date(year, 1, 1))) & (c < F.lit(_dt.date(year + 1, 1, 1)))


def age_bucket(age: ColumnOrName) -> Column:
    """Age -> bucket label.  ``age`` is cast fail-fast (bad text raises)."""
    a = _col(age).cast("int")
    expr = None
    for bound, label in AGE_BOUNDS:
        expr = F.when(a <= bound, label) if expr is None else expr.when(a <= bound, label)
    return expr.otherwise(AGE_TOP_LABEL)


def gender_from_key(key: ColumnOrName) -> Column:
    """Stand-in gender for a numeric user key: even -> M, odd -> F."""
    return F.when(_col(key) % 2 == 0, F.lit("M")).otherwise(F.lit("F"))


def split_literal(c: ColumnOrName, delimiter: str) -> Column:
    """Split on a literal delimiter, keeping trailing empty fields (like
    Python's ``str.split(d)``).  Spark's pattern is a regex, so the delimiter
    is escaped."""
    import re

    return F.split(_col(c), re.escape(delimiter), -1)


def explode_delimited(c: ColumnOrName, delimiter: str) -> Column:
    """One row per delimited item; ``''`` yields one empty item."""
    return F.explode(split_literal(c, delimiter))


def split_first(c: ColumnOrName, delimiter: str) -> tuple[Column, Column]:
    """``s.split(d, 1)`` as (head, tail); tail is NULL if ``d`` is absent."""
    c = _col(c)
    pos = F.instr(c, delimiter)
    head = F.substring_index(c, delimiter, 1)
    tail = F.when(pos > 0, c.substr(pos + len(delimiter), F.length(c)))
    return head, tail


def format2(x: ColumnOrName) -> Column:
    """``f'{x:.2f}'``: two decimals, half-even on the exact binary value,
    no thousands separator."""
    return F.translate(F.format_number(_col(x), 2), ",", "")


def format_thousands(x: ColumnOrName, decimals: int = 0) -> Column:
    """``f'{x:,}'`` (decimals=0) or ``f'{x:,.2f}'`` (decimals=2)."""
    return F.format_number(_col(x), decimals)


def format_or_missing(x: ColumnOrName) -> Column:
    """Two-decimal text, or ``NA`` when the value is missing."""
    return F.coalesce(format2(x), F.lit(MISSING_VALUE_TEXT))


def pad_right(s: ColumnOrName, width: int) -> Column:
    """``f'{s:<width}'``: pads, never truncates (``rpad`` alone would)."""
    s = _col(s).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.rpad(s, width, " "))


def pad_left(s: ColumnOrName, width: int) -> Column:
    """``f'{s:>width}'``: pads, never truncates."""
    s = _col(s).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, " "))


def label_or_default(c: ColumnOrName, default: str = UNKNOWN_LABEL) -> Column:
    """``c if c else default``: NULL and empty text both get the default."""
    return F.coalesce(F.nullif(_col(c), F.lit("")), F.lit(default))


def epoch_year(epoch_seconds: ColumnOrName) -> Column:
    """UTC calendar year of epoch seconds, independent of the session time
    zone.  Text input is cast fail-fast (like ``int(ts)``)."""
    secs = _col(epoch_seconds).cast("bigint")
    return F.year(F.date_from_unix_date(F.floor(secs / 86400).cast("int")))


def percent_of(part: ColumnOrName, total: ColumnOrName) -> Column:
    """``part / total * 100`` in double; NULL instead of an error when the
    total is zero or missing."""
    return F.try_divide(_col(part).cast("double") * 100.0, _col(total).cast("double"))


def b64_encode(c: ColumnOrName) -> Column:
    """Base64 text of a string (UTF-8) or binary column, on one line.

    Spark 4.1 wraps base64 output every 76 characters by default; the packet
    format is line framed, so the CR/LF pairs are removed (a literal
    ``replace``, much cheaper than ``translate`` or a regex on long text)."""
    return F.replace(F.base64(_col(c)), F.lit("\r\n"), F.lit(""))


# Characters outside the base64 alphabet, and a text made only
# of alphabet characters.
B64_FOREIGN = "[^A-Za-z0-9+/=]"
B64_ONLY_ALPHABET = r"^[A-Za-z0-9+/=]*\z"  # \z: absolute end ($ also matches before a final newline)
B64_NON_ASCII = r"[^\x00-\x7F]"
B64_BEHIND_PADDING = "(?<==)(?=[^=])"  # where data follows padding


def _b64_data(c: Column) -> tuple[Column, Column, Column]:
    """Data characters that Python's scan of a base64 text uses, their number
    and whether the text is valid (NULL: it has non-ASCII characters).

    The scan counts data characters; an ``=`` ends it if it completes a quad
    (two after 4k + 2, one after 4k + 3 data characters) and is skipped
    otherwise.  Padding at the end alone, the normal case, needs no scan: only
    text with an ``=`` before data is cut into segments of data and padding,
    which are followed one by one."""
    clean = F.when(c.rlike(B64_ONLY_ALPHABET), c).when(
        ~c.rlike(B64_NON_ASCII), F.regexp_replace(c, B64_FOREIGN, "")
    )
    data = F.rtrim(clean, F.lit("="))
    inner = F.instr(data, "=") > 0

    def ends(n: Column, pads: Column) -> Column:
        return ((n % 4 == 2) & (pads >= 2)) | ((n % 4 == 3) & (pads >= 1))

    def follow(state: Column, segment: Column) -> Column:
        here = F.length(F.rtrim(segment, F.lit("=")))
        n = state["n"] + here
        return F.when(state["ended"], state).otherwise(
            F.struct(n.alias("n"), ends(n, F.length(segment) - here).alias("ended")))

    scanned = F.aggregate(F.split(clean, B64_BEHIND_PADDING), F.struct(F.lit(0).alias("n"), F.lit(False).alias("ended")), follow)
    n = F.when(inner, scanned["n"]).otherwise(F.length(data))
    ended = F.when(inner, scanned["ended"]).otherwise(ends(F.length(data), F.length(clean) - F.length(data)))
    used = F.when(inner, F.substr(F.replace(clean, F.lit("="), F.lit("")), F.lit(1), scanned["n"])).otherwise(data)
    return used, n, ended | (n % 4 == 0)


def b64_decode(c: ColumnOrName) -> Column:
    """Lenient base64 decode to binary, NULL when the text is not valid --
    Python's non-validating ``base64.b64decode``:

    * text with a non-ASCII character is invalid (Python rejects such a str);
    * other characters outside the base64 alphabet are ignored;
    * with ``L`` data characters and ``P`` ``=`` behind them: ``L % 4 == 0`` is
      valid with any padding, ``L % 4 == 2`` needs ``P >= 2``, ``L % 4 == 3``
      needs ``P >= 1``, ``L % 4 == 1`` is never valid;
    * an ``=`` amid data ends the text if it completes a quad, and is ignored
      if not.

    Cost: text made only of alphabet characters (the normal case) needs no
    rewrite; only text with foreign characters pays for the character-class
    regex, and only text with an inner ``=`` for the scan."""
    data, n, valid = _b64_data(_col(c))
    padded = F.when(n % 4 == 0, data).otherwise(F.concat(data, F.substring(F.lit("=="), 1, 4 - n % 4)))
    return F.when(valid, F.try_to_binary(padded, F.lit("base64")))


def b64_length(c: ColumnOrName) -> Column:
    """Bytes that ``b64_decode`` would give, NULL when the text is not valid:
    counted from the characters, nothing is decoded."""
    _, n, valid = _b64_data(_col(c))
    return F.when(valid, F.floor(n * 3 / 4).cast("int"))


def frame_file_name(frame_id: ColumnOrName) -> Column:
    """``frame_%04d.jpg``; ids wider than 4 digits are kept whole."""
    return F.format_string(FRAME_FILE_PATTERN, _col(frame_id).cast("bigint"))


def map_lookup(pairs: ColumnOrName, key: str) -> Column:
    """``dict(pairs).get(key)`` for an array of (key, value) structs."""
    return F.try_element_at(F.map_from_entries(_col(pairs)), F.lit(key))


def bracket_list(items: Sequence[Column]) -> Column:
    """``'[' + ', '.join(items) + ']'``."""
    return F.concat(F.lit("["), F.concat_ws(", ", *items), F.lit("]"))
