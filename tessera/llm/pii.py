"""PII (operator 4): format-preserving Feistel pseudonyms, in DataFrame functions only.

One pattern finds candidates: hexadecimal secrets, IBANs, e-mail addresses,
IPv4 addresses, dates, social security numbers, phone numbers and long digit
numbers.  Candidates that pass their kind's validation are permuted within
their format by a keyed Feistel network, so a pseudonym is valid in the same
way and equal values get equal pseudonyms in every document; without the key
nothing can be traced back, with it ``reveal`` inverts it.  Rounds are HMAC-SHA256
under a key derived from the caller's: query plans show what is derived (enough
to trace values back, so plans are to be kept like the data), never the key.

* Digit strings: alternating Feistel over the two halves, modulo powers of ten.
  Card numbers (Luhn) and IBANs (mod 97) get new check digits.
* Dates of 1900-2099 and social security numbers: mixed-radix Feistel over
  exactly the valid values.  IPv4: over two 16-bit halves.
* E-mail names and secrets: Feistel over the two halves, each character
  shifted within its class (digit, lower, upper); domains stay.
* An IBAN printed in groups of four gets the pseudonym of its compact form.

All patterns are bounded, so long texts cost in proportion: an e-mail name has at
most 256 characters, a domain 127 labels of 63; what is longer is no address and
stays.

Defined results: null text stays null; empty text stays empty; candidates that
fail validation stay as they are; repeated rows and ties change alike; all
columns are kept; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import hmac

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
#: Letters, digits and underscore of any script would join words; ASCII ones bound candidates.
_NOT_BEFORE, _NOT_AFTER = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
#: Not into an address, a date or an expiry behind the number.
_NOT_INTO = r"(?![0-9]|\.[0-9]{1,3}\.|/[0-9])"
#: Not a few digits and then a whole card.
_NOT_BEFORE_CARD = (r"(?![0-9]{1,12}[ \-](?:[0-9]{13,19}|[0-9]{4}(?:[ \-][0-9]{4}){3}|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{5})"
                    r"(?![0-9]))")
KINDS = {
    "secret": r"[0-9a-fA-F]{32,128}",
    "iban": r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)",
    "email": r"[A-Za-z0-9._%+\-]{1,256}+@[A-Za-z0-9\-]{1,63}+(?:\.[A-Za-z0-9\-]{1,63}+){1,126}+(?!\.[A-Za-z0-9\-])",
    "ip": r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",
    "iso_date": r"[0-9]{4}-[0-9]{2}-[0-9]{2}(?!-?[0-9])",
    "dot_date": r"[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?!\.?[0-9])",
    "slash_date": r"[0-9]{2}/[0-9]{2}/[0-9]{4}(?!/?[0-9])",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-?[0-9])",
    "phone": r"\+[0-9]{1,3}[ \-]?\(?[0-9]{3}\)?[ \-]?[0-9]{3}[ \-]?[0-9]{4}|\([0-9]{3}\)[ \-]?[0-9]{3}[ \-][0-9]{4}"
             r"|[0-9]{3}[. \-][0-9]{3}[. \-][0-9]{4}"
             # other countries: groups of two to four digits, seven digits at least
             r"|\+(?=(?:[ .\-()]{0,2}[0-9]){7})[0-9]{1,3}[ .\-]?(?:\(0\) ?)?\(?[0-9]{1,4}\)?(?:[ .\-]?[0-9]{2,4}){1,5}"
             + _NOT_INTO,
    # whole cards first, so that digits behind a card are not drawn into it
    "number": "|".join(
        [r"[0-9]{13,19}"]
        + [rf"[0-9]{{4}}(?:{c}[0-9]{{4}}){{3}}(?!-[0-9])" for c in " -"]
        + [rf"[0-9]{{4}}{c}[0-9]{{6}}{c}[0-9]{{4,5}}(?!-[0-9])" for c in " -"]
        + [_NOT_BEFORE_CARD + r"[0-9](?:[ \-]?[0-9]){12,18}" + end for end in (_NOT_INTO, "")]),
}
#: An e-mail name starts where its characters start, or it would be scanned from each of them.
_BEFORE = {"email": r"(?<![A-Za-z0-9._%+\-])", "ip": r"(?<![0-9A-Za-z.])"}
#: A time may follow a date.
_AFTER = {"iso_date": r"(?![0-9A-SU-Za-z]|T(?![0-9]{2}:?[0-9]{2}))"}
CANDIDATE = "|".join(
    f"{_BEFORE.get(kind, _NOT_BEFORE)}(?:{pattern}){_AFTER.get(kind, _NOT_AFTER)}" for kind, pattern in KINDS.items())
_FIRST_DAY, _DAYS, _DAY_RADIX = "1900-01-01", 73049, 4297  # 17 * 4297 days are 1900-2099
_SSN_AREAS, _SSN_REST, _SERIALS = 898, 99 * 9999, 9999


def _pads(key: str) -> tuple[bytes, bytes]:
    """Inner and outer HMAC key blocks under a key derived from the caller's."""
    block = hmac.new(key.encode(), b"format-preserving pseudonyms", hashlib.sha256).digest().ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in block), bytes(b ^ 0x5C for b in block)


def _keyed_hash(key: str, *parts: Column) -> Column:
    """HMAC-SHA256 of the parts, as 64 hexadecimal digits."""
    inner, outer = _pads(key)
    first = F.sha2(F.concat(F.lit(inner), F.concat_ws("|", *parts).cast("binary")), 256)
    return F.sha2(F.concat(F.lit(outer), F.unhex(first)), 256)


def _round_value(key: str, kind: Column | str, turn: Column, value: Column) -> Column:
    """60 keyed pseudorandom bits."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    digest = _keyed_hash(key, kind, turn.cast("string"), value.cast("string"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def _feistel(key: str, kind, left: Column, right: Column, left_radix: Column, right_radix: Column,
             inverse: bool) -> Column:
    """Struct (a, b) of the permuted pair in Z_left_radix x Z_right_radix."""
    sign = -1 if inverse else 1
    turns = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if inverse else F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def step(state, turn):
        on_left = turn % 2 == 0
        move_a = F.pmod(state["a"] + sign * (_round_value(key, kind, turn, state["b"]) % left_radix), left_radix)
        move_b = F.pmod(state["b"] + sign * (_round_value(key, kind, turn, state["a"]) % right_radix), right_radix)
        return F.struct(F.when(on_left, move_a).otherwise(state["a"]).alias("a"),
                        F.when(on_left, state["b"]).otherwise(move_b).alias("b"))

    start = F.struct(left.cast("bigint").alias("a"), right.cast("bigint").alias("b"))
    return F.aggregate(turns, start, step)


def _with(value: Column, then) -> Column:
    """Evaluate ``value`` once and pass it on (a one-element transform)."""
    return F.transform(F.array(value), then)[0]


def _power_of_ten(n: Column) -> Column:
    return F.rpad(F.lit("1"), (n + 1).cast("int"), F.lit("0")).cast("bigint")


def _pad(value: Column, n: Column) -> Column:
    return F.when(n == 0, F.lit("")).otherwise(F.lpad(value.cast("string"), n.cast("int"), F.lit("0")))


def _permute_digits(key: str, kind: str, digits: Column, inverse: bool) -> Column:
    """Digit string of 2 to 36 digits -> another of the same length."""
    n = F.length(digits)
    u = F.floor(n / 2).cast("int")
    v = n - u
    pair = _feistel(key, F.concat(F.lit(kind), n.cast("string")), F.substring(digits, F.lit(1), u).cast("bigint"),
                    F.substring(digits, u + 1, v).cast("bigint"), _power_of_ten(u), _power_of_ten(v), inverse)
    return _with(pair, lambda p: F.concat(_pad(p["a"], u), _pad(p["b"], v)))


def _permute_characters(key: str, kind: str, text: Column, letters: int, inverse: bool) -> Column:
    """String -> one of the same length and character classes."""
    n = F.length(text)
    u = F.floor(n / 2).cast("int")
    turns = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if inverse else F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def shifted(half: Column, stream: Column) -> Column:
        def move(c, j):
            code = F.ascii(c)
            k = F.conv(F.substring(stream, j * 2 + 1, F.lit(2)), 16, 10).cast("int") * (-1 if inverse else 1)
            out = F.lit(None).cast("string")
            for first, size in ((97, letters), (65, letters), (48, 10)):
                out = F.when((code >= first) & (code < first + size), F.char(first + F.pmod(code - first + k, F.lit(size)))
                             ).otherwise(out)
            return F.coalesce(out, c)

        characters = F.when(F.length(half) > 0, F.split(half, "")).otherwise(F.array().cast("array<string>"))
        return F.array_join(F.transform(characters, move), "")

    def step(state, turn):
        on_left = turn % 2 == 0
        other = F.when(on_left, state["b"]).otherwise(state["a"])
        # two hexadecimal digits for each character of a half
        stream = F.array_join(F.transform(
            F.sequence(F.lit(0), F.floor(n / 64).cast("int")),
            lambda i: _keyed_hash(key, F.lit(kind), turn.cast("string"), i.cast("string"), other)), "")
        return _with(stream, lambda s: F.struct(
            F.when(on_left, shifted(state["a"], s)).otherwise(state["a"]).alias("a"),
            F.when(on_left, state["b"]).otherwise(shifted(state["b"], s)).alias("b")))

    start = F.struct(F.substring(text, F.lit(1), u).alias("a"), F.substring(text, u + 1, n - u).alias("b"))
    return _with(F.aggregate(turns, start, step), lambda p: F.concat(p["a"], p["b"]))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _refill(text: Column, digits: Column) -> Column:
    """The text with its digits replaced in order."""
    return F.array_join(F.transform(
        F.split(text, ""),
        lambda c, i: F.when(c.between("0", "9"), F.substring(
            digits, F.length(_digits(F.substring(text, F.lit(1), i + 1))), F.lit(1))).otherwise(c)), "")


def _luhn_digit(digits: Column) -> Column:
    """Check digit of a digit string without it."""
    n = F.length(digits)
    total = F.aggregate(
        F.transform(F.split(digits, ""), lambda c, i: F.when(
            (n - i) % 2 == 1, F.floor(c.cast("int") * 2 / 10) + c.cast("int") * 2 % 10).otherwise(c.cast("int")).cast("bigint")),
        F.lit(0).cast("bigint"), lambda s, x: s + x)
    return ((10 - total % 10) % 10).cast("string")


def _mod97(text: Column) -> Column:
    """Value of an IBAN's rearranged text modulo 97 (letters are 10 to 35)."""
    return F.aggregate(F.split(text, ""), F.lit(0).cast("bigint"), lambda s, c: F.when(
        c.between("0", "9"), (s * 10 + c.cast("int")) % 97).otherwise((s * 100 + F.ascii(c) - 55) % 97))


def _number(key: str, text: Column, inverse: bool) -> Column:
    def of(digits):
        n = F.length(digits)
        body = F.substring(digits, F.lit(1), n - 1)
        card = F.substring(digits, n, F.lit(1)) == _luhn_digit(body)
        as_card = _with(_permute_digits(key, "card", body, inverse), lambda b: F.concat(b, _luhn_digit(b)))
        # the rest must not become cards by chance, or two values could meet: they
        # keep their distance from the check digit
        gap = F.pmod(F.substring(digits, n, F.lit(1)).cast("int") - _luhn_digit(body).cast("int"), F.lit(10))
        as_number = _with(_permute_digits(key, "number", body, inverse), lambda b: F.concat(
            b, F.pmod(_luhn_digit(b).cast("int") + gap, F.lit(10)).cast("string")))
        return _refill(text, F.when(card, as_card).otherwise(as_number))

    return _with(_digits(text), of)


def _phone(key: str, text: Column, inverse: bool) -> Column:
    def of(digits):
        n = F.length(digits)
        # a separated country code stays, or else what stands before the last ten digits
        code = F.length(F.regexp_extract(text, r"^\+([0-9]{1,3})[ .\-(]", 1))
        stays = F.when(code > 0, code).when(text.startswith("+"), F.greatest(n - 10, F.lit(1))).otherwise(n - 10)
        return _refill(text, F.concat(F.substring(digits, F.lit(1), stays), _permute_digits(
            key, "phone", F.substring(digits, stays + 1, n - stays), inverse)))

    return _with(_digits(text), of)


def _ip(key: str, text: Column, inverse: bool) -> Column:
    octets = F.split(text, r"\.")
    valid = F.forall(octets, lambda o: (o.cast("int") <= 255) & (o.cast("int").cast("string") == o))
    half = lambda i: octets[i].cast("bigint") * 256 + octets[i + 1].cast("bigint")
    pair = _feistel(key, "ip", half(0), half(2), F.lit(65536), F.lit(65536), inverse)
    moved = _with(pair, lambda p: F.concat_ws(
        ".", *[x for side in ("a", "b") for x in (F.floor(p[side] / 256).cast("string"), (p[side] % 256).cast("string"))]))
    return F.when(valid, moved).otherwise(text)


def _ssn(key: str, text: Column, inverse: bool) -> Column:
    area, group, serial = (F.split(text, "-")[i].cast("int") for i in range(3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    rank = area - 1 - F.when(area > 666, 1).otherwise(0)
    pair = _feistel(key, "ssn", rank, (group - 1) * _SERIALS + serial - 1, F.lit(_SSN_AREAS), F.lit(_SSN_REST), inverse)
    moved = _with(pair, lambda p: F.concat_ws(
        "-", _pad(p["a"] + 1 + F.when(p["a"] >= 665, 1).otherwise(0), F.lit(3)),
        _pad(F.floor(p["b"] / _SERIALS) + 1, F.lit(2)), _pad(p["b"] % _SERIALS + 1, F.lit(4))))
    return F.when(valid, moved).otherwise(text)


def _date(key: str, text: Column, day: Column, form: str, inverse: bool) -> Column:
    def of(d):
        index = F.datediff(d, F.lit(_FIRST_DAY).cast("date"))
        pair = _feistel(key, "date", F.floor(index / _DAY_RADIX), index % _DAY_RADIX, F.lit(_DAYS // _DAY_RADIX),
                        F.lit(_DAY_RADIX), inverse)
        return F.when(index.between(0, _DAYS - 1), _with(pair, lambda p: F.date_format(F.date_add(
            F.lit(_FIRST_DAY).cast("date"), (p["a"] * _DAY_RADIX + p["b"]).cast("int")), form))).otherwise(text)

    return F.coalesce(_with(day, lambda d: F.when(d.isNotNull(), of(d))), text)


def _valid_iban(compact: Column) -> Column:
    return _mod97(F.concat(F.substring(compact, F.lit(5), F.length(compact)), F.substring(compact, 1, 4))) == 1


def _moved_iban(key: str, compact: Column, inverse: bool) -> Column:
    country, body = F.substring(compact, 1, 2), F.substring(compact, F.lit(5), F.length(compact))
    return _with(_permute_characters(key, "iban", body, 26, inverse), lambda b: F.concat(
        country, _pad(98 - _mod97(F.concat(b, country, F.lit("00"))), F.lit(2)), b))


def _iban(key: str, text: Column, inverse: bool) -> Column:
    """Solid or in groups; of a grouped one the last group may be the next word,
    and where neither is an IBAN a number behind the first group is one."""
    def grouped(part: Column) -> Column:
        return _with(F.replace(part, F.lit(" "), F.lit("")), lambda c: F.when(_valid_iban(c), F.regexp_replace(
            _moved_iban(key, c, inverse), "(.{4})(?=.)", "$1 ")))

    rest = F.substring(text, F.lit(6), F.length(text))
    number = F.when(rest.rlike(f"^(?:{KINDS['number']})$"), F.concat(F.substring(text, 1, 5), _number(key, rest, inverse)))
    shorter = F.regexp_replace(text, " [^ ]+$", "")
    cut = F.concat(grouped(shorter), F.substring(text, F.length(shorter) + 1, F.length(text)))
    return F.when(~text.contains(" "), F.when(_valid_iban(text), _moved_iban(key, text, inverse)).otherwise(text)
                  ).otherwise(F.coalesce(grouped(text), cut, number, text))


def _email(key: str, text: Column, inverse: bool) -> Column:
    name = F.substring_index(text, "@", 1)
    return F.concat(_permute_characters(key, "email", name, 26, inverse), F.substring(text, F.length(name) + 1, F.length(text)))


def pseudonym(text: Column, key: str, inverse: bool = False) -> Column:
    """The pseudonym of one candidate; itself if it fails its kind's validation."""
    day = lambda form: F.try_to_timestamp(text, F.lit(form)).cast("date")
    forms = {
        "secret": _permute_characters(key, "secret", text, 6, inverse),
        "iban": _iban(key, text, inverse),
        "email": _email(key, text, inverse),
        "ip": _ip(key, text, inverse),
        "iso_date": _date(key, text, day("yyyy-MM-dd"), "yyyy-MM-dd", inverse),
        "dot_date": _date(key, text, day("dd.MM.yyyy"), "dd.MM.yyyy", inverse),
        "slash_date": _date(key, text, day("MM/dd/yyyy"), "MM/dd/yyyy", inverse),
        "ssn": _ssn(key, text, inverse),
        "phone": _phone(key, text, inverse),
        "number": _number(key, text, inverse),
    }
    out = text
    for kind in reversed(KINDS):
        out = F.when(text.rlike(f"^(?:{KINDS[kind]})$"), forms[kind]).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None,
                 inverse: bool = False) -> DataFrame:
    """The documents with pseudonyms in ``text_col`` (``n_chars``, where
    present, follows); ``count_col`` adds the number of values that changed."""
    columns = docs.columns
    text = F.col(text_col)
    found = docs.withColumn("__found", F.when(
        text.rlike("[0-9@]") & text.rlike(CANDIDATE), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))))
    found = found.withColumn("__new", F.transform("__found", lambda m: pseudonym(m, key, inverse)))
    gaps = F.split(text, CANDIDATE, -1)
    rebuilt = F.array_join(F.flatten(F.zip_with(
        gaps, F.col("__new"), lambda gap, new: F.array(gap, F.coalesce(new, F.lit(""))))), "")
    changed = F.when(F.col("__found").isNotNull(), rebuilt).otherwise(text)
    new = {text_col: changed}
    if "n_chars" in columns and text_col != "n_chars":
        new["n_chars"] = F.when(F.col("__found").isNotNull(), F.length(changed).cast(docs.schema["n_chars"].dataType)
                                ).otherwise(F.col("n_chars"))
    out = [new[c].alias(c) if c in new else F.col(c) for c in columns]
    if count_col:
        out.append(F.coalesce(F.size(F.filter(F.zip_with("__found", "__new", lambda a, b: a != b), lambda x: x)),
                              F.lit(0)).cast("bigint").alias(count_col))
    return found.select(*out)


def reveal(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """Inverse of ``pseudonymise`` for the same key."""
    return pseudonymise(docs, key, text_col, inverse=True)
