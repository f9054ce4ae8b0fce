"""Token counts (operator 1): exact counts at every prefix by dynamic programming.

A byte-pair encoding has the prefix property: dropping the last token of an
encoding leaves the encoding of the shorter string.  So the encoding of a
prefix is fixed by its last token alone, and that token is the one vocabulary
entry that ends there and is compatible with the last token of what lies
before it (two tokens are compatible if their joined symbols encode to just
them).  One pass over a word gives the count at every prefix; a text's table is
the concatenation of its words' tables, because the pre-tokenizer never joins
characters across white space.  The table answers truncation and budget
questions without encoding again.

Positions are code points of the text as the tokenizer's normalizer leaves it
(NFC, one space for each white-space run, lower case, as far as the file asks
for them); ``prefix`` holds, per code point, the change of the count as a
little-endian int16.

Defined results: null text counts as empty (0 tokens, empty table); repeated
rows and ties give equal rows; an empty table gives an empty table; extra
columns are not carried.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from itertools import accumulate
from operator import sub

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ship_package

MEMO_PIECES = 1_000_000
MEMO_PAIRS = 500_000
_ODD_SPACE = re.compile(r"[\x1c-\x1f]")
_SPACES = re.compile(r"[^\S\x1c-\x1f]+")
_MARKS = r"!\"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~"
# what the pre-tokenizer makes of lower-case text over ASCII and Latin-1 letters,
# on which all Unicode versions agree; white space as one more kind of piece
_PLAIN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[{_MARKS}]+|[ \t\n\r]+")
_CONTRACTIONS = {"'s", "'t", "'re", "'ve", "'m", "'ll", "'d"}
#: Words share the states of their first characters.
STEM = 6
MEMO_STEMS = 100_000


def _changes(counts: list[int]) -> bytes:
    """Cumulative counts -> little-endian int16 changes (OverflowError should
    one character change the count by more than that)."""
    changes = array("h", map(sub, counts, [0, *counts]))
    if sys.byteorder == "big":
        changes.byteswap()
    return changes.tobytes()


class PrefixCounter:
    """Prefix counts under one word-level BPE tokenizer file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout"):
            raise ValueError(f"{path}: prefix counts need a plain BPE model")
        self.tokenizer = Tokenizer.from_file(path)
        suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        #: the same merges without the word-end mark, for the inside of words
        self.inner = BPE(vocab=model["vocab"], merges=merges)
        #: symbols of a token -> 1: it occurs inside words, 2: at their end
        self.kinds: dict[str, int] = {}
        for token in model["vocab"]:
            at_end = token.endswith(suffix)
            base = token[: len(token) - len(suffix)] if at_end else token
            if base:
                self.kinds[base] = self.kinds.get(base, 0) | (3 if not suffix else 2 if at_end else 1)
        self.longest = max(map(len, self.kinds))
        special = [re.escape(a["content"]) for a in spec.get("added_tokens", [])]
        self.special = re.compile("(" + "|".join(special) + ")") if special else None
        normal = spec.get("normalizer") or {}
        steps = [s["type"] for s in normal.get("normalizers", [normal])]
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        # the file drops white space and lower-cases: words can be taken one by one
        if "Lowercase" not in steps or split.get("type") != "Split" or split.get("behavior") != "Removed":
            raise ValueError(f"{path}: prefix counts need a lower-casing tokenizer that drops white space")
        self.memo: dict[str, bytes] = {}
        self.stems: dict[str, tuple] = {}
        self.pairs: dict[tuple[str, str, bool], bool] = {}

    def _alone(self, token: str, final: bool) -> bool:
        """Whether the token's own symbols encode to just the token."""
        tokens = (self.tokenizer.model if final else self.inner).tokenize(token)
        return len(tokens) == 1

    def _compatible(self, first: str, second: str, final: bool) -> bool:
        """Whether the joined symbols encode to just these two tokens."""
        tokens = (self.tokenizer.model if final else self.inner).tokenize(first + second)
        return len(tokens) == 2 and tokens[0].value == first

    def word_counts(self, word: str) -> list[int]:
        """Token count of every non-empty prefix of a mapped word, each prefix
        taken as a word of its own."""
        kinds, longest, pairs = self.kinds, self.longest, self.pairs
        if len(pairs) > MEMO_PAIRS:
            pairs.clear()
        # last token of the prefix inside a longer word, its count, and the count as a word
        stem = self.stems.get(word[:STEM]) if len(word) > STEM else None
        last: list[str | None] = [""]
        count, ends = [0], []
        if stem is not None:
            last, count, ends = stem[0][:], stem[1][:], stem[2][:]
        for i in range(len(ends) + 1, len(word) + 1):
            inner, inner_count, final = None, 0, None
            for j in range(i - 1, i - longest - 1 if i > longest else -1, -1):
                token = word[j:i]
                kind = kinds.get(token)
                before = last[j]
                if kind is None or before is None:
                    continue
                if inner is None and kind & 1:
                    key = (before, token, False)
                    fits = pairs.get(key)
                    if fits is None:
                        fits = pairs[key] = self._compatible(*key) if j else self._alone(token, False)
                    if fits:
                        inner, inner_count = token, count[j] + 1
                if final is None and kind & 2:
                    key = (before, token, True)
                    fits = pairs.get(key)
                    if fits is None:
                        fits = pairs[key] = self._compatible(*key) if j else self._alone(token, True)
                    if fits:
                        final = count[j] + 1
                if inner is not None and final is not None:
                    break
            if final is None:
                raise ValueError(f"no encoding found for {word[:i]!r}")
            last.append(inner)
            count.append(inner_count)
            ends.append(final)
            if i == STEM and len(word) > STEM:
                if len(self.stems) > MEMO_STEMS:
                    self.stems.clear()
                self.stems[word[:STEM]] = (last[:], count[:], ends[:])
        if ends[-1] != len(self.tokenizer.model.tokenize(word)):
            raise ValueError(f"prefix count of {word!r} differs from the library")
        return ends

    def _ordinary(self, piece: str) -> list[int]:
        """Cumulative counts per code point of a normalised piece without
        special strings and without white space inside."""
        out: list[int] = []
        total = 0
        words = [piece[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(piece)]
        at = 0
        for word in words:
            gap = piece.index(word, at) - at
            out += [total] * gap  # characters that the pre-tokenizer drops
            at += gap + len(word)
            counts = self._counts(word)
            out += [total + c for c in counts]
            total += counts[-1]
        return out + [total] * (len(piece) - at)

    def _counts(self, word: str) -> list[int]:
        """Cumulative counts per code point of one pre-tokenized word."""
        pre = self.tokenizer.pre_tokenizer.pre_tokenize_str
        if word in _CONTRACTIONS:  # shorter prefixes split otherwise
            return [sum(self.word_counts(m)[-1] for m, _ in pre(word[:n])) for n in range(1, len(word) + 1)]
        if word.isascii() and word.isprintable():
            return self.word_counts(word)
        ends = self.word_counts("".join(m for m, _ in pre(word)))
        # a code point of several bytes counts where its last byte ends
        return [ends[n - 1] for n in accumulate(len(c.encode()) for c in word)]

    def _normal(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        return self.tokenizer.normalizer.normalize_str(text)

    def piece(self, piece: str) -> bytes:
        """Prefix table (int16 changes) of a raw piece."""
        table: list[int] = []
        total = 0
        parts = self.special.split(piece) if self.special else [piece]
        for n in range(0, len(parts), 2):
            segment = self._normal(parts[n])
            token = parts[n + 1] if n + 1 < len(parts) else ""
            # inside a special string a prefix is ordinary text; at its end one token
            counts = self._ordinary(segment + token[:-1]) if segment or token else []
            table += [total + c for c in counts]
            if token:
                total += (counts[len(segment) - 1] if segment else 0) + 1
                table.append(total)
            elif counts:
                total += counts[-1]
        return _changes(table)

    def table(self, text: str) -> bytes:
        """Prefix table of a whole text."""
        if not text:
            return b""
        memo = self.memo
        if not (self.special and self.special.search(text)):
            low = text.lower()
            words = _PLAIN.findall(low)
            if sum(map(len, words)) == len(low):
                missing = set(words).difference(memo)
                if missing:
                    if len(memo) + len(missing) > MEMO_PIECES:
                        memo.clear()
                        missing = set(words)
                    for w in missing:
                        memo[w] = b"\0\0" if w.isspace() else _changes(self._counts(w))
                return b"".join(map(memo.__getitem__, words))
        # other scripts and special strings: between white space, by the library's own steps
        pieces = [p for p in _SPACES.split(text) if p] if _ODD_SPACE.search(text) else text.split()
        if not pieces:
            return b"\0\0"
        body = b"\0\0".join(map(self.piece, pieces))
        return b"\0\0" * bool(_SPACES.match(text)) + body + b"\0\0" * bool(_SPACES.match(text[-1]))


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def _count_task(path: str):
    def run(batches):
        table_of = counter(path).table
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                tables = [table_of(t) for t in part.column("text").to_pylist()]
                totals = [int(np.frombuffer(t, "<i2").sum(dtype=np.int64)) for t in tables]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_bytes"), pa.array(totals, pa.int64()),
                     pa.array(tables, pa.binary())],
                    names=["doc_id", "n_bytes", "n_tokens", "prefix"])

    return run


def prefix_token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id, n_bytes`` (UTF-8), ``n_tokens`` and the ``prefix`` table."""
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("bigint").alias("n_bytes"),
                       text.alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_count_task(tokenizer_path), f"doc_id {id_type}, n_bytes bigint, n_tokens bigint, prefix binary")


def tokens_at(prefix: bytes, position: int) -> int:
    """Tokens of the first ``position`` code points."""
    return int(np.frombuffer(prefix, "<i2")[:position].sum(dtype=np.int64))


def longest_prefix(prefix: bytes, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    fits = np.flatnonzero(np.cumsum(np.frombuffer(prefix, "<i2"), dtype=np.int64) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def normalized(text: str, tokenizer_path: str) -> str:
    """The text whose code points the table's positions count."""
    c = counter(tokenizer_path)
    parts = c.special.split(text) if c.special else [text]
    return "".join(p if n % 2 else (c.tokenizer.normalizer.normalize_str(p) if p else "") for n, p in enumerate(parts))


def with_budgets(counted: DataFrame, budgets: list[int]) -> DataFrame:
    """Adds ``fits_<budget>``: code points of the longest prefix within it."""
    import pandas as pd

    out = counted
    for budget in budgets:
        fit = F.pandas_udf(lambda s, n=budget: pd.Series([longest_prefix(p, n) for p in s]), "bigint")
        out = out.withColumn(f"fits_{budget}", fit("prefix"))
    return out
