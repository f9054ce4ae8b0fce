"""Token ids of whole texts by the ``tokenizers`` library, with a piece memo.

A byte-level BPE never merges across a boundary between a non-space character
and a following space or line feed, so a text falls into pieces, each with its
one leading white-space character, whose ids simply follow each other.  Nor does
it between an ASCII letter or digit and ASCII punctuation behind it, so a word
and its full stop are two pieces.  Pieces are found, hashed (128 bits) and looked up for a whole slice of texts at once in
numpy, and their ids are gathered from one array; only pieces that are new to
the worker go to the library, one by one.  The memo is bounded: when it is full,
the pieces that were seen longest ago go.  Texts with a piece that begins with
more white space, where the cut is not safe, or with a special token go to the
library whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tessera.llm.words import Texts, U, span_hashes, text_slices

#: Pieces that a worker's memo holds.
MEMO_PIECES = 1_500_000
#: Longest piece (bytes) that is hashed and kept.
_MAX_PIECE = 48
#: Bytes of texts that are looked up at once.
SLICE_BYTES = 4 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x0A]] = True
_ALPHANUMERIC, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_ALPHANUMERIC[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_MARK[[b for b in range(33, 127) if not _ALPHANUMERIC[b]]] = True
_OTHER = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64)  # for the second hash
# letters on which all Unicode versions agree, or digits, after one optional white
# space, then at most one run of other printable ASCII (no apostrophe: contractions)
_SIMPLE = re.compile(r"([ \n]?)([A-Za-zÀ-ÖØ-öø-ÿ]*|[0-9]*)([!\"#$%&()*+,\-./:;<=>?@\[\]^_`{|}~]*)", re.A)


def _byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others for U+0100 onwards."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Memo:
    """Hash -> ids of pieces, as sorted arrays.  Entry e has the ids
    ``ids[first[e]:first[e] + size[e]]``; size -1 marks an unsafe cut."""

    def __init__(self):
        self.keys, self.checks = np.empty(0, U), np.empty(0, U)
        self.first, self.size, self.seen = (np.empty(0, np.int64) for _ in range(3))
        self.ids = np.empty(0, np.uint32)
        self.slice = 0

    def find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Entries of ascending ``keys``, -1 where there is none."""
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        if not len(self.keys):
            return np.full(len(keys), -1)
        return np.where((self.keys[at] == keys) & (self.checks[at] == checks), at, -1)

    def add(self, keys: np.ndarray, checks: np.ndarray, values: list) -> None:
        """Take in new pieces (ascending keys); a key that is there already stays."""
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool) if not len(self.keys) else self.keys[np.minimum(at, len(self.keys) - 1)] != keys
        values = [v for v, n in zip(values, new) if n]
        sizes = np.array([-1 if v is None else len(v) for v in values], np.int64)
        starts = len(self.ids) + np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
        at = at[new]
        self.keys, self.checks = np.insert(self.keys, at, keys[new]), np.insert(self.checks, at, checks[new])
        self.first, self.size = np.insert(self.first, at, starts), np.insert(self.size, at, sizes)
        self.seen = np.insert(self.seen, at, self.slice)
        self.ids = np.concatenate([self.ids, *[np.array(v, np.uint32) for v in values if v]])
        if len(self.keys) > MEMO_PIECES:
            self._forget(MEMO_PIECES // 2)

    def _forget(self, keep: int) -> None:
        at = np.sort(np.argsort(-self.seen, kind="stable")[:keep])
        size = np.maximum(self.size[at], 0)
        self.ids = self.ids[_ranges(self.first[at], size)]
        self.keys, self.checks, self.size, self.seen = self.keys[at], self.checks[at], self.size[at], self.seen[at]
        self.first = np.cumsum(size) - size


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of the ranges ``[first, first + size)``, one after another."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)


class Encoder:
    """Ids of texts by one tokenizer file, with this worker's memo."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        self.pieces = (
            spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
            and not pre.get("add_prefix_space") and model["type"] == "BPE" and not model.get("dropout")
            and all(not a["normalized"] and not a["lstrip"] and not a["rstrip"] and not a["single_word"]
                    and not re.search(r"\s", a["content"]) for a in spec.get("added_tokens", []))
        )
        self.special = [a["content"].encode() for a in spec.get("added_tokens", [])]
        self.alphabet = _byte_alphabet()
        self.tokenize = self.tokenizer.model.tokenize if model["type"] == "BPE" else None
        self.memo = _Memo()

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)] if texts else []

    def _word(self, mapped: str) -> list[int]:
        return [t.id for t in self.tokenize(mapped)]

    def _simple(self, piece: str) -> list[int] | None:
        m = _SIMPLE.fullmatch(piece)
        if m is None:
            return None
        space, letters, rest = m.groups()
        if space == "\n":
            parts = ["\n", letters, rest]
        elif letters:
            parts = [space + letters, rest]
        else:
            parts = [space + rest]
        ids: list[int] = []
        for part in parts:
            if part:
                if part.isascii():
                    mapped = part.replace(" ", "\u0120").replace("\n", "\u010a")
                else:
                    mapped = part.encode().decode("latin-1").translate(self.alphabet)
                ids += self._word(mapped)
        return ids

    def piece_ids(self, piece: str) -> list[int] | None:
        """Ids of one piece; None where the cut in front of it is unsafe."""
        if piece in (" ", "\n") or piece[1:2].isspace():
            return None
        if piece[0] == " " and piece[1:].isalpha() and piece.isascii():  # most pieces
            return self._word("\u0120" + piece[1:])
        ids = self._simple(piece)
        return self._library([piece])[0] if ids is None else ids

    def _entries(self, texts: Texts, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Memo entry of every (short) piece; new pieces are taken in."""
        keys = span_hashes(texts.buf, starts, ends)
        checks = span_hashes(_OTHER[texts.buf], starts, ends)
        distinct, where, inverse = np.unique(keys, return_index=True, return_inverse=True)
        memo = self.memo
        memo.slice += 1
        found = memo.find(distinct, checks[where])
        new = np.flatnonzero(found < 0)
        if len(new):
            raw, at = texts.buf.tobytes(), where[new]
            values = [self.piece_ids(raw[a:b].decode()) for a, b in zip(starts[at].tolist(), ends[at].tolist())]
            memo.add(distinct[new], checks[at], values)
            found = memo.find(distinct, checks[where])
        memo.seen[found[found >= 0]] = memo.slice
        entry = found[inverse]
        entry[memo.checks[entry] != checks] = -1  # two pieces of one hash: not to be looked up
        return entry

    def _with_special(self, texts: Texts) -> np.ndarray:
        """Texts that hold a special token's string."""
        raw, found = texts.buf.tobytes(), []
        for content in self.special:
            at = raw.find(content)
            while at >= 0:
                found.append(at)
                at = raw.find(content, at + 1)
        return texts.row_of(np.array(sorted(found), np.int64))

    def slice_ids(self, texts: Texts) -> list[np.ndarray]:
        """Ids of every text of a slice, as uint32 arrays."""
        n = len(texts)
        bounds = texts.offsets
        if not self.pieces:
            raw = texts.buf.tobytes()
            return [np.array(x, np.uint32) for x in
                    self._library([raw[bounds[r]: bounds[r + 1]].decode() for r in range(n)])]
        begins = _SPACE[texts.buf]
        begins[1:] |= _ALPHANUMERIC[texts.buf[:-1]] & _MARK[texts.buf[1:]]
        begins[bounds[:-1][bounds[:-1] < len(texts.buf)]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(texts.buf))
        short = ends - starts <= _MAX_PIECE
        first, size = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        known = self._entries(texts, starts[short], ends[short]) if short.any() else np.empty(0, np.int64)
        memo, others = self.memo, {}
        first[short], size[short] = memo.first[known], np.where(known < 0, -2, memo.size[known])
        base, more = len(memo.ids), []
        for i in np.flatnonzero(~short | (size == -2)).tolist():  # each by its own bytes
            piece = texts.buf[starts[i]: ends[i]].tobytes()
            if piece not in others:
                ids = self.piece_ids(piece.decode())
                others[piece] = (base, -1) if ids is None else (base, len(ids))
                more += ids or []
                base += len(ids or [])
            first[i], size[i] = others[piece]
        ids = np.concatenate([memo.ids, np.array(more, np.uint32)]) if more else memo.ids
        row = texts.row_of(starts)
        unsafe = np.unique(np.concatenate([row[size < 0], self._with_special(texts)]))
        size = np.maximum(size, 0)
        flat = ids[_ranges(first, size)]
        total = np.concatenate([[0], np.cumsum(size)])
        cuts = total[np.searchsorted(row, np.arange(n + 1))]
        out = [flat[cuts[r]: cuts[r + 1]] for r in range(n)]
        if len(unsafe):
            raw = [texts.buf[bounds[r]: bounds[r + 1]].tobytes().decode() for r in unsafe]
            for r, found in zip(unsafe.tolist(), self._library(raw)):
                out[r] = np.array(found, np.uint32)
        return out

    def column_ids(self, column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
        """(first row, ids of each text) for slices of a string column (null: empty)."""
        for texts in text_slices(column, SLICE_BYTES):
            yield texts.first, self.slice_ids(texts)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian uint32 bytes."""
        return [x.astype("<u4").tobytes() for _, ids in self.column_ids(pa.array(texts, pa.string())) for x in ids]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
