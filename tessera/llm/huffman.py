"""Canonical length-limited Huffman codes over token ids, in numpy."""

from __future__ import annotations

import numpy as np

U = np.uint64
ENCODE_TOKENS = 1 << 18


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code length per symbol (0: does not occur) of at most ``limit``
    bits, by package-merge."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) == 0:
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols do not fit codes of {limit} bits")
    if len(used) == 1:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    levels, packages = [], np.empty(0)
    for _ in range(limit):
        items = np.concatenate([leaves, packages])
        rank = np.argsort(items, kind="stable")
        levels.append(rank < len(leaves))
        items = items[rank]
        even = len(items) // 2 * 2
        packages = items[0:even:2] + items[1:even:2]
    taken, wanted = np.zeros(len(order), np.uint8), 2 * len(order) - 2
    for is_leaf in reversed(levels):
        n = int(is_leaf[:wanted].sum())
        taken[:n] += 1
        wanted = 2 * (wanted - n)
    lengths[order] = taken
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, symbol), each one more than the last."""
    codes = np.zeros(len(lengths), U)
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    code, last = 0, 0
    for symbol in order.tolist():
        length = int(lengths[symbol])
        code <<= length - last
        codes[symbol] = code
        code, last = code + 1, length
    return codes


class Decoder:
    """Table-driven decoding of independent blocks, all blocks in step."""

    def __init__(self, lengths: np.ndarray):
        self.limit = max(int(lengths.max(initial=0)), 1)
        codes, used = canonical_codes(lengths), np.flatnonzero(lengths)
        self.symbol = np.zeros(1 << self.limit, np.uint32)
        self.length = np.ones(1 << self.limit, np.int64)
        order = used[np.argsort(lengths[used], kind="stable")]
        spans = (1 << (self.limit - lengths[order].astype(np.int64)))
        starts = (codes[order] << (self.limit - lengths[order].astype(np.int64)).astype(U)).astype(np.int64)
        at = np.repeat(starts, spans) + np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans)
        self.symbol[at] = np.repeat(order, spans)
        self.length[at] = np.repeat(lengths[order], spans)

    def blocks(self, payload: bytes, starts: np.ndarray, n_tokens: int, block: int) -> np.ndarray:
        """All tokens of a payload whose blocks start at these bit offsets."""
        if n_tokens == 0:
            return np.empty(0, np.uint32)
        raw = np.frombuffer(payload, np.uint8).astype(np.uint32)
        window = (raw << 24)
        for shift, bits in ((1, 16), (2, 8), (3, 0)):
            window[:-shift] |= raw[shift:] << np.uint32(bits)
        out = np.empty((len(starts), block), np.uint32)
        at = starts.astype(np.int64)
        tail = n_tokens - block * (len(starts) - 1)
        mask = np.uint32((1 << self.limit) - 1)
        for step in range(block):
            if step == tail:  # the last block is shorter
                at = at[:-1]
                if not len(at):
                    break
            shift = (32 - self.limit - (at & 7)).astype(np.uint32)
            key = (window[at >> 3] >> shift) & mask
            out[: len(at), step] = self.symbol[key]
            at = at + self.length[key]
        return out.reshape(-1)[: n_tokens]


def encode_blocks(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray, block: int) -> tuple[bytes, np.ndarray]:
    """The payload of the ids and the bit offset at which each block starts."""
    parts, starts, base = [], [], 0
    step = max(ENCODE_TOKENS // block, 1) * block
    for i in range(0, len(ids), step):
        part = ids[i: i + step]
        size = lengths[part].astype(np.int64)
        end = np.cumsum(size)
        at = end - size
        starts.append(base + at[::block])
        value = codes[part] << (64 - size - (at & 31)).astype(U)
        word = at >> 5
        first = np.flatnonzero(np.diff(word, prepend=-1))
        slots = np.zeros(int(end[-1] >> 5) + 2, U)
        slots[word[first]] += np.add.reduceat(value >> U(32), first)
        slots[word[first] + 1] += np.add.reduceat(value & U(0xFFFFFFFF), first)
        n = int(end[-1] + 31) >> 5
        parts.append(slots[:n].astype(">u4").tobytes())
        base += n * 32
    return b"".join(parts), np.concatenate(starts) if starts else np.empty(0, np.int64)
