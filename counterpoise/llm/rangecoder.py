"""Context-mixing range coder for token ids, many blocks in lockstep.

A block is at most ``BLOCK`` ids and is coded on its own: its models start empty.
For every id three models speak:

* order 2: the id that last followed the two ids before, if any;
* order 1: the id that last followed the id before;
* order 0: the block's own id counts (in its header).

Their mix is ``w2 [x = p2] + w1 [x = p1] + w0 count(x) / n``.  The weights adapt: each
predicted id carries a confidence (0 to 2 hits in a row), and every confidence has an
adaptive hit probability.  One range coder step of 16-bit precision codes an id.

The coder works on numpy vectors over blocks ("lanes"), all with 64-bit integers and
exact quotients, so files do not depend on the machine.  Low and range are 48 bits, output is 16-bit words;
carries are settled in the finished word lists.

Block: ``<4s`` magic, ``<I`` ids, ``<I`` distinct ids, ``<I`` bytes of the header, ``<I``
words, ``<I`` crc32 of what follows; then the header (distinct ids as varint gaps with
their counts) and the words.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

from counterpoise.llm.common import ship

ship(__name__)

BLOCK = 2048
MAGIC = b"TKB1"
_HEAD, _HEAD_SIZE = "<4sIIIII", 24
_TOTAL = 1 << 16
_CTX2, _CTX1 = 1 << 11, 1 << 10  # entries of a lane's prediction tables
_MAX_MIX = _TOTAL - _TOTAL // 8  # order 0 keeps an eighth: each of up to BLOCK ids has a place
_START = np.array([0, 3000, 26000, 50000], np.int64)  # hit probability by confidence, of 65536
_RATE = 4


class CorruptBlock(ValueError):
    pass


def _varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unsigned LEB128 of values below 2**28, and the place after each value."""
    v = values.astype(np.uint32)
    n = 1 + (v >= 1 << 7) + (v >= 1 << 14) + (v >= 1 << 21)
    ends = np.cumsum(n)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(4):
        on = np.flatnonzero(n > k)
        out[ends[on] - n[on] + k] = ((v[on] >> (7 * k)) & 127) | np.where(n[on] > k + 1, 128, 0)
    return out, ends


def _read_varints(data: np.ndarray, count: int) -> np.ndarray:
    ends = np.flatnonzero(data < 128)
    if len(ends) != count:
        raise CorruptBlock("short header")
    begins = np.concatenate([[0], ends[:-1] + 1]) if count else ends
    out = np.zeros(count, np.int64)
    for k in range(4):
        on = np.flatnonzero(begins + k <= ends)
        out[on] |= (data[begins[on] + k].astype(np.int64) & 127) << (7 * k)
    return out


class _Mix:
    """The order-1 and order-2 models of all lanes; the same steps for coding and decoding.

    An entry is ``predicted id + 1 << 2 | confidence``; confidence 0 is an entry never
    seen, whose hit probability stays 0.
    """

    def __init__(self, lanes: int):
        size = _CTX2 + _CTX1
        self.table = np.zeros(lanes * size, np.int32)
        self.hits = np.tile(_START, 2 * lanes)
        lane = np.arange(lanes, dtype=np.int64)
        self.base = np.stack([lane * size, lane * size + _CTX2])
        self.slot = np.stack([lane * 8, lane * 8 + 4])

    def predict(self, a: np.ndarray, b: np.ndarray):
        """Order-2 and order-1 predictions after ids ``a`` (before last) and ``b`` (last), and their parts of 65536."""
        k = len(a)
        at = np.empty((2, k), np.int64)
        h = b * 30011
        at[1] = (h >> 4) & (_CTX1 - 1)
        h ^= a * 40503
        at[0] = ((h >> 13) ^ h) & (_CTX2 - 1)
        at += self.base[:, :k]
        self.at, self.entry = at, self.table.take(at, mode="clip")
        self.where = self.slot[:, :k] + (self.entry & 3)
        self.q = self.hits.take(self.where, mode="clip")
        self.said = p = (self.entry >> 2) - 1
        f2 = self.q[0] * _MAX_MIX >> 16
        f1 = (self.q[1] * (_MAX_MIX - f2) >> 16) * (p[1] != p[0])
        return p, f2, f1

    def update(self, x: np.ndarray, hit: np.ndarray) -> None:
        """After id ``x``; ``hit`` tells where the predictions were right."""
        e = self.entry
        fresh = (x << 2) + 5
        np.put(self.table, self.at, fresh + hit * (np.minimum(e + 1, e | 3) - fresh), mode="clip")
        self.hits[self.where] = self.q + ((hit * 65535 - self.q) >> _RATE)


def _floor_div(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact for non-negative a < 2**49 with quotients below 2**17: the rounded quotient cannot reach the next integer."""
    return (a / b).astype(np.int64)


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Every block's bytes; a block is a non-empty array of at most ``BLOCK`` ids below 65536 (others raise)."""
    if any(len(b) and (int(np.max(b)) > 0xFFFF or int(np.min(b)) < 0) for b in blocks):
        raise ValueError("ids above 65535 do not fit this format")
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    n = np.array([len(blocks[i]) for i in order], np.int64)
    lanes, longest = len(n), int(n[0]) if len(n) else 0
    syms, lows, counts = (np.zeros((longest, lanes), np.int32) for _ in range(3))
    low_of, count_of = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)
    pairs, distinct = [], np.zeros(lanes, np.int64)
    for j, i in enumerate(order):
        block = blocks[i].astype(np.uint16)
        inorder = np.sort(block, kind="stable")  # 16 bits: radix sort
        cum = np.flatnonzero(np.concatenate([[True], inorder[1:] != inorder[:-1]]))
        ids, count = inorder[cum], np.diff(np.append(cum, len(block)))
        low_of[ids], count_of[ids] = cum, count
        k = len(block)
        syms[:k, j], lows[:k, j], counts[:k, j] = block, low_of[block], count_of[block]
        distinct[j] = len(ids)
        pairs.append(np.column_stack([np.diff(ids.astype(np.int64), prepend=0), count]).ravel())
    header, ends = _varints(np.concatenate(pairs) if pairs else np.zeros(0, np.int64))
    head_at = np.concatenate([[0], ends[2 * np.cumsum(distinct) - 1]]) if lanes else np.zeros(1, np.int64)
    mix = _Mix(lanes)
    low, rng = np.zeros(lanes, np.int64), np.full(lanes, 1 << 48, np.int64)
    words = np.zeros((longest + 4, lanes), np.uint32)
    used = np.zeros(lanes, np.int64)
    a, b = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    active = np.searchsorted(-n, -np.arange(longest), side="left")  # lanes with more than t ids
    for t in range(longest):
        k = int(active[t])
        x = syms[t, :k].astype(np.int64)
        first = lows[t, :k].astype(np.int64)
        said, f2, f1 = mix.predict(a[:k], b[:k])
        rest = _TOTAL - f2 - f1
        hit = said == x
        is2, is1 = hit[0] & (f2 > 0), hit[1] & (f1 > 0)
        zero = _floor_div(first * rest, n[:k])
        start = np.where(is2, 0, np.where(is1, f2, f2 + f1 + zero))
        size = np.where(is2, f2, np.where(is1, f1, _floor_div((first + counts[t, :k]) * rest, n[:k]) - zero))
        r = rng[:k] >> 16
        low[:k] += r * start
        r *= size
        move = np.flatnonzero(r < 1 << 32)
        words[used[move], move] = low[move] >> 32
        used[move] += 1
        low[move] = (low[move] & 0xFFFFFFFF) << 16
        r[move] <<= 16
        rng[:k] = r
        mix.update(x, hit)
        a[:k], b[:k] = b[:k], x
    for shift in (32, 16, 0):  # flush the 48 bits of low, the carry with the first word
        words[used, np.arange(lanes)] = (low >> shift) & (0x1FFFF if shift == 32 else 0xFFFF)
        used += 1
    out: list[bytes] = [b""] * lanes
    for j, i in enumerate(order):
        w = words[: used[j], j].copy()
        while (over := np.flatnonzero(w >> 16)).size:
            w[over] &= 0xFFFF
            w[over[over > 0] - 1] += 1
        body = header[head_at[j] : head_at[j + 1]].tobytes() + w.astype("<u2").tobytes()
        out[i] = struct.pack(_HEAD, MAGIC, int(n[j]), int(distinct[j]), int(head_at[j + 1] - head_at[j]), len(w), zlib.crc32(body)) + body
    return out


def split_blocks(data: bytes) -> list[tuple[int, int, bytes, bytes]]:
    """(ids, distinct, header, words) of every block of a payload, checksums verified."""
    out, at = [], 0
    while at < len(data):
        if len(data) - at < _HEAD_SIZE:
            raise CorruptBlock("short block")
        magic, n, distinct, head, words, crc = struct.unpack_from(_HEAD, data, at)
        at += _HEAD_SIZE
        if magic != MAGIC or not 0 < n <= BLOCK or distinct > n or head > 8 * distinct or not 3 <= words <= BLOCK + 8:
            raise CorruptBlock("not a block")
        body = data[at : at + head + 2 * words]
        if len(body) < head + 2 * words or zlib.crc32(body) != crc:
            raise CorruptBlock("checksum differs")
        out.append((n, distinct, body[:head], body[head:]))
        at += len(body)
    return out


def decode_blocks(payload: bytes) -> list[np.ndarray]:
    """The ids of every block of a payload (blocks one after another)."""
    parts = split_blocks(payload)
    order = sorted(range(len(parts)), key=lambda i: -parts[i][0])
    n = np.array([parts[i][0] for i in order], np.int64)
    lanes, longest = len(n), int(n[0]) if len(n) else 0
    # The block's ids in order: slot -> id, first slot of the id, its count (28, 14 and 14 bits).
    slots = np.zeros((lanes, longest), np.int64)
    words = np.zeros((longest + 8, lanes), np.int64)
    pairs = _read_varints(np.frombuffer(b"".join(parts[i][2] for i in order), np.uint8), 2 * sum(p[1] for p in parts))
    at = 0
    for j, i in enumerate(order):
        k, distinct, _, body = parts[i]
        ids, count = np.cumsum(pairs[at : at + 2 * distinct : 2]), pairs[at + 1 : at + 2 * distinct : 2]
        at += 2 * distinct
        ends = np.cumsum(count)
        if not len(ends) or ends[-1] != k:
            raise CorruptBlock("counts differ")
        slots[j, :k] = np.repeat((ids << 28) + ((ends - count) << 14) + count, count)
        words[: len(body) // 2, j] = np.frombuffer(body, "<u2")
    mix = _Mix(lanes)
    value = (words[0] << 32) + (words[1] << 16) + words[2]
    rng, used = np.full(lanes, 1 << 48, np.int64), np.full(lanes, 3, np.int64)
    a, b = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    lane = np.arange(lanes)
    out = np.zeros((longest, lanes), np.uint32)
    row = lane * longest
    slots = slots.ravel()
    active = np.searchsorted(-n, -np.arange(longest), side="left")
    for t in range(longest):
        k = int(active[t])
        nk = n[:k]
        said, f2, f1 = mix.predict(a[:k], b[:k])
        f21 = f2 + f1
        rest = _TOTAL - f21
        r = rng[:k] >> 16
        s = np.minimum(_floor_div(value[:k], r), _TOTAL - 1)
        slot = np.minimum(_floor_div((np.maximum(s - f21, 0) + 1) * nk - 1, rest), nk - 1) + row[:k]
        entry = slots.take(slot, mode="clip")
        first = (entry >> 14) & 16383
        zero = _floor_div(first * rest, nk)
        in2, in1 = s < f2, s < f21
        x = np.where(in2, said[0], np.where(in1, said[1], entry >> 28))
        start = np.where(in2, 0, np.where(in1, f2, f21 + zero))
        size = np.where(in2, f2, np.where(in1, f1, _floor_div((first + (entry & 16383)) * rest, nk) - zero))
        value[:k] -= r * start
        r *= size
        move = np.flatnonzero(r < 1 << 32)
        value[move] = (value[move] << 16) + words[used[move], move]
        used[move] += 1
        r[move] <<= 16
        rng[:k] = r
        mix.update(x, said == x)
        out[t, :k] = x
        a[:k], b[:k] = b[:k], x
    done: list[np.ndarray] = [np.zeros(0, np.uint32)] * lanes
    for j, i in enumerate(order):
        done[i] = out[: n[j], j].copy()
    return done
