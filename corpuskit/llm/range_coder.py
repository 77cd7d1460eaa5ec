"""An adaptive context-mixing range coder for token ids below 65,536.

Three distributions predict each id: order 0, order 1 (the ids after the id before) and order 2
(those after the two before). They are mixed by weights that follow how often a context of an
order brings a new id. The three likeliest ids of a mixture have shares of 64ths; any other id
has its share of what they leave, by order 0, where every id has one. Everything is integer
arithmetic (quotients that doubles hold exactly), so any machine decodes what another wrote.

Blocks are coded on their own, each with fresh statistics, a header and a crc32 of its ids.
A block is cut into runs of ``RUN`` ids that are coded in step, one numpy lane each, by a range
coder of its own. The statistics belong to the block: they are counted anew from all ids before
at the steps of ``ROUNDS``, and stand still between. So the encoder looks up many steps at once,
and the decoder has one look-up a step.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

MAGIC = b"CMX3"
HEADER = struct.Struct("<4sIII")  # magic, ids, crc32 of the ids (little-endian 32-bit), bytes that follow
RUN = 512
LANES = 8192
BLOCK_IDS = RUN * LANES
ROUNDS = (1, 2, 4, 8, 16, 32, 128)
STEPS = 16  # that the encoder looks up at once
ALL = 1 << 16  # ids
BITS0, BITS = 19, 6  # the shares of order 0, and of a mixture's ids, are of two to these
TOTAL = BITS0 + BITS
HASHED, SHIFT = 1 << 19, np.uint32(13)  # contexts of order 2, shared by hash
FINE = 20  # masses are of two to this while they are mixed
WORD, HIGH = 16, 32  # a range is at least two to HIGH before an id, and below two to HIGH + WORD
MASK16, MASK32 = 0xFFFF, (1 << HIGH) - 1


def _states() -> tuple[np.ndarray, np.ndarray]:
    """The number of each three shares that leave one at least, and the ends of the shares, a byte each, by the number."""
    number, k = np.zeros((64, 64, 64), np.int64), np.arange(64)
    held = np.argwhere(k[:, None, None] + k[:, None] + k < 64)
    number[tuple(held.T)] = np.arange(len(held))
    ends = np.cumsum(held, axis=1)
    return number.reshape(-1), ends[:, 0] | ends[:, 1] << 8 | ends[:, 2] << 16 | 64 << 24


STATE, ENDS = _states()


def _best(keys: np.ndarray) -> tuple:
    """Of contexts times 2**16 plus ids: the contexts, their three commonest ids and counts (3, contexts), how many ids and
    different ids each has, what a seen id leaves to the lower order (of 2**8; more where many ids came once), and the ids
    that are none of the three with their counts."""
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    n = np.diff(first, append=len(keys))
    once, twice = int((n == 1).sum()), int((n == 2).sum())
    off = min(max((once << 8) // (once + 2 * twice + 1), 4), 240)
    keys = keys[first].astype(np.int64)
    context = keys >> 16
    at = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
    total, size = np.add.reduceat(n, at), np.diff(at, append=len(keys))
    many = np.repeat(size > 1, size)  # contexts of one id are in order
    keys[many] = np.sort((context[many] << 32) | (MASK16 - np.minimum(n[many], MASK16)) << 16 | (keys[many] & MASK16))
    ids = keys & MASK16
    n[many] = MASK16 - (keys[many] >> 16 & MASK16)
    end = np.minimum(np.arange(3)[:, None], size - 1) + at
    count = n[end]
    count[1] *= size > 1
    count[2] *= size > 2
    place = np.arange(len(ids)) - np.repeat(at, size)
    other = place > 2
    return context[at], ids[end], count, total, size, off, ids[other], n[other]


def _masses(n: np.ndarray, total: np.ndarray, off: int) -> np.ndarray:
    """What ids that came ``n`` times in a context of ``total`` have of it."""
    return np.maximum(((n << 8) - off) * (1 << FINE) // (total << 8), 1) * (n > 0)


def _packed(ids: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """Three ids and the number of their shares as an integer; of ids without a mass, the first stands again."""
    have = mass > 0
    scale = 63 - have.sum(axis=0)
    share = ((mass * scale) >> FINE) + have
    out = STATE[(share[0] << 12) | (share[1] << 6) | share[2]] << 48
    return out | ids[0] | np.where(have[1], ids[1], ids[0]) << 16 | np.where(have[2], ids[2], ids[0]) << 32


def _slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The place of the context of the ids ``b``, ``a`` (uint32) among those of order 2."""
    mixed = a * np.uint32(0x9E3779B1)
    mixed += b * np.uint32(0x85EBCA6B)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0xC2B2AE35)
    mixed >>= SHIFT
    return mixed


class Model:
    """What the ids of a block's first steps say about the next: contexts' entries, and order 0."""

    def __init__(self, seen: np.ndarray):
        """Of ``seen``, steps by lanes, after two rows of zeros."""
        self.one, self.two = np.zeros(ALL, np.int64), np.zeros(HASHED, np.int64)
        counts = np.zeros(ALL, np.int64)
        if len(seen) > 2:
            b, a, c = seen[:-2].reshape(-1), seen[1:-1].reshape(-1), seen[2:].reshape(-1)
            own, ids, n, total, size, off, other, times = _best(a << np.uint32(16) | c)
            counts += np.bincount(other, times, ALL).astype(np.int64) * 4
            counts += np.bincount(ids[0], minlength=ALL)
            mass = _masses(n, total, off)
            self.one[own] = _packed(ids, mass)
            near, near_mass = np.zeros((3, ALL), np.int64), np.zeros((3, ALL), np.int64)
            near[:, own], near_mass[:, own] = ids, mass
            slot = _slot(a, b)
            owner = np.zeros(HASHED, np.uint32)
            owner[slot] = a
            own, ids, n, total, size, off, _, _ = _best(slot.astype(np.int64) << 16 | c)
            before = owner[own]
            low, low_mass = near[:, before], near_mass[:, before]
            mass = _masses(n, total, off)
            low_mass = low_mass * (off * size) // (total << 8)
            for i in range(3):  # what order 1 gives goes to the id's place, or to the first that is free
                left = low_mass[i].copy()
                for j in range(3):
                    same = (ids[j] == low[i]) & (mass[j] > 0)
                    mass[j] += left * same
                    left *= ~same
                for j in range(1, 3):
                    free = (mass[j] == 0) & (left > 0)
                    ids[j] = np.where(free, low[i], ids[j])
                    mass[j] += left * free
                    left *= ~free
            self.two[own] = _packed(ids, mass)
        each = (((1 << BITS0) - ALL) << 20) // max(int(counts.sum()), 1)
        self.upper = np.zeros(ALL + 1, np.int64)
        np.cumsum(((counts * each) >> 20) + 1, out=self.upper[1:])
        self.upper[-1] = 1 << BITS0
        self.at = None

    def entries(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The entries of the contexts of ``b``, ``a``: of order 2, or of order 1 where nothing came after both."""
        got = self.two.take(_slot(a, b))
        new = np.flatnonzero(got == 0)
        got[new] = self.one.take(a.take(new))
        return got

    def spans(self, a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and sizes of the ids."""
        entry = self.entries(a, b)
        hit = entry ^ ids * 0x100010001
        state = entry >> 48 & MASK16
        place = np.where((hit & MASK16) == 0, 0, np.where((hit & MASK16 << 16) == 0, 8, np.where((hit & MASK16 << 32) == 0, 16, 24)))
        place[state == 0] = 24
        ends = ENDS.take(state)
        start = (ends << 8 >> place) & 0xFF
        size = ((ends >> place) & 0xFF) - start
        start <<= BITS0
        other = np.flatnonzero(place == 24)
        named, factor = ids.take(other), size.take(other)
        below = self.upper.take(named)
        size <<= BITS0
        start[other] += below * factor
        size[other] = (self.upper.take(named + 1) - below) * factor
        return start, size

    def find(self, entry: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids whose spans hold the values, with their starts and sizes."""
        ends = ENDS.take(entry >> 48 & MASK16)
        over = (value >> BITS0) * 0x10101
        over += 0x808080
        over -= ends
        over &= 0x808080
        place = np.bitwise_count(over).astype(np.int64)
        place <<= 3
        size = ends >> place
        size &= 0xFF
        start = ends
        start <<= 8
        start >>= place
        start &= 0xFF
        size -= start
        start <<= BITS0
        other = np.flatnonzero(place == 24)
        place <<= 1
        ids = entry >> place
        ids &= MASK16
        if len(other):
            if self.at is None:
                self.at = np.repeat(np.arange(ALL, dtype=np.uint16), np.diff(self.upper))
            factor, begin = size.take(other), start.take(other)
            named = self.at.take((value.take(other) - begin) // factor).astype(np.int64)
            size <<= BITS0
            below = self.upper.take(named)
            ids[other], start[other] = named, begin + below * factor
            size[other] = (self.upper.take(named + 1) - below) * factor
        else:
            size <<= BITS0
        return ids, start, size


def _lanes(n: int) -> tuple[int, int]:
    """Lanes of a block of ``n`` ids, and ids of the last one; the others have ``RUN``."""
    lanes = -(-n // RUN)
    return lanes, n - (lanes - 1) * RUN


def _rounds(lanes: int, last: int) -> Iterator[tuple[int, int, int]]:
    """Steps from, to, and the lanes that have them; the last lane may end between ``ROUNDS``."""
    at, stop = 0, RUN if lanes > 1 else last
    while at < stop:
        to = min([r for r in ROUNDS if at < r < stop], default=stop)
        if at < last < to:
            to = last
        yield at, to, lanes if at < last else lanes - 1
        at = to


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Each array of ids as a block with header."""
    out = []
    for block in blocks:
        ids = np.ascontiguousarray(block, "<u4")
        payload = _encode(ids) if len(ids) else b""
        out.append(HEADER.pack(MAGIC, len(ids), zlib.crc32(ids.tobytes()), len(payload)) + payload)
    return out


def _encode(block: np.ndarray) -> bytes:
    lanes, last = _lanes(len(block))
    ids = np.zeros(lanes * RUN, np.uint32)
    ids[: len(block)] = block
    ids = np.concatenate([np.zeros((2, lanes), np.uint32), ids.reshape(lanes, RUN).T])
    low, size = np.zeros(lanes, np.int64), np.full(lanes, 1 << HIGH + WORD, np.int64)
    room = np.zeros((2 * RUN + 4) * lanes, np.uint32)  # two words an id at most; those of a lane stand in a column
    pos = np.arange(lanes)
    for at, to, k in _rounds(lanes, last):
        model = Model(ids[: at + 2, :k])
        for t in range(at, to, STEPS):
            b, a, c = (ids[t + i: min(t + STEPS, to) + i, :k].reshape(-1) for i in range(3))
            begin, width = model.spans(a, b, c.astype(np.int64))
            for start, each in zip(begin.reshape(-1, k), width.reshape(-1, k)):
                part = size[:k] >> TOTAL
                low[:k] += start * part
                np.multiply(each, part, out=size[:k])
                while len(go := np.flatnonzero(size[:k] < 1 << HIGH)):
                    value, where = low.take(go), pos.take(go)
                    room[where] = value >> HIGH  # with the carry for the word before
                    low[go] = (value & MASK32) << WORD
                    size[go] <<= WORD
                    pos[go] = where + lanes
    low += MASK16  # any number that begins with these two words is in the range, whatever follows
    for _ in range(2):
        room[pos] = low >> HIGH
        low = (low & MASK32) << WORD
        pos += lanes
    words = room.reshape(-1, lanes)[: int(pos.max()) // lanes]
    for i in range(len(words) - 1, 0, -1):
        words[i - 1] += words[i] >> WORD
    length = pos // lanes
    return length.astype("<u2").tobytes() + words.T.astype("<u2")[np.arange(len(words)) < length[:, None]].tobytes()


def decode(blocks: list[bytes]) -> list[np.ndarray]:
    """The ids of each block; a block that doesn't match its checksum is an error."""
    out = []
    for b in blocks:
        magic, n, crc, size = HEADER.unpack_from(b)
        ids = _decode(b[HEADER.size:], n) if magic == MAGIC and len(b) == HEADER.size + size else None
        if ids is None or zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes()) != crc:
            raise ValueError("a block of token ids is damaged")
        out.append(ids)
    return out


def _decode(payload: bytes, n: int) -> np.ndarray | None:
    """The ids; None where the lanes don't fill the payload."""
    if not n:
        return np.zeros(0, np.uint32)
    lanes, last = _lanes(n)
    if len(payload) < 2 * lanes or len(payload) % 2:
        return None
    length, words = np.frombuffer(payload, "<u2", lanes).astype(np.int64), np.frombuffer(payload, "<u2", offset=2 * lanes)
    if length.sum() != len(words):
        return None
    words = np.concatenate([words, np.zeros(2 * RUN + 4, "<u2")]).astype(np.int64)  # a damaged lane may read on
    pos = np.cumsum(length) - length
    end = np.int64(len(words) - 1)
    code, size = np.zeros(lanes, np.int64), np.full(lanes, 1 << HIGH + WORD, np.int64)
    for _ in range(3):
        code = (code << WORD) | words.take(np.minimum(pos, end))
        pos += 1
    ids = np.zeros((RUN + 2, lanes), np.uint32)
    for at, to, k in _rounds(lanes, last):
        model = Model(ids[: at + 2, :k])
        code, size, pos = code[:k], size[:k], pos[:k]
        for t in range(at, to):
            entry = model.entries(ids[t + 1, :k], ids[t, :k])
            part = size >> TOTAL
            value = (code / part).astype(np.int64)  # exact, as all are below 2**52
            np.minimum(value, (1 << TOTAL) - 1, out=value)
            got, start, size = model.find(entry, value)
            ids[t + 2, :k] = got
            start *= part
            code -= start
            size *= part
            np.minimum(code, size - 1, out=code)  # where the block is damaged
            move = (size < 1 << HIGH).astype(np.int64)
            word = words.take(pos)
            word *= move
            pos += move
            move <<= 4
            size <<= move
            code <<= move
            code |= word
            while len(go := np.flatnonzero(size < 1 << HIGH)):
                where = pos.take(go)
                code[go] = code.take(go) << WORD | words.take(np.minimum(where, end))
                size[go] <<= WORD
                pos[go] = where + 1
            np.minimum(pos, end, out=pos)
    return ids[2:].T.reshape(-1)[:n]
