"""Adaptive context-mixing range coder for token ids, many blocks at a time.

A stream is cut into blocks of BLOCK ids, which advance together, one id each, in NumPy vectors. The
model mixes three predictions into one distribution: the id that last followed the two ids before
(order 2), the one that last followed the id before (order 1), and the stream's id frequencies
(order 0), which its header carries. All blocks of a stream share the context tables and weights,
so each learns from all; a step reads what the steps before left. The weights go by how often the
two contexts were right before and whether they agree, and are counted anew every LEARN steps.
A 48-bit range coder with carries gives each block its 16-bit words.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

BLOCK = 512
#: Bits of the slots of the order-2 and the order-1 table, of the weights' and of the frequencies' totals.
SLOTS2, SLOTS1, WEIGHT_BITS, TABLE_BITS = 17, 16, 8, 20
TOTAL_BITS = WEIGHT_BITS + TABLE_BITS
TOP, LOW32 = 1 << 32, (1 << 32) - 1
#: Steps after which the weights are learned anew, and the part (a power of two) of the older counts that then goes.
LEARN, FADE = 16, 5
#: Ids that the model goes ahead of the coder, or LEARN steps of all blocks.
AHEAD = 1 << 16


class Frequencies:
    """Order 0: quantised frequencies with the sum 2**TABLE_BITS, each present id with one at least."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.int32)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.int32)

    @classmethod
    def of(cls, ids: np.ndarray) -> Frequencies:
        counts = np.bincount(ids)
        total = 1 << TABLE_BITS
        present = counts > 0
        freq = np.where(present, np.maximum(1, counts * (total - present.sum()) // counts.sum()), 0)
        freq[np.argmax(counts)] += total - freq.sum()
        return cls(freq)

    def slots(self) -> np.ndarray:
        """The id at each of the 2**TABLE_BITS places."""
        return np.repeat(np.arange(len(self.freq), dtype=np.min_scalar_type(len(self.freq))), self.freq)

    def pack(self) -> bytes:
        return zlib.compress(self.freq.astype("<u4").tobytes(), 6)

    @classmethod
    def unpack(cls, data: bytes) -> Frequencies:
        return cls(np.frombuffer(zlib.decompress(data), "<u4"))


class Contexts:
    """Order-2 and order-1 table of a stream: an entry is prediction * 4 + confidence (0: empty slot, 1 to 3).

    Order 2 comes first in every pair. Where blocks meet in one slot, the last one's entry stays.
    """

    def __init__(self):
        self.table = np.zeros((1 << SLOTS2) + (1 << SLOTS1), np.int32)

    @staticmethod
    def slots(before: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Places in the table, by the two ids before: of order 2 and of order 1, in the last axis but one."""
        at = np.empty((*last.shape[:-1], 2, last.shape[-1]), np.uint32)
        two, one = at[..., 0, :], at[..., 1, :]
        np.multiply(last, 40503, out=one)
        np.multiply(before, 2654435761, out=two)
        two += one
        two ^= two >> 15
        two &= (1 << SLOTS2) - 1
        one &= (1 << SLOTS1) - 1
        one += 1 << SLOTS2
        return at.astype(np.int64)

    def look(self, at: np.ndarray) -> np.ndarray:
        return self.table.take(at, mode="clip")

    def update(self, at: np.ndarray, entry: np.ndarray, ids4: np.ndarray) -> np.ndarray:
        """Learns from the ids, given times 4 and as 32 bits: a right entry gains confidence, a wrong one loses it or goes. Which were right."""
        right = (entry ^ ids4) < 4
        new = entry - 1
        np.copyto(new, ids4 + 1, where=(entry & 3) < 2)
        np.copyto(new, np.minimum(entry + 1, ids4 + 3), where=right)
        self.table[at.reshape(-1)] = new.reshape(-1)
        return right


class Weights:
    """What the predictions weigh, of 2**TOTAL_BITS, by their confidences and whether they are the same id.

    Predictions that are the same id have one weight, that of order 2 unless its slot is empty.
    """

    def __init__(self):
        same, two, one = (x.reshape(-1) for x in np.meshgrid(range(2), range(4), range(4), indexing="ij"))
        self.valid = np.stack([two > 0, (one > 0) & ((same == 0) | (two == 0))])
        guess = np.array([0, 1, 3, 5])
        #: Times that each kind met an id that neither, order 2, order 1 or both gave.
        self.met = np.stack([12 - guess[two] - guess[one], guess[two], guess[one], guess[two] * 0], 1)
        self.fresh = np.zeros(128, np.int64)
        self._weigh()

    def _weigh(self) -> None:
        right = np.stack([self.met[:, 1] + self.met[:, 3], self.met[:, 2] + self.met[:, 3]])
        pair = np.where(self.valid, (right << WEIGHT_BITS) // (self.met.sum(1) + 1), 0)
        self.pair = (pair << TABLE_BITS).astype(np.int32)
        self.rest = ((1 << WEIGHT_BITS) - pair.sum(0)).astype(np.int32)

    @staticmethod
    def kinds(entry: np.ndarray) -> np.ndarray:
        two, one = entry[..., 0, :], entry[..., 1, :]
        sure = entry & 3
        kind = sure[..., 0, :] << 2
        kind += sure[..., 1, :]
        return np.add(kind, ((two ^ one) < 4).view(np.uint8) << 4, dtype=np.int64)

    def look(self, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights of order 2 and of order 1 (times 2**TABLE_BITS), and that of order 0."""
        return self.pair[0].take(kind, mode="clip"), self.pair[1].take(kind, mode="clip"), self.rest.take(kind, mode="clip")

    def count(self, kind: np.ndarray, right: np.ndarray) -> None:
        right = right.view(np.uint8)
        met = kind << 2
        met += (right[..., 1, :] << 1) + right[..., 0, :]
        self.fresh += np.bincount(met.reshape(-1), minlength=128)

    def learn(self) -> None:
        self.met += self.fresh.reshape(32, 4) - (self.met >> FADE)
        self.fresh[:] = 0
        self._weigh()


def _lengths(n_ids: int) -> np.ndarray:
    blocks = -(-n_ids // BLOCK)
    out = np.full(blocks, BLOCK, np.int64)
    if blocks:
        out[-1] = n_ids - BLOCK * (blocks - 1)
    return out


class Encoder:
    """Words are kept with their carry, a 17th bit, until the end. A symbol gives two at most, the end two."""

    def __init__(self, blocks: int, symbols: int):
        self.low, self.range = np.zeros(blocks, np.int64), np.full(blocks, 1 << 48)
        self.words = np.zeros((blocks, 2 * symbols + 2), np.int32)
        self.first = np.arange(blocks) * self.words.shape[1]
        self.next = self.first.copy()

    def put(self, start: np.ndarray, size: np.ndarray) -> None:
        """Codes a symbol of 2**TOTAL_BITS in each of the first blocks."""
        low, range_ = self.low[: len(start)], self.range[: len(start)]
        range_ >>= TOTAL_BITS
        low += start * range_
        range_ *= size
        todo = (range_ < TOP).nonzero()[0]
        while len(todo):
            l, r = low[todo], range_[todo] << 16
            self._word(todo, l >> 32)
            low[todo], range_[todo] = (l & LOW32) << 16, r
            todo = todo[r < TOP]

    def _word(self, blocks: np.ndarray, words: np.ndarray) -> None:
        at = self.next[blocks]
        self.words.reshape(-1)[at] = words
        self.next[blocks] = at + 1

    def finish(self) -> list[bytes]:
        """The words of each block, in the order they came; carries go into the words before."""
        blocks = np.arange(len(self.low))
        # Two words are enough: whatever follows them lies within the range.
        self.low += 0xFFFF
        self._word(blocks, self.low >> 32)
        self._word(blocks, self.low >> 16 & 0xFFFF)
        words = self.words.reshape(-1)
        while len(over := (words > 0xFFFF).nonzero()[0]):
            words[over] &= 0xFFFF
            words[over - 1] += 1
        return [row[:n].astype("<u2").tobytes() for row, n in zip(self.words, (self.next - self.first).tolist())]


class Decoder:
    """``code`` is how far each block's code lies above its low."""

    def __init__(self, payloads: list[bytes]):
        blocks = len(payloads)
        self.words = np.frombuffer(b"".join([*payloads, bytes(2)]), "<u2").astype(np.int64)
        sizes = np.array([len(p) // 2 for p in payloads])
        self.next = np.cumsum(sizes) - sizes
        self.range, self.code = np.full(blocks, 1 << 48), np.zeros(blocks, np.int64)
        for _ in range(3):
            self.code = self.code << 16 | self.words.take(self.next, mode="clip")
            self.next += 1

    def first(self, n: int) -> None:
        """Goes on with the first ``n`` blocks."""
        self.range, self.code, self.next = self.range[:n], self.code[:n], self.next[:n]

    def target(self) -> np.ndarray:
        """Where in 2**TOTAL_BITS each block's symbol lies. Quotients below 2**28 of whole numbers below 2**48 are rounded down rightly in doubles."""
        self.range >>= TOTAL_BITS
        return (self.code / self.range).astype(np.int32)

    def take(self, start: np.ndarray, size: np.ndarray) -> None:
        range_, code = self.range, self.code
        code -= start * range_
        range_ *= size
        todo = (range_ < TOP).nonzero()[0]
        while len(todo):
            at, r = self.next[todo], range_[todo] << 16
            code[todo] = code[todo] << 16 | self.words.take(at, mode="clip")
            self.next[todo], range_[todo] = at + 1, r
            todo = todo[r < TOP]


@dataclass
class Coded:
    """A coded stream: its number of ids, the order-0 header, and each block's payload and crc32 of its ids."""

    n_ids: int
    table: bytes
    payloads: list[bytes]
    checksums: list[int]


def encode(ids: np.ndarray) -> Coded:
    ids = np.asarray(ids, dtype="<u4")
    lengths = _lengths(len(ids))
    checksums = [zlib.crc32(ids[i * BLOCK : (i + 1) * BLOCK].tobytes()) for i in range(len(lengths))]
    if not len(ids):
        return Coded(0, b"", [], [])
    order0, blocks = Frequencies.of(ids), len(lengths)
    full = np.zeros((blocks, BLOCK), "<u4")
    full.reshape(-1)[: len(ids)] = ids
    # Two steps without ids before the first: the contexts of step t are in rows t and t + 1.
    grid = np.zeros((BLOCK + 2, blocks), np.uint32)
    for at in range(0, blocks, 64):
        grid[2:, at : at + 64] = full[at : at + 64].T
    model, weights, coder = Contexts(), Weights(), Encoder(blocks, int(lengths[0]))
    ahead = max(1, AHEAD // blocks // LEARN) * LEARN
    t, steps = 0, int(lengths[0])
    while t < steps:
        # The last block may end before the others.
        n, until = (blocks, int(lengths[-1])) if t < lengths[-1] else (blocks - 1, steps)
        until = min(until, t // LEARN * LEARN + ahead)
        # The tables first, as they need the ids alone; then the weights; then what they gave is coded.
        ids4 = (grid[t + 2 : until + 2, :n] << 2).view(np.int32)
        entries, rights = np.empty((until - t, 2, n), np.int32), np.empty((until - t, 2, n), bool)
        for k, at in enumerate(model.slots(grid[t:until, :n], grid[t + 1 : until + 1, :n])):
            entries[k] = entry = model.look(at)
            rights[k] = model.update(at, entry, ids4[k])
        first = t
        while t < until:
            to = min(until, (t // LEARN + 1) * LEARN)
            own = slice(t - first, to - first)
            entry, right = entries[own], rights[own]
            kind = weights.kinds(entry)
            weight2, weight1, rest = weights.look(kind)
            less = entry < ids4[own, None]
            now = grid[t + 2 : to + 2, :n].astype(np.int64)
            start, size = order0.start.take(now, mode="clip"), order0.freq.take(now, mode="clip")
            start *= rest
            start += weight2 * less[:, 0]
            start += weight1 * less[:, 1]
            size *= rest
            size += weight2 * right[:, 0]
            size += weight1 * right[:, 1]
            weights.count(kind, right)
            for step in zip(start, size):
                coder.put(*step)
            if to % LEARN == 0:
                weights.learn()
            t = to
    return Coded(len(ids), order0.pack(), coder.finish(), checksums)


@np.errstate(invalid="ignore")
def decode(coded: Coded) -> np.ndarray:
    """The ids; raises ValueError if a block doesn't give its checksum."""
    lengths = _lengths(coded.n_ids)
    if not len(lengths):
        return np.zeros(0, "<u4")
    order0, n = Frequencies.unpack(coded.table), len(lengths)
    slots = order0.slots()
    grid = np.zeros((BLOCK, n), "<u4")
    model, weights, coder = Contexts(), Weights(), Decoder(coded.payloads)
    before = last = np.zeros(n, np.uint32)
    for t in range(int(lengths[0])):
        if t == lengths[-1]:
            n -= 1
            before, last = before[:n], last[:n]
            coder.first(n)
        at = model.slots(before, last)
        entry = model.look(at)
        kind = weights.kinds(entry)
        weight2, weight1, rest = weights.look(kind)
        guess = entry >> 2
        # The ends of the two guesses' own parts say which of them the symbol is, or how many it lies past.
        at0, target = guess.astype(np.int64), coder.target()
        start, end = order0.start.take(at0, mode="clip"), order0.freq.take(at0, mode="clip")
        start *= rest
        start[0] += weight1 * (guess[1] < guess[0])
        start[1] += weight2 * (guess[0] < guess[1])
        end *= rest
        end += start
        end[0] += weight2
        end[1] += weight1
        past = target >= end
        right = (target >= start) > past
        moved = weight2 * past[0]
        moved += weight1 * past[1]
        now = slots.take(((target - moved) / rest).astype(np.int64), mode="clip").astype(np.int32)
        np.copyto(now, guess[1], where=right[1])
        np.copyto(now, guess[0], where=right[0])
        at0 = now.astype(np.int64)
        start, size = order0.start.take(at0, mode="clip"), order0.freq.take(at0, mode="clip")
        start *= rest
        start += moved
        size *= rest
        size += weight2 * right[0]
        size += weight1 * right[1]
        coder.take(start, size)
        weights.count(kind, model.update(at, entry, now << 2))
        if (t + 1) % LEARN == 0:
            weights.learn()
        now = now.view(np.uint32)
        before, last = last, now
        grid[t, :n] = now
    full = np.empty(grid.shape[::-1], "<u4")
    for at in range(0, len(full), 64):
        full[at : at + 64] = grid[:, at : at + 64].T
    ids = full.reshape(-1)[: coded.n_ids]
    for i, want in enumerate(coded.checksums):
        if zlib.crc32(ids[i * BLOCK : (i + 1) * BLOCK].tobytes()) != want:
            raise ValueError(f"block {i} does not match its checksum")
    return ids
