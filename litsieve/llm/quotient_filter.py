"""Counting quotient filters over sorted fingerprints, in numpy.

A fingerprint is cut into a quotient, the slot it would like to have, and a remainder, which
is what gets stored. Remainders of one quotient form a sorted run; a run that finds its
slots taken is shifted to the right. One bit a quotient tells that it has a run, one bit a
slot that a run ends there; together they place every run again, so nothing is lost.

Remainders are stored from 1 on. A value met once is its remainder x, met twice x x, and met
n >= 3 times x, the digits of n - 3, x. A digit is never x, and the first one is below x (a
leading zero is put before it if need be): since runs ascend, a lesser value after x can only
be a counter.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

_HEAD = struct.Struct("<BBQQ")
LOAD = 0.9


def _places(quotients: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """First slot of each run: its quotient, or the end of the run before."""
    before = np.cumsum(lengths) - lengths
    return before + np.maximum.accumulate(quotients - before)


def _digits(value: int, bits: int) -> list[int]:
    out = [value & ((1 << bits) - 1)]
    while value := value >> bits:
        out.append(value & ((1 << bits) - 1))
    return out[::-1]


@dataclass
class QuotientFilter:
    """``occupied`` by quotient, ``ends`` by slot, and the remainders of the used slots."""

    quotient_bits: int
    remainder_bits: int
    occupied: np.ndarray
    ends: np.ndarray
    slots: np.ndarray

    @classmethod
    def build(cls, values: np.ndarray, counts: np.ndarray, bits: int) -> QuotientFilter:
        """From ascending distinct numbers below 2**bits and how often each was met."""
        need = len(values) + int((counts > 1).sum() + (counts > 2).sum())
        q = min(max(int(np.ceil(np.log2(max(need, 1) / LOAD))), 0), bits)
        r = min(max(bits - q, 1), 63)
        q = bits - r if bits > r else 0
        home = (values >> np.uint64(r)).astype(np.int64) if r < 64 else np.zeros(len(values), np.int64)
        x = (values & np.uint64((1 << r) - 1)) + np.uint64(1)
        sizes = np.minimum(counts, 2).astype(np.int64)
        counters: dict[int, list[int]] = {}
        for i in np.flatnonzero(counts > 2):
            own = int(x[i])
            digits = [d if d < own else d + 1 for d in _digits(int(counts[i]) - 3, r)]
            counters[int(i)] = digits if digits[0] < own else [0, *digits]
            sizes[i] += len(counters[int(i)])
        upto = np.cumsum(sizes)
        slots = np.zeros(int(upto[-1]) if len(upto) else 0, np.uint64)
        slots[upto - sizes] = x
        slots[upto - 1] = x
        for i, digits in counters.items():
            at = int(upto[i] - sizes[i]) + 1
            slots[at : at + len(digits)] = digits
        occupied = np.zeros(1 << q, bool)
        occupied[home] = True
        quotients, first = np.unique(home, return_index=True)
        lengths = np.add.reduceat(sizes, first) if len(first) else sizes
        starts = _places(quotients, lengths)
        ends = np.zeros(max(1 << q, int(starts[-1] + lengths[-1]) if len(starts) else 0), bool)
        ends[starts + lengths - 1] = True
        return cls(q, r, occupied, ends, slots)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """(values, counts), ascending: what the filter was built from."""
        quotients, last = np.flatnonzero(self.occupied), np.flatnonzero(self.ends)
        starts = np.maximum(quotients, np.concatenate([[0], last[:-1] + 1])) if len(last) else quotients
        lengths = last - starts + 1
        run = np.repeat(np.arange(len(lengths)), lengths)
        v = self.slots
        inside = run[1:] == run[:-1]
        head = np.ones(len(v), bool)  # slots at which a value begins
        counts = np.ones(len(v), np.int64)
        done = 0
        for i in np.flatnonzero(inside & (v[1:] < v[:-1])):
            if i < done:
                continue  # a digit of the counter before
            digits, at, own = 0, int(i) + 1, int(v[i])
            while (d := int(v[at])) != own:
                digits = digits << self.remainder_bits | (d - (d > own))
                at += 1
            head[i + 1 : at + 1] = False
            counts[i] = digits + 3
            done = at + 1
        twice = np.flatnonzero(inside & (v[1:] == v[:-1]) & head[:-1] & head[1:])
        head[twice + 1] = False
        counts[twice] = 2
        low = v[head] - np.uint64(1)
        high = quotients[run[head]].astype(np.uint64)
        return high << np.uint64(self.remainder_bits) | low, counts[head]

    def to_bytes(self) -> bytes:
        width = (self.remainder_bits + 8) // 8
        packed = self.slots.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        head = _HEAD.pack(self.quotient_bits, self.remainder_bits, len(self.ends), len(self.slots))
        return b"".join([head, *(np.packbits(b).tobytes() for b in (self.occupied, self.ends)), packed.tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> QuotientFilter:
        q, r, n_ends, n_slots = _HEAD.unpack_from(data)
        raw = np.frombuffer(data, np.uint8, offset=_HEAD.size)
        flags = []
        for n in (1 << q, n_ends):
            size = -(-n // 8)
            flags.append(np.unpackbits(raw[:size], count=n).astype(bool))
            raw = raw[size:]
        width = (r + 8) // 8
        whole = np.zeros((n_slots, 8), np.uint8)
        whole[:, :width] = raw.reshape(n_slots, width)
        return cls(q, r, *flags, whole.view("<u8").ravel())


def counted(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values in ascending order, each once, with the sum of its counts."""
    order = np.argsort(values, kind="stable")  # merges runs that already ascend
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else order
    return values[first], np.add.reduceat(counts, first) if len(first) else counts


def merged(filters: Iterable[QuotientFilter], bits: int) -> QuotientFilter:
    """One filter of all, by their sorted streams; as if built from all values at once."""
    streams = [f.items() for f in filters]
    values = np.concatenate([np.zeros(0, np.uint64), *(s[0] for s in streams)])
    counts = np.concatenate([np.zeros(0, np.int64), *(s[1] for s in streams)])
    return QuotientFilter.build(*counted(values, counts), bits)
