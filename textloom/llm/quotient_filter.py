"""Counting quotient filters as bytes: build, read, merge.

A fingerprint of ``bits`` bits is cut into a quotient, which names a home slot, and a remainder, which is stored. Equal
quotients form a run of ascending remainders; runs stand in the order of their quotients, each at its home slot or at
the first slot after the run before (Pandey et al., "A General-Purpose Counting Filter: Making Every Bit Count"). Three bits
a slot say what stands there: ``occupied`` (the slot is the home of a run), ``runend`` (a run ends here) and
``counter`` (the slot holds a digit of the count of the remainder before it; this bit is used in place of the
paper's escape sequences). A count of one takes no digit; of c, the digits of c - 1, least first.

A filter's number of slots follows its number of entries. Whatever it is, quotient and remainder together are the
fingerprint, so entries come out sorted, and filters of any sizes merge without loss: their sorted entries are merged
and the counts of equal ones added.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable

import numpy as np

#: Bits of the fingerprint, bits of the quotient, bytes of a slot, slots.
HEADER = struct.Struct("<BBBxI")
#: Entries per home slot at most.
LOAD = 0.95


def build(prints: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """A filter of ascending, distinct fingerprints (unsigned, below 2**bits) and their counts (1 or more)."""
    n = len(prints)
    if not n:
        return HEADER.pack(bits, 0, 1, 0)
    q = min(bits, max(1, int(np.ceil(np.log2(n / LOAD)))))
    r = bits - q
    width = max(1, -(-r // 8))
    digits = np.zeros(n, np.int64)
    rest = counts.astype(np.uint64) - np.uint64(1)
    extra = rest.copy()
    while rest.any():
        digits += rest > 0
        rest = rest >> np.uint64(8 * width)
    prints = prints.astype(np.uint64)
    home = (prints >> np.uint64(r)).astype(np.int64)
    size = digits + 1
    before = np.cumsum(size) - size
    at = before + np.maximum.accumulate(home - before)
    slots = max(1 << q, int(at[-1] + size[-1]))
    stored = np.zeros(slots, np.uint64)
    occupied, runend, counter = np.zeros(1 << q, bool), np.zeros(slots, bool), np.zeros(slots, bool)
    stored[at] = prints & np.uint64((1 << r) - 1)
    for j in range(int(digits.max())):
        has = digits > j
        stored[at[has] + 1 + j] = (extra[has] >> np.uint64(8 * width * j)) & np.uint64((1 << 8 * width) - 1)
        counter[at[has] + 1 + j] = True
    occupied[home] = True
    last = np.append(home[1:] != home[:-1], True)
    runend[(at + size - 1)[last]] = True
    body = stored.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return b"".join([HEADER.pack(bits, q, width, slots), *(np.packbits(x).tobytes() for x in (occupied, runend, counter)), body.tobytes()])


def entries(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprints ascending, counts) of a filter."""
    bits, q, width, slots = HEADER.unpack_from(data)
    if not slots:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    place = HEADER.size

    def flags(n: int) -> np.ndarray:
        nonlocal place
        size = -(-n // 8)
        got = np.unpackbits(np.frombuffer(data, np.uint8, size, place), count=n).astype(bool)
        place += size
        return got

    home, end, counter = np.flatnonzero(flags(1 << q)), np.flatnonzero(flags(slots)), flags(slots)
    body = np.zeros((slots, 8), np.uint8)
    body[:, :width] = np.frombuffer(data, np.uint8, slots * width, place).reshape(slots, width)
    stored = body.view("<u8").ravel()
    # The k-th occupied home owns the run with the k-th end; it starts at home or just after the run before.
    start = np.maximum(home, np.concatenate([[0], end[:-1] + 1]))
    length = end - start + 1
    slot = np.arange(int(length.sum())) + np.repeat(start - (np.cumsum(length) - length), length)
    digit = counter[slot]
    prints = (np.repeat(home, length)[~digit].astype(np.uint64) << np.uint64(bits - q)) | stored[slot[~digit]]
    owner = np.cumsum(~digit) - 1
    first = np.flatnonzero(~digit)
    nth = np.flatnonzero(digit) - first[owner[digit]] - 1
    extra = np.zeros(len(prints), np.uint64)
    np.add.at(extra, owner[digit], stored[slot[digit]] << (nth * 8 * width).astype(np.uint64))
    return prints, extra.astype(np.int64) + 1


def summed(prints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct fingerprints and their added counts."""
    if not len(prints):
        return prints, counts
    order = np.argsort(prints, kind="stable")
    prints, counts = prints[order], counts[order]
    first = np.flatnonzero(np.append(True, prints[1:] != prints[:-1]))
    return prints[first], np.add.reduceat(counts, first)


def merge(filters: Iterable[bytes], bits: int) -> bytes:
    """One filter of all entries of several, counts added."""
    parts = [entries(f) for f in filters]
    if not parts:
        return build(np.zeros(0, np.uint64), np.zeros(0, np.int64), bits)
    return build(*summed(np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts])), bits)
