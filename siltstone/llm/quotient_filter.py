"""Counting quotient filters: sorted fingerprints with counts, in runs of remainders.

A fingerprint has 64 bits. Its first ``slice_bits`` choose the filter it goes to, the next ones are
its quotient and the others its remainder. A filter notes which quotients occur (one bit each) and
holds the remainders of every one of them as a run in ascending order, the last one marked. A
remainder that was counted more than once is followed by counter slots, marked as such, with the
digits of the count less one. Decoding gives the fingerprints back in order, so merging filters
is merging sorted remainders and loses nothing.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np

_U = np.uint64
_HEADER = struct.Struct("<BBBxIQ")


def _low_bits(n: int) -> np.uint64:
    return _U((1 << n) - 1)


def encode(fingerprints: np.ndarray, counts: np.ndarray, slice_bits: int) -> bytes:
    """The filter of ascending, distinct fingerprints of one slice; every count is at least 1."""
    n = len(fingerprints)
    free = 64 - slice_bits
    # Whole bytes for a remainder, and about as many quotients as fingerprints or fewer.
    slot_bytes = min(-(-(free - max(n, 1).bit_length() + 1) // 8), free // 8, 7)
    quotient_bits = free - 8 * slot_bytes
    first = int(fingerprints[0]) >> free if n else 0
    own = fingerprints & _low_bits(free)
    quotient = (own >> _U(8 * slot_bytes)).astype(np.int64)
    digits = np.zeros(n, dtype=np.int64)
    more = counts.astype(np.uint64) - _U(1)
    left = more.copy()
    while left.any():
        digits += left > 0
        left >>= _U(8 * slot_bytes)
    at = np.cumsum(1 + digits) - digits - 1  # slot of each remainder
    size = int(n + digits.sum())
    slots = np.zeros(size, dtype=np.uint64)
    slots[at] = own & _low_bits(8 * slot_bytes)
    is_digit = np.ones(size, dtype=bool)
    is_digit[at] = False
    for level in range(int(digits.max(initial=0))):
        has = digits > level
        slots[at[has] + 1 + level] = (more[has] >> _U(8 * slot_bytes * level)) & _low_bits(8 * slot_bytes)
    ends = np.zeros(size, dtype=bool)
    last = np.flatnonzero(np.append(quotient[1:] != quotient[:-1], True)) if n else np.zeros(0, np.int64)
    ends[at[last] + digits[last]] = True
    occupied = np.zeros(1 << quotient_bits, dtype=bool)
    occupied[quotient] = True
    raw = slots.astype("<u8").view(np.uint8).reshape(size, 8)[:, :slot_bytes]
    return b"".join(
        (
            _HEADER.pack(slice_bits, quotient_bits, slot_bytes, first, size),
            np.packbits(occupied).tobytes(),
            np.packbits(ends).tobytes(),
            np.packbits(is_digit).tobytes(),
            raw.tobytes(),
        )
    )


def decode(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints of a filter in ascending order, and their counts."""
    slice_bits, quotient_bits, slot_bytes, first, size = _HEADER.unpack_from(data)
    at = _HEADER.size

    def bits(n: int) -> np.ndarray:
        nonlocal at
        packed = np.frombuffer(data, np.uint8, -(-n // 8), at)
        at += len(packed)
        return np.unpackbits(packed, count=n).astype(bool)

    occupied, ends, is_digit = bits(1 << quotient_bits), bits(size), bits(size)
    slots = np.zeros((size, 8), dtype=np.uint8)
    slots[:, :slot_bytes] = np.frombuffer(data, np.uint8, size * slot_bytes, at).reshape(size, slot_bytes)
    slots = slots.view("<u8").reshape(size).astype(np.uint64)
    run = np.cumsum(ends) - ends
    opens = np.flatnonzero(~is_digit)
    quotient = np.flatnonzero(occupied)[run[opens]].astype(np.uint64)
    fingerprints = (quotient << _U(8 * slot_bytes)) | slots[opens]
    if slice_bits:
        fingerprints |= _U(first) << _U(64 - slice_bits)
    counts = np.ones(len(opens), dtype=np.uint64)
    places = np.flatnonzero(is_digit)
    owner = np.searchsorted(opens, places) - 1
    shift = (places - opens[owner] - 1).astype(np.uint64) * _U(8 * slot_bytes)
    np.add.at(counts, owner, slots[places] << shift)
    return fingerprints, counts.astype(np.int64)


def tally(fingerprints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct fingerprints with the sums of their counts."""
    if not len(fingerprints):
        return fingerprints, counts
    order = np.argsort(fingerprints, kind="stable")
    ordered = fingerprints[order]
    opens = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    return ordered[opens], np.add.reduceat(counts[order], opens)


def merge(filters: Sequence[bytes]) -> bytes:
    """One filter with all counts of several filters of the same slice."""
    parts = [decode(f) for f in filters]
    fingerprints, counts = tally(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
    return encode(fingerprints, counts, _HEADER.unpack_from(filters[0])[0])
