"""Hashes of all windows of a text at once, and a bit set of hashes, sized by their number."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bits for each hash, and the logs of the fewest (1 MB) and of the most: 8 MB, and eight times that
# unpacked in a worker.
BITS_EACH = 32
LEAST_BITS = 23
MOST_BITS = 26
MOST_HASHES = (1 << MOST_BITS) // BITS_EACH
# Where a hash holds the places in its block; the low MOST_BITS pick the block.
PROBES = (40, 46, 52, 58)
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(32))


def window_hashes(text: bytes, lengths: tuple[int, ...]) -> dict[int, np.ndarray]:
    """For each length, which are powers of two, the hashes of all windows of so many bytes."""
    whole, found, length, power = np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1), {}, 1, _BASE
    while True:
        if length in lengths:
            found[length] = mixed(whole + np.uint64(length * 0x51ED27))
        if length >= max(lengths, default=0):
            return found
        if len(whole) > length:
            whole = whole[:-length] * np.uint64(power) + whole[length:]
        else:
            whole = whole[:0]
        length, power = length * 2, power * power % (1 << 64)


def filter_bits(n: int) -> int:
    """Log of the bits of a filter of ``n`` hashes: at least ``BITS_EACH`` for each, up to ``MOST_HASHES``."""
    return min(max((BITS_EACH * n - 1).bit_length(), LEAST_BITS), MOST_BITS)


def bit_filter(hashes: DataFrame, column: str, bits: int) -> bytes:
    """All hashes as a blocked Bloom filter of 2^``bits`` bits, made in parts of 4 KB.

    The low bits of a hash pick a block of 64 bits, high bits ``PROBES`` places in it.
    """
    h = F.col(column)
    block = h.bitwiseAND(F.lit((1 << bits) - 64))
    places = [block + F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(63)) + 1 for shift in PROBES]
    parts = (
        hashes.select(F.explode(F.array(*places)).alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).collect()
    )
    whole = bytearray((1 << bits) // 8)
    for part in parts:
        at = (part["bucket"] - 1) * len(part["bits"])
        whole[at:at + len(part["bits"])] = part["bits"]
    return bytes(whole)


def unpacked(bits: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").astype(bool)


def passes(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Indices of hashes that may be in the set; those that are in it always pass."""
    block, at = hashes & np.uint64(len(known) - 64), None
    for shift in PROBES:
        place = (block + (hashes >> np.uint64(shift) & np.uint64(63))).astype(np.int64)
        hit = np.flatnonzero(known[place])
        at, block, hashes = hit if at is None else at[hit], block[hit], hashes[hit]
    return at
