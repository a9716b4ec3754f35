"""MinHash signatures and their Jaccard estimate.

The scheme is the published one of 128 functions ``(a*h + b) mod p`` with p = 2^61 - 1, kept to 32
bits, over the first four SHA-1 bytes of each token. Coefficients come from a seeded generator and
products wrap at 64 bits, as in the widely used public Python implementation, so that signatures
can be exchanged with it.
"""

from __future__ import annotations

from binascii import unhexlify
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUM_PERM = 128
TREES = 8
DEPTH = NUM_PERM // TREES
SLOT_BYTES = 4
SEED = 1
PRIME = (1 << 61) - 1
MAX_HASH = (1 << 32) - 1
# Tokens per step: 512 x 128 values stay in the cache of a core.
_CHUNK = 512


@lru_cache(maxsize=None)
def permutations(num_perm: int = NUM_PERM, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients ``a`` and ``b``, drawn in pairs from the seeded generator."""
    draw = np.random.RandomState(seed).randint
    pairs = [
        (draw(1, PRIME, dtype=np.uint64), draw(0, PRIME, dtype=np.uint64))
        for _ in range(num_perm)
    ]
    table = np.array(pairs, dtype=np.uint64)
    return table[:, 0].copy(), table[:, 1].copy()


def token_hashes(token_set: Column) -> Column:
    """First four SHA-1 bytes of each token, as the eight digits that they have in hex."""
    return F.transform(token_set, lambda t: F.substring(F.sha1(t.cast("binary")), 1, 8))


def _numbers(hashes: pa.Array) -> np.ndarray:
    """Hashes of eight hex digits as little-endian numbers. A hash of no token, NULL, is 0."""
    if hashes.null_count:
        hashes = hashes.fill_null("0" * 8)
    # Strings of equal length stand back to back, in a slice from its offset on.
    digits = memoryview(hashes.buffers()[2] or b"")[hashes.offset * 8:(hashes.offset + len(hashes)) * 8]
    return np.frombuffer(unhexlify(digits), "<u4")


def _permuted(hashes: np.ndarray, a: np.ndarray, b: np.ndarray, x: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All functions of all hashes, in ``x``; the remainder uses that the prime is 2^61 - 1. ``high`` is work space, as
    new arrays of this size cost more than the numbers in them."""
    np.multiply(hashes[:, None], a, out=x)
    x += b
    np.right_shift(x, np.uint64(61), out=high)
    x &= np.uint64(PRIME)
    x += high
    if x.max() >= PRIME:
        np.subtract(x, np.uint64(PRIME), out=x, where=x >= np.uint64(PRIME))
    return x


def signatures_of(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Signature rows for sets stored back to back; set i is ``values[offsets[i]:offsets[i+1]]``."""
    a, b = permutations()
    out = np.full((len(offsets) - 1, NUM_PERM), MAX_HASH, dtype=np.uint32)
    x, high = np.empty((2, _CHUNK, NUM_PERM), np.uint64)
    low = np.empty((_CHUNK, NUM_PERM), np.uint32)
    first, last = int(offsets[0]), int(offsets[-1])
    for start in range(first, last, _CHUNK):
        stop = min(start + _CHUNK, last)
        # Sets that overlap this chunk; empty sets own no value and are skipped.
        lo = int(np.searchsorted(offsets, start, side="right")) - 1
        hi = int(np.searchsorted(offsets, stop, side="left"))
        starts = np.clip(offsets[lo:hi], start, stop)
        filled = np.clip(offsets[lo + 1:hi + 1], start, stop) > starts
        rows = np.arange(lo, hi)[filled]
        size = stop - start
        block = _permuted(values[start:stop].astype(np.uint64), a, b, x[:size], high[:size])
        np.copyto(low[:size], block, casting="unsafe")  # cuts to 32 bits
        mins = np.minimum.reduceat(low[:size], starts[filled] - start, axis=0)
        out[rows] = np.minimum(out[rows], mins)
    return out


def _rows_of(items: pa.Array, width: int) -> pa.ListArray:
    """Lists of equal length from items stored back to back."""
    bounds = np.arange(0, len(items) + 1, width, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), items)


_SIGNED = T.StructType(
    [
        T.StructField("sig", T.ArrayType(T.LongType())),
        T.StructField("trees", T.ArrayType(T.BinaryType())),
    ]
)


@F.arrow_udf(_SIGNED)
def _signed(hashes: pa.Array) -> pa.Array:
    slots = signatures_of(_numbers(hashes.values), hashes.offsets.to_numpy())
    sig = _rows_of(pa.array(slots.astype(np.int64).ravel()), NUM_PERM)
    size = DEPTH * SLOT_BYTES
    ends = np.arange(0, len(slots) * TREES * size + 1, size, dtype=np.int32)
    packed = pa.py_buffer(slots.astype(">u4").tobytes())
    parts = pa.BinaryArray.from_buffers(
        pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), packed]
    )
    return pa.StructArray.from_arrays([sig, _rows_of(parts, TREES)], ["sig", "trees"])


_signed = _signed.asNondeterministic()


def signed(hashes: Column) -> Column:
    """``(sig, trees)`` of a token-hash set: the 128 slots of its signature, and the same slots as
    8 strings of 16 big-endian numbers, whose byte order and prefixes are those of the slots."""
    return _signed(hashes)


def first_slot(slots: Column) -> Column:
    return F.conv(F.hex(F.substring(slots, 1, SLOT_BYTES)), 16, 10).cast("bigint")


def prefix(slots: Column, depth: Column) -> Column:
    """The first ``depth`` slots of a tree."""
    return F.substring(slots, F.lit(1), depth * SLOT_BYTES)


def packed_signature(trees: Column) -> Column:
    """All 128 slots as 512 bytes."""
    return F.concat(*[F.element_at(trees, i + 1) for i in range(TREES)])


def trees_of(packed: Column) -> Column:
    """The trees of a packed signature."""
    size = DEPTH * SLOT_BYTES
    return F.array(*[F.substring(packed, i * size + 1, size) for i in range(TREES)])


@F.arrow_udf(T.DoubleType())
def _packed_estimate(left: pa.Array, right: pa.Array) -> pa.Array:
    slots = lambda side: np.frombuffer(b"".join(side.to_pylist()), "<u4").reshape(-1, NUM_PERM)
    return pa.array((slots(left) == slots(right)).mean(axis=1, dtype=np.float64))


def packed_estimate(left: Column, right: Column) -> Column:
    """Share of equal slots of two packed signatures, neither of them NULL."""
    return _packed_estimate(left, right)


def equal_slots(left: Column, right: Column) -> Column:
    return F.size(F.filter(F.zip_with(left, right, lambda x, y: x == y), lambda same: same))


def jaccard_estimate(left: Column, right: Column) -> Column:
    """Share of equal slots."""
    return equal_slots(left, right) / F.lit(float(NUM_PERM))


def jaccard(left: Column, right: Column) -> Column:
    """Exact Jaccard similarity of two token sets; 0 when both are empty."""
    union = F.size(F.array_union(left, right))
    return F.when(union > 0, F.size(F.array_intersect(left, right)) / union).otherwise(F.lit(0.0))
