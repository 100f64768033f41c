"""The 64-bit FarmHash fingerprint, as a column function over Arrow batches.

The algorithm and its three constants are published with the hash; the warehouse function
``FARM_FINGERPRINT`` is this hash as a signed integer. Texts of a batch are hashed together,
by classes of length, in numpy arrays of 64-bit integers that wrap around as the hash needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published algorithm.
K0 = np.uint64(0xC3A5C85C97CB3127)
K1 = np.uint64(0xB492B66FBE98F273)
K2 = np.uint64(0x9AE16A3B2F90404F)
SEED = np.uint64(81)


def u(n: int) -> np.uint64:
    return np.uint64(n)


def rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return (x >> u(bits)) | (x << u(64 - bits))


def mixed(x: np.ndarray) -> np.ndarray:
    return x ^ (x >> u(47))


def joined(a: np.ndarray, b: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Two words to one."""
    x = mixed((a ^ b) * factor)
    return mixed((b ^ x) * factor) * factor


class Bytes:
    """The bytes of many texts, of which words are read at given places."""

    def __init__(self, data: np.ndarray) -> None:
        self.data = np.concatenate([data, np.zeros(8, np.uint8)])

    def word(self, at: np.ndarray, size: int = 8) -> np.ndarray:
        taken = self.data[at[:, None] + np.arange(size)]
        return np.ascontiguousarray(taken).view(f"<u{size}")[:, 0].astype(np.uint64)


def up_to_16(text: Bytes, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    out = np.full(len(at), K2)
    n = size.astype(np.uint64)
    factor = K2 + n * u(2)
    k = size >= 8
    a, b = text.word(at[k]) + K2, text.word(at[k] + size[k] - 8)
    f = factor[k]
    out[k] = joined(rotated(b, 37) * f + a, (rotated(a, 25) + b) * f, f)
    k = (size >= 4) & (size < 8)
    a, b = text.word(at[k], 4), text.word(at[k] + size[k] - 4, 4)
    out[k] = joined(n[k] + (a << u(3)), b, factor[k])
    k = (size > 0) & (size < 4)
    one, half, last = (text.word(at[k] + d, 1) for d in (0, size[k] >> 1, size[k] - 1))
    out[k] = mixed((one + (half << u(8))) * K2 ^ (n[k] + (last << u(2))) * K0) * K2
    return out


def ends(text: Bytes, at: np.ndarray, size: np.ndarray, first: np.uint64) -> tuple[np.ndarray, ...]:
    """What texts of 17 to 64 bytes have in common: the factor, four words and two sums."""
    factor = K2 + size.astype(np.uint64) * u(2)
    a, b = text.word(at) * first, text.word(at + 8)
    c, d = text.word(at + size - 8) * factor, text.word(at + size - 16) * K2
    return factor, a, rotated(a + b, 43) + rotated(c, 30) + d, a + rotated(b + K2, 18) + c


def up_to_32(text: Bytes, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    factor, _, one, two = ends(text, at, size, K1)
    return joined(one, two, factor)


def up_to_64(text: Bytes, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    factor, a, y, two = ends(text, at, size, K2)
    z = joined(y, two, factor)
    e, f = text.word(at + 16) * factor, text.word(at + 24)
    g = (y + text.word(at + size - 32)) * factor
    h = (z + text.word(at + size - 24)) * factor
    return joined(rotated(e + f, 43) + rotated(g, 30) + h, e + rotated(f + a, 18) + g, factor)


class Long:
    """Texts over 64 bytes: seven words of state, turned once for each 64 bytes."""

    def __init__(self, n: int) -> None:
        y = SEED * K1 + u(113)
        start = [SEED * K2, y, mixed(y * K2 + u(113)) * K2, u(0), u(0), u(0), u(0)]
        self.state = [np.full(n, s) for s in start]

    @staticmethod
    def half(text: Bytes, at: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w, x, y, z = (text.word(at + d) for d in (0, 8, 16, 24))
        a = a + w
        b = rotated(b + a + z, 21)
        c = a
        a = a + x + y
        return a + z, b + rotated(a, 44) + c

    def turned(self, text: Bytes, at: np.ndarray, rows: np.ndarray | slice, last: bool, rest=None) -> None:
        x, y, z, v1, v2, w1, w2 = (s[rows] for s in self.state)
        nine = u(9) if last else u(1)
        factor = K1 + ((z & u(255)) << u(1)) if last else K1
        if last:
            w1 = w1 + rest
            v1 = v1 + w1
            w1 = w1 + v1
        x = rotated(x + y + v1 + text.word(at + 8), 37) * factor
        y = rotated(y + v2 + text.word(at + 48), 42) * factor
        x = x ^ (w2 * nine)
        y = y + v1 * nine + text.word(at + 40)
        z = rotated(z + w1, 33) * factor
        v1, v2 = self.half(text, at, v2 * factor, x + w1)
        w1, w2 = self.half(text, at + 32, z + w2, y + text.word(at + 16))
        for s, new in zip(self.state, (z, y, x, v1, v2, w1, w2)):
            s[rows] = new
        self.factor = factor


def over_64(text: Bytes, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    long = Long(len(at))
    long.state[0] = long.state[0] + text.word(at)
    whole = (size - 1) // 64
    for k in range(int(whole.max())):
        rows = np.flatnonzero(whole > k)
        long.turned(text, at[rows] + 64 * k, rows, last=False)
    rest = ((size - 1) & 63).astype(np.uint64)
    long.turned(text, at + size - 64, slice(None), last=True, rest=rest)
    x, y, z, v1, v2, w1, w2 = long.state
    f = long.factor
    return joined(joined(v1, w1, f) + mixed(y) * K0 + z, joined(v2, w2, f) + x, f)


CLASSES = ((0, 16, up_to_16), (17, 32, up_to_32), (33, 64, up_to_64), (65, None, over_64))


def fingerprints(values: pa.Array) -> pa.Array:
    """The fingerprint of each value; null stays null."""
    array = values.cast(pa.large_binary())
    _, offsets, data = array.buffers()
    ends_ = np.frombuffer(offsets, np.int64, len(array) + 1, array.offset * 8)
    at, size = ends_[:-1], np.diff(ends_)
    text = Bytes(np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8))
    out = np.zeros(len(array), np.uint64)
    with np.errstate(over="ignore"):
        for low, high, hashed in CLASSES:
            rows = np.flatnonzero((size >= low) & (size <= (high or size.max(initial=0))))
            if len(rows):
                out[rows] = hashed(text, at[rows], size[rows])
    empty = np.asarray(array.is_null())
    return pa.array(out.view(np.int64), pa.int64(), mask=empty)


def farm_fingerprint(c: Column | str) -> Column:
    """The FarmHash fingerprint of a text or binary column, as a signed 64-bit integer."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from map(fingerprints, batches)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "long")(c)
