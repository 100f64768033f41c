"""The fingerprint against published values and a version that hashes one text at a time."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.functions.farmhash import farm_fingerprint, fingerprints
from tidemark.operators.cleaning import hash_sample, time_text

M = (1 << 64) - 1
K0, K1, K2 = 0xC3A5C85C97CB3127, 0xB492B66FBE98F273, 0x9AE16A3B2F90404F


def rot(x, r):
    return (x >> r | x << (64 - r)) & M


def shift(x):
    return x ^ x >> 47


def pair(a, b, m):
    x = shift((a ^ b) * m & M)
    return shift((b ^ x) * m & M) * m & M


def weak(s, i, a, b):
    w, x, y, z = (int.from_bytes(s[i + d : i + d + 8], "little") for d in (0, 8, 16, 24))
    a = a + w & M
    b = rot(b + a + z & M, 21)
    c = a
    a = a + x + y & M
    return a + z & M, b + rot(a, 44) + c & M


def slow(s):
    def w(i, size=8):
        return int.from_bytes(s[i : i + size], "little")

    n = len(s)
    m = K2 + 2 * n & M
    if n == 0:
        return K2
    if n < 4:
        y, z = s[0] + (s[n >> 1] << 8), n + (s[n - 1] << 2)
        return shift(y * K2 & M ^ z * K0 & M) * K2 & M
    if n < 8:
        return pair(n + (w(0, 4) << 3), w(n - 4, 4), m)
    if n <= 16:
        a, b = w(0) + K2 & M, w(n - 8)
        return pair(rot(b, 37) * m + a & M, (rot(a, 25) + b) * m & M, m)
    if n <= 64:
        a, b, c, d = w(0) * (K1 if n <= 32 else K2) & M, w(8), w(n - 8) * m & M, w(n - 16) * K2 & M
        y = rot(a + b & M, 43) + rot(c, 30) + d & M
        z = a + rot(b + K2 & M, 18) + c & M
        if n <= 32:
            return pair(y, z, m)
        z = pair(y, z, m)
        e, f, g, h = w(16) * m & M, w(24), (y + w(n - 32)) * m & M, (z + w(n - 24)) * m & M
        return pair(rot(e + f & M, 43) + rot(g, 30) + h & M, e + rot(f + a & M, 18) + g & M, m)
    y = 81 * K1 + 113 & M
    z = shift(y * K2 + 113 & M) * K2 & M
    x, v, u = 81 * K2 + w(0) & M, (0, 0), (0, 0)
    at, m, nine = 0, K1, 1
    for k in range((n - 1) // 64 + 1):
        if k == (n - 1) // 64:
            at, m, nine = n - 64, K1 + ((z & 255) << 1), 9
            u = (u[0] + (n - 1 & 63) & M, u[1])
            v = (v[0] + u[0] & M, v[1])
            u = (u[0] + v[0] & M, u[1])
        x = rot(x + y + v[0] + w(at + 8) & M, 37) * m & M
        y = rot(y + v[1] + w(at + 48) & M, 42) * m & M
        x ^= u[1] * nine & M
        y = y + v[0] * nine + w(at + 40) & M
        z = rot(z + u[0] & M, 33) * m & M
        v = weak(s, at, v[1] * m & M, x + u[0] & M)
        u = weak(s, at + 32, z + u[1] & M, y + w(at + 16) & M)
        z, x, at = x, z, at + 64
    one = pair(v[0], u[0], m) + shift(y) * K0 + z & M
    return pair(one, pair(v[1], u[1], m) + x & M, m)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_published_values(spark):
    want = {
        "1footrue": -1541654101129638711,
        "2applefalse": 2794438866806483259,
        "3true": -4880158226897771312,
        "": signed(K2),
    }
    df = spark.createDataFrame([(s,) for s in [*want, None]], "s string")
    got = {r.s: r.h for r in df.select("s", farm_fingerprint("s").alias("h")).collect()}
    assert got == {**want, None: None}


def test_all_lengths():
    rnd = random.Random(3)
    texts = [rnd.randbytes(n) for n in [*range(200), 255, 256, 257, 1000, 5000]]
    rnd.shuffle(texts)
    values = pa.array([*texts, None, b""], pa.binary())
    want = [*(signed(slow(s)) for s in texts), None, signed(K2)]
    assert fingerprints(values).to_pylist() == want
    # A part of an array starts at an offset.
    assert fingerprints(values.slice(7, 90)).to_pylist() == want[7:97]
    assert fingerprints(pa.array([], pa.string())).to_pylist() == []


def test_sample_by_fingerprint(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(0, 0, 0, id * 0.5) AS t FROM range(3000)"
    ).unionByName(spark.sql("SELECT CAST(NULL AS TIMESTAMP_NTZ) AS t"))
    texts = [r[0] for r in df.select(time_text("t")).collect()]
    assert texts[0] == "2024-01-01 00:00:00+00" and texts[1] == "2024-01-01 00:00:00.500+00"
    want = sorted(s for s in texts if s and abs(signed(slow(s.encode()))) % 10 == 0)
    got = hash_sample(df, "t", 10, fingerprint="farm").select(time_text("t").alias("s"))
    assert sorted(r.s for r in got.collect()) == want and 200 < len(want) < 400
    by_text = df.select(F.col("t").cast("string").alias("s"))
    assert 200 < hash_sample(by_text, "s", 10, fingerprint="farm").count() < 400
