import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.data import documents, empty
from tidemark.llm import rangecoder as R
from tidemark.llm.tokens import Encoder


def sequences():
    rng = np.random.default_rng(1)
    yield np.zeros(1, np.uint32)
    yield np.zeros(500, np.uint32)
    yield np.full(300, R.NOTHING - 1, np.uint32)
    yield rng.integers(0, R.NOTHING, 700).astype(np.uint32)
    yield (rng.zipf(1.3, 900) % 50_000).astype(np.uint32)
    yield np.tile(np.arange(40, dtype=np.uint32), 30)
    yield np.arange(65_000, dtype=np.uint32)[::-1].copy()[:3000]


@pytest.mark.parametrize("block", [1, 7, 256, R.BLOCK])
def test_round_trip(block):
    for ids in sequences():
        parts = R.blocks_of(ids[: 60 * block], block)
        got = R.decode_blocks(R.encode_blocks(parts), [len(p) for p in parts])
        assert all((a == b).all() for a, b in zip(parts, got))


def test_random_lanes():
    rng = np.random.default_rng(2)
    for _ in range(10):
        size = int(rng.integers(1, 400))
        parts = [rng.integers(0, int(rng.integers(1, R.NOTHING)), size).astype(np.uint32) for _ in range(9)]
        parts.append(parts[0][: int(rng.integers(1, size + 1))])
        got = R.decode_blocks(R.encode_blocks(parts), [len(p) for p in parts])
        assert all((a == b).all() for a, b in zip(parts, got))


def test_blocks_stand_alone():
    ids = np.concatenate(list(sequences()))
    parts = R.blocks_of(ids, 512)
    codes = R.encode_blocks(parts)
    for k in (0, 3, len(parts) - 1):
        assert (R.decode_blocks([codes[k]], [len(parts[k])])[0] == parts[k]).all()


def test_predictable_ids_shrink():
    ids = np.tile(np.arange(100, dtype=np.uint32) * 300, 80)
    assert len(R.encode_blocks([ids])[0]) < len(ids) * 2 / 8


def test_damage_is_found_and_ids_are_bounded():
    table = pa.table({"id": [1], "n_tokens": [600]})
    data = R.file_bytes(table, np.arange(600, dtype=np.uint32) * 7 % 501, block=200)
    got, ids = R.file_content(data)
    assert got.equals(table) and len(ids) == 600
    broken = bytearray(data)
    broken[-150] ^= 1
    with pytest.raises(ValueError, match="block 2 is damaged"):
        R.file_content(bytes(broken))
    with pytest.raises(ValueError, match="not a file"):
        R.file_content(b"x" * 40)
    with pytest.raises(ValueError, match="below 65535"):
        R.encode_blocks([np.array([65535], np.uint32)])


@pytest.mark.parametrize("file_tokens", [50, R.FILE_TOKENS])
def test_rows_of_all_kinds(spark, file_tokens, tmp_path):
    docs = documents(spark)
    files = R.write_ids(docs, f"file://{tmp_path}/ids", file_tokens=file_tokens)
    files = spark.createDataFrame(files.collect())
    got = sorted(R.read_ids(files, "long", with_ids=True).collect(), key=lambda r: r["start"])
    tokenizer = Encoder().tokenizer
    rows = sorted(
        docs.select("doc_id", "text").collect(),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()),
    )
    at = 0
    for r, (i, text) in zip(got, rows):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, R.END_ID]
        assert (r["id"], r["start"], r["n_tokens"], r["ids"]) == (i, at, len(ids), ids)
        assert r["crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert len(got) == len(rows)


def test_no_documents(spark):
    assert R.round_trip(empty(spark)).count() == 0


def skewed(n):
    return (np.random.default_rng(5).zipf(1.3, n) % 50_000).astype(np.uint32)


def test_coding_an_id_costs_little():
    """CPU time of coding and of decoding, in that of sorting as many numbers."""
    ids = skewed(400_000)
    parts = R.blocks_of(ids, R.BLOCK)
    numbers = np.random.default_rng(6).random(len(ids))
    took = []
    for _ in range(3):
        marks = [time.process_time()]
        np.argsort(numbers, kind="stable")
        marks.append(time.process_time())
        codes = R.encode_blocks(parts)
        marks.append(time.process_time())
        R.decode_blocks(codes, [len(p) for p in parts])
        marks.append(time.process_time())
        took.append(np.diff(marks))
    sort, code, decode = np.min(took, axis=0)
    assert code < 12 * sort and decode < 12 * sort


def test_code_is_near_the_entropy():
    ids = skewed(400_000)
    p = np.bincount(ids) / len(ids)
    entropy = -(p[p > 0] * np.log2(p[p > 0])).sum()
    assert len(R.encode_blocks([ids])[0]) * 8 < (entropy + 0.75) * len(ids)


@pytest.mark.parametrize("n", [511, 512, 513, 767, 769, 70_000, R.LANES * R.LEAST_STEPS + 1])
def test_lanes_of_all_shapes(n):
    for ids in (skewed(n), np.arange(n, dtype=np.uint32) % R.NOTHING):
        assert (R.decode_blocks(R.encode_blocks([ids]), [n])[0] == ids).all()


def test_unlikely_ids_need_two_words():
    """Runs that make the last id of each as unlikely as the coder has it."""
    ids = np.zeros(300_000, np.uint32)
    ids[::997] = np.arange(len(ids[::997])) * 200 % R.NOTHING
    assert (R.decode_blocks(R.encode_blocks([ids]), [len(ids)])[0] == ids).all()


def test_ids_of_a_block_by_number_and_by_bit():
    rng = np.random.default_rng(7)
    last = R.NOTHING - 1
    for most, n in ((0, 1), (last, 1), (last, last + 1), (40, 30), (16, 17), (50_000, 3_000), (50_000, 9_000)):
        used = np.append(np.sort(rng.choice(most, n - 1, replace=False)) if n > 1 else [], most).astype(np.int64)
        data = np.append(R.named(used), [7, 8]).astype("<u2")
        got, rest = R.names(data)
        assert got.tolist() == used.tolist() and rest.tolist() == [7, 8]


def test_every_damaged_byte_is_found():
    ids = skewed(3000)
    data = R.file_bytes(pa.table({"id": [1], "n_tokens": [3000]}), ids)
    start = len(data) - len(R.encode_blocks([ids])[0])
    for k in np.random.default_rng(8).integers(start, len(data) - 16, 60):
        broken = bytearray(data)
        broken[k] ^= 1 << int(k) % 8
        with pytest.raises(ValueError, match="block 0 is damaged"):
            R.file_content(bytes(broken))
    with pytest.raises(ValueError, match="block 0 is damaged"):
        R.file_content(data[: start + 40])
