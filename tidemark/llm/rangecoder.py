"""Token ids in files, compressed by an adaptive context-mixing range coder.

A block's ids are numbered (symbols from 1 on) and dealt to lanes, runs of nearly the same
length. A step codes one symbol of each lane, as numpy arrays, and the models that the
lanes share learn all of them after it. Two models predict the next symbol: what came last
after the same symbol (order 1) and after the same two (order 2). A symbol is first one of
three kinds, "as order 2 says", "as order 1 says" or neither; if neither, it is coded by how
often it was neither before (order 0). The kinds' probabilities are mixed from adaptive
counts: of the kind before, of how often order 2 has been right here, of how often order 1
has (twice: whether both say the same), and of these together. Every block starts from
empty models and has a checksum, so that each can be decoded alone.

The range coder's state is in 64-bit floats that hold whole numbers below 2**49, so that
every sum, product and quotient rounded down is exact. Probabilities of kinds and of symbols
have at most 12 and 20 bits, and a lane's range is never below 2**32 when a symbol comes.
All lanes share one stream of 16-bit words, in the order in which decoding asks for them.

``write_ids`` sorts documents by id over range partitions and writes files of bounded
size to one shared folder, each with its table of documents; ``read_ids`` decodes them.
Ids must be below 65535.

Defined results: a null or empty text is its end id alone; rows without an id come
first; rows that repeat an id are ordered by their text; no documents give no file;
extra columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved, shared_folder
from tidemark.llm.tokens import ArrowEncoder, crc32, encoder
from tidemark.llm.warc import file_system

END_ID = 2
#: Ids in one block, lanes of a block at most, and steps of a block with more than one lane.
BLOCK, LANES, LEAST_STEPS = 1 << 21, 4096, 256
#: Ids in one file.
FILE_TOKENS = 6_000_000
MAGIC = b"TMIDS2\0\0"
NOTHING = 0xFFFF
# Bits of the probabilities of kinds and, at most, of symbols; steps between new ones of kinds.
KIND_BITS, SYMBOL_BITS, EVERY = 12, 20, 16
KINDS = 3
#: Entries of order 2's predictions, as a power of two, and the highest confidence.
SLOT_BITS, SURE = 18, 7
#: Weight of the mixed rows beside the counts of all contexts together.
PRIOR = 64
LOW, WORD, FULL = 2.0**32, 2.0**16, 2.0**48
CONFIDENT, SAID = np.uint32(16), np.uint32(0xFFFF)


class Model:
    """Predictions and counts of a block of ``n`` symbols from 1 to ``size``."""

    def __init__(self, n: int, lanes: int, size: int) -> None:
        bits = min(SLOT_BITS, max(8, n.bit_length()))
        self.shift = np.uint32(32 - bits)
        # The confidence above the symbol; zero says nothing.
        self.said = [np.zeros(size + 1, np.uint32), np.zeros(1 << bits, np.uint32)]
        self.last = np.zeros(lanes, np.int64)
        self.hashes = np.zeros((2, lanes), np.uint32)
        self.kind = np.zeros(lanes, np.uint32)
        # By the kind before, the confidences in order 2 and 1, whether they say the same.
        self.counts = np.zeros((KINDS, SURE + 1, SURE + 1, 2, KINDS), np.int64)
        self.size, self.bits = size, min(SYMBOL_BITS, size.bit_length() + 4)
        self.seen = np.zeros(size + 1, np.int64)
        self.cells: list[np.ndarray] = []
        self.entries: list[np.ndarray] = []
        self.steps = self.coded = 0
        self.due = 64
        self.weigh()
        self.rank()

    def weigh(self) -> None:
        """New probabilities of the kinds, in whole numbers."""
        if self.cells:
            cells = np.bincount(np.concatenate(self.cells), minlength=self.counts.size)
            self.counts += cells.reshape(self.counts.shape)
            self.cells = []

        def share(row: np.ndarray) -> np.ndarray:
            return (row + 1 << 16) // (row + 1).sum(-1, keepdims=True)

        before = share(self.counts.sum((1, 2, 3)))[:, None, None, None]
        second = share(self.counts.sum((0, 2, 3)))[:, None, None]
        first = share(self.counts.sum((0, 1)))
        rows = (self.counts << 10) + (PRIOR * (before + second + first) >> 8) // 3 + 1
        width = 1 + rows * ((1 << KIND_BITS) - KINDS) // rows.sum(-1, keepdims=True)
        width[..., -1] += (1 << KIND_BITS) - width.sum(-1)
        self.kind_width = width.ravel().astype(np.float64)
        self.kind_start = (np.cumsum(width, -1) - width).ravel().astype(np.float64)

    def rank(self) -> None:
        """New probabilities of the symbols; entry 0, all of the range, is for none."""
        if self.entries:
            self.seen += np.bincount(np.concatenate(self.entries), minlength=self.size + 1)
            self.entries = []
        seen, all_ = self.seen[1:], 1 << self.bits
        # Those that never came share as much as those that came once have (Good and Turing).
        none, once = np.count_nonzero(seen == 0), np.count_nonzero(seen == 1)
        weight = np.where(seen, 64 * seen, 1 + 64 * once // max(none, 1))
        self.widths = 1 + weight * (all_ - self.size) // int(weight.sum())
        self.symbol_width = np.append(all_, self.widths).astype(np.float64)
        self.symbol_start = np.append(0, np.cumsum(self.widths) - self.widths).astype(np.float64)

    def symbols(self) -> np.ndarray:
        """The symbol of each place in the range."""
        return np.repeat(np.arange(1, self.size + 1, dtype=np.uint16), self.widths)

    def begin(self, m: int) -> np.ndarray:
        """Predictions for the next symbol in the first m lanes; their cells of counts."""
        slot = self.hashes[0, :m] ^ self.hashes[1, :m]
        slot >>= self.shift
        self.slots = [self.last[:m], slot.astype(np.int64)]
        found = [said.take(slot, mode="clip") for said, slot in zip(self.said, self.slots)]
        self.sure = [f >> CONFIDENT for f in found]
        for f in found:
            f &= SAID
        self.guess = found
        cell = self.kind[:m] * np.uint32(SURE + 1)
        cell += self.sure[1]
        cell *= np.uint32(SURE + 1)
        cell += self.sure[0]
        cell *= np.uint32(2)
        cell += found[0] == found[1]
        cell *= np.uint32(KINDS)
        return cell.astype(np.int64)

    def learn(self, kind: np.ndarray, cell: np.ndarray, now: np.ndarray, entry: np.ndarray) -> bool:
        """Whether the symbols have new probabilities."""
        m = len(now)
        for said, slot, sure, guess in zip(self.said, self.slots, self.sure, self.guess):
            np.minimum(sure, np.uint32(SURE - 1), out=sure)
            sure *= guess == now
            sure += np.uint32(1)
            sure <<= CONFIDENT
            sure |= now
            said[slot] = sure  # of lanes that meet here, the last one stays
        np.multiply(self.hashes[0, :m], np.uint32(0x85EBCA77), out=self.hashes[1, :m])
        np.multiply(now, np.uint32(0x9E3779B1), out=self.hashes[0, :m])
        self.last[:m] = now
        self.kind[:m] = kind
        self.cells.append(cell)
        self.entries.append(entry)
        self.coded += m
        self.steps += 1
        if self.steps < EVERY or self.steps % EVERY == 0:
            self.weigh()
        if self.coded < self.due:
            return False
        self.due = self.coded * 3 // 2
        self.rank()
        return True


def dealt(n: int) -> tuple[int, int, int]:
    """(lanes, steps, lanes in the last step) of a block of n ids."""
    lanes = max(1, min(LANES, n // LEAST_STEPS))
    steps = -(-n // lanes)
    return lanes, steps, n - lanes * (steps - 1)


def runs(flat: np.ndarray, grid: np.ndarray, tail: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(run of ids per lane, its columns of the grid): the first ``tail`` lanes have one more."""
    steps, lanes = grid.shape
    cut = tail * steps
    out = [(flat[:cut].reshape(tail, steps), grid[:, :tail].T)]
    if tail < lanes:
        out.append((flat[cut:].reshape(lanes - tail, steps - 1), grid[:-1, tail:].T))
    return out


def blocks_of(ids: np.ndarray, block: int) -> list[np.ndarray]:
    """Blocks of one length; only the last can be shorter."""
    return [ids[a : a + block] for a in range(0, len(ids), block)]


def named(used: np.ndarray) -> np.ndarray:
    """Rising ids as 16-bit integers: the last one, how many less one, and the shorter of
    the ids themselves and a bit for each id up to the last."""
    last, n = int(used[-1]), len(used)
    if n > last // 16 + 1:
        bits = np.zeros((last // 16 + 1) * 16, np.uint8)
        bits[used] = 1
        used = np.packbits(bits).view("<u2")
    return np.append([last, n - 1], used)


def names(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, what comes after them), from the integers that ``named`` made."""
    last, n = int(data[0]), int(data[1]) + 1
    words = min(n, last // 16 + 1)
    used = data[2 : 2 + words]
    if n > words:
        used = np.flatnonzero(np.unpackbits(used.view(np.uint8)))
        if len(used) != n:
            raise ValueError("not the ids of a block")
    return used.astype(np.uint32), data[2 + words :]


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """The code of each block."""
    return [encode_block(b) for b in blocks]


def encode_block(ids: np.ndarray) -> bytes:
    """Code of a block: its distinct ids, the first three words of each lane, and the
    stream; all in little-endian 16-bit integers."""
    if int(ids.max()) >= NOTHING:
        raise ValueError(f"ids must be below {NOTHING}")
    lanes, steps, tail = dealt(len(ids))
    count = np.bincount(ids)
    used = np.flatnonzero(count)
    number = np.zeros(len(count), np.uint32)
    number[used] = np.arange(1, len(used) + 1)
    grid = np.zeros((steps, lanes), np.uint32)
    for run, columns in runs(number.take(ids), grid, tail):
        columns[:] = run
    model = Model(len(ids), lanes, len(used))
    low_of, width_of, spare = np.zeros(lanes), np.full(lanes, FULL - 1), np.empty(lanes)
    # A step writes two words of a lane at most; row k has the k-th word of each lane.
    out = np.zeros((2 * steps + 4) * lanes, np.uint32)
    at = np.arange(lanes)
    asked = []
    for t in range(steps):
        m = lanes if t < steps - 1 else tail
        now, low, width, x = grid[t, :m], low_of[:m], width_of[:m], spare[:m]
        cell = model.begin(m)
        miss = model.guess[1] != now
        kind = miss.astype(np.uint32)
        miss &= model.guess[0] != now
        kind += miss
        cell += kind
        entry = (now * miss).astype(np.int64)
        for starts, widths, k, bits in (
            (model.kind_start, model.kind_width, cell, KIND_BITS),
            (model.symbol_start, model.symbol_width, entry, model.bits),
        ):
            width *= 2.0**-bits
            np.floor(width, out=width)
            starts.take(k, out=x, mode="clip")
            x *= width
            low += x
            widths.take(k, out=x, mode="clip")
            width *= x
        # Out go the top 16 of 48 bits of narrow lanes, and the carry above them.
        need = width < LOW
        while need.any():
            np.multiply(low, 1 / LOW, out=x)
            np.floor(x, out=x)
            rows = np.flatnonzero(need)
            place = at.take(rows)
            out[place] = x.take(rows).astype(np.uint32)
            asked.append(place)
            at[rows] = place + lanes
            more = need.astype(np.float64)
            x *= LOW
            x *= more
            low -= x
            more *= WORD - 1
            more += 1
            low *= more
            width *= more
            need = width < LOW
        model.learn(kind, cell, now, entry)
    # One more word names a number in the last range; what is not written is zero.
    out[at] = ((low_of + (LOW - 1)) / LOW).astype(np.uint32)
    out = out[: int(at.max()) + 1 + 3 * lanes]
    while len(over := np.flatnonzero(out >> np.uint32(16))):
        out[over] &= np.uint32(0xFFFF)
        out[over - lanes] += np.uint32(1)
    # Decoding begins with three words of a lane and is that much ahead.
    places = np.concatenate(asked) + 3 * lanes if asked else np.zeros(0, np.int64)
    parts = [named(used), out[: 3 * lanes], out.take(places, mode="clip")]
    return b"".join(p.astype("<u2").tobytes() for p in parts)


def decode_blocks(codes: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The ids of each block."""
    return [decode_block(c, n) for c, n in zip(codes, sizes)]


def decode_block(code: bytes, n: int) -> np.ndarray:
    lanes, steps, tail = dealt(n)
    data = np.frombuffer(code, "<u2")
    used, words = names(data)
    size = len(used)
    first = words[: 3 * lanes].reshape(3, lanes).astype(np.float64)
    stream = np.append(words[3 * lanes :], np.uint16(0))
    # What the code is above the lower end of the range.
    past_of = (first[0] * WORD + first[1]) * WORD + first[2]
    width_of, spare = np.full(lanes, FULL - 1), np.empty(lanes)
    model = Model(n, lanes, size)
    symbols = model.symbols()
    grid = np.zeros((steps, lanes), np.uint32)
    choice, lane = np.zeros((KINDS, lanes), np.uint32), np.arange(lanes)
    done = 0
    for t in range(steps):
        m = lanes if t < steps - 1 else tail
        now, past, width, x = grid[t, :m], past_of[:m], width_of[:m], spare[:m]
        cell = model.begin(m)
        width *= 2.0**-KIND_BITS
        np.floor(width, out=width)
        target = past / width
        model.kind_start[1:].take(cell, out=x, mode="clip")
        kind = (target >= x).astype(np.int64)
        model.kind_start[2:].take(cell, out=x, mode="clip")
        miss = target >= x
        kind += miss
        cell += kind
        model.kind_start.take(cell, out=x, mode="clip")
        x *= width
        past -= x
        model.kind_width.take(cell, out=x, mode="clip")
        width *= x
        width *= 2.0**-model.bits
        np.floor(width, out=width)
        np.divide(past, width, out=x)
        choice[0, :m], choice[1, :m] = model.guess[1], model.guess[0]
        choice[2, :m] = symbols.take(x.astype(np.int64), mode="clip")
        pick = kind * lanes
        pick += lane[:m]
        choice.ravel().take(pick, out=now, mode="clip")
        entry = (now * miss).astype(np.int64)
        model.symbol_start.take(entry, out=x, mode="clip")
        x *= width
        past -= x
        model.symbol_width.take(entry, out=x, mode="clip")
        width *= x
        need = width < LOW
        while need.any():
            place = np.cumsum(need)
            asked = int(place[-1])
            place += done - 1
            done += asked
            more = need.astype(np.float64)
            got = stream.take(place, mode="clip").astype(np.float64)
            got *= more
            more *= WORD - 1
            more += 1
            past *= more
            past += got
            width *= more
            need = width < LOW
        if model.learn(kind, cell, now, entry):
            symbols = model.symbols()
    ids = np.zeros(n, np.uint32)
    for run, columns in runs(ids, grid, tail):
        run[:] = columns
    return used.take(ids - np.uint32(1))


def file_bytes(table: pa.Table, ids: np.ndarray, block: int | None = None) -> bytes:
    """A file: its table of documents (id, n_tokens), then blocks with their checksums.

    Layout, little-endian: magic; bytes of the table (u32); number of blocks (u32); the
    table as an Arrow stream; per block its ids (u32), bytes (u32) and the CRC-32 of its
    ids (u32); the blocks' codes.
    """
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    head = sink.getvalue().to_pybytes()
    parts = blocks_of(ids, block or BLOCK)
    codes = encode_blocks(parts)
    entries = [struct.pack("<3I", len(p), len(c), crc32(p)) for p, c in zip(parts, codes)]
    return b"".join([MAGIC, struct.pack("<2I", len(head), len(codes)), head, *entries, *codes])


def file_content(data: bytes) -> tuple[pa.Table, np.ndarray]:
    """(table of documents, ids) of a file; raises ValueError if a block is damaged."""
    if data[:8] != MAGIC:
        raise ValueError("not a file of token ids")
    n_head, n_blocks = struct.unpack_from("<2I", data, 8)
    table = pa.ipc.open_stream(data[16 : 16 + n_head]).read_all()
    at = 16 + n_head
    entries = [struct.unpack_from("<3I", data, at + 12 * k) for k in range(n_blocks)]
    at += 12 * n_blocks
    blocks = []
    for k, (n, size, check) in enumerate(entries):
        try:
            with np.errstate(all="ignore"):  # what a damaged block gives is not used
                blocks += decode_blocks([data[at : at + size]], [n])
        except (ValueError, IndexError):
            blocks.append(None)
        if blocks[-1] is None or crc32(blocks[-1]) != check:
            raise ValueError(f"block {k} is damaged")
        at += size
    return table, np.concatenate(blocks) if blocks else np.zeros(0, np.uint32)


def write_ids(
    docs: DataFrame,
    folder: str,
    text: str = "text",
    id_col: str = "doc_id",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """(path, part, number, n_tokens) of the files; (part, number) is their order by id."""

    def write(batches):
        part = TaskContext.get().partitionId()
        system, base = file_system(folder)
        system.create_dir(base, recursive=True)
        enc = encoder(tokenizer, ArrowEncoder)
        names: list = []
        held: list[np.ndarray] = []
        done = []

        def close() -> None:
            sizes = np.array([len(x) for x in held], np.int64)
            table = pa.table({"id": pa.concat_arrays(names), "n_tokens": pa.array(sizes)})
            name = f"ids-{part:05d}-{len(done):05d}-{uuid.uuid4().hex}.tmids"
            with system.open_output_stream(f"{base}/{name}", compression=None) as out:
                out.write(file_bytes(table, np.concatenate(held)))
            done.append((f"{folder}/{name}", int(sizes.sum())))
            names.clear()
            held.clear()

        size = 0
        for batch in batches:
            for k, ids in enumerate(enc.batches(batch.column(1))):
                held.append(np.append(ids, np.uint32(end_id)))
                names.append(batch.column(0).slice(k, 1))
                size += len(held[-1])
                if size >= file_tokens:
                    close()
                    size = 0
        if held:
            close()
        if done:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p for p, _ in done]),
                    pa.array([part] * len(done), pa.int32()),
                    pa.array(range(len(done)), pa.int32()),
                    pa.array([n for _, n in done], pa.int64()),
                ],
                ["path", "part", "number", "n_tokens"],
            )

    return (
        docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
        .repartitionByRange("id")
        .sortWithinPartitions("id", "text")
        .mapInArrow(write, "path string, part int, number int, n_tokens long")
    )


def read_ids(files: DataFrame, id_type: str, with_ids: bool = False) -> DataFrame:
    """(id, start, n_tokens, crc32[, ids]) of the documents in the files.

    ``start`` counts the ids of all documents before; it comes from the files' sizes.
    """
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select(
        "path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")).alias("before")
    )

    def read(batches):
        for batch in batches:
            for path, first in zip(*(c.to_pylist() for c in batch.columns)):
                system, place = file_system(path)
                with system.open_input_stream(place, compression=None) as stream:
                    table, ids = file_content(stream.read())
                sizes = table.column("n_tokens").to_numpy()
                starts = np.cumsum(sizes) - sizes
                parts = [ids[a : a + s] for a, s in zip(starts, sizes)]
                columns = [
                    table.column("id").combine_chunks(),
                    pa.array(starts + first),
                    pa.array(sizes),
                    pa.array([zlib.crc32(p.astype("<u4").tobytes()) for p in parts], pa.int64()),
                ]
                names = ["id", "start", "n_tokens", "crc32"]
                if with_ids:
                    columns.append(pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"id {id_type}, start long, n_tokens long, crc32 long" + ", ids array<int>" * with_ids
    return placed.repartition(max(1, files.count())).mapInArrow(read, schema)


def round_trip(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """What ``read_ids`` finds in the files that ``write_ids`` made of all documents."""
    folder = shared_folder(docs.sparkSession, "ids")
    files = saved(write_ids(docs, folder, text, id_col), "files")
    return read_ids(files, docs.schema[id_col].dataType.simpleString())
