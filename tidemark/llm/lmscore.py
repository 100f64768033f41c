"""N-gram language model scores from Elias-Fano tries.

The model is an interpolated trigram model with Dirichlet smoothing: the unigram is
(c + 1/2) / (N + (V + 1)/2), and a longer context shares ``mu`` counts out by the
shorter one. How the counts get to the texts:

1. Documents are gathered into chunks of about ``chunk_tokens`` tokens, kept as word
   hashes and a stream of places in them.
2. Each chunk's distinct 1-, 2- and 3-grams are hashed, sorted and sent to the shard of
   their hash range, as Elias-Fano lists with the chunk's own training counts. A frequent
   n-gram arrives once per chunk. A shard adds the counts up over all chunks and answers
   each chunk with the totals alone, in the order in which it sent its n-grams.
3. A chunk builds the trie of what it can ask for, in a memory-mapped file: per level
   monotone pointers and ids in Elias-Fano form and 16-bit quantised log probabilities.
   A third word is stored as its rank among the successors of the second one. Its
   documents are scored by successor search.

Chunks and shards are bounded, and their numbers follow the input; raise both sizes
with the executors' memory, so that lists stay long. Words and longer n-grams meet by
64-bit hashes.

Defined results: a null or empty text is its end alone; a first word has no context; no
training text gives every word the probability one; rows that repeat are scored (and
learnt from) one by one; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import tempfile
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bytes_of, saved, saved_in_buckets

ORDER = 3
CHUNK_TOKENS = 1_000_000
SHARD_GRAMS = 1_000_000
MU = (256.0, 4.0)
END = xxhash.xxh64_intdigest(b"\n")
#: Quantised log10 probabilities: 16 bits from 0 down to this.
LEAST = -32.0
#: Bits of the hashes by which 2- and 3-grams meet; single words have 64.
HASH_BITS = 64
#: For the place of a bit in a word: masks, and the place of the k-th one of each byte.
_PAIRS, _FOURS, _BYTES, _ONES, _HIGHS = (
    np.uint64(0x0101010101010101 * m) for m in (0x55, 0x33, 0x0F, 0x01, 0x80)
)
_IN_BYTE = np.zeros((256, 8), np.uint64)
for _byte in range(256):
    _places = [k for k in range(8) if _byte >> k & 1]
    _IN_BYTE[_byte, : len(_places)] = _places
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class EliasFano:
    """A non-decreasing sequence: low bytes as they are, the rest as a unary bit array.

    The i-th value, with its high part h, sets bit h + i. A directory holds the number
    of ones before each 64-bit word. All parts are plain arrays, which can be mapped.
    """

    def __init__(self, n: int, low_bytes: int, low, high, ones) -> None:
        self.n, self.low_bytes, self.low, self.high, self.ones = n, low_bytes, low, high, ones

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        low_bytes = 0 if bits < 4 else -(-bits // 8)
        low = values.astype("<u8").view(np.uint8).reshape(n, 8)[:, :low_bytes].copy()
        # Eight spare bytes, so that any low part can be read as one 64-bit word.
        low = np.append(low.ravel(), np.zeros(8, np.uint8))
        top = (values >> np.uint64(8 * low_bytes)).astype(np.int64) if low_bytes < 8 else np.zeros(n, np.int64)
        size = int(top[-1]) + n + 1 if n else 1
        marks = np.zeros(-(-size // 64) * 64, np.uint8)
        marks[top + np.arange(n)] = 1
        high = np.packbits(marks, bitorder="little").view("<u8")
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high))]).astype(np.int64)
        return cls(n, low_bytes, low, high, ones)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bytes:
            return np.zeros(len(i), np.uint64)
        words = np.lib.stride_tricks.as_strided(
            self.low[:8].view("<u8"), (len(self.low) - 7,), (1,)
        )
        return words[i * self.low_bytes] & np.uint64((1 << 8 * self.low_bytes) - 1)

    def _select(self, k: np.ndarray, bit: int) -> np.ndarray:
        """Place of the k-th one or zero of the high bits."""
        before = self.ones if bit else 64 * np.arange(len(self.ones)) - self.ones
        word = np.searchsorted(before, k, "right") - 1
        left = (k - before[word]).astype(np.uint64)
        bits = self.high[word] if bit else ~self.high[word]
        # Ones in the first byte of the word, the first two, and so on, one sum per byte.
        sums = bits - (bits >> np.uint64(1) & _PAIRS)
        sums = (sums & _FOURS) + (sums >> np.uint64(2) & _FOURS)
        sums = (sums + (sums >> np.uint64(4)) & _BYTES) * _ONES
        # The high bit stays in each byte whose sum is not over the number looked for.
        passed = np.bitwise_count((left * _ONES | _HIGHS) - sums & _HIGHS).astype(np.uint64)
        passed = np.minimum(passed, np.uint64(7)) << np.uint64(3)
        left -= (sums << np.uint64(8)) >> passed & np.uint64(255)
        byte = bits >> passed & np.uint64(255)
        return word * 64 + (passed + _IN_BYTE[byte, np.minimum(left, np.uint64(7))]).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The i-th values."""
        top = (self._select(i, 1) - i).astype(np.uint64)
        return top << np.uint64(8 * self.low_bytes) | self._low(i)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of the first value equal to x, or -1."""
        x = x.astype(np.uint64)
        top = (x >> np.uint64(8 * self.low_bytes)).astype(np.int64)
        zeros = 64 * (len(self.ones) - 1) - int(self.ones[-1])
        inside = (top < zeros) & (self.n > 0)
        at = np.full(len(x), -1, np.int64)
        rows = np.flatnonzero(inside)
        top, low = top[rows], x[rows] & np.uint64((1 << 8 * self.low_bytes) - 1)
        # The values with this high part lie between two zeros of the bit array.
        stop = self._select(top, 0) - top
        here = np.where(top > 0, self._select(np.maximum(top - 1, 0), 0) - np.maximum(top - 1, 0), 0)
        # Successor search by halving between them.
        last = stop.copy()
        open_ = np.flatnonzero(here < last)
        while len(open_):
            a, b = here[open_], last[open_]
            middle = (a + b) >> 1
            less = self._low(middle) < low[open_]
            here[open_] = a = np.where(less, middle + 1, a)
            last[open_] = b = np.where(less, b, middle)
            open_ = open_[a < b]
        ok = here < stop
        ok[ok] = self._low(here[ok]) == low[ok]
        at[rows[ok]] = here[ok]
        return at

    def all(self) -> np.ndarray:
        """All values."""
        marks = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))
        top = (marks - np.arange(self.n)).astype(np.uint64)
        shift = 8 * self.low_bytes
        return (top << np.uint64(shift) if shift < 64 else top * 0) | self._low(np.arange(self.n))

    def parts(self) -> list[np.ndarray]:
        head = np.array([self.n, self.low_bytes, len(self.low), len(self.high)], np.int64)
        return [head, self.low, self.high, self.ones]

    def to_bytes(self) -> bytes:
        """Without the directory, which ``from_bytes`` makes anew."""
        return rising_to_bytes(self.all())

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        return cls.of(rising_from_bytes(data))


def rising_to_bytes(values: np.ndarray) -> bytes:
    """A non-decreasing sequence in Elias-Fano form, to be read as a whole.

    The low parts have whole bits instead of whole bytes: their full bytes stand value by
    value, the bits above those in planes.
    """
    values = values.astype("<u8")
    n = len(values)
    universe = int(values[-1]) + 1 if n else 1
    bits = min(63, max(0, (universe // max(n, 1)).bit_length() - 1))
    whole, rest = divmod(bits, 8)
    raw = values.view(np.uint8).reshape(n, 8)
    planes = (raw[:, whole] >> np.arange(rest, dtype=np.uint8)[:, None]) & 1
    top = (values >> np.uint64(bits)).astype(np.int64)
    marks = np.zeros(int(top[-1]) + n if n else 0, np.uint8)
    marks[top + np.arange(n)] = 1
    parts = (np.packbits(x, bitorder="little") for x in (planes.ravel(), marks))
    head = np.array([n, bits, len(marks)], "<u4")
    return b"".join(x.tobytes() for x in (head, raw[:, :whole], *parts))


def rising_from_bytes(data: bytes) -> np.ndarray:
    """The values that ``rising_to_bytes`` was given."""
    n, bits, size = np.frombuffer(data, "<u4", 3).tolist()
    whole, rest = divmod(bits, 8)
    raw, at = np.zeros((n, 8), np.uint8), 12 + n * whole
    raw[:, :whole] = np.frombuffer(data, np.uint8, n * whole, 12).reshape(n, whole)
    if rest:
        planes = np.frombuffer(data, np.uint8, -(-n * rest // 8), at)
        at += len(planes)
        planes = np.unpackbits(planes, count=n * rest, bitorder="little").reshape(rest, n)
        raw[:, whole] = np.bitwise_or.reduce(planes << np.arange(rest, dtype=np.uint8)[:, None])
    marks = np.unpackbits(np.frombuffer(data, np.uint8, -1, at), count=size, bitorder="little")
    top = (np.flatnonzero(marks) - np.arange(n)).astype(np.uint64)
    return top << np.uint64(bits) | raw.view("<u8").ravel()


def quantised(log10: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(log10 / LEAST, 0, 1) * 65535).astype(np.uint16)


def restored(codes: np.ndarray) -> np.ndarray:
    return codes * (LEAST / 65535)


class Trie:
    """Levels of words in memory-mapped arrays.

    ``prob[k]`` and ``back[k]`` are the quantised probability and back-off weight of
    each entry of level k. The entries below entry i of level k are those from
    pointer i to pointer i + 1 of ``pointers[k]``. Their ids rise within such a range;
    each is stored plus the number of ids that a range may hold times the range's entry,
    so that a level is one rising sequence and a search in a range is one search.
    """

    def __init__(self, arrays: dict) -> None:
        self.prob, self.back, self.pointers, self.ids = (
            arrays[k] for k in ("prob", "back", "pointers", "ids")
        )
        self.words = len(self.prob[0])

    @staticmethod
    def build(words: int, bigrams, trigrams, probs, backs) -> Trie:
        """bigrams (a, b), sorted; trigrams (entry of (a, b), entry of (b, c)), sorted."""
        a, b = bigrams
        starts = np.searchsorted(a, np.arange(words + 1))
        prefix, suffix = trigrams
        rank = suffix - starts[b[prefix]]  # among the successors of the middle word
        pointers = [
            EliasFano.of(starts),
            EliasFano.of(np.searchsorted(prefix, np.arange(len(a) + 1))),
        ]
        # Ranges need different room: the successors of the entry's own last word.
        room = np.append(0, np.cumsum((starts[1:] - starts[:-1])[b]))
        ids = [EliasFano.of(a * words + b), EliasFano.of(room[prefix] + rank)]
        arrays = {
            "prob": [quantised(p) for p in probs],
            "back": [quantised(x) for x in backs],
            "pointers": pointers,
            "ids": ids,
        }
        trie = Trie(arrays)
        trie.room = EliasFano.of(room)
        return trie

    def save(self, file) -> None:
        """The arrays one after the other, each with its type and length before it."""
        sequences = [*self.pointers, *self.ids, self.room]
        for array in [*self.prob, *self.back, *(p for s in sequences for p in s.parts())]:
            array = np.ascontiguousarray(array)
            head = f"{array.dtype.str:<4}{len(array):>12}".encode()
            pad = -(file.tell() + 16 + array.nbytes) % 8
            file.write(head + array.tobytes() + bytes(pad))
        file.flush()

    @staticmethod
    def open(path: str) -> Trie:
        mapped = np.memmap(path, np.uint8, "r")
        arrays, at = [], 0
        while at < len(mapped):
            head = mapped[at : at + 16].tobytes().decode()
            kind, n = np.dtype(head[:4].strip()), int(head[4:])
            arrays.append(mapped[at + 16 : at + 16 + n * kind.itemsize].view(kind))
            at += 16 + n * kind.itemsize
            at += -at % 8
        prob, back, rest = arrays[:3], arrays[3:5], arrays[5:]
        sequences = [
            EliasFano(int(h[0]), int(h[1]), low, high, ones)
            for h, low, high, ones in zip(*(rest[k::4] for k in range(4)))
        ]
        trie = Trie(
            {"prob": prob, "back": back, "pointers": sequences[:2], "ids": sequences[2:4]}
        )
        trie.room = sequences[4]
        return trie

    def bigram(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Entries of (a, b), or -1."""
        return self.ids[0].find(a * self.words + b)

    def trigram(self, prefix: np.ndarray, b: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        """Entries of the context (a, b) followed by c, or -1; from the entries of (a, b), (b, c)."""
        rank = suffix - self.pointers[0].get(b).astype(np.int64)
        return self.ids[1].find(self.room.get(prefix).astype(np.int64) + rank)

    def after_one(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entries, log10 probabilities) of b after a."""
        entry = self.bigram(a, b)
        out = restored(self.back[0][a]) + restored(self.prob[0][b])
        known = np.flatnonzero(entry >= 0)
        out[known] = restored(self.prob[1][entry[known]])
        return entry, out

    def after_two(self, b, prefix, suffix, shorter) -> np.ndarray:
        """log10 probabilities of c after (a, b), from the entries of (a, b) and of (b, c)
        and the log10 probability of c after b."""
        out = shorter.copy()
        known = np.flatnonzero(prefix >= 0)
        out[known] += restored(self.back[1][prefix[known]])
        both = known[suffix[known] >= 0]
        entry = self.trigram(prefix[both], b[both], suffix[both])
        both, entry = both[entry >= 0], entry[entry >= 0]
        out[both] = restored(self.prob[2][entry])
        return out


def packed(values: np.ndarray) -> bytes:
    """Unsigned integers, as many bytes wide as the largest needs, byte by byte of
    significance, compressed."""
    largest = int(values.max()) if len(values) else 0
    width = max(1, -(-largest.bit_length() // 8))
    whole = values.astype("<u4" if width <= 4 else "<u8")
    planes = whole.view(np.uint8).reshape(len(values), whole.itemsize).T[:width]
    body = zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())
    return bytes([width]) + body


def packed_counts(values: np.ndarray) -> bytes:
    """Unsigned integers that are mostly small: the number of bits of each, by Huffman's
    code, and the bits below the highest one in planes."""
    largest = int(values.max()) if len(values) else 0
    if largest >> 32:
        return packed(values)
    values = values.astype(np.uint32)
    size = np.frexp(values.astype(np.float64))[1].astype(np.uint8)
    coder = zlib.compressobj(6, zlib.DEFLATED, -9, 7, zlib.Z_HUFFMAN_ONLY)
    sizes = coder.compress(size.tobytes()) + coder.flush()
    planes = [values[size > b + 1] >> np.uint32(b) & np.uint32(1) for b in range(largest.bit_length() - 1)]
    bits = np.packbits(np.concatenate(planes).astype(np.uint8)).tobytes() if planes else b""
    return bytes([0]) + len(sizes).to_bytes(4, "little") + sizes + bits


def unpacked(data: bytes) -> np.ndarray:
    """The values that ``packed`` or ``packed_counts`` was given."""
    width = data[0]
    if not width:
        stop = 5 + int.from_bytes(data[1:5], "little")
        size = np.frombuffer(zlib.decompress(data[5:stop], -9), np.uint8)
        bits = np.unpackbits(np.frombuffer(data, np.uint8, -1, stop))
        out = np.where(size > 0, np.uint32(1) << np.maximum(size, 1).astype(np.uint32) - 1, 0).astype("<u4")
        at = 0
        for b in range(int(size.max()) - 1 if len(size) else 0):
            rows = np.flatnonzero(size > b + 1)
            out[rows] |= bits[at : at + len(rows)].astype(np.uint32) << np.uint32(b)
            at += len(rows)
        return out
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 4 if width <= 4 else 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u4" if width <= 4 else "<u8").ravel()


#: Words of up to so many tokens in a chunk are stored as one rising list per count.
RARE = 8


def packed_words(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """Word hashes by falling count, those with the same count rising."""
    borders = np.searchsorted(-counts, np.arange(-RARE, 2))
    parts = [hashes[: borders[0]].astype("<u8").tobytes()]
    parts += [rising_to_bytes(hashes[a:b]) for a, b in zip(borders[:-1], borders[1:])]
    return np.array([len(p) for p in parts], "<u4").tobytes() + b"".join(parts)


def unpacked_words(data: bytes) -> np.ndarray:
    sizes = np.frombuffer(data, "<u4", RARE + 2)
    stops = (4 * len(sizes) + np.cumsum(sizes, dtype=np.int64)).tolist()
    lists = [rising_from_bytes(data[a:b]) for a, b in zip(stops[:-1], stops[1:])]
    return np.concatenate([np.frombuffer(data, "<u8", sizes[0] // 8, 4 * len(sizes)), *lists])


def chunks(docs: DataFrame, learn: Column, text: str, id_col: str, chunk_tokens: int) -> DataFrame:
    """(chunk, ids, learn, sizes, words, stream, n): documents as places in a list of word hashes."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def gather(batches):
        part, number = TaskContext.get().partitionId(), 0
        place: dict[bytes, int] = {}
        ids, flags, sizes, stream = [], [], [], []

        def row():
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, place), np.uint64, len(place))
            hashes[0] = END
            # Frequent words first: their places are small numbers.
            tokens = np.concatenate(stream)
            counts = np.bincount(tokens, minlength=len(hashes))
            order = np.lexsort((hashes, -counts))
            to = np.empty(len(order), np.uint32)
            to[order] = np.arange(len(order))
            tokens = to[tokens]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part << 32 | number], pa.int64()),
                    pa.ListArray.from_arrays([0, len(ids)], pa.concat_arrays(ids)),
                    pa.array([np.array(flags, np.uint8).tobytes()], pa.binary()),
                    pa.array([np.array(sizes, "<u4").tobytes()], pa.binary()),
                    pa.array([packed_words(hashes[order], counts[order])], pa.binary()),
                    pa.array([packed(tokens)], pa.binary()),
                    pa.array([len(tokens)], pa.int64()),
                ],
                ["chunk", "ids", "learn", "sizes", "words", "stream", "n"],
            )

        held = 0
        for batch in batches:
            learns = batch.column(2).to_pylist()
            for k, t in enumerate(batch.column(1)):
                if not place:
                    place[b"\n"] = 0
                words = t.as_py().lower().split()
                at = list(map(place.get, words))
                if None in at:
                    for w, p in zip(words, at):
                        if p is None:
                            place.setdefault(w, len(place))
                    at = list(map(place.__getitem__, words))
                at.append(0)
                stream.append(np.array(at, np.uint32))
                ids.append(batch.column(0).slice(k, 1))
                flags.append(bool(learns[k]))
                sizes.append(len(at))
                held += len(at)
                if held >= chunk_tokens:
                    yield row()
                    number += 1
                    held = 0
                    for x in (place, ids, flags, sizes, stream):
                        x.clear()
        if held:
            yield row()

    return docs.select(F.col(id_col), bytes_of(text), learn).mapInArrow(
        gather,
        f"chunk long, ids array<{id_type}>, learn binary, sizes binary, words binary, "
        "stream binary, n long",
    )


@dataclass
class Grams:
    """Distinct n-grams of one order in a chunk, by hash; ``left`` and ``right`` name the
    (n-1)-grams they consist of, in the order of keys."""

    hashes: np.ndarray  # sorted
    counts: np.ndarray  # in learning documents, aligned with hashes
    by_key: np.ndarray  # place of each key's n-gram among the hashes
    keys: np.ndarray  # sorted: left * size + right
    ends: np.ndarray  # tokens at which one ends
    which: np.ndarray  # and its key


class Chunk:
    """The tokens of a chunk, and the n-grams in them."""

    def __init__(self, learn: bytes, sizes: bytes, words: bytes | np.ndarray, stream: bytes) -> None:
        self.learn = np.frombuffer(learn, np.uint8).astype(bool)
        self.sizes = np.frombuffer(sizes, "<u4").astype(np.int64)
        by_count = np.frombuffer(words, np.uint64)
        order = np.argsort(by_count, kind="stable")
        self.words = by_count[order]  # sorted hashes
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.tokens = place[unpacked(stream)]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.learnt = np.repeat(self.learn, self.sizes)
        #: Words of the same document before each token.
        self.before = np.arange(len(self.tokens)) - np.repeat(self.starts, self.sizes)

    def grams(self) -> list[Grams]:
        size = len(self.words)
        every = np.arange(size)
        n = np.bincount(self.tokens, self.learnt, size).astype(np.int64)
        tokens = np.arange(len(self.tokens))
        found = [Grams(self.words, n, every, every, tokens, self.tokens)]
        ids, hashes = self.tokens, self.words
        for order in range(2, ORDER + 1):
            # A longer n-gram is a shorter one and the next word.
            ends = np.flatnonzero(self.before >= order - 1)
            keys = ids[ends - 1] * size + self.tokens[ends]
            distinct, inverse = np.unique(keys, return_inverse=True)
            n = np.bincount(inverse, self.learnt[ends], len(distinct)).astype(np.int64)
            left, right = distinct // size, distinct % size
            hashed = (hashes[left] * _M1 ^ (self.words[right] + _M2)) * _M2
            hashed ^= hashed >> np.uint64(29)
            hashed *= _M1
            hashed &= np.uint64((1 << HASH_BITS) - 1 << 64 - HASH_BITS)
            by_hash = np.argsort(hashed)  # equal hashes get equal answers, in any order
            by_key = np.empty_like(by_hash)
            by_key[by_hash] = np.arange(len(by_hash))
            found.append(Grams(hashed[by_hash], n[by_hash], by_key, distinct, ends, inverse))
            ids = np.full(len(self.tokens), -1)
            ids[ends] = inverse
            hashes = hashed
        return found


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each hash; shards are ranges, so they rise with the hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def sent_grams(stored: DataFrame, shards: int) -> DataFrame:
    """(shard, chunk, level, grams, counts): each chunk's sorted hashes, cut by shard."""

    def send(batches):
        for batch in batches:
            for chunk, learn, sizes, words, stream in zip(*(c.to_pylist() for c in batch.columns)):
                own = Chunk(learn, sizes, unpacked_words(words), stream)
                for level, g in enumerate(own.grams()):
                    borders = np.searchsorted(shard_of(g.hashes, shards), np.arange(shards + 1))
                    rows = [
                        (
                            s,
                            rising_to_bytes(g.hashes[a:b] - g.hashes[a]),
                            g.hashes[a].tobytes() + packed_counts(g.counts[a:b]),
                        )
                        for s, (a, b) in enumerate(zip(borders[:-1], borders[1:]))
                        if b > a
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([r[0] for r in rows], pa.int64()),
                            pa.array([chunk] * len(rows), pa.int64()),
                            pa.array([level] * len(rows), pa.int32()),
                            pa.array([r[1] for r in rows], pa.binary()),
                            pa.array([r[2] for r in rows], pa.binary()),
                        ],
                        ["shard", "chunk", "level", "grams", "counts"],
                    )

    return stored.select("chunk", "learn", "sizes", "words", "stream").mapInArrow(
        send, "shard long, chunk long, level int, grams binary, counts binary"
    )


def summed(table: pa.Table) -> pa.Table:
    """One shard: the totals of each chunk's n-grams; level -1 carries V and N."""
    out = []
    rows = table.to_pydict()
    shard = rows["shard"][0]
    levels = np.array(rows["level"])
    for level in np.unique(levels):
        at = np.flatnonzero(levels == level)
        hashes = [
            rising_from_bytes(rows["grams"][i]) + np.frombuffer(rows["counts"][i], np.uint64, 1)
            for i in at
        ]
        borders = np.cumsum([len(h) for h in hashes])[:-1]
        hashes = np.concatenate(hashes)
        counts = np.concatenate([unpacked(rows["counts"][i][8:]) for i in at]).astype(np.int64)
        order = np.argsort(hashes)
        hashes = hashes[order]
        first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        sums = np.add.reduceat(counts[order], first)
        totals = np.empty(len(order), np.int64)
        totals[order] = np.repeat(sums, np.diff(np.append(first, len(order))))
        out += [
            (rows["chunk"][i], shard, int(level), packed_counts(t)) for i, t in zip(at, np.split(totals, borders))
        ]
        if level == 0:
            v_n = np.array([np.count_nonzero(sums), sums.sum()], np.int64)
            out.append((-1, shard, -1, v_n.tobytes()))
    chunk, shards, level, totals = zip(*out)
    return pa.table(
        {
            "chunk": pa.array(chunk, pa.int64()),
            "shard": pa.array(shards, pa.int64()),
            "level": pa.array(level, pa.int32()),
            "totals": pa.array(totals, pa.binary()),
        }
    )


def suffixes(chunk: Chunk, grams: list[Grams]) -> np.ndarray:
    """The 2-gram that each 3-gram ends with, by key."""
    at_token = np.empty(len(chunk.tokens), np.int64)
    at_token[grams[1].ends] = grams[1].which
    out = np.empty(len(grams[2].keys), np.int64)
    out[grams[2].which] = at_token[grams[2].ends]
    return out


def trie_of(
    chunk: Chunk, grams: list[Grams], suffix: np.ndarray, totals: list[np.ndarray], v: int, n: int, mu
) -> Trie:
    """The smoothed model of the n-grams that the chunk shares with the learning texts."""
    size = len(chunk.words)
    one = totals[0].astype(float)
    p1 = (one + 0.5) / (n + 0.5 * (v + 1))
    two = totals[1][grams[1].by_key]  # by key
    three = totals[2][grams[2].by_key]
    # A learnt 3-gram has learnt parts: one without them has met a stranger's hash.
    three = np.where((two[grams[2].keys // size] > 0) & (two[suffix] > 0), three, 0)
    kept2, kept3 = np.flatnonzero(two), np.flatnonzero(three)
    a, b = grams[1].keys // size, grams[1].keys % size
    p2 = (two + mu[0] * p1[b]) / (one[a] + mu[0])
    prefix, suffix = grams[2].keys[kept3] // size, suffix[kept3]
    p3 = (three[kept3] + mu[1] * p2[suffix]) / (two[prefix] + mu[1])
    to = np.cumsum(two > 0) - 1  # entries among the kept ones
    return Trie.build(
        size,
        (a[kept2], b[kept2]),
        (to[prefix], to[suffix]),
        [np.log10(p1), np.log10(p2[kept2]), np.log10(p3)],
        [np.log10(mu[0] / (one + mu[0])), np.log10(mu[1] / (two[kept2] + mu[1]))],
    )


def token_logs(chunk: Chunk, grams: list[Grams], suffix: np.ndarray, trie: Trie) -> np.ndarray:
    """log10 probability of each token: each distinct n-gram is searched once, in order."""
    size = len(chunk.words)
    a, b = grams[1].keys // size, grams[1].keys % size
    entry, two = trie.after_one(a, b)
    prefix = grams[2].keys // size
    three = trie.after_two(b[prefix], entry[prefix], entry[suffix], two[suffix])
    out = restored(trie.prob[0])[chunk.tokens]
    out[grams[1].ends] = two[grams[1].which]
    out[grams[2].ends] = three[grams[2].which]
    return out


def scored(
    docs: DataFrame,
    learn: Column,
    text: str = "text",
    id_col: str = "doc_id",
    chunk_tokens: int = CHUNK_TOKENS,
    shard_grams: int = SHARD_GRAMS,
    mu: tuple[float, float] = MU,
) -> DataFrame:
    """(id, learn, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    # In buckets, so that the chunks themselves are not shuffled when the answers come back.
    stored = saved_in_buckets(chunks(docs, learn, text, id_col, chunk_tokens), "chunks", "chunk")
    tokens = stored.agg(F.sum("n")).first()[0] or 0
    shards = max(32, ORDER * tokens // (2 * shard_grams))
    totals = saved(
        sent_grams(stored, shards)
        .groupBy("shard")
        .applyInArrow(summed, "chunk long, shard long, level int, totals binary"),
        "totals",
    )
    v = n = 0
    for row in totals.filter("level = -1").select("totals").toLocalIterator():
        here = np.frombuffer(row["totals"], np.int64)
        v, n = v + int(here[0]), n + int(here[1])
    id_type = docs.schema[id_col].dataType.simpleString()

    def score(own: pa.Table, answers: pa.Table) -> pa.Table:
        row = own.to_pylist()[0]
        chunk = Chunk(row["learn"], row["sizes"], unpacked_words(row["words"]), row["stream"])
        grams = chunk.grams()
        suffix = suffixes(chunk, grams)
        got: dict[int, list] = {level: [] for level in range(ORDER)}
        for a in sorted(answers.to_pylist(), key=lambda a: a["shard"]):
            got[a["level"]].append(unpacked(a["totals"]))
        counts = [
            np.concatenate(got[k]).astype(np.int64) if got[k] else np.zeros(0, np.int64)
            for k in range(ORDER)
        ]
        t = chunk.tokens
        with tempfile.NamedTemporaryFile(suffix=".trie") as file:
            trie_of(chunk, grams, suffix, counts, v, n, mu).save(file)
            logs = token_logs(chunk, grams, suffix, Trie.open(file.name))
        one = counts[0].astype(float)
        base = np.log10((one + 0.5) / (n + 0.5 * (v + 1)))
        by_doc = [
            np.add.reduceat(x, chunk.starts) for x in (counts[0][t] > 0, base[t], logs)
        ]
        return pa.table(
            {
                "id": own.column("ids").combine_chunks().flatten(),
                "learn": pa.array(chunk.learn),
                "n_tokens": pa.array(chunk.sizes),
                "n_known": pa.array(by_doc[0].astype(np.int64)),
                "base_score": pa.array(by_doc[1]),
                "score": pa.array(by_doc[2]),
            }
        )

    return (
        stored.groupBy("chunk")
        .cogroup(totals.filter("level >= 0").groupBy("chunk"))
        .applyInArrow(
            score,
            f"id {id_type}, learn boolean, n_tokens long, n_known long, base_score double, score double",
        )
        .withColumn("train_tokens", F.lit(n).cast("long"))
    )
