"""Byte-level BPE through a sentencepiece model that is written from a rank file.

The model is serialised directly from the vocabulary: each token's bytes are mapped to
printable characters, one per byte, and the piece is scored by its negative rank, so that
the library's merges (highest score first, leftmost of equals) are those of the rank file
(lowest rank first, leftmost of equals). Normalisation is the identity, without dummy
prefix or escaped spaces, and pieces stand in the order of their ranks, so that piece ids
are token ids. Texts are cut by the pre-token pattern; each distinct pre-token is given to
the model once per worker while its memory lasts. A pre-token that is a token as a whole is
that token. Ids are decoded by mapping each piece's characters back to bytes.

The model's bytes, about the size of the vocabulary file, are serialised on the driver and
sent to the workers once; a vocabulary over ``MAX_VOCABULARY`` bytes is refused. The rest is a
map over batches: no shuffle, and a lost executor costs its own batches.

Defined results: a null text is empty, and an empty text has no ids; long texts are encoded
whole; rows that repeat are encoded alike; an empty table gives an empty table. ``encoded``
returns every input row, once, with the column ``id`` and no other column of the input.
Ids that the vocabulary does not have are an error when they are decoded.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

VOCABULARY = "byte_bpe_50k.tiktoken"
MAX_VOCABULARY = 64 << 20
#: Pre-tokens that a worker remembers; longer ones are encoded anew each time.
REMEMBERED = 300_000
REMEMBERED_LENGTH = 64
#: Not of the byte alphabet, so no token has this name.
UNKNOWN = "⁇"


def byte_alphabet() -> list[str]:
    """The character of each byte: itself where it is visible, else the next one from U+0100."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(others)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file in the order of their ranks, which must be 0, 1, 2, ..."""
    with open(path, "rb") as file:
        content = file.read(MAX_VOCABULARY + 1)
    if len(content) > MAX_VOCABULARY:
        raise ValueError(f"{path} is over {MAX_VOCABULARY} bytes")
    pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, content.splitlines()))
    if [rank for rank, _ in pairs] != list(range(len(pairs))):
        raise ValueError(f"the ranks of {path} have gaps or repeat")
    return [token for _, token in pairs]


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def field(number: int, value: int | float | bytes) -> bytes:
    """One field of a protocol buffer: a varint, a 32-bit float or a string of bytes."""
    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3) + varint(value)


def serialised(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece ids are the places of the tokens.

    Field numbers and values are those of the library's public model format.
    """
    character = byte_alphabet()
    # ModelProto: 1 pieces (1 piece, 2 score, 3 type), 2 trainer, 3 normaliser.
    normal, unknown, bpe = 1, 2, 2
    out = [
        field(1, field(1, "".join(map(character.__getitem__, t)).encode()) + field(2, -float(k)) + field(3, normal))
        for k, t in enumerate(tokens)
    ]
    out.append(field(1, field(1, UNKNOWN.encode()) + field(2, -float(len(tokens))) + field(3, unknown)))
    # Trainer: 3 model type, 4 number of pieces, 40 id and 45 piece of the unknown.
    trainer = field(3, bpe) + field(4, len(tokens) + 1) + field(40, len(tokens)) + field(45, UNKNOWN.encode())
    # Normaliser: 1 name, 3 dummy prefix, 4 extra spaces removed, 5 spaces escaped.
    normaliser = field(1, b"identity") + field(3, 0) + field(4, 0) + field(5, 0)
    return b"".join([*out, field(2, trainer), field(3, normaliser)])


class Codec:
    """Encodes texts to ids, and decodes ids to bytes, with a serialised model."""

    def __init__(self, model: bytes, pattern: str) -> None:
        import regex
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=model)
        self.cut = regex.compile(pattern).findall
        self.character = dict(enumerate(byte_alphabet()))
        self.known: dict[str, bytes] = {}

    def pieces(self) -> list[str]:
        return [self.model.id_to_piece(k) for k in range(self.model.get_piece_size() - 1)]

    @cached_property
    def whole(self) -> dict[str, int]:
        """The id of each piece."""
        return {piece: k for k, piece in enumerate(self.pieces())}

    @cached_property
    def bytes_of(self) -> np.ndarray:
        """The bytes of each id."""
        inverse = {c: b for b, c in self.character.items()}
        return np.array([bytes(map(inverse.__getitem__, p)) for p in self.pieces()], object)

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers."""
        mapped = [w.encode().decode("latin-1").translate(self.character) for w in words]
        found = [self.whole.get(m) for m in mapped]
        split = iter(self.model.encode([m for m, k in zip(mapped, found) if k is None], num_threads=1))
        ids = [next(split) if k is None else [k] for k in found]
        return {w: np.array(i, "<u4").tobytes() for w, i in zip(words, ids)}

    def encode(self, text: str) -> bytes:
        words = self.cut(text)
        ids = list(map(self.known.get, words))
        if None in ids:
            new = self.learn(list({w for w, k in zip(words, ids) if k is None}))
            ids = [new[w] if k is None else k for w, k in zip(words, ids)]
            short = {w: k for w, k in new.items() if len(w) <= REMEMBERED_LENGTH}
            if len(self.known) + len(short) > REMEMBERED:
                self.known = {}
            if len(short) <= REMEMBERED:
                self.known.update(short)
        return b"".join(ids)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(self.bytes_of[np.frombuffer(ids, "<u4")].tolist())


class Model:
    """A serialised model as Spark sends it: each worker makes its codec once."""

    codecs: dict[int, Codec] = {}

    def __init__(self, spark, path: str | None = None, pattern: str | None = None) -> None:
        import public_tokenizers

        self.pattern = pattern or public_tokenizers.PATTERN
        self.sent = spark.sparkContext.broadcast(
            serialised(read_ranks(path or public_tokenizers.path(VOCABULARY)))
        )
        self.key = hash((self.sent.value, self.pattern))

    def codec(self) -> Codec:
        if self.key not in Model.codecs:
            Model.codecs[self.key] = Codec(self.sent.value, self.pattern)
        return Model.codecs[self.key]


def mapped(model: Model, step: str):
    """A column function that applies a method of the codec to each value."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        apply = getattr(model.codec(), step)
        for values in batches:
            yield pa.array([apply(v.as_py()) for v in values], pa.binary())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, BinaryType())


def encoded(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(id, ids): the token ids of each whole text, as little-endian unsigned 32-bit integers."""
    content = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("id"), mapped(model, "encode")(content).alias("ids"))


def decoded(rows: DataFrame, model: Model, ids: str = "ids") -> DataFrame:
    """``rows`` with ``data``, the bytes that the ids stand for."""
    return rows.withColumn("data", mapped(model, "decode")(F.col(ids)))
