"""Language of texts: multinomial naive Bayes over hashed character n-grams.

Training counts every n-gram of every learning document, adds up within a task and
then per (language, hash bucket). The matrix of log probabilities has a fixed width
and one row per learnt language; its size is checked before it is broadcast. Scoring
gathers the matrix columns of a batch's n-grams at once and adds them up per text.

Defined results: ``und`` with score 0 if the text is null or has no letter, or if no
language was learnt; ties go to the language that sorts first; texts are read whole;
a null language teaches nothing; rows that repeat count each time; an empty table
gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDERS = (1, 2, 3)
BITS = 16
SMOOTHING = 0.5
UNKNOWN = "und"
#: Bytes of the matrix that may be broadcast: 256 languages at 16 bits.
MAX_MATRIX = 256 * (1 << BITS) * 8
#: N-grams that are looked up at once.
CHUNK = 1 << 20
# Odd multipliers of the hash, one per character of an n-gram.
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def _folded() -> np.ndarray:
    """Code points below 0x10000: letters in lower case, all others as a space."""
    out = np.full(1 << 16, 32, np.uint32)
    for c in range(1 << 16):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


_FOLD: np.ndarray | None = None


def code_points(text: str) -> np.ndarray:
    global _FOLD
    if _FOLD is None:
        _FOLD = _folded()
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    return np.where(points < (1 << 16), _FOLD[np.minimum(points, 0xFFFF)], points)


def buckets(text: str, orders=ORDERS, bits: int = BITS):
    """Hash buckets of the n-grams of " text ", in arrays of about ``CHUNK`` n-grams."""
    points = code_points(f" {text} ")
    longest = max(orders)
    for at in range(0, len(points), CHUNK):
        part = points[at : at + CHUNK + longest - 1].astype(np.uint32)
        for n in orders:
            size = min(CHUNK, len(part) - n + 1)
            if size <= 0:
                continue
            h = np.full(size, n, np.uint32)
            for k in range(n):
                h = (h ^ part[k : k + size]) * _FACTORS[k]
                h ^= h >> np.uint32(15)
            yield (h >> np.uint32(32 - bits)).astype(np.int32)


def ngram_counts(
    docs: DataFrame, learn: Column, text: str, lang: str, orders=ORDERS, bits: int = BITS
) -> DataFrame:
    """(lang, bucket, n) over all documents that ``learn`` selects; bucket -1 counts documents."""

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for t, name in zip(batch.column(0), batch.column(1).to_pylist()):
                of = totals.setdefault(name, np.zeros((1 << bits) + 1, np.int64))
                of[-1] += 1
                for found in buckets(t.as_py(), orders, bits):
                    of[:-1] += np.bincount(found, minlength=1 << bits)
        for name, of in totals.items():
            at = np.flatnonzero(of)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(at), pa.string()),
                    pa.array(np.where(at == 1 << bits, -1, at), pa.int32()),
                    pa.array(of[at]),
                ],
                ["lang", "bucket", "n"],
            )

    return (
        docs.filter(learn & F.col(lang).isNotNull() & F.col(text).isNotNull())
        .select(F.col(text), F.col(lang).cast("string"))
        .mapInArrow(count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )


@dataclass
class Model:
    langs: list[str]
    prior: np.ndarray  # log share of the documents
    matrix: np.ndarray  # [bucket, lang]: log probability
    orders: tuple[int, ...]
    bits: int

    def posterior(self, text: str) -> np.ndarray:
        """Probability of each language."""
        score = self.prior.copy()
        for found in buckets(text, self.orders, self.bits):
            # A sparse row of counts times the matrix, as a sum over the n-grams there.
            at, n = np.unique(found, return_counts=True) if len(found) > 4096 else (found, None)
            rows = self.matrix[at]
            score += rows.sum(0) if n is None else n @ rows
        score = np.exp(score - score.max())
        return score / score.sum()

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or text is None or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        p = self.posterior(text)
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def train(
    docs: DataFrame,
    learn: Column,
    text: str = "text",
    lang: str = "lang",
    orders=ORDERS,
    bits: int = BITS,
    smoothing: float = SMOOTHING,
    max_matrix: int = MAX_MATRIX,
) -> Model:
    """The model of the documents that ``learn`` selects, with additive smoothing."""
    counts = ngram_counts(docs, learn, text, lang, orders, bits).persist()
    shares = counts.filter("bucket = -1").orderBy("lang").collect()
    langs = [r["lang"] for r in shares]
    width = 1 << bits
    if len(langs) * width * 8 > max_matrix:
        counts.unpersist()
        raise ValueError(f"the matrix of {len(langs)} languages is over {max_matrix} bytes")
    documents = np.array([r["n"] for r in shares], float)
    matrix = np.full((width, len(langs)), smoothing)
    for k, name in enumerate(langs):
        got = counts.filter((F.col("lang") == name) & (F.col("bucket") >= 0)).toPandas()
        matrix[got["bucket"], k] += got["n"]
    counts.unpersist()
    return Model(
        langs,
        np.log(documents / max(1, documents.sum())),
        np.log(matrix / matrix.sum(0)) if langs else matrix,
        tuple(orders),
        bits,
    )


def predicted(
    docs: DataFrame, model: Model, text: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """(id, lang, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def score(batches):
        for batch in batches:
            got = [shared.value.predict(t.as_py()) for t in batch.column(1)]
            langs, scores = zip(*got) if got else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["id", "lang", "score"],
            )

    return docs.select(F.col(id_col).alias("id"), F.col(text)).mapInArrow(
        score, f"id {id_type}, lang string, score double"
    )
