"""Image analysis results: star join, scoring, typed columns, roll-ups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S

# The scored labels.
LABELS = [
    "landscape",
    "plants",
    "buildings",
    "food",
    "people",
    "animals",
    "happiness",
    "love",
    "sadness",
    "fear",
    "mystery",
    "confusion",
    "bright",
    "dark",
]
# Labels, score threshold and smallest group of the two roll-ups.
SUBJECTS = ["landscape", "people", "food", "plants", "buildings", "animals"]
SUBJECT_SCORE = 0.8
EMOTIONS = ["happiness", "love", "sadness", "fear", "mystery", "confusion", "bright", "dark"]
EMOTION_SCORE = 0.6
MIN_GROUP = 10

Scorer = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def merging(df: DataFrame) -> DataFrame:
    """``df`` for a join by sort and merge.

    Spark's size check goes by the files, and texts can unfold to a hundred times
    that: it would have the driver hold them all for a broadcast.
    """
    return df.hint("merge")


def star_join(files: DataFrame, images: DataFrame, objects: DataFrame) -> DataFrame:
    """Stored files with their image and object rows."""
    found = merging(files).join(images.drop("title"), F.col("uri") == F.col("gcs_url"))
    return (
        merging(found)
        .join(objects, "object_id")
        .select(
            *files.columns,
            *[c for c in images.columns if c != "title"],
            *[c for c in objects.columns if c != "object_id"],
        )
    )


def length_scorer(labels: list[str] = LABELS) -> Scorer:
    """Scorer without a model: scores from the size of the content, a batch at a time."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size = batch["content"].str.len()
            cells = [
                f'"{label}": {{"score": ' + ((size + i) % 11 / 10).astype(str) + "}"
                for i, label in enumerate(labels)
            ]
            text = cells[0].str.cat(cells[1:], sep=", ") if cells else ""
            yield pd.DataFrame({"uri": batch["uri"], "result": "{" + text + "}"})

    return score


def score_objects(files: DataFrame, scorer: Scorer) -> DataFrame:
    """(uri, result): JSON text per stored object.

    Only here is the content of an object read. ``session.BASE_CONF`` bounds the
    batches by their bytes, since objects may be large.
    """
    return files.select("uri", "content").mapInPandas(scorer, "uri string, result string")


def parse_results(results: DataFrame) -> DataFrame:
    """Add ``parsed_json`` and drop results without a readable JSON object."""
    parsed = S.parse_json_safe(S.json_block("result"))
    # A generator drops the unreadable ones: a filter would be pushed below the
    # projection and parse every text a second time.
    readable = F.filter(F.array(parsed), lambda v: v.isNotNull())
    return results.withColumn("parsed_json", F.explode(readable))


def join_results(results: DataFrame, source: DataFrame) -> DataFrame:
    """Readable results with the columns of their object."""
    return merging(parse_results(results)).join(source, "uri")


def enrich_results(results: DataFrame, source: DataFrame, strict: bool = True) -> DataFrame:
    """Object columns, clean culture, century, and one double per label.

    The text is parsed once per row; all labels read the parsed value.
    """
    joined = join_results(results, source)
    return joined.select(
        "uri",
        "result",
        "parsed_json",
        "object_id",
        "title",
        "department",
        "artist_display_name",
        "artist_nationality",
        S.normalize_culture("culture").alias("culture"),
        "object_begin_date",
        "object_end_date",
        "medium",
        "classification",
        S.century_of("object_begin_date").alias("century"),
        *[S.json_double("parsed_json", f"$.{name}.score", strict).alias(name) for name in LABELS],
    )


def conditional_counts(
    df: DataFrame, by: list[str], cols: list[str], thr: float, min_n: int = MIN_GROUP
) -> DataFrame:
    """Rows per group, and per label the rows with at least ``thr``; small groups are left out."""
    return (
        df.where(F.col(by[0]).isNotNull())
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("image_count"),
            *[F.count_if(F.col(c) >= thr).alias(c) for c in cols],
        )
        .where(F.col("image_count") >= min_n)
    )


def culture_subjects(enriched: DataFrame) -> DataFrame:
    counts = conditional_counts(enriched, ["culture"], SUBJECTS, SUBJECT_SCORE)
    return counts.orderBy(F.desc("image_count"))


def century_culture_emotions(enriched: DataFrame) -> DataFrame:
    counts = conditional_counts(enriched, ["century", "culture"], EMOTIONS, EMOTION_SCORE)
    return counts.orderBy("culture")
