"""Image listings, manifests, star join, scoring and roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import artworks as A
from tidemark.operators.cleaning import filter_artworks
from tidemark.plans.adapters import (
    ARTWORKS,
    CLASSES,
    CULTURE_SQL,
    ENRICHED,
    KEPT_OBJECTS,
    OBJECTS,
    RESULTS,
    Tables,
    score_sql,
)
from tidemark.plans.registry import query, with_ctes
from tidemark.sources.readers import image_manifest

SITE = "https?://[^/]+"
LANGS = ["en", "fr", "de", "es"]


@query(
    "image_manifest",
    f"""
SELECT 'images/' || path AS uri, split_part(path, '/', 1) AS label
FROM (SELECT regexp_extract(url, '^(?:{SITE})/?(.*)$', 1) AS path FROM pages)
WHERE path LIKE '%/%' AND split_part(path, '/', 1) IN ('en', 'fr', 'de', 'es')""",
)
def _(t: Tables):
    listing = t.raw("pages").select(F.col("url").alias("uri"))
    return image_manifest(listing, LANGS, SITE, "images/")


@query(
    "last_path_segment",
    "SELECT page_id, split_part(url, '/', -1) AS segment FROM pages",
)
def _(t: Tables):
    return t.raw("pages").select("page_id", S.last_path_segment("url").alias("segment"))


@query(
    "normalize_culture",
    with_ctes(OBJECTS, select=f"SELECT object_id, {CULTURE_SQL} AS culture FROM objects"),
)
def _(t: Tables):
    return t.objects().select("object_id", S.normalize_culture("culture").alias("culture"))


@query(
    "century_of",
    with_ctes(
        OBJECTS,
        select="SELECT object_id, (floor(object_begin_date / 100) + 1)::DOUBLE AS century FROM objects",
    ),
)
def _(t: Tables):
    return t.objects().select("object_id", S.century_of("object_begin_date").alias("century"))


@query(
    "extract_json_block",
    with_ctes(
        RESULTS,
        select=r"""
SELECT uri, nullif(regexp_extract(result, '\{[\s\S]*\}'), '') AS block FROM results""",
    ),
)
def _(t: Tables):
    return t.results().select("uri", S.json_block("result").alias("block"))


@query(
    "json_scores",
    with_ctes(RESULTS, select=f"SELECT uri, {', '.join(score_sql(n) for n in A.LABELS)} FROM parsed"),
)
def _(t: Tables):
    scores = [S.json_double("parsed_json", f"$.{n}.score").alias(n) for n in A.LABELS]
    return A.parse_results(t.results()).select("uri", *scores)


@query(
    "class_in_filter",
    with_ctes(
        OBJECTS,
        KEPT_OBJECTS,
        select="SELECT object_id, gcs_url, classification FROM kept",
    ),
)
def _(t: Tables):
    rows = t.objects().join(t.images().drop("title"), "object_id")
    return filter_artworks(rows, CLASSES).select("object_id", "gcs_url", "classification")


@query(
    "artwork_star_join",
    with_ctes(
        OBJECTS,
        select="""
SELECT f.uri, f.size, i.gcs_url, o.* FROM files f JOIN images i ON f.uri = i.gcs_url
JOIN objects o ON i.object_id = o.object_id""",
    ),
)
def _(t: Tables):
    return A.star_join(t.files(), t.images(), t.objects())


@query(
    "results_join",
    with_ctes(
        ARTWORKS,
        RESULTS,
        select="SELECT p.uri, a.object_id, a.title FROM parsed p JOIN artworks a ON p.uri = a.uri",
    ),
)
def _(t: Tables):
    return A.join_results(t.results(), t.artworks()).select("uri", "object_id", "title")


@query("enrich_results", with_ctes(ENRICHED, select="SELECT * FROM enriched"))
def _(t: Tables):
    # A VARIANT has no counterpart in the SQL check.
    return A.enrich_results(t.results(), t.artworks()).drop("parsed_json")


def counts_sql(names: list[str], thr: float) -> str:
    return ", ".join(f"count(CASE WHEN {n} >= {thr} THEN 1 END) AS {n}" for n in names)


SUBJECTS_SQL = f"""
SELECT culture, count(*) AS image_count, {counts_sql(A.SUBJECTS, A.SUBJECT_SCORE)}
FROM enriched WHERE culture IS NOT NULL GROUP BY culture HAVING count(*) >= 10"""


@query("conditional_counts", with_ctes(ENRICHED, select=SUBJECTS_SQL))
def _(t: Tables):
    enriched = A.enrich_results(t.results(), t.artworks())
    return A.conditional_counts(enriched, ["culture"], A.SUBJECTS, A.SUBJECT_SCORE)


@query("order_by_size", with_ctes(ENRICHED, select=SUBJECTS_SQL + " ORDER BY image_count DESC"))
def _(t: Tables):
    return A.culture_subjects(A.enrich_results(t.results(), t.artworks()))


@query(
    "conditional_counts_2key",
    with_ctes(
        ENRICHED,
        select=f"""
SELECT century, culture, count(*) AS image_count, {counts_sql(A.EMOTIONS, A.EMOTION_SCORE)}
FROM enriched WHERE century IS NOT NULL GROUP BY century, culture HAVING count(*) >= 10""",
    ),
)
def _(t: Tables):
    return A.century_culture_emotions(A.enrich_results(t.results(), t.artworks()))


def _object_json() -> str:
    items = ", ".join(
        f"""'"{n}": {{"score": ' || ((octet_length(encode(html)) + {i}) % 11 / 10)::DOUBLE::VARCHAR || '}}'"""
        for i, n in enumerate(A.LABELS)
    )
    return f"'{{' || concat_ws(', ', {items}) || '}}'"


@query("score_objects", f"SELECT url AS uri, {_object_json()} AS result FROM pages")
def _(t: Tables):
    """The pages stand in for stored objects."""
    objects = t.raw("pages").select(F.col("url").alias("uri"), F.encode("html", "UTF-8").alias("content"))
    return A.score_objects(objects, A.length_scorer())
