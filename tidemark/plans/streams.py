"""Streaming operators run over the event and chat files until they are used up."""

from __future__ import annotations

import os

from tidemark.operators import chat as H
from tidemark.plans.adapters import CATEGORIZED, KEYWORDS, Tables
from tidemark.plans.registry import query, with_ctes
from tidemark.session import shared_dir
from tidemark.streaming import categorize as SC
from tidemark.streaming import latest as SL

NEWEST = """
SELECT user_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""


def event_stream(t: Tables):
    stream = (
        t.spark.readStream.schema(t.raw("events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(t.sf_dir)
    )
    return stream.select("user_id", "ts", "event_type", "value")


@query("stream_latest_features", NEWEST)
def _(t: Tables):
    base = shared_dir(t.spark, "latest")
    sink, checkpoint = os.path.join(base, "view"), os.path.join(base, "checkpoint")
    SL.stream_latest(event_stream(t), "user_id", "ts", sink, checkpoint, once=True).awaitTermination()
    return SL.read_latest_view(t.spark, sink, "user_id", "ts")


@query("scheduled_sync", NEWEST)
def _(t: Tables):
    """Two runs of the scheduled job; the second finds nothing new."""
    base = shared_dir(t.spark, "sync")
    sink, checkpoint = os.path.join(base, "view"), os.path.join(base, "checkpoint")
    for _run in range(2):
        SL.sync_once(event_stream(t), "user_id", "ts", sink, checkpoint)
    return SL.read_latest_view(t.spark, sink, "user_id", "ts")


@query("stream_categorize", with_ctes(CATEGORIZED, select="SELECT * FROM categorized"))
def _(t: Tables):
    """The chat rows, written out once, arrive as a stream."""
    base = shared_dir(t.spark, "chat")
    source, sink = os.path.join(base, "source"), os.path.join(base, "categories")
    chat = t.chat()
    chat.write.parquet(source)
    stream = t.spark.readStream.schema(chat.schema).parquet(source)
    SC.stream_categorize(
        stream,
        H.keyword_scorer(KEYWORDS),
        sink,
        os.path.join(base, "checkpoint"),
        once=True,
    ).awaitTermination()
    return SC.read_categories(t.spark, sink)
