"""Sessions of a click stream, each sent once, when it is closed.

State is kept by session id and spans of event time: a click within ``gap`` of an open span of its session joins it,
and two spans that come to touch become one. A span is closed once the watermark, the latest event time seen less
``delay``, has passed its last click by ``gap``; it is then emitted and its state dropped.

A click later than the watermark is dropped, since its session may have been sent; Spark counts such rows in the
query's progress. A click of a session id that was closed, but later than ``gap``, opens a session of its own. All this is
an aggregate of Spark's; no Python runs in tasks. State holds the measures of the open sessions and the sets of
their pages, products and categories, so it grows with what is open, not with what was seen.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tradewind.functions import classify
from tradewind.plans.intermediate import session_facts, session_measures

GAP, DELAY = "30 minutes", "10 minutes"
FACETS = {"pages": "page_url", "products": "product_id", "categories": "category"}


def closing_sessions(clicks: DataFrame, gap: str = GAP, delay: str = DELAY,
                     active_events: int = classify.ACTIVE_SESSION_EVENTS) -> DataFrame:
    """One row per closed session, with the columns of ``int_clickstream_sessionized``; ``clicks`` are staged ones.

    Clicks without a time take no part. Those without a session id form sessions of their own. Of several users the one
    with most clicks counts, the smallest among equals. A batch of rows gives the sessions of all its clicks.
    """
    timed = clicks.where(F.col("event_timestamp").isNotNull()).withWatermark("event_timestamp", delay)
    spans = timed.groupBy(F.session_window("event_timestamp", gap).alias("span"), "session_id").agg(
        *session_measures(),
        *[F.collect_set(name).alias(facet) for facet, name in FACETS.items()],
        F.mode("user_id", deterministic=True).alias("user_id"),
    )
    counted = spans.withColumns({facet: F.size(facet).cast("bigint") for facet in FACETS})
    return session_facts(counted, active_events)


def land_sessions(sessions: DataFrame, path: str, checkpoint: str, trigger: Mapping | None = None) -> StreamingQuery:
    """Append closed sessions to a table. A restarted query goes on from its checkpoint, open sessions included."""
    return (
        sessions.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"})).start()
    )
