"""Lateness rule: accept, quarantine or drop out-of-order events; collapse to state.

The rule is a batch rule on stored columns (arrival time minus event time),
not a watermark: a watermark drops late rows silently, this rule routes them
to a quarantine table with a reason.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import ColumnLike, not_null, whole_seconds
from strata.operators.keyed import latest_by
from strata.operators.merge import Matched

ROUTE = "route"
ACCEPTED, REJECTED, UNROUTABLE = "accepted", "rejected", "unroutable"


def lateness_hours(df: DataFrame, event_col: str = "event_time", arrival_col: str = "_ingested_at",
                   out: str = "lateness_hours") -> DataFrame:
    """``(unix_timestamp(arrival) - unix_timestamp(event)) / 3600.0``.

    Each side is truncated to whole seconds before subtracting; the result is
    a double and may be negative (arrival before the event clock).
    """
    return df.withColumn(out, (whole_seconds(arrival_col) - whole_seconds(event_col)) / F.lit(3600.0))


@dataclass
class Routed:
    """Deduplicated events with a ``route`` column, and the three views of it.

    ``routed`` can be written once partitioned by ``route``; ``over(df)``
    re-derives the views from such a materialised copy (each view is then a
    partition read).
    """

    routed: DataFrame
    base: list[str]
    reason: str
    rejected_at: Column

    def _view(self, route: str) -> DataFrame:
        return self.routed.filter(F.col(ROUTE) == route).select(*self.base)

    @property
    def accepted(self) -> DataFrame:
        return self._view(ACCEPTED)

    @property
    def rejected(self) -> DataFrame:
        return (self._view(REJECTED).withColumn("reject_reason", F.lit(self.reason))
                                    .withColumn("rejected_at", self.rejected_at))

    @property
    def unroutable(self) -> DataFrame:
        return self._view(UNROUTABLE)

    def over(self, routed: DataFrame) -> "Routed":
        return Routed(routed, self.base, self.reason, self.rejected_at)


def route_events(df: DataFrame, limit_hours: float = 48, key: str = "event_id",
                 event_col: str = "event_time", arrival_col: str = "_ingested_at",
                 required: Sequence[str] = ("order_id",),
                 order: Sequence[ColumnLike] | None = None,
                 tiebreak: Sequence[ColumnLike] | None = None,
                 reason: str | None = None, rejected_at: Column | None = None) -> Routed:
    """Split events by lateness in one pass.

    * accepted: lateness ≤ limit (inclusive) and ``required`` columns set;
    * rejected: lateness > limit (``required`` columns may be NULL), with
      ``reject_reason`` and ``rejected_at``;
    * unroutable: on time but missing a ``required`` column (the reference
      drops these; they are kept apart so nothing vanishes unseen).
    Rows with a NULL key, event time or arrival time are in none of them.

    Filtering precedes the per-key dedup, and the dedup key is ``(key,
    route)``: an event delivered once on time and once too late lands in both
    outputs, as with two independent filtered dedups, but from a single scan
    and a single shuffle.
    """
    order = list(order) if order is not None else [f"{arrival_col} DESC"]
    staged = lateness_hours(df, event_col, arrival_col)
    lat = F.col("lateness_hours")
    route = (F.when(lat <= F.lit(limit_hours),
                    F.when(not_null(list(required)), F.lit(ACCEPTED)).otherwise(F.lit(UNROUTABLE)))
              .when(lat > F.lit(limit_hours), F.lit(REJECTED)))
    staged = (staged.filter(not_null([key, event_col]))
                    .withColumn(ROUTE, route)
                    .filter(F.col(ROUTE).isNotNull()))
    routed = latest_by(staged, [key, ROUTE], order, tiebreak)
    reason = reason or f"arrived more than {limit_hours:g}h after {event_col}"
    rejected_at = rejected_at if rejected_at is not None else F.current_timestamp()
    base = [c for c in staged.columns if c != ROUTE]
    return Routed(routed, base, reason, rejected_at)


def collapse_events(df: DataFrame, key: str = "order_id", event_col: str = "event_time",
                    order: Sequence[str] = ("event_time", "_ingested_at"),
                    tiebreak: Sequence[str] = ("event_id",),
                    payload: Sequence[str] | None = None,
                    first_col: str = "first_event_time") -> DataFrame:
    """Current state per key: the latest event wins, the earliest event time is kept.

    One aggregation: ``max_by(struct(payload), struct(order…, tiebreak…))``
    and ``min(event_col)`` per key. It aggregates partially before the
    shuffle, so a key holding a large share of the events costs one partial
    row per input partition. Struct comparison puts NULL lowest, which is
    ``ORDER BY … DESC NULLS LAST``; ``order`` and ``tiebreak`` are all
    descending (latest wins).
    """
    payload = list(payload) if payload is not None else [c for c in df.columns if c != key]
    rank = F.struct(*[F.col(c) for c in list(order) + list(tiebreak)])
    agg = (df.groupBy(key)
             .agg(F.max_by(F.struct(*[F.col(c) for c in payload]), rank).alias("__latest"),
                  F.min(event_col).alias(first_col)))
    return agg.select(key, *[F.col("__latest")[c].alias(c) for c in payload], first_col)


def stream_orders(accepted: DataFrame, key: str = "order_id") -> DataFrame:
    """Accepted events → one silver order per key (stream provenance).

    total_amount = ROUND(quantity * unit_price, 2); order_ts = first event
    time; updated_at = arrival time of the winning event.
    """
    state = collapse_events(accepted, key=key,
                            payload=["customer_id", "product_id", "quantity", "unit_price", "status",
                                     "_ingested_at"])
    return state.select(
        key, "customer_id", "product_id", "quantity", "unit_price",
        F.round(F.col("quantity") * F.col("unit_price"), 2).alias("total_amount"),
        "status", F.col("first_event_time").alias("order_ts"),
        F.lit("stream").alias("source"), F.col("_ingested_at").alias("updated_at"))


STATE_RANK = ("event_time", "_ingested_at", "event_id")
STATE_PAYLOAD = ("customer_id", "product_id", "quantity", "unit_price", "status", "_ingested_at")


def order_state(events: DataFrame, key: str = "order_id") -> DataFrame:
    """What a set of events says about each order, in a form that merges: ``rank``
    of the latest event, its values ``latest``, and ``first_event_time``.

    The states of two sets merge to the state of their union (``fold_states``), in
    any order, and folding a set twice changes nothing. So a batch needs the stored
    state of its orders, never their earlier events.
    """
    rank = F.struct(*STATE_RANK)
    return (events.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.max(rank).alias("rank"), F.max_by(F.struct(*STATE_PAYLOAD), rank).alias("latest"),
                 F.min("event_time").alias("first_event_time")))


def fold_states(*states: DataFrame, key: str = "order_id") -> DataFrame:
    """One state per order from several tables of states."""
    every = states[0]
    for more in states[1:]:
        every = every.unionByName(more)
    return every.groupBy(key).agg(F.max("rank").alias("rank"), F.max_by("latest", "rank").alias("latest"),
                                  F.min("first_event_time").alias("first_event_time"))


def fold_clause() -> Matched:
    """``fold_states`` of a stored state and a batch's state, as a MERGE clause."""
    later = lambda c: lambda t, s: F.when(s["rank"] > t["rank"], s[c]).otherwise(t[c])
    return Matched(update={"rank": later("rank"), "latest": later("latest"),
                           "first_event_time": lambda t, s: F.least(t["first_event_time"], s["first_event_time"])})


def orders_of(state: DataFrame, key: str = "order_id") -> DataFrame:
    """The silver orders that states describe; ``orders_of(order_state(events))`` is ``stream_orders(events)``."""
    v = lambda c: F.col(f"latest.{c}").alias(c)
    return state.select(
        key, v("customer_id"), v("product_id"), v("quantity"), v("unit_price"),
        F.round(F.col("latest.quantity") * F.col("latest.unit_price"), 2).alias("total_amount"),
        v("status"), F.col("first_event_time").alias("order_ts"), F.lit("stream").alias("source"),
        F.col("latest._ingested_at").alias("updated_at"))


__all__ = ["ACCEPTED", "REJECTED", "UNROUTABLE", "ROUTE", "Routed", "collapse_events",
           "fold_clause", "fold_states", "lateness_hours", "order_state", "orders_of", "route_events", "stream_orders"]
