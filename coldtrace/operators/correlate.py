"""Requests matched with their responses.

A request is open until the next message of the same (client, type, id). A response that is this
next message and comes within the wait answers it. The match is a neighbour lookup in time order,
so no pairs are formed and one pass over the sorted messages is enough.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coldtrace.operators.hot import slice_in_order, split_hot, with_neighbours
from coldtrace.session import materialise

KEY = ["client", "msg_type", "msg_id"]
ORDER = ["at", "is_response", "seq"]
WAIT_SECONDS = 15


def _neighbours(messages: DataFrame) -> DataFrame:
    record = F.struct(*ORDER)
    inside = W.partitionBy(*KEY).orderBy(*ORDER)
    return messages.withColumn("previous", F.lag(record).over(inside)).withColumn(
        "following", F.lead(record).over(inside)
    )


def correlate(
    messages: DataFrame,
    wait_seconds: int = WAIT_SECONDS,
    hot: DataFrame | None = None,
    slices: int | None = None,
) -> DataFrame:
    """One row per request (Success with its latency, or Timeout) and per stray response (Failure).

    `messages`: client, msg_type, msg_id, at, is_response, seq. `hot` lists the oversized keys.
    """
    messages = messages.select(*KEY, *ORDER)
    if hot is not None:  # read once for the split
        messages = materialise(messages)
    ordinary, oversized = split_hot(messages, hot, KEY)
    paired = _neighbours(ordinary)
    if oversized is not None:
        sliced = slice_in_order(oversized, [*KEY, *ORDER], slices)
        paired = paired.unionByName(with_neighbours(sliced, KEY, ORDER, []).drop("slice"))
    wait = F.lit(wait_seconds * 1_000_000)

    def micros(column):
        return F.unix_micros(column)

    answered = F.coalesce(
        F.col("following.is_response")
        & (micros(F.col("following.at")) - micros(F.col("at")) <= wait),
        F.lit(False),
    )
    answers = F.coalesce(
        ~F.col("previous.is_response")
        & (micros(F.col("at")) - micros(F.col("previous.at")) <= wait),
        F.lit(False),
    )
    is_response = F.col("is_response")
    latency = F.ceil((micros(F.col("following.at")) - micros(F.col("at"))) / F.lit(1000))
    return paired.filter(~is_response | ~answers).select(
        *KEY,
        "seq",
        F.when(~is_response, F.col("at")).alias("request_at"),
        F.when(is_response, F.col("at")).when(answered, F.col("following.at")).alias("response_at"),
        F.when(is_response, "Failure").when(answered, "Success").otherwise("Timeout").alias("result"),
        F.when(~is_response & answered, latency).alias("latency_ms"),
    )
