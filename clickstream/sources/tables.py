"""Parquet tables and the role mapping used by the query catalogue.

The catalogue runs the reference's programs over the driver's ``events`` table:
item / ad / url / book = ``k`` from ``props`` (``{"k": n}``), behaviour =
``event_type`` (``view`` is a page view), ``error`` is a failed login and every
other type a success, points = ``value``, ties in time broken by ``event_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickstream.functions.eventtime import ensure_utc


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def item_key(props: str = "props") -> F.Column:
    """``props.$.k`` as int: the item / ad / url / book key of an event."""
    return F.get_json_object(F.col(props), "$.k").try_cast("int")


def behaviour_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with the derived item key ``k``."""
    return read_table(spark, sf_dir, "events").withColumn("k", item_key())
