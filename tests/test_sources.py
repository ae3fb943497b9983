"""The Tables helpers: hand-made frames, overrides for tables from another
source (e.g. a second database), and the zone-less timestamp rule."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import types as T

from tokoledger.sources.tables import from_frames, zone_less


def test_from_frames_and_overrides(spark):
    items = spark.createDataFrame([("G1", 5)], "redeem_code string, point int")
    users = spark.createDataFrame([("u1", "T1")], "user_id string, outlet_id string")
    t = from_frames(redeem_item=items)
    assert t["redeem_item"] is items
    with pytest.raises(KeyError):
        t["user_info"]
    t2 = t.with_overrides(user_info=users)
    assert t2["user_info"] is users and t2["redeem_item"] is items


def test_zone_less_turns_zoned_timestamps_into_wall_clock(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 1, 9, 0),)], "ts timestamp")
    out = zone_less(df)
    assert isinstance(out.schema["ts"].dataType, T.TimestampNTZType)
    assert out.first().ts == dt.datetime(2024, 2, 1, 9, 0)
