from __future__ import annotations

import datetime as dt
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from halala.operators import asof
from halala.operators.asof import asof_join

START = dt.datetime(2026, 1, 1)


def make_rows(seed: int, n: int, unit: dt.timedelta, span: int, unique: bool):
    rng = random.Random(seed)
    out, seen = [], set()
    for i in range(n):
        key = rng.choice(["A", "B", "C", "D", None])
        time = None if rng.random() < 0.05 else START + unit * rng.randrange(span)
        if unique and (key, time) in seen:
            continue
        seen.add((key, time))
        out.append((i, key, time))
    return out


def with_duckdb(left, right, strict: bool):
    l = pd.DataFrame(left, columns=["id", "k", "t"]).astype({"t": "datetime64[us]"})
    r = pd.DataFrame(right, columns=["rid", "k", "t", "v"]).astype({"t": "datetime64[us]"})
    con = duckdb.connect()
    con.register("l", l)
    con.register("r", r)
    compare = "<" if strict else "<="
    found = con.execute(
        f"SELECT l.id, r.rid, r.v FROM l ASOF LEFT JOIN r ON r.k = l.k AND r.t {compare} l.t ORDER BY l.id"
    ).fetchall()
    return [(i, None if rid is None else int(rid), v) for i, rid, v in found]


@pytest.mark.parametrize("kind", ["date", "date without calendar", "timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("strict", [False, True])
def test_matches_duckdb_on_random_rows(spark, monkeypatch, kind, strict):
    if kind == "date without calendar":
        monkeypatch.setattr(asof, "BROADCAST_ROWS", 10)
        kind = "date"
    unit = dt.timedelta(days=1) if kind == "date" else dt.timedelta(seconds=7, microseconds=13)
    left = make_rows(1, 3000, unit, 2000, unique=False)
    right = [(*row, None if row[0] % 9 == 0 else f"v{row[0]}") for row in make_rows(2, 700, unit, 2000, unique=True)]
    right = [(i, k, t, v) for i, k, t, v in right]
    l = spark.createDataFrame(left, "id int, k string, t timestamp_ntz").withColumn("t", F.col("t").cast(kind))
    r = spark.createDataFrame(right, "rid int, k string, t timestamp_ntz, v string").withColumn("t", F.col("t").cast(kind))
    joined = asof_join(l, r, ["k"], "t", "t", {"rid": "rid", "v": "v"}, strict=strict)
    found = sorted((x.id, x.rid, x.v) for x in joined.select("id", "rid", "v").collect())
    assert found == sorted(with_duckdb(left, right, strict))


def test_hot_key_and_repeated_probes(spark):
    """A third of the rows share one key and time, and none is lost."""
    left = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(20260110)).otherwise((20260101 + F.col("id") % 20).cast("int")).alias("t"),
    )
    right = spark.createDataFrame([("hot", 20260105, 1.5), ("hot", 20260111, 9.0), ("k1", 20260103, 2.0)], "k string, t int, v double")
    joined = asof_join(left, right, ["k"], "t", "t", {"v": "v"})
    assert joined.count() == 3000
    assert joined.where("k = 'hot' and v = 1.5").count() == 1000
    assert joined.where("k = 'k1' and v is null and t >= 20260103").count() == 0


def test_matched_row_with_nulls_stays_a_match(spark, rows):
    left = spark.createDataFrame([(1, "a", dt.date(2026, 1, 5))], "id int, k string, t date")
    right = spark.createDataFrame(
        [("a", dt.date(2026, 1, 1), 1.0), ("a", dt.date(2026, 1, 4), None)], "k string, t date, v double"
    )
    joined = asof_join(left, right, ["k"], "t", "t", {"t": "found_at", "v": "v"})
    assert rows(joined, "found_at", "v") == [(dt.date(2026, 1, 4), None)]


def test_empty_right_side(spark, rows):
    left = spark.createDataFrame([(1, "a", dt.date(2026, 1, 5))], "id int, k string, t date")
    right = spark.createDataFrame([], "k string, t date, v double")
    assert rows(asof_join(left, right, ["k"], "t", "t", {"v": "v"}), "id", "v") == [(1, None)]


def test_refuses_mixed_types_and_name_clashes(spark):
    left = spark.createDataFrame([(1, "a", dt.date(2026, 1, 5))], "id int, k string, t date")
    right = left.withColumn("t", F.col("t").cast("timestamp"))
    with pytest.raises(ValueError, match="type"):
        asof_join(left, right, ["k"], "t", "t", {"id": "other"})
    with pytest.raises(ValueError, match="exist"):
        asof_join(left, left, ["k"], "t", "t", {"id": "id"})
