"""Left as-of join: for each row the latest known row at or before its time.

Three forms, none with a range join; the choice follows the type of the time and a counted size.

* Dates, few keys (rates per currency): every known row is repeated for the days it stays valid, so
  the lookup is plain equality on (key, day). The filled calendar is broadcast after its exact size
  was counted, and the left side is read once, without a shuffle.
* Dates beyond that bound, and YYYYMMDD keys: the left side is reduced to its distinct (key, time)
  probes. Probes and known rows are merged in time order per key and the last known row is carried
  forward; the answers go back to the left rows by equality. A key has at most one probe and one
  known row per calendar day, however many rows share the key, so the merge is per key.
* Timestamps: a key may have very many distinct times, so the merge is per (key, minute). Each
  minute starts from a carry row, found by the same merge over the last known rows of the day's
  earlier minutes, and each day from one found over the last known rows of earlier days. A merge
  holds the times of a minute, the minutes of a day or the days of a key, never a whole history.

The right side must be unique on (key, time), or `tie` must name the columns that decide: of equal
times the row counts that is greatest in them. NULL keys or times match nothing; such left rows
stay with NULLs. Either side may be read more than once: settle one that is costly to compute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halala.operators.lookup import BROADCAST_BYTES, BROADCAST_ROWS, checked_broadcast, known_size, row_bytes, settle
from halala.operators.pick import latest_by

_CARRY, _BEFORE, _PROBE, _AFTER = -1, 0, 1, 2
_TIE = "_tie"

# Answers to be broadcast at most: the driver holds them several times over, and by shuffle they are the small side.
ANSWER_ROWS = 250_000


def _answer_rows() -> int:
    return min(ANSWER_ROWS, BROADCAST_ROWS)



def _minute_of(time: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.floor(F.unix_seconds(time) / 60).cast("bigint")
    days = F.unix_date(time.cast("date")).cast("bigint")
    return days * 1440 + F.hour(time) * 60 + F.minute(time)


def _carry_forward(rows: DataFrame, group: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    running = (
        W.partitionBy(*group)
        .orderBy(F.col("_time").asc_nulls_first(), "_rank", *[F.col(t).asc_nulls_first() for t in ties])
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    carried = rows.withColumn("_hit", F.last("_known", ignorenulls=True).over(running))
    return carried.where((F.col("_rank") == _PROBE) & F.col("_hit").isNotNull())


def _merge(probes: DataFrame, known: DataFrame, group: Sequence[str], strict: bool, extra: DataFrame | None = None):
    ties = [c for c in known.columns if c.startswith(_TIE)]
    nothing = [F.lit(None).cast(known.schema[c].dataType).alias(c) for c in ["_known", *ties]]
    rows = probes.select("*", *nothing, F.lit(_PROBE).alias("_rank")).unionByName(
        known.withColumn("_rank", F.lit(_AFTER if strict else _BEFORE))
    )
    if extra is not None:
        rows = rows.unionByName(extra)
    return _carry_forward(rows, group, ties).drop(*ties)


def _carried(opening: DataFrame, keys: list[str], name: str, kind) -> DataFrame:
    """Carry rows: what is known when each `name` of a key begins."""
    return opening.select(
        *keys,
        F.lit(None).cast(kind).alias("_time"),
        F.col("_time").alias(name),
        F.col("_hit").alias("_known"),
        F.lit(_CARRY).alias("_rank"),
    )


def _merge_by_minute(probes: DataFrame, known: DataFrame, keys: list[str], strict: bool) -> DataFrame:
    kind = known.schema["_time"].dataType
    minute = _minute_of(F.col("_time"), kind).alias("_minute")
    probes, known = probes.select("*", minute), known.select("*", minute)

    day = F.floor(F.col("_minute") / 1440).cast("bigint")
    last_of_minute = known.groupBy(*keys, F.col("_minute")).agg(F.max_by("_known", "_time").alias("_known"))
    wanted = probes.select(*keys, "_minute").distinct()
    minutes, asked = (x.withColumn("_day", day).withColumnRenamed("_minute", "_time") for x in (last_of_minute, wanted))

    last_of_day = minutes.groupBy(*keys, F.col("_day")).agg(F.max_by("_known", "_time").alias("_known"))
    days = asked.select(*keys, "_day").distinct().withColumnRenamed("_day", "_time")
    opening = _merge(days, last_of_day.withColumnRenamed("_day", "_time"), keys, strict=True)
    opening = _merge(asked, minutes, [*keys, "_day"], True, _carried(opening, keys, "_day", "bigint"))
    carry = _carried(opening, keys, "_minute", kind)
    return _merge(probes, known, [*keys, "_minute"], strict, carry)


def _strict_date(known: DataFrame, strict: bool) -> DataFrame:
    return known.withColumn("_time", F.date_add("_time", 1)) if strict else known


def _calendar(known: DataFrame, keys: list[str]) -> tuple[DataFrame, Column] | None:
    """Known rows for every day from the first one of their key to the last day of all, and that
    day; None when this would not be small. Later days look up the last day."""
    last = known.agg(F.max("_time").alias("last")).first()["last"]
    if last is None:
        return None
    per_key = known.groupBy(*keys).agg(
        (F.datediff(F.lit(last), F.min("_time")) + 1).alias("days"), F.max(row_bytes(known)).alias("width")
    )
    size = per_key.agg(F.sum("days").alias("rows"), F.max("width").alias("width")).first()
    if size["rows"] > BROADCAST_ROWS or size["rows"] * size["width"] > BROADCAST_BYTES:
        return None
    following = F.lead("_time").over(W.partitionBy(*keys).orderBy("_time"))
    valid_to = F.coalesce(F.date_sub(following, 1), F.lit(last))
    filled = known.withColumn("_to", valid_to).where("_time <= _to")
    filled = filled.select(*keys, F.explode(F.sequence("_time", "_to")).alias("_time"), "_known")
    return F.broadcast(filled), F.lit(last)


def _may_be_few(source: DataFrame, asked: DataFrame) -> bool:
    """Whether the distinct rows can be within the bound of a broadcast, by their known size or a sketch with a wide
    margin; when they can, the answers are settled and counted, else that would be a copy of many rows for nothing."""
    size = known_size(source)
    if size is not None and size[0] <= _answer_rows():
        return True
    return asked.agg(F.approx_count_distinct(F.xxhash64(*asked.columns)).alias("n")).first()["n"] <= 1.25 * _answer_rows()


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    take: dict[str, str],
    strict: bool = False,
    tie: Sequence[str] = (),
    probes: DataFrame | None = None,
    few_ties: bool = False,
) -> DataFrame:
    """Attach `take` (right column -> output name) of the latest right row with
    right_time <= left_time (or <, when strict) and equal `on` columns.

    `probes` may name rows that hold the keys and times to be answered, where they are cheaper to read than the
    left side or fewer than its own: what is not among them stays without an answer.

    `few_ties` says that no key has many right rows of one time: of YYYYMMDD keys they are then told apart in the
    merge itself, without a shuffle of their own."""
    keys = list(on)
    kind = left.schema[left_time].dataType
    in_merge = list(tie) if few_ties and not isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) else []
    if tie and not in_merge:
        right = latest_by(right, [*keys, right_time], tie)
    if right.schema[right_time].dataType != kind:
        raise ValueError(f"as-of times differ in type: {left_time} and {right_time}")
    clash = set(take.values()) & set(left.columns)
    if clash:
        raise ValueError(f"as-of output columns already exist on the left: {sorted(clash)}")

    known = right.select(
        *keys,
        F.col(right_time).alias("_time"),
        F.struct(*[F.col(source).alias(name) for source, name in take.items()]).alias("_known"),
        *[F.col(c).alias(f"{_TIE}{i}") for i, c in enumerate(in_merge)],
    ).dropna(subset=[*keys, "_time"])

    if isinstance(kind, T.DateType):
        calendar = _calendar(_strict_date(known, strict), keys)
        if calendar is not None:
            filled, last = calendar
            day = F.when(F.col(left_time) > last, last).otherwise(F.col(left_time))
            joined = left.withColumn("_time", day).join(filled, [*keys, "_time"], "left")
            return joined.select(*left.columns, *[F.col("_known")[name].alias(name) for name in take.values()])

    source = left if probes is None else probes
    asked = source.select(*keys, F.col(left_time).alias("_time")).dropna()
    probes = asked.distinct()
    by_clock = isinstance(kind, (T.TimestampType, T.TimestampNTZType))
    answers = (_merge_by_minute if by_clock else _merge)(probes, known, keys, strict)
    answers = answers.select(*keys, F.col("_time").alias(left_time), "_hit.*")
    if not by_clock and _may_be_few(source, asked):
        # keys x calendar days: often small enough to spare the left side its shuffle
        answers = checked_broadcast(settle(answers), _answer_rows())
    return left.join(answers, [*keys, left_time], "left").select(*left.columns, *take.values())
