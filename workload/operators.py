"""Single operators as registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from halala.functions import amounts, casts, documents, keys
from halala.operators import reshape
from halala.operators.asof import asof_join
from halala.operators.lookup import attach
from halala.operators.pick import latest_by, prefer_by
from halala.plans.fx import rebased
from workload.inputs import chosen, epoch_of, table
from workload.registry import register

# ---- as-of joins ----------------------------------------------------------------------------

DAILY_RATE = """
    SELECT CAST(o_orderdate AS DATE) AS rate_date, o_orderpriority AS code, max(o_totalprice) AS rate
    FROM orders GROUP BY ALL"""


def daily_rate(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("rate_date"), F.col("o_orderpriority").alias("code"))
        .agg(F.max("o_totalprice").alias("rate"))
    )


@register(
    "asof_daily_rate",
    f"""
    SELECT l.l_orderkey, l.l_linenumber, l.day, l.code, r.rate_date, r.rate, l.l_extendedprice * r.rate AS value
    FROM (SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(l_shipdate AS DATE) - 400 AS day,
                 o_orderpriority AS code
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey) AS l
    ASOF LEFT JOIN ({DAILY_RATE}) AS r ON r.code = l.code AND r.rate_date <= l.day""",
)
def asof_daily_rate(spark: SparkSession, folder: str) -> DataFrame:
    """Every line at the latest daily rate of its order's priority; early lines have none."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderpriority").alias("code"))
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        F.date_sub(F.col("l_shipdate").cast("date"), 400).alias("day"),
    )
    lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    valued = asof_join(lines, daily_rate(spark, folder), ["code"], "day", "rate_date", {"rate_date": "rate_date", "rate": "rate"})
    return valued.withColumn("value", F.col("l_extendedprice") * F.col("rate")).drop("l_extendedprice")


QUOTES_SQL = """
    SELECT p.event_id, p.user_id, p.value AS paid, q.event_id AS quote_id, q.value AS quoted
    FROM (SELECT * FROM events WHERE event_type NOT IN ('view', 'signup')) AS p
    ASOF LEFT JOIN (SELECT {key} AS user_id, ts, max(event_id) AS event_id, arg_max(value, event_id) AS value
                    FROM events WHERE event_type IN ('view', 'signup') GROUP BY ALL) AS q
      ON q.user_id = {asked} AND q.ts <= p.ts"""


def _quoted_events(events: DataFrame, key: str) -> DataFrame:
    """Events that ask for a price with the latest quote of their key; of equal times the greater event."""
    asked = events.where(~F.col("event_type").isin("view", "signup"))
    asked = asked.select("event_id", "user_id", *({key} - {"user_id"}), "ts", F.col("value").alias("paid"))
    quotes = events.where(F.col("event_type").isin("view", "signup"))
    take = {"event_id": "quote_id", "value": "quoted"}
    joined = asof_join(asked, quotes, [key], "ts", "ts", take, tie=["event_id"])
    return joined.select("event_id", "user_id", "paid", "quote_id", "quoted")


@register("asof_event_quote", QUOTES_SQL.format(key="user_id", asked="p.user_id"))
def asof_event_quote(spark: SparkSession, folder: str) -> DataFrame:
    """Every other event with its user's latest quote, on timestamps."""
    return _quoted_events(table(spark, folder, "events"), "user_id")


@register("asof_hot_key", QUOTES_SQL.format(key="0", asked="0"))
def asof_hot_key(spark: SparkSession, folder: str) -> DataFrame:
    """The same with one key for all events, so one key's history is all there is."""
    return _quoted_events(table(spark, folder, "events").withColumn("market", F.lit(0)), "market")


@register(
    "position_latest_price",
    """
    SELECT p.user_id, p.day, p.event_type, p.quantity, coalesce(m.price, 0) AS price,
           round(p.quantity * coalesce(m.price, 0), 4) AS value
    FROM (SELECT user_id, CAST(ts AS DATE) AS day, event_type,
                 sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS quantity
          FROM events GROUP BY ALL) AS p
    ASOF LEFT JOIN (SELECT event_type, CAST(ts AS DATE) AS day, arg_max(value, ts) AS price
                    FROM events GROUP BY ALL) AS m
      ON m.event_type = p.event_type AND m.day <= p.day""",
)
def position_latest_price(spark: SparkSession, folder: str) -> DataFrame:
    """Daily positions at the latest price on or before the day."""
    events = table(spark, folder, "events").withColumn("day", F.col("ts").cast("date"))
    quantity = documents.text_at(documents.document("props"), "k").cast("bigint")
    positions = events.groupBy("user_id", "day", "event_type").agg(F.sum(quantity).alias("quantity"))
    prices = (
        events.groupBy("event_type", "day")
        .agg(F.max_by("value", "ts").alias("price"))
    )
    priced = asof_join(positions, prices, ["event_type"], "day", "day", {"price": "found"})
    price = F.coalesce("found", F.lit(0.0))
    return priced.select(
        "user_id", "day", "event_type", "quantity", price.alias("price"), F.round(F.col("quantity") * price, 4).alias("value")
    )


# ---- one row per key ------------------------------------------------------------------------

LATEST_COPY = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST(l_shipdate AS DATE) AS shipped
    FROM lineitem
    QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1"""
LATEST_KEYS = ["l_orderkey", "l_linenumber"]
LATEST_ORDER = ["shipped", "l_partkey", "l_suppkey", "l_extendedprice"]


def copies(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        F.col("l_shipdate").cast("date").alias("shipped"),
    )


@register("latest_copy", LATEST_COPY)
def latest_copy(spark: SparkSession, folder: str) -> DataFrame:
    return latest_by(copies(spark, folder), LATEST_KEYS, LATEST_ORDER)


@register(
    "prefer_by_priority",
    """
    SELECT code, min(priority) AS priority, arg_min(origin, priority) AS origin
    FROM (SELECT c_mktsegment AS code, 2 AS priority, 'segment' AS origin FROM customer
          UNION ALL SELECT p_type, 1, 'type' FROM part
          UNION ALL SELECT p_brand, 1, 'brand' FROM part
          UNION ALL SELECT unnest(['ECONOMY', 'MACHINERY', 'GOLD']), 0, 'fixed') AS c
    GROUP BY code""",
)
def prefer_by_priority(spark: SparkSession, folder: str) -> DataFrame:
    """Codes from several sources; the most trusted source names each."""
    customer, part = table(spark, folder, "customer"), table(spark, folder, "part")
    fixed = spark.createDataFrame([("ECONOMY",), ("MACHINERY",), ("GOLD",)], "code string")

    def named(df: DataFrame, column: str, priority: int, origin: str) -> DataFrame:
        return df.select(F.col(column).alias("code"), F.lit(priority).alias("priority"), F.lit(origin).alias("origin"))

    offered = reshape.stack_rows(
        named(customer, "c_mktsegment", 2, "segment"),
        named(part, "p_type", 1, "type"),
        named(part, "p_brand", 1, "brand"),
        named(fixed, "code", 0, "fixed"),
    )
    return prefer_by(offered, ["code"], ["priority", "origin"])


# ---- exchange rates -------------------------------------------------------------------------


@register(
    "fx_rebase",
    f"""
    WITH quoted AS ({DAILY_RATE})
    SELECT q.rate_date, q.code, round(q.rate / b.rate, 6) AS rate
    FROM quoted AS q JOIN quoted AS b ON b.rate_date = q.rate_date AND b.code = '1-URGENT'""",
)
def fx_rebase(spark: SparkSession, folder: str) -> DataFrame:
    """A day's document of rates, restated against another base, rounded to six digits."""
    entry = F.struct("code", "rate")
    # one entry per code, since the rates are aggregated per code
    by_day = daily_rate(spark, folder).groupBy("rate_date").agg(F.map_from_entries(F.collect_list(entry)).alias("rates"))
    quoted = by_day.where(F.map_contains_key("rates", "1-URGENT"))
    return quoted.select("rate_date", F.explode(rebased(F.col("rates"), "1-URGENT")).alias("code", "rate"))


# ---- documents ------------------------------------------------------------------------------


@register(
    "json_text_typed",
    """
    SELECT event_id, json_extract_string(props, '$.k') AS k_text,
           try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k,
           json_extract_string(props, '$.missing') AS missing,
           try_cast(event_type AS DOUBLE) AS not_a_number
    FROM events""",
)
def json_text_typed(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumn("doc", documents.document("props"))
    return events.select(
        "event_id",
        documents.text_at("doc", "k").alias("k_text"),
        casts.bigint_or_null(documents.text_at("doc", "k")).alias("k"),
        documents.text_at("doc", "missing").alias("missing"),
        casts.double_or_null("event_type").alias("not_a_number"),
    )


@register("json_object_rows", f"SELECT rate_date, code, rate FROM ({DAILY_RATE}) AS r")
def json_object_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One document per day with its rates as an object, read back as rows."""
    entries = F.map_from_entries(F.collect_list(F.struct("code", "rate")))
    docs = daily_rate(spark, folder).groupBy("rate_date").agg(F.to_json(F.struct(entries.alias("rates"))).alias("raw"))
    parsed = docs.select("rate_date", documents.document("raw").alias("doc"))
    rows = documents.explode_members(parsed, documents.members(documents.node_at("doc", "rates")), "code", "text")
    return rows.select("rate_date", "code", casts.double_or_null("text").alias("rate"))


@register(
    "json_two_level_rows",
    """
    SELECT user_id, CAST(ts AS DATE) AS day, event_type, count(*) AS events,
           CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k
    FROM events GROUP BY ALL""",
)
def json_two_level_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One document per user, an object of days holding an object of event types."""
    k = documents.text_at(documents.document("props"), "k").cast("bigint")
    daily = (
        table(spark, folder, "events")
        .groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type")
        .agg(F.count(F.lit(1)).alias("events"), F.sum(k).alias("k"))
    )
    # entries are bounded by the event types of a day, then by the days of a user
    by_day = daily.groupBy("user_id", "day").agg(
        F.map_from_entries(F.collect_list(F.struct("event_type", F.struct("events", "k").alias("seen")))).alias("types")
    )
    docs = by_day.groupBy("user_id").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("day", "types")))).alias("raw")
    )
    days = documents.explode_members(docs, documents.text_members("raw"), "day", "types").select("user_id", "day", "types")
    types = documents.explode_members(days, documents.text_members("types"), "event_type", "seen")
    seen = F.from_json("seen", "map<string,string>")
    return types.select(
        "user_id",
        casts.date_or_null("day").alias("day"),
        "event_type",
        casts.bigint_or_null(seen["events"]).alias("events"),
        casts.bigint_or_null(seen["k"]).alias("k"),
    )


# ---- scalar expressions ---------------------------------------------------------------------


@register(
    "epoch_to_timestamp",
    """
    SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS seen_at,
           CAST(ts AS DATE) AS day
    FROM events""",
)
def epoch_to_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    """Epoch seconds in text, back to naive UTC timestamps."""
    seconds = epoch_of("ts").cast("bigint").cast("string")
    events = table(spark, folder, "events").select("event_id", seconds.alias("epoch"))
    at = casts.epoch_to_naive("epoch")
    return events.select(
        "event_id", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("seen_at"), at.cast("date").alias("day")
    )


@register(
    "text_to_types",
    """
    SELECT o_orderkey, CAST(round(o_totalprice, 1) AS DOUBLE) AS price, CAST(o_orderdate AS DATE) AS day,
           epoch(o_orderdate) + 34200 AS ordered_epoch,
           CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS flag,
           try_cast(o_orderpriority AS BIGINT) AS not_a_number, try_cast('2026' AS DATE) AS no_full_date
    FROM orders""",
)
def text_to_types(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as text, cast back; what does not parse becomes NULL."""
    text = table(spark, folder, "orders").select(
        "o_orderkey",
        F.round("o_totalprice", 1).cast("string").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T09:30:00+00:00")).alias("ordered"),
        chosen("o_orderstatus", {"F": "true", "O": "false"}, "perhaps").alias("flag"),
        "o_orderpriority",
    )
    return text.select(
        "o_orderkey",
        casts.decimal_or_null("price", 4).cast("double").alias("price"),
        casts.date_or_null("day").alias("day"),
        epoch_of(casts.naive_timestamp_or_null("ordered")).alias("ordered_epoch"),
        casts.boolean_or_null("flag").alias("flag"),
        casts.bigint_or_null("o_orderpriority").alias("not_a_number"),
        casts.date_or_null(F.left("day", F.lit(4))).alias("no_full_date"),
    )


@register(
    "surrogate_keys",
    """
    SELECT o_orderkey,
           md5(o_orderkey || '-' || coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END,
                                             '_dbt_utils_surrogate_key_null_') || '-' || o_orderpriority) AS order_key,
           md5(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END) AS status_key
    FROM orders""",
)
def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return table(spark, folder, "orders").select(
        "o_orderkey",
        keys.surrogate_key("o_orderkey", status, "o_orderpriority").alias("order_key"),
        keys.hashed(status).alias("status_key"),
    )


@register(
    "exact_amounts",
    """
    SELECT l_orderkey, l_linenumber, l_linestatus,
           CAST(CAST(l_quantity AS DECIMAL(18,4)) * CAST(l_extendedprice AS DECIMAL(18,4)) AS VARCHAR) AS gross,
           CAST(CAST(CAST(l_orderkey AS DECIMAL(18,0)) + 123456789012345 AS DECIMAL(19,4)) * CAST(l_extendedprice AS DECIMAL(18,4)) AS VARCHAR) AS large,
           CAST(CASE l_linestatus WHEN 'O' THEN l_quantity WHEN 'F' THEN -l_quantity END AS DOUBLE) AS signed_quantity,
           round(l_extendedprice / l_quantity, 9) AS unit_price
    FROM lineitem""",
)
def exact_amounts(spark: SparkSession, folder: str) -> DataFrame:
    side = chosen("l_linestatus", {"O": "BUY", "F": "SELL"})
    quantity, price = F.col("l_quantity").cast("decimal(38,4)"), F.col("l_extendedprice").cast("decimal(38,4)")
    large = (F.col("l_orderkey") + F.lit(123456789012345)).cast("decimal(38,4)")  # 15 integer digits
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_linestatus",
        amounts.exact_product(quantity, price).cast("string").alias("gross"),
        amounts.exact_product(large, price).cast("string").alias("large"),
        amounts.signed_quantity(side, quantity).cast("double").alias("signed_quantity"),
        F.round(amounts.ratio(price, quantity), 9).alias("unit_price"),
    )


# ---- set operations -------------------------------------------------------------------------


@register(
    "unpivot_measures",
    """
    SELECT l_returnflag, l_linestatus, measure, count(*) AS n, round(sum(amount), 2) AS total
    FROM (SELECT l_returnflag, l_linestatus,
                 unnest(['quantity', 'price', 'discount', 'tax']) AS measure,
                 unnest([l_quantity, l_extendedprice, CASE WHEN l_discount > 0 THEN l_discount END, l_tax]) AS amount
          FROM lineitem) AS m
    WHERE amount IS NOT NULL GROUP BY ALL""",
)
def unpivot_measures(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").withColumn(
        "l_discount", F.when(F.col("l_discount") > 0, F.col("l_discount"))
    )
    labels = {"l_quantity": "quantity", "l_extendedprice": "price", "l_discount": "discount", "l_tax": "tax"}
    long = reshape.columns_to_rows(lines, ["l_returnflag", "l_linestatus"], labels, "measure", "amount", "double")
    return long.groupBy("l_returnflag", "l_linestatus", "measure").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("total")
    )


@register(
    "widened_union",
    """
    SELECT kind, count(*) AS n, round(sum(amount), 2) AS total
    FROM (SELECT 'order' AS kind, CAST(CAST(o_totalprice AS DECIMAL(38,6)) AS DOUBLE) AS amount FROM orders
          UNION ALL SELECT 'line', l_extendedprice FROM lineitem) AS u
    GROUP BY kind""",
)
def widened_union(spark: SparkSession, folder: str) -> DataFrame:
    """Decimal and double amounts in one column, as double."""
    orders = table(spark, folder, "orders").select(
        F.lit("order").alias("kind"), F.col("o_totalprice").cast("decimal(38,6)").cast("double").alias("amount")
    )
    lines = table(spark, folder, "lineitem").select(F.lit("line").alias("kind"), F.col("l_extendedprice").alias("amount"))
    both = reshape.stack_rows(orders, lines)
    return both.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("total"))


@register(
    "code_union",
    """
    SELECT code, md5(code) AS code_key
    FROM (SELECT c_mktsegment AS code FROM customer UNION SELECT o_orderpriority FROM orders
          UNION SELECT p_type FROM part UNION SELECT event_type FROM events) AS c
    WHERE code IS NOT NULL""",
)
def code_union(spark: SparkSession, folder: str) -> DataFrame:
    sources = [("customer", "c_mktsegment"), ("orders", "o_orderpriority"), ("part", "p_type"), ("events", "event_type")]
    codes = reshape.distinct_values("code", [(table(spark, folder, name), column) for name, column in sources])
    return codes.select("code", keys.hashed("code").alias("code_key"))


@register(
    "calendar_of_dates",
    """
    SELECT full_date, CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key
    FROM (SELECT CAST(o_orderdate AS DATE) AS full_date FROM orders
          UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem UNION SELECT CAST(ts AS DATE) FROM events) AS d""",
)
def calendar_of_dates(spark: SparkSession, folder: str) -> DataFrame:
    sources = [("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts")]
    days = [(table(spark, folder, name).select(F.col(c).cast("date").alias("day")), "day") for name, c in sources]
    return reshape.distinct_values("full_date", days).select("full_date", keys.date_key("full_date").alias("date_key"))


# ---- joins and windows ----------------------------------------------------------------------


@register(
    "star_join",
    """
    SELECT n_name, r_name, p_brand, count(*) AS n, round(sum(l_extendedprice), 2) AS revenue
    FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation ON n_nationkey = s_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey JOIN part ON p_partkey = l_partkey
    GROUP BY ALL""",
)
def star_join(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with their dimensions, left and inner, then summed."""
    rows = table(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_extendedprice")
    rows = attach(rows, table(spark, folder, "supplier"), "l_suppkey", "s_suppkey", ["s_nationkey"])
    rows = attach(rows, table(spark, folder, "nation"), "s_nationkey", "n_nationkey", ["n_name", "n_regionkey"])
    rows = attach(rows, table(spark, folder, "region"), "n_regionkey", "r_regionkey", ["r_name"])
    rows = attach(rows, table(spark, folder, "part"), "l_partkey", "p_partkey", ["p_brand"], "inner")
    return rows.groupBy("n_name", "r_name", "p_brand").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("revenue")
    )


@register(
    "daily_return",
    """
    SELECT user_id, day, round(value, 4) AS value,
           round(coalesce((value - before) / nullif(before, 0), 0), 6) AS change
    FROM (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY day NULLS LAST) AS before
          FROM (SELECT user_id, CAST(ts AS DATE) AS day,
                       sum(CASE WHEN event_type = 'error' THEN 0 ELSE value END) AS value
                FROM events GROUP BY ALL) AS d) AS h""",
)
def daily_return(spark: SparkSession, folder: str) -> DataFrame:
    """Change against the user's previous day with events."""
    amount = F.when(F.col("event_type") == "error", 0.0).otherwise(F.col("value"))
    daily = (
        table(spark, folder, "events")
        .groupBy("user_id", F.col("ts").cast("date").alias("day"))
        .agg(F.sum(amount).alias("value"))
    )
    before = F.lag("value").over(W.partitionBy("user_id").orderBy(F.col("day").asc_nulls_last()))
    return daily.withColumn("before", before).select(
        "user_id",
        "day",
        F.round("value", 4).alias("value"),
        F.round(amounts.relative_change("value", "before"), 6).alias("change"),
    )
