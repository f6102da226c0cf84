"""Exchange rates: rebasing to USD and triangulation to the reporting currency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from halala.functions.amounts import ratio
from halala.functions.documents import document, node_at, text_at
from halala.operators.pick import prefer_by

# Fixed values
PIVOT = "USD"
LEGACY_BASE = "EUR"
REPORTING = "SAR"
NATIVE, REBASED = 0, 1


def rebased(rates: Column, pivot: str = PIVOT) -> Column:
    """A document's rates (map of code to double) restated per unit of `pivot`, to six digits."""
    return F.transform_values(rates, lambda _, rate: F.round(rate / F.element_at(rates, F.lit(pivot)), 6))


def rebased_legacy(fx_rates_raw: DataFrame) -> DataFrame:
    """RAW rate documents; those in the legacy base are restated, all others stay as delivered."""
    legacy = F.coalesce(text_at(document("raw"), "base") == LEGACY_BASE, F.lit(False))
    columns = fx_rates_raw.columns
    return rebased_documents(fx_rates_raw.where(legacy)).select(*columns).unionByName(fx_rates_raw.where(~legacy))


def rebased_documents(fx_rates_raw: DataFrame) -> DataFrame:
    """Rate documents restated to a USD base; all their other members stay as they are."""
    docs = fx_rates_raw.select("file_name", "loaded_at", document("raw").alias("doc"))
    parts = docs.select(
        "file_name",
        "loaded_at",
        F.col("doc").cast("map<string,variant>").alias("whole"),
        node_at("doc", "rates").cast("map<string,double>").alias("rates"),
    )
    kept = F.map_filter("whole", lambda name, _: ~name.isin("base", "rates"))
    restated = F.create_map(
        F.lit("base"),
        F.lit(PIVOT).cast("variant"),
        F.lit("rates"),
        F.to_variant_object(rebased(F.col("rates"))),
    )
    return parts.select(F.to_json(F.map_concat(kept, restated)).alias("raw"), "file_name", "loaded_at")


def usd_rates(staged: DataFrame) -> DataFrame:
    """Units of each currency per 1 USD, one row per date and currency.

    Documents quoted in USD win over EUR documents rebased through that day's EUR->USD rate.
    All steps group by date, so one shuffle on `rate_date` serves the whole function; a date
    holds one row per currency pair, because staging removed the copies.
    """
    day = W.partitionBy("rate_date")
    quoted = staged.where(F.col("rate_date").isNotNull() & (F.col("exchange_rate") > 0)).where(
        F.col("base_currency").isin(PIVOT, LEGACY_BASE)
    )
    is_native = F.col("base_currency") == PIVOT
    eur_usd = (F.col("base_currency") == LEGACY_BASE) & (F.col("target_currency") == PIVOT)
    with_pivot = quoted.select(
        "rate_date",
        "target_currency",
        "exchange_rate",
        is_native.alias("native"),
        F.max(F.when(eur_usd, F.col("exchange_rate"))).over(day).alias("usd_per_eur"),
    )

    def offer(currency, rate, priority):
        return F.struct(currency.alias("currency_code"), rate.alias("usd_rate"), F.lit(priority).alias("priority"))

    native = offer(F.col("target_currency"), F.col("exchange_rate").cast("double"), NATIVE)
    rebased = offer(F.col("target_currency"), ratio("exchange_rate", "usd_per_eur"), REBASED)
    # a base has no rate of its own, so its rate is the pivot's turned over
    legacy_base = offer(F.lit(LEGACY_BASE), ratio(F.lit(1), "usd_per_eur"), REBASED)
    offers = (
        F.when(F.col("native"), F.array(native))
        .when(F.col("usd_per_eur").isNotNull() & (F.col("target_currency") == PIVOT), F.array(rebased, legacy_base))
        .when(F.col("usd_per_eur").isNotNull(), F.array(rebased))
    )
    candidates = with_pivot.select("rate_date", F.explode(offers).alias("o")).select("rate_date", "o.*")
    return prefer_by(candidates, ["rate_date", "currency_code"], ["priority", "usd_rate"]).drop("priority")


def int_fx_rates_to_sar(staged: DataFrame) -> DataFrame:
    """SAR per unit of each currency and date; dates without a SAR rate drop out."""
    day = W.partitionBy("rate_date")
    sar = F.max(F.when(F.col("currency_code") == REPORTING, F.col("usd_rate"))).over(day)
    priced = usd_rates(staged).withColumn("sar_per_usd", sar).where("sar_per_usd is not null")
    return priced.select("rate_date", "currency_code", ratio("sar_per_usd", "usd_rate").alias("rate_to_sar"))
