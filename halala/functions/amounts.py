"""Money arithmetic that Spark's default decimal rules would round."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from halala.functions.casts import as_column


def exact_product(a: Column | str, b: Column | str, strict: bool = True) -> Column:
    """decimal(38,4) x decimal(38,4) with all 8 fraction digits, as decimal(38,8).

    Spark would return 6. Operands that fit are narrowed first; larger ones are multiplied as whole
    numbers of their fourth digits. A product that has no room in 38 digits raises, or is NULL
    when not `strict`.
    """
    a, b = as_column(a).cast("decimal(38,4)"), as_column(b).cast("decimal(38,4)")
    narrow = a.try_cast("decimal(18,4)") * b.try_cast("decimal(18,4)")

    def whole(x: Column) -> Column:
        return F.replace(x.cast("string"), F.lit("."), F.lit("")).cast("decimal(38,0)")

    digits = F.try_multiply(F.abs(whole(a)), F.abs(whole(b)))
    text = F.lpad(digits.cast("string"), 39, "0")
    sign = F.when(F.signum(a.cast("double")) * F.signum(b.cast("double")) < 0, "-").otherwise("")
    joined = F.concat(sign, F.left(text, F.lit(31)), F.lit("."), F.right(text, F.lit(8)))
    wide = joined.try_cast("decimal(38,8)")
    if strict:
        too_large = F.raise_error(F.lit("a product has more than 30 integer digits")).cast("decimal(38,8)")
        wide = F.when(a.isNotNull() & b.isNotNull(), F.coalesce(wide, too_large))
    return F.coalesce(narrow.cast("decimal(38,8)"), wide)


def ratio(a: Column | str, b: Column | str) -> Column:
    """Quotient in double; a decimal quotient would keep 6 digits only."""
    return as_column(a).cast("double") / as_column(b).cast("double")


def relative_change(now: Column | str, before: Column | str) -> Column:
    """Change against the earlier value; 0 when that value is missing or 0."""
    now, before = as_column(now), as_column(before)
    return F.coalesce((now - before) / F.nullif(before, F.lit(0.0)), F.lit(0.0))


def signed_quantity(side: Column | str, quantity: Column | str) -> Column:
    side, quantity = as_column(side), as_column(quantity)
    return F.when(side == "BUY", quantity).when(side == "SELL", -quantity)
