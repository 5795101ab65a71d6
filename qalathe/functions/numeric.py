"""Number expressions whose results must equal Python's."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def python_round(c, digits: int) -> Column:
    """Rounds the exact binary value, ties to even, as Python's ``round`` does.

    ``F.round`` and ``F.bround`` round the shortest decimal form and differ in about 3 % of
    two-digit cases; ``format_number`` formats the exact value.
    """
    c = F.col(c) if isinstance(c, str) else c
    plain = F.replace(F.format_number(c.cast("double"), digits), F.lit(","), F.lit(""))
    return plain.cast("double")


def strict_int(c) -> Column:
    """The integer a text holds, null when it holds none."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("bigint")


def int_or_zero(c) -> Column:
    """As :func:`strict_int`, but a missing or empty text counts as 0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit(0).cast("long")).otherwise(strict_int(c))


# Exponents of one class of the exact sum: a value of the class is an integer below 2^(53 + CLASS_BITS)
# once scaled, and DECIMAL(38, 0) holds the sum of 2^57 of them.
CLASS_BITS = 16


def _pow2(k: Column) -> Column:
    """2^k for any k of a double's range, in two factors so that neither leaves it."""
    half = F.floor(k / 2)
    return F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), k - half)


def exponent_class(x: Column) -> tuple[Column, Column]:
    """(class, integer) with x = integer * 2^(class * CLASS_BITS - 52), both exact, for finite x != 0."""
    a = F.abs(x)
    e0 = F.floor(F.log2(a)).cast("int")
    e = (e0 - F.when(F.pow(F.lit(2.0), e0) > a, 1).otherwise(0)
         + F.when(F.pow(F.lit(2.0), e0 + 1) <= a, 1).otherwise(0))
    cls = F.floor(e / CLASS_BITS).cast("int")
    scale = 52 - cls * CLASS_BITS
    half = F.floor(scale / 2)
    whole = x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), scale - half)
    return cls, whole.cast("decimal(38,0)")


def exact_means(df, keys: list[str], columns: list[str], suffix: str = "_mean"):
    """Means of double columns per key group that do not depend on the order of the rows.

    Each value is split into its exponent class and an exact integer; integers are summed per
    class in DECIMAL(38, 0), and the few class sums are added from the smallest class up. The
    sum is thereby the same under any partitioning and order. Nulls are skipped; a column without
    values in a group has a null mean, and a group without values in any column has no row (join
    it on the left); NaN, or both infinities, give NaN; one infinity gives it.
    """
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_x")) for c in columns]))
    long = df.select(*keys, cells.alias("_cell")).select(*keys, "_cell._c", "_cell._x").where("_x IS NOT NULL")
    finite = ~F.isnan("_x") & (F.abs("_x") != float("inf"))
    cls, whole = exponent_class(F.col("_x"))
    parts = long.select(
        *keys, "_c", F.when(finite & (F.col("_x") != 0), cls).alias("_k"),
        F.when(finite & (F.col("_x") != 0), whole).otherwise(F.lit(0).cast("decimal(38,0)")).alias("_w"),
        F.isnan("_x").cast("int").alias("_nan"), (F.col("_x") == float("inf")).cast("int").alias("_pos"),
        (F.col("_x") == float("-inf")).cast("int").alias("_neg"))
    by_class = parts.groupBy(*keys, "_c", "_k").agg(
        F.sum("_w").alias("_s"), F.count(F.lit(1)).alias("_n"), F.sum("_nan").alias("_nan"),
        F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
    total = F.aggregate(
        F.array_sort(F.collect_list(F.struct(F.coalesce("_k", F.lit(-100000)).alias("k"), F.col("_s").alias("s")))),
        F.lit(0.0), lambda acc, t: acc + t["s"].cast("double") * _pow2(t["k"] * CLASS_BITS - 52))
    per = by_class.groupBy(*keys, "_c").agg(
        total.alias("_sum"), F.sum("_n").alias("_n"), F.sum("_nan").alias("_nan"), F.sum("_pos").alias("_pos"),
        F.sum("_neg").alias("_neg"))
    nan = F.lit(float("nan"))
    mean = (F.when((F.col("_nan") > 0) | ((F.col("_pos") > 0) & (F.col("_neg") > 0)), nan)
            .when(F.col("_pos") > 0, F.lit(float("inf"))).when(F.col("_neg") > 0, F.lit(float("-inf")))
            .otherwise(F.try_divide(F.col("_sum"), F.col("_n"))))
    pivoted = per.groupBy(*keys).agg(*[
        F.max(F.when(F.col("_c") == c, mean)).alias(f"{c}{suffix}") for c in columns])
    return pivoted
