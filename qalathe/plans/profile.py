"""Column profiles and declarative expectations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import defaults as D
from ..operators import beside, column_quantiles, duplicate_summary
from .checks import share

FEW_VALUES = 100
_NUMBERS = ("mean", "std", "min", "max", "median", "q25", "q75")
_TEXTS = ("min_length", "max_length", "mean_length")


def _kind(field: T.StructField) -> str:
    if isinstance(field.dataType, (T.NumericType, T.BooleanType)):
        return "number"
    return "text" if isinstance(field.dataType, T.StringType) else "other"


def _of_kind(df: DataFrame, kind: str) -> list[str]:
    return [f.name for f in df.schema.fields if _kind(f) == kind]


def _number(c: str) -> Column:
    return F.col(c).cast("double")


def _short_key(value: Column) -> Column:
    """A text stands for itself when short and for its digest when long, so that counting
    distinct texts does not shuffle the texts."""
    digest = F.concat(F.lit("sha256:"), F.base64(F.unhex(F.sha2(value, 256))))
    return F.when(F.octet_length(value) > 64, digest).otherwise(value)


def _text_values(df: DataFrame, columns) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull())


def _distinct_texts(df: DataFrame, columns) -> DataFrame:
    return (
        _text_values(df, columns).groupBy("column", _short_key(F.col("value")).alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row per column: counts and nulls for all, moments and quartiles for numbers,
    lengths and distinct values for texts. An all-null column has null statistics."""
    numbers, texts = _of_kind(df, "number"), _of_kind(df, "text")
    null = F.lit(None).cast("double")

    def measures(f: T.StructField) -> Column:
        c, kind = f.name, _kind(f)
        if kind == "number":
            values = {"mean": F.avg(_number(c)), "std": F.stddev_samp(_number(c)),
                      "min": F.min(_number(c)), "max": F.max(_number(c))}
        elif kind == "text":
            values = {"min_length": F.min(F.length(c)), "max_length": F.max(F.length(c)),
                      "mean_length": F.avg(F.length(c))}
        else:
            values = {}
        names = ("mean", "std", "min", "max", *_TEXTS)
        return F.struct(
            F.count(F.col(c)).alias("count"), F.count_if(F.col(c).isNull()).alias("null_count"),
            *[values.get(n, null).cast("double").alias(n) for n in names],
        ).alias(c)

    row = df.agg(*[measures(f) for f in df.schema.fields])
    table = row.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("dtype"), F.col(f"`{f.name}`").alias("m"))
        for i, f in enumerate(df.schema.fields)
    ]))).select("ordinal", "column", "dtype", "m.*")
    # The joined sides have at most one row per column.
    if numbers:
        quartiles = column_quantiles(
            df, numbers, {"median": 0.5, "q25": 0.25, "q75": 0.75}, approximate)
        table = table.join(F.broadcast(quartiles), "column", "left")
    else:
        table = table.withColumns({n: null for n in ("median", "q25", "q75")})
    if texts and approximate:
        distinct = _text_values(df, texts).groupBy("column").agg(
            F.approx_count_distinct(_short_key(F.col("value"))).alias("unique_count"))
        table = table.join(F.broadcast(distinct), "column", "left")
    elif texts:
        distinct = _distinct_texts(df, texts).groupBy("column").agg(
            F.count(F.lit(1)).alias("unique_count"))
        table = table.join(F.broadcast(distinct), "column", "left")
    else:
        table = table.withColumn("unique_count", F.lit(None).cast("long"))
    null_share = share(F.col("null_count"), F.col("count") + F.col("null_count"))
    return table.select(
        "ordinal", "column", "dtype", "count", "null_count",
        (null_share * 100).alias("null_percentage"), *_NUMBERS, "unique_count", *_TEXTS)


def common_texts(df: DataFrame, k: int = 5, few: int = FEW_VALUES) -> DataFrame:
    """The k most frequent values of each text column with fewer than ``few`` distinct ones.

    Long values are counted by digest; the few that are wanted are then read back.
    """
    texts = _of_kind(df, "text")
    if not texts:
        return df.sparkSession.createDataFrame([], "column string, value string, n bigint")
    counted = _distinct_texts(df, texts)
    small = counted.groupBy("column").agg(F.count(F.lit(1)).alias("distinct")).where(
        F.col("distinct") < few).select("column")
    # Fewer than ``few`` keys per column are left here, so one group is never large. All that are
    # tied with the k-th are kept until their texts are known.
    ranked = counted.join(F.broadcast(small), "column").groupBy("column").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("minus_n"), "key"))).alias("all"))
    kth = F.element_at("all", F.least(F.lit(k), F.size("all")))["minus_n"]
    likely = ranked.select("column", F.inline(F.filter("all", lambda x: x["minus_n"] <= kth)))
    digests = F.broadcast(likely.where(F.col("key").startswith("sha256:")).select("column", "key"))
    read_back = (
        _text_values(df, texts).withColumn("key", _short_key(F.col("value")))
        .join(digests, ["column", "key"]).groupBy("column", "key").agg(F.min("value").alias("whole"))
    )
    found = likely.join(F.broadcast(read_back), ["column", "key"], "left").groupBy("column").agg(
        F.array_sort(F.collect_list(F.struct("minus_n", F.coalesce("whole", "key").alias("value")))).alias("all"))
    return found.select("column", F.inline(F.slice("all", 1, k))).select(
        "column", "value", (-F.col("minus_n")).alias("n"))


def dataset_info(df: DataFrame) -> DataFrame:
    """One row: rows, columns and copies of whole rows. Rows are compared by digest, which also
    works for nested columns."""
    whole = F.unhex(F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])), 256))
    summary = duplicate_summary(df.select(whole.alias("_row")), "_row")
    return summary.select(
        F.col("total_rows").alias("row_count"),
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        F.lit(",".join(df.columns)).alias("columns"),
        F.col("duplicates").alias("duplicate_rows"))


# --- expectations ---------------------------------------------------------------------

@dataclass(frozen=True)
class Expectation:
    """One declared rule. ``kind``: required_columns, row_count, exists, type, not_null, nullable,
    unique, minimum or length. Failures of severity warning do not make the table invalid."""

    name: str
    kind: str
    column: str | None = None
    low: float | None = None
    high: float | None = None
    severity: str = "error"
    columns: tuple[str, ...] = ()


def declared_expectations(
    schema=None, required=D.REQUIRED_COLUMNS, min_rows: int = D.MIN_ROWS, every_key: bool = False,
) -> list[Expectation]:
    """Rules of a declared schema. ``every_key`` adds the lengths, types and the largest row count
    it names, which the plain check passes over."""
    schema = D.DECLARED_SCHEMA if schema is None else schema
    rules = [
        Expectation("required_columns", "required_columns", columns=tuple(required)),
        Expectation("min_row_count", "row_count", low=min_rows,
                    high=D.MAX_ROWS if every_key else None),
    ]
    for c, s in schema.items():
        rules.append(Expectation(f"{c}_not_null", "nullable" if s.get("nullable", True) else "not_null", c))
        if s.get("unique"):
            rules.append(Expectation(f"{c}_unique", "unique", c))
        if "min_value" in s:
            rules.append(Expectation(f"{c}_min_value", "minimum", c, low=s["min_value"], severity="warning"))
        if every_key:
            if "type" in s:
                rules.append(Expectation(f"{c}_type", "type", c, columns=(s["type"],)))
            if "min_length" in s or "max_length" in s:
                rules.append(Expectation(
                    f"{c}_length", "length", c, low=s.get("min_length"), high=s.get("max_length"),
                    severity="warning"))
    return rules


def table_expectations(min_rows: int = D.MIN_ROWS, max_rows: int | None = D.MAX_ROWS) -> list[Expectation]:
    """The ten rules of the expectation suite."""
    keys = D.CRITICAL_COLUMNS
    return [
        Expectation("table_row_count_between", "row_count", low=min_rows, high=max_rows),
        *[Expectation("column_exists", "exists", c) for c in keys],
        *[Expectation("values_not_null", "not_null", c) for c in keys],
        Expectation("values_unique", "unique", "question_id"),
        Expectation("values_between", "minimum", "score", low=0),
        Expectation("values_between", "minimum", "quality_score", low=0),
    ]


_TYPE_NAMES = {
    "int64": (T.LongType, T.IntegerType, T.ShortType, T.ByteType),
    "float64": (T.DoubleType, T.FloatType),
    "object": (T.StringType, T.ArrayType, T.StructType, T.MapType),
}


def check_expectations(
    df: DataFrame, rules: list[Expectation], skip_absent: bool = False,
) -> DataFrame:
    """One row per rule with what was observed. All aggregates run in one pass, each uniqueness
    rule in one narrow pass of its own. ``skip_absent`` leaves out rules on absent columns;
    otherwise they fail."""
    have = {f.name: f for f in df.schema.fields}
    measures: dict[str, Column] = {"total_rows": F.count(F.lit(1))}
    sides: dict[str, DataFrame] = {}
    rows = []
    for i, r in enumerate(rules):
        c, present = r.column, r.column is None or r.column in have
        observed, ok = F.lit(None), F.lit(present)
        if not present and skip_absent:
            continue
        if r.kind == "required_columns":
            absent = [x for x in r.columns if x not in have]
            observed, ok = F.lit(float(len(absent))), F.lit(not absent)
        elif r.kind == "row_count":
            observed = F.col("total_rows")
            ok = (observed >= F.lit(r.low or 0))
            if r.high is not None:
                ok = ok & (observed <= F.lit(r.high))
        elif r.kind == "type":
            ok = F.lit(present and isinstance(have[c].dataType, _TYPE_NAMES[r.columns[0]]))
        elif r.kind in ("not_null", "nullable") and present:
            measures[f"nulls_{c}"] = F.count_if(F.col(c).isNull())
            observed = F.col(f"nulls_{c}")
            ok = (observed == 0) if r.kind == "not_null" else F.lit(True)
        elif r.kind == "unique" and present:
            sides[c] = duplicate_summary(df.select(c), c).select(F.col("duplicates").alias(f"copies_{c}"))
            observed, ok = F.col(f"copies_{c}"), F.col(f"copies_{c}") == 0
        elif r.kind == "minimum" and present:
            if _kind(have[c]) != "number":
                continue
            measures[f"min_{c}"] = F.min(_number(c))
            observed = F.col(f"min_{c}")
            ok = ~F.coalesce(observed < F.lit(float(r.low)), F.lit(False))
        elif r.kind == "length" and present:
            measures[f"shortest_{c}"], measures[f"longest_{c}"] = F.min(F.length(c)), F.max(F.length(c))
            observed = F.col(f"shortest_{c}")
            ok = F.lit(True)
            if r.low is not None:
                ok = ok & ~F.coalesce(observed < F.lit(r.low), F.lit(False))
            if r.high is not None:
                ok = ok & ~F.coalesce(F.col(f"longest_{c}") > F.lit(r.high), F.lit(False))
        rows.append(F.struct(
            F.lit(i).alias("ordinal"), F.lit(r.name).alias("check"),
            F.lit(c).cast("string").alias("column"),
            F.when(ok, "pass").otherwise("fail").alias("status"),
            F.when(ok, "info").otherwise(r.severity).alias("severity"),
            observed.cast("double").alias("value"), F.lit(r.low).cast("double").alias("threshold"),
        ))
    one = df.agg(*[m.alias(n) for n, m in measures.items()])
    for side in sides.values():
        one = beside(one, side)
    return one.select(F.inline(F.array(*rows)))


def expectation_metrics(df: DataFrame, results: DataFrame) -> DataFrame:
    """One row: validity, passes, failures, rows and columns."""
    failed = F.col("status") == "fail"
    counts = results.agg(
        (F.count_if(failed & (F.col("severity") == "error")) == 0).alias("schema_valid"),
        F.count_if(~failed).alias("checks_passed"), F.count_if(failed).alias("checks_failed"))
    size = df.agg(F.count(F.lit(1)).alias("row_count"))
    return beside(counts, size).withColumn(
        "column_count", F.lit(len(df.columns)).cast("long"))
