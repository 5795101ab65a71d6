"""Oversampling, weights, the exact seeded split, and the example formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import defaults as D
from ..functions import comma_joined
from ..operators import beside, most_frequent
from .bias import ARRAY_DIMENSIONS, SCALAR_DIMENSIONS, dimension_order

# Hex digits of the shuffle key that name a bucket: 65,536 buckets, at most that many totals.
BUCKET_DIGITS = 4


# --- oversampling ---------------------------------------------------------------------

def _chosen_slices(suggestions: DataFrame, arrays, scalars, max_slices: int) -> DataFrame:
    """One row with the first urgent augmentation suggestions, at most ``max_slices`` of them.

    A slice of a scalar column takes up a place but is not oversampled.
    """
    first = (
        suggestions.where((F.col("strategy") == "data_augmentation") & (F.col("priority") == "high"))
        .withColumn("_order", dimension_order(scalars, arrays))
        .orderBy("_order", "value", "factor_order").limit(max_slices)
        .where(F.col("dimension").isin(*arrays))
    )
    return first.agg(F.array_sort(F.collect_list(F.struct("_order", "value", "dimension"))).alias("_picks"))


def oversample(
    df: DataFrame, suggestions: DataFrame, key: str = "question_id", max_slices: int = 3,
    small: int = 30, factor: int = 2, cap: int = 100, seed: int = D.SPLIT_SEED,
    arrays=None, scalars=SCALAR_DIMENSIONS,
) -> DataFrame:
    """All rows, plus min(factor * n, cap) draws with replacement from each chosen slice of fewer
    than ``small`` rows. Column ``copy`` is 0 for the original and numbers the drawn rows.

    Draws follow from the seed alone. Chosen slices and their rows are few by these limits;
    slices that turn out larger are dropped by their size before any row is gathered.
    """
    arrays = ARRAY_DIMENSIONS if arrays is None else arrays
    arrays = {c: p for c, p in arrays.items() if c in df.columns}
    original = df.withColumn("copy", F.lit(0).cast("long"))
    if not arrays:
        return original
    picks = _chosen_slices(suggestions, arrays, scalars, max_slices)

    def holds(pick: Column) -> Column:
        hit = F.lit(False)
        for c in arrays:
            hit = hit | ((pick["dimension"] == c) & F.coalesce(
                F.array_contains(c, pick["value"]), F.lit(False)))
        return hit

    member = (
        beside(df, picks).withColumn("_in", F.filter("_picks", holds)).where(F.size("_in") > 0)
        .withColumn("_pick", F.explode("_in"))
        .withColumn("_place", F.array_position("_picks", F.col("_pick")))
        .drop("_picks", "_in", "_pick")
    )
    sizes = (
        member.groupBy("_place").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") < small))
    text_key = F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))
    # Fewer than ``small`` rows per slice from here on.
    numbered = member.join(F.broadcast(sizes.select("_place")), "_place").withColumn(
        "_index", F.row_number().over(Window.partitionBy("_place").orderBy(F.md5(text_key), F.col(key))))
    draws = sizes.withColumn(
        "_draw", F.explode(F.sequence(F.lit(1), F.least(F.col("_n") * factor, F.lit(cap)).cast("int"))))
    dice = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "_place", "_draw")), 1, 8), 16, 10)
    draws = draws.select(
        "_place", "_draw", (F.pmod(dice.cast("long"), F.col("_n")) + 1).cast("int").alias("_index"))
    drawn = numbered.join(F.broadcast(draws), ["_place", "_index"]).withColumn(
        "copy", (F.col("_place") - 1) * cap + F.col("_draw"))
    return original.unionByName(drawn.select(*original.columns))


# --- weights --------------------------------------------------------------------------

def quality_weights(df: DataFrame, score: str = "quality_score") -> DataFrame:
    """``sample_weight`` in [0.5, 1.5] by the place of the score in its range; 1.0 without range."""
    span = df.agg(F.min(score).alias("_low"), F.max(score).alias("_high"))
    width = F.col("_high") - F.col("_low")
    weight = F.when(width > 0, F.lit(0.5) + (F.col(score) - F.col("_low")) / width).otherwise(F.lit(1.0))
    return beside(df, span).withColumn("sample_weight", weight).drop("_low", "_high")


# --- split ----------------------------------------------------------------------------

def train_test_split(
    df: DataFrame, test_ratio: float = D.TEST_RATIO, seed: int = D.SPLIT_SEED,
    key=("question_id", "copy"), stratify_by: str | None = None,
) -> DataFrame:
    """Adds ``split``: the first floor(n * (1 - test_ratio)) rows in a seeded shuffle are train.

    The shuffle order is the digest of seed and key, then the digest of the whole row, so it
    follows from content alone, whatever plan the rows come from. No row is moved: bucket totals
    tell where the cut falls, and the digests of that bucket are ranked. Only where the cut falls
    among rows of one key are whole rows looked at. Rows that are equal in everything are told
    apart by nothing; where the cut falls among those, it is made by count.
    """
    keys = [key] if isinstance(key, str) else [c for c in key if c in df.columns]
    parts = [F.col(c).cast("string") for c in keys]
    whole = F.md5(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))
    marked = df.withColumns({
        "_key": F.md5(F.concat_ws(":", F.lit(str(seed)), *parts)),
        "_stratum": F.lit("") if stratify_by is None else F.coalesce(
            F.col(stratify_by).cast("string"), F.lit("\x00")),
    })
    places = marked.select("_stratum", "_key", F.substring("_key", 1, BUCKET_DIGITS).alias("_bucket"))

    def reached(amount: str, *by: str, order: str) -> Column:
        return F.sum(amount).over(Window.partitionBy(*by).orderBy(order))

    # Level 1, at most 65,536 totals per stratum: the bucket of the cut.
    buckets = places.groupBy("_stratum", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    everything = Window.partitionBy("_stratum")
    cut_bucket = (
        buckets.withColumns({
            "_upto": reached("_n", "_stratum", order="_bucket"), "_all": F.sum("_n").over(everything)})
        .withColumn("_train", F.floor(F.col("_all") * F.lit(1 - test_ratio)))
        .where((F.col("_train") > F.col("_upto") - F.col("_n")) & (F.col("_train") <= F.col("_upto")))
        .select("_stratum", "_bucket", (F.col("_train") - F.col("_upto") + F.col("_n")).alias("_want"))
    )
    # Level 2, the digests of one bucket, copies already counted into one: the digest of the cut.
    in_bucket = places.groupBy("_stratum", "_bucket", "_key").agg(F.count(F.lit(1)).alias("_n")).join(
        cut_bucket, ["_stratum", "_bucket"])

    def cut_of(counted: DataFrame, place: str) -> DataFrame:
        """(stratum, cut, rows at the cut, how many of them train) from counts per ``place``."""
        return (
            counted.withColumn("_upto", reached("_n", "_stratum", order=place))
            .where((F.col("_want") > F.col("_upto") - F.col("_n")) & (F.col("_want") <= F.col("_upto")))
            .select("_stratum", F.col(place).alias(f"_cut{place}"), F.col("_n").alias(f"_at{place}"),
                    (F.col("_want") - F.col("_upto") + F.col("_n")).alias(f"_take{place}"))
        )

    cuts = cut_of(in_bucket, "_key")
    one = (lambda few: few) if stratify_by else F.broadcast  # without strata these are one row at most
    # Level 3, only where the cut lies among rows of one key: the digest of the whole row.
    torn = cuts.where("_take_key < _at_key").select("_stratum", F.col("_cut_key").alias("_key"), F.col("_take_key").alias("_want"))
    tied = marked.join(one(torn), ["_stratum", "_key"]).withColumn("_whole", whole)
    inner = cut_of(tied.groupBy("_stratum", "_whole", "_want").agg(F.count(F.lit(1)).alias("_n")), "_whole")
    both = cuts.join(one(inner), "_stratum", "left")
    if stratify_by is None:
        placed = beside(marked, both.drop("_stratum"))
    else:
        placed = marked.join(both, "_stratum", "left")
    at_cut = (F.col("_key") == F.col("_cut_key")) & F.col("_cut_whole").isNotNull()
    train = F.when(at_cut, whole <= F.col("_cut_whole")).otherwise(F.col("_key") <= F.col("_cut_key"))
    cloven = F.when(at_cut, (whole == F.col("_cut_whole")) & (F.col("_take_whole") < F.col("_at_whole")))
    clear = placed.where(~F.coalesce(cloven, F.lit(False))).withColumn(
        "split", F.when(train, "train").otherwise("test"))
    # Equal rows on both sides of the cut: one of them, as often as there are; the first ones train.
    again = (
        tied.join(one(inner.where("_take_whole < _at_whole")), "_stratum").where("_whole = _cut_whole")
        .groupBy("_stratum").agg(
            F.first(F.struct(*df.columns)).alias("_row"), F.first("_at_whole").alias("_n"), F.first("_take_whole").alias("_take"))
        .select("_row", "_take", F.explode(F.sequence(F.lit(1).cast("long"), "_n")).alias("_nth"))
        .select("_row.*", F.when(F.col("_nth") <= F.col("_take"), "train").otherwise("test").alias("split"))
    )
    return clear.select(*df.columns, "split").unionByName(again)


# --- formats --------------------------------------------------------------------------

def _or_default(df: DataFrame, name: str, kind: str, default) -> Column:
    """A column, or its default where the table lacks it."""
    c = F.col(name) if name in df.columns else (F.array() if default == [] else F.lit(default))
    return c.cast(kind).alias(name)


def chat_examples(df: DataFrame, system_prompt: str | None = D.SYSTEM_PROMPT, weighted: bool = True) -> DataFrame:
    """Messages and metadata. Without a system prompt the first message is the user's; the
    scheduled run uses that form, without weights."""
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), F.coalesce(content, F.lit("")).alias("content"))

    messages = [] if system_prompt is None else [message("system", F.lit(system_prompt))]
    messages += [message("user", F.col("question_body")), message("assistant", F.col("answer_body"))]
    metadata = [
        _or_default(df, "question_id", "bigint", None), _or_default(df, "tags", "array<string>", []),
        _or_default(df, "error_signatures", "array<string>", []),
        _or_default(df, "infra_components", "array<string>", []),
        _or_default(df, "quality_score", "double", 0.0),
    ]
    if weighted:
        metadata.append(_or_default(df, "sample_weight", "double", 1.0))
    keep = ["split"] if "split" in df.columns else []
    return df.select(
        F.array(*messages).alias("messages"), F.struct(*metadata).alias("metadata"), *keep)


def completion_examples(df: DataFrame) -> DataFrame:
    """Prompt, completion and metadata."""
    prompt = F.concat(
        F.lit("### Question\n"), F.coalesce("title", F.lit("")), F.lit("\n\n"),
        F.coalesce("question_body", F.lit("")), F.lit("\n\nTags: "), comma_joined("tags"),
        F.lit("\n\n### Answer\n"))
    keep = ["split"] if "split" in df.columns else []
    return df.select(
        prompt.alias("prompt"), F.coalesce("answer_body", F.lit("")).alias("completion"),
        F.struct(_or_default(df, "question_id", "bigint", None),
                 _or_default(df, "quality_score", "double", 0.0)).alias("metadata"), *keep)


# --- the stage ------------------------------------------------------------------------

def training_rows(
    df: DataFrame, suggestions: DataFrame | None = None, apply_mitigation: bool = True,
    test_ratio: float = D.TEST_RATIO, seed: int = D.SPLIT_SEED, stratify_by: str | None = None,
) -> DataFrame:
    """Resampled, weighted and split rows. Without suggestions nothing is resampled."""
    mitigated = apply_mitigation and suggestions is not None
    rows = oversample(df, suggestions, seed=seed) if mitigated else df.withColumn(
        "copy", F.lit(0).cast("long"))
    return train_test_split(quality_weights(rows), test_ratio, seed, stratify_by=stratify_by)


def training_examples(rows: DataFrame, output_format: str = "chat") -> DataFrame:
    """Examples in ``chat`` or ``completion`` format from :func:`training_rows`."""
    formats = {"chat": chat_examples, "completion": completion_examples}
    if output_format not in formats:
        raise ValueError(f"unknown output format {output_format!r}")
    return formats[output_format](rows)


def training_statistics(rows: DataFrame) -> DataFrame:
    """One row: input, resampled, train, test and total counts."""
    return rows.agg(
        F.count_if(F.col("copy") == 0).alias("input_records"),
        F.count(F.lit(1)).alias("after_resampling"),
        F.count_if(F.col("split") == "train").alias("train_examples"),
        F.count_if(F.col("split") == "test").alias("test_examples"),
        F.count(F.lit(1)).alias("total_examples"))


def train_tag_frequency(rows: DataFrame, k: int = 10) -> DataFrame:
    return most_frequent(rows.where(F.col("split") == "train"), "tags", k)
