"""Exact duplicates by block naming, in DataFrame operations only.

A text is cut into blocks of a fixed number of characters. Distinct blocks are sorted and get
their place as integer name. Adjacent names are then named as pairs, again by sorting, until each
document has one name; equal names on one level mean equal texts, without any chance of a
collision. A hash of a block only routes it: texts under one hash are compared in full, and the
name depends on the text.

Defined cases. A null text is empty; empty texts are equal to each other. A null id counts as
larger than any other. Rows equal in id and text are copies like any others: one of them stays.
Other columns never matter. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import forget, saved

BLOCK_CHARS = 4096


def normalised(text: Column) -> Column:
    """Each run of blanks as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _block_hash(block: Column) -> list[Column]:
    return [F.xxhash64(block), F.xxhash64(F.lit(1), block)]


def _with_names(distinct: DataFrame, order: list[str]) -> DataFrame:
    """Integer names by sorted place: they rise with the order and are fixed by writing them."""
    return saved(distinct.orderBy(*order).withColumn("name", F.monotonically_increasing_id()), "names")


def _name_blocks(rows: DataFrame, block_hash) -> tuple[DataFrame, DataFrame]:
    """(id, sha, n, i, name) for each block of ``rows``, and the work table of names.

    Map tasks send each distinct block once, so a block that much of the table shares is one row
    per task. Names go back by hash; only under a hash with several texts also by the text.
    """
    blocks = rows.select("id", "sha", "n", F.posexplode("blocks").alias("i", "block"))
    hashes = [h.alias(f"h{k}") for k, h in enumerate(block_hash(F.col("block")))]
    keys = [f"h{k}" for k in range(len(hashes))]
    hashed = blocks.select("id", "sha", "n", "i", "block", *hashes)
    found = (
        hashed.groupBy(*keys).agg(F.array_sort(F.collect_set("block")).alias("texts"))
        .select(*keys, F.size("texts").alias("n_texts"), F.posexplode("texts").alias("nth", "block"))
        .withColumn("block", F.when(F.col("n_texts") > 1, F.col("block")))
    )
    names = _with_names(found, [*keys, "nth"])
    out = hashed.join(names.where("n_texts = 1").select(*keys, "name"), keys).select("id", "sha", "n", "i", "name")
    several = names.where("n_texts > 1")
    if not several.isEmpty():
        out = out.unionByName(
            hashed.join(several.select(*keys, "block", "name"), [*keys, "block"])
            .select("id", "sha", "n", "i", "name"))
    return out, names


def document_names(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
    block_chars: int = BLOCK_CHARS, block_hash=_block_hash,
) -> DataFrame:
    """(id, sha, copies, level, name), one row per distinct id and text.

    Texts are equal exactly if ``level`` and ``name`` are. ``sha`` is the SHA-256 of the
    normalised text; with the id it tells rows apart, it takes no part in the naming.
    Each round halves the blocks of the documents that are not named yet.
    """
    rows = docs.select(F.col(doc_id).alias("id"), normalised(F.col(text)).alias("norm")).select(
        "id",
        F.unhex(F.sha2("norm", 256)).alias("sha"),
        F.when(F.length("norm") <= block_chars, F.array("norm"))
        .otherwise(F.regexp_extract_all("norm", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))).alias("blocks"),
    ).withColumn("n", F.size("blocks"))
    named, names = _name_blocks(rows, block_hash)
    level, table = 0, saved(named, "level")
    forget(names)
    done = table.where("n = 1").groupBy("id", "sha").agg(
        F.count(F.lit(1)).alias("copies"), F.min("name").alias("name")).withColumn("level", F.lit(0))
    tables = [table]
    # A text of many blocks is in one row per block, so its copies are counted by its first block.
    active = table.where("n > 1").groupBy("id", "sha", "n", "i").agg(
        F.count(F.lit(1)).alias("copies"), F.min("name").alias("name"))
    while not active.isEmpty():
        level += 1
        pairs = saved(
            active.groupBy("id", "sha", ((F.col("n") + 1) / 2).cast("int").alias("n"),
                           F.floor(F.col("i") / 2).cast("int").alias("i")).agg(
                F.min("copies").alias("copies"),
                F.min(F.when(F.col("i") % 2 == 0, F.col("name"))).alias("left"),
                F.min(F.when(F.col("i") % 2 == 1, F.col("name"))).alias("right")), "pairs")
        names = _with_names(pairs.groupBy("left", "right").agg(F.count(F.lit(1)).alias("uses")), ["left", "right"])
        same = (pairs["left"] == names["left"]) & pairs["right"].eqNullSafe(names["right"])
        table = saved(pairs.join(names, same).select("id", "sha", "n", "i", "copies", "name"), "level")
        forget(pairs, names)
        tables.append(table)
        done = done.unionByName(
            table.where("n = 1").select("id", "sha", "copies", "name").withColumn("level", F.lit(level)))
        active = table.where("n > 1")
    out = saved(done, "document-names")
    forget(*tables)
    return out


def exact_groups(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
    block_chars: int = BLOCK_CHARS, block_hash=_block_hash,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``keep_id`` is the smallest id of the texts equal to it. Groups are one row each by the time
    they meet their members, so the adaptive planner can split the members of a large group.
    """
    named = document_names(docs, text, doc_id, block_chars, block_hash)
    groups = saved(
        named.groupBy("level", "name").agg(F.min("id").alias("keep_id"), F.sum("copies").alias("group_size")),
        "groups")
    return (
        named.join(groups, ["level", "name"])
        .select("id", "sha", "keep_id", "group_size", F.explode(F.sequence(F.lit(1), "copies")).alias("nth"))
        .select(
            F.col("id").alias(doc_id), "keep_id", "group_size",
            (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
            F.lower(F.hex("sha")).alias("text_sha256"))
    )


def exact_dedup(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` with one row of each group of equal texts, that of the smallest id."""
    named = saved(exact_groups(docs, text, doc_id, block_chars), "exact-groups")
    kept = named.where("kept").select(F.col(doc_id).alias("__id"), F.col("text_sha256").alias("__sha"))
    repeated = (
        named.groupBy(F.col(doc_id).alias("__id"), F.col("text_sha256").alias("__sha"))
        .agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    )
    keyed = docs.withColumn("__sha_own", F.sha2(normalised(F.col(text)), 256))
    same = F.col(doc_id).eqNullSafe(F.col("__id")) & (F.col("__sha_own") == F.col("__sha"))
    survivors = keyed.join(kept.join(repeated, ["__id", "__sha"], "left_anti"), same, "left_semi")
    # Rows equal in id and text: any one of them, few as ids should not repeat.
    if repeated.isEmpty():
        return survivors.drop("__sha_own")
    once = keyed.join(kept.join(repeated, ["__id", "__sha"], "left_semi"), same, "left_semi")
    return survivors.unionByName(once.dropDuplicates([doc_id, "__sha_own"])).drop("__sha_own")
