"""Explode, the nested bag of the first k rows per key, and bags of whole groups in chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.text import TOKEN_DELIMITERS, delimiter_pattern, split_list
from marquee.operators.topk import top_k_per_group


CHUNK_ROWS = 10_000


def explode_list(
    df: DataFrame, list_col: str, out_col: str, keep: Sequence[str], separator: str | None = None
) -> DataFrame:
    """One row per element of a list column (or of a delimited string when
    ``separator`` is given). Blank elements are dropped, repeats kept."""
    items = split_list(F.col(list_col), separator) if separator else F.col(list_col)
    return df.select(*keep, F.explode(items).alias(out_col))


def explode_tokens(
    df: DataFrame,
    text: Column,
    keep: Sequence[str],
    out_col: str = "word",
    delimiters: str = TOKEN_DELIMITERS,
) -> DataFrame:
    """One row per token occurrence of ``text``; a NULL or token-less text gives no row.

    The empty pieces left by leading delimiters are dropped after the
    explode with a plain filter: an array ``filter`` lambda is not
    code-generated, a ``where`` on the exploded column is. The pattern is
    possessive: after a run of delimiters nothing is tried again.
    """
    pieces = df.select(F.explode(F.split(text, delimiter_pattern(delimiters) + "+")).alias(out_col), *keep)
    return pieces.where(F.col(out_col) != F.lit(""))


def top_k_bag(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[Column],
    limit: int,
    fields: Sequence[str],
    bag_col: str = "bag",
) -> DataFrame:
    """The first ``limit`` rows per key as one ordered bag.

    The limit comes first (a partial limit runs before the exchange), so a
    bag never holds more than ``limit`` entries however large the group is.
    The bag is ordered by a ``__pos`` field and then dropped to the requested
    fields.
    """
    limited = top_k_per_group(df, keys, order_cols, limit, rank_col="__pos")
    bag = F.array_sort(F.collect_list(F.struct(F.col("__pos"), *[F.col(f) for f in fields])))
    grouped = limited.groupBy(*keys).agg(bag.alias("__bag"))
    return grouped.select(
        *keys,
        F.transform("__bag", lambda e: F.struct(*[e[f].alias(f) for f in fields])).alias(bag_col),
    )


def group_bags(
    df: DataFrame, keys: Sequence[str], fields: Sequence[str], chunk_rows: int = CHUNK_ROWS, bag_col: str = "bag"
) -> DataFrame:
    """Whole groups as bags: (keys, chunk, bag), with at most ``chunk_rows`` entries a bag.

    A group is cut into chunks with different numbers (ascending, with gaps),
    so it may be of any size: no row, and no task, ever holds more of a group
    than one input partition had of it. Rows are numbered per key and input
    partition; that is the only shuffle, and a hot key is dealt over as many
    tasks as it had partitions. Equal rows and NULL keys and fields stay, as in
    a bag. The order within a group is not defined.
    """
    parts = df.select(*keys, F.struct(*fields).alias("__entry"), F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__row"))
    place = F.row_number().over(Window.partitionBy(*keys, "__part").orderBy("__row")) - 1
    chunked = parts.withColumn("__no", F.floor(place / F.lit(chunk_rows)))
    bags = chunked.groupBy(*keys, "__part", "__no").agg(F.collect_list("__entry").alias(bag_col))
    number = F.col("__part").cast("bigint") * F.lit(1 << 32) + F.col("__no")
    return bags.select(*keys, number.alias("chunk"), bag_col)


def fold_bags(df: DataFrame, keys: Sequence[str], measures: dict[str, tuple[Column, Column]], bag_col: str = "bag") -> DataFrame:
    """Per-group results from chunked bags: ``{name: (of a bag, merged)}``.

    The first expression works on one bag (``F.aggregate`` over ``bag_col``, or ``F.size``), the
    second is an aggregate that merges the chunks' results, held in columns named like the measures.
    """
    per_chunk = df.select(*keys, *[of_bag.alias(name) for name, (of_bag, _) in measures.items()])
    return per_chunk.groupBy(*keys).agg(*[merged.alias(name) for name, (_, merged) in measures.items()])


def unnest_group(df: DataFrame, keys: Sequence[str], bag_col: str = "bag") -> DataFrame:
    """Flatten a bag of structs back into rows (``inline``)."""
    return df.select(*keys, F.inline(F.col(bag_col)))
