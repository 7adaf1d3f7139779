"""Mixing sources to target weights, cut at each source's exact budget.

Every document gets a hash-random key; a source's documents, in key order, are
taken until the source's budget of words is reached, after as many whole
epochs as the budget holds. Sorting and prefix sums are done by key range: the
word counts of ``RANGES`` key ranges per source give the prefix sum at each
range's start, and only the range in which the budget ends is sorted by key.
What is taken of any document then follows from its source's cut point alone,
so documents are neither sorted nor shuffled whole, however large one source is.

Defined cases:

* null source: a source of its own, the last one; null text: no words;
* a source without words has target 0; documents without words take nothing;
* rows with the same id and size share one key: if the cut falls on such
  rows, each takes the same number of words (the rest of a division is left);
* a very long text counts with all its words, and may be cut at the budget;
* extra columns of any name pass through (rows travel as one struct);
* null id: hashed as the empty string; empty table: no sources, no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import materialized

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all words
MAX_EPOCHS = 2
RANGES = 1024


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def mix_key(doc_id: Column, seed: str) -> Column:
    """Hash-random key in [0, 2^60)."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def key_range(key: Column) -> Column:
    return F.shiftright(key, 50).cast("int")  # 2^60 / 2^50 = RANGES


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(source, source_size) -> adds ``weight`` and ``target``.

    Sources share ``share`` of all words by weight; a target stops at
    ``MAX_EPOCHS`` times its source, and the excess goes to the others by
    weight. With sources in the order of the level at which they fill up, the
    full ones come first, so one pass of prefix sums finds the level.
    """
    everything = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn(
        "nth", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    ).withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("nth") % len(weights) + 1))
    capped = ranked.withColumn("cap", (F.lit(MAX_EPOCHS) * F.col("source_size")).cast("double")).withColumn(
        "full_at", F.col("cap") / F.col("weight")
    )
    by_level = everything.orderBy("full_at", "nth").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(by_level), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_level), F.lit(0.0))
    )
    levels = capped.withColumn("level", level)
    # the level of the first source that doesn't fill up holds for all others
    open_level = F.min(F.when(F.col("full_at") >= F.col("level"), F.struct("full_at", "nth", "level"))).over(everything)
    return levels.withColumn("open", open_level["level"]).select(
        "source",
        "source_size",
        "weight",
        F.least(F.col("cap"), F.coalesce(F.col("weight") * F.col("open"), F.col("cap"))).alias("target"),
    )


def cut_points(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, seed: str = "mix-1"
) -> DataFrame:
    """One row per source: target, whole epochs, and the key, size and words of the document that the cut falls on.

    Written to the checkpoint folder and read back, so that its true size is
    known to the join that uses it.
    """
    key = mix_key(F.col("doc_id"), seed)
    keyed = docs.select("source", key.alias("key"), "text").withColumn("range", key_range(F.col("key")))
    ranges = keyed.groupBy("source", "range").agg(F.sum(n_words(F.col("text"))).alias("range_size"))
    ranges = materialized(ranges, "mix-ranges")

    sizes = ranges.groupBy("source").agg(F.sum("range_size").alias("source_size"))
    budget = F.floor("target").cast("bigint")
    targets = source_targets(sizes, weights, share).select(
        F.col("source").alias("of"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as bigint) div source_size"))
        .otherwise(0)
        .cast("bigint")
        .alias("epochs"),
        budget.alias("budget"),
    ).withColumn("part", F.col("budget") - F.col("epochs") * F.col("source_size"))

    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    at_start = ranges.withColumn("before", F.coalesce(F.sum("range_size").over(earlier), F.lit(0).cast("bigint")))
    cut_range = (
        at_start.join(targets, F.col("source").eqNullSafe(F.col("of")))
        .where((F.col("before") <= F.col("part")) & (F.col("part") < F.col("before") + F.col("range_size")))
        .select("of", F.col("range").alias("in_range"), "before", "part")
    )
    inside = keyed.join(
        materialized(cut_range, "mix-cut-ranges"), F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("in_range"))
    ).select("of", "key", n_words(F.col("text")).alias("size"), "before", "part")
    ties = inside.groupBy("of", "key", "size", "before", "part").agg(F.count(F.lit(1)).alias("n"))
    so_far = Window.partitionBy("of").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        ties.withColumn("upto", F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(so_far), F.lit(0)))
        .where((F.col("upto") <= F.col("part")) & (F.col("part") < F.col("upto") + F.col("size") * F.col("n")))
        .select(
            F.col("of").alias("cut_of"),
            F.col("key").alias("cut_key"),
            F.col("size").alias("cut_size"),
            F.expr("(part - upto) div n").alias("cut_words"),
        )
    )
    found = targets.join(cuts, F.col("of").eqNullSafe(F.col("cut_of")), "left").select(
        "of", "source_size", "target", "epochs", "cut_key", "cut_size", "cut_words"
    )
    return materialized(found, "mix-cuts")


def taken_words(docs: DataFrame, cuts: DataFrame, seed: str = "mix-1") -> DataFrame:
    """(doc, mix): the row of ``docs``, and its size, source_size, target, taken, epochs and extra (words beyond the epochs)."""
    sized = docs.select(F.struct("*").alias("doc")).select(
        "doc", n_words(F.col("doc.text")).alias("size"), mix_key(F.col("doc.doc_id"), seed).alias("key")
    )
    here, cut = F.struct("key", "size"), F.struct("cut_key", "cut_size")
    extra = (
        F.when(F.col("cut_key").isNull() | (here > cut), F.lit(0).cast("bigint"))
        .when(here < cut, F.col("size"))
        .otherwise(F.col("cut_words"))
    )
    taken = (F.col("epochs") * F.col("size") + F.col("extra")).alias("taken")
    return (
        sized.join(cuts, F.col("doc.source").eqNullSafe(F.col("of")))
        .withColumn("extra", extra)
        .select("doc", F.struct("size", "source_size", "target", taken, "epochs", "extra").alias("mix"))
    )


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word, white space kept."""
    pieces = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    return F.array_join(F.slice(pieces, F.lit(1), F.greatest(n, F.lit(1)).cast("int")), "")


def mix_sources(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, seed: str = "mix-1"
) -> DataFrame:
    """The mixed documents: one row per copy, in the columns of ``docs``.

    A document comes once per whole epoch, and once more if it lies before its
    source's cut; the document on the cut is shortened to the words that the
    budget leaves for it (``n_chars``, if there, follows).
    """
    slim = docs.select("doc_id", "source", "text")
    marked = taken_words(docs, cut_points(slim, weights, share, seed), seed)
    parts = F.concat(
        F.array_repeat(F.col("mix.size"), F.col("mix.epochs").cast("int")),
        F.when(F.col("mix.extra") > 0, F.array("mix.extra")).otherwise(F.expr("cast(array() as array<bigint>)")),
    )
    copies = marked.where(F.col("mix.taken") > 0).withColumn("part", F.explode(parts))
    cut, text = F.col("part") < F.col("mix.size"), F.col("doc.text")
    shortened = first_words(text, F.col("part"))
    out = F.col("doc").withField("text", F.when(cut, shortened).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withField("n_chars", F.when(cut, F.length(shortened).cast("bigint")).otherwise(F.col("doc.n_chars")))
    return copies.select(out.alias("doc")).select("doc.*")


def mix_report(docs: DataFrame) -> DataFrame:
    slim = docs.select("doc_id", "source", "text")
    return taken_words(slim, cut_points(slim)).select(
        "doc.doc_id",
        F.col("mix.size").alias("size"),
        F.col("mix.source_size").alias("source_size"),
        F.col("mix.target").alias("target"),
        F.col("mix.taken").alias("taken"),
    )
