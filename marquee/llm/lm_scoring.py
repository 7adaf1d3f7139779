"""LM scoring by cross-entropy difference of two matched n-gram models.

A target model (trusted documents, label 1) and a background model (all
documents) share one vocabulary: every word of the corpus. Both are class-based
bigram models, smoothed alike. A word that makes up a ``FREQUENT``th of all
words or more is a symbol of its own; every other word belongs to a symbol by
its length and characters. A word's probability is

* that of its symbol after the symbol before it: the bigram's share of its
  history, interpolated with the smoothed symbol share;
* times, for a word without a symbol of its own, its smoothed share of the
  words of its symbol.

A document's score is its mean target loss minus its mean background loss
(nats per word); lower is closer to the target.

What is counted grows with the corpus and stays distributed: one row per
different word. Only parts with a proven bound leave it: at most ``FREQUENT``
words can each make up a ``FREQUENT``th of the corpus, which bounds the bigram
tables, and at most ``HOT`` words a ``HOT``th, whose losses are looked up where
texts are read. All rarer words, no longer hot by that rule, meet their losses
in a join on the word, one row per word and different text; only sums come
back. Trusted texts are found through a Bloom filter of the labelled ids, so
other texts aren't shuffled to learn their label.

Defined cases: a null or wordless text has no words and null losses; a very
long text is one row per different word at most; an id with several labels
belongs to the target if one of them is 1; without target documents the target
model is uniform; repeated documents count each time, and score alike; ties
in counts don't matter (both rules are thresholds); extra columns stay, those
named like an output are replaced; empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import words as W
from marquee.llm.repeats import digest_columns
from marquee.operators.join import may_match
from marquee.session import materialized

FREQUENT = 1024  # a word with at least this part of all words has its own symbol, so there are no more of them
HOT = 1 << 18  # likewise for words whose losses are broadcast (6 MB)
CLASSES = 8
MIX = 0.75  # weight of the bigram share against the symbol share
ADDED = 0.5  # added to every count of a symbol, and of a word within its symbol
LABEL_BITS = 1 << 23  # 1 MB: filter of the trusted ids

_MARKS = np.zeros(256, dtype=bool)  # ASCII digits and punctuation
_MARKS[0x21:0x41] = _MARKS[0x5B:0x61] = _MARKS[0x7B:0x7F] = True
_CHAR_START = (np.arange(256) & 0xC0) != 0x80


def _chunks(texts: pa.Array) -> Iterator[W.Chunk]:
    return W.chunks(texts, W.not_space(), W.lower_ascii())


def _classes(chunk: W.Chunk) -> np.ndarray:
    """Class of each word, by characters (four at a time, up to 13) and whether it holds a digit or mark."""
    chars = np.concatenate(([0], np.cumsum(_CHAR_START[chunk.data])))
    marks = np.concatenate(([0], np.cumsum(_MARKS[chunk.data])))
    length = chars[chunk.end] - chars[chunk.start]
    return np.minimum((length - 1) // 4, 3) + 4 * (marks[chunk.end] > marks[chunk.start])


def _places(sorted_: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether it is there) of values in a sorted array."""
    if not len(sorted_):
        return np.zeros(len(values), np.int64), np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)
    return at, sorted_[at] == values


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, counts, kinds = [], [], []
        for chunk in _chunks(batch.column(0)):
            found = chunk.hashes()
            first, count = W.repeats(np.zeros(len(found), np.int64), found)
            hashes.append(found[first])
            counts.append(count[first])
            kinds.append(_classes(chunk)[first])
        if not hashes:
            continue
        word, at, group = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        total = np.bincount(group, np.concatenate(counts), len(at)).astype(np.int64)
        kind = np.concatenate(kinds)[at].astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(kind), pa.array(total)], ["word", "kind", "n"])


def trusted_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text) of the documents with label 1; texts that can't have one are left where they are."""
    trusted = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    maybe = may_match(docs.select("doc_id", "text"), trusted, "doc_id", LABEL_BITS)
    # one plan at every size: a sorted shuffle join, also where the ids would fit a broadcast
    return materialized(maybe.join(trusted.hint("merge"), "doc_id", "left_semi").select("text"), "trusted-texts")


def word_counts(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(word, kind, background, target): a row for every word (by hash) of the corpus; A-Z lower-cased."""
    counted = "word bigint, kind int, n bigint"
    of_all = docs.select("text").mapInArrow(_count_words, counted).select("word", "kind", "n", F.lit(0).cast("bigint").alias("t"))
    of_target = trusted.mapInArrow(_count_words, counted).select("word", "kind", F.lit(0).cast("bigint").alias("n"), F.col("n").alias("t"))
    both = of_all.unionAll(of_target).groupBy("word").agg(F.min("kind").alias("kind"), F.sum("n").alias("background"), F.sum("t").alias("target"))
    return materialized(both, "word-counts")


class Symbols:
    """Maps words to numbers: frequent words first, then the classes of other words."""

    def __init__(self, frequent: np.ndarray):
        self.known = np.sort(frequent)
        self.n_words = len(frequent)
        self.n = len(frequent) + CLASSES

    def of(self, chunk: W.Chunk, hashes: np.ndarray) -> np.ndarray:
        at, known = _places(self.known, hashes)
        return np.where(known, at, self.n_words + _classes(chunk))

    def cells(self, chunk: W.Chunk, hashes: np.ndarray) -> np.ndarray:
        """One cell per word: history (the last number: start of text) times ``n``, plus the symbol."""
        now = self.of(chunk, hashes)
        before = np.concatenate(([self.n], now[:-1])) if len(now) else now
        before[chunk.first_word[:-1][np.diff(chunk.first_word) > 0]] = self.n
        return before * self.n + now


def _count_cells(frequent: Broadcast):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Symbols(frequent.value)
        size = (symbols.n + 1) * symbols.n
        total = np.zeros(size, np.int64)
        for batch in batches:
            for chunk in _chunks(batch.column(0)):
                total += np.bincount(symbols.cells(chunk, chunk.hashes()), minlength=size)
        cell = np.flatnonzero(total)
        for lo in range(0, len(cell), 100_000):
            part = cell[lo : lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["cell", "n"])

    return count


def bigram_counts(texts: DataFrame, frequent: np.ndarray) -> np.ndarray:
    """Counts of all cells over the texts; there are (``FREQUENT`` + 9) * (``FREQUENT`` + 8) at most."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent)
    counted = texts.select("text").mapInArrow(_count_cells(shared), "cell bigint, n bigint")
    found = counted.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    n = len(frequent) + CLASSES
    table = np.zeros((n + 1) * n)
    table[found["cell"].to_numpy()] = found["n"].to_numpy()
    return table


def losses(counts: np.ndarray, n: int) -> np.ndarray:
    """Loss of every cell from its counts: ``-ln(MIX * bigram share + (1 - MIX) * symbol share)``."""
    table = counts.reshape(n + 1, n).astype(np.float64)
    word = table.sum(axis=0)
    unigram = (word + ADDED) / (word.sum() + ADDED * n)
    history = table.sum(axis=1, keepdims=True)
    share = np.divide(table, history, out=np.zeros_like(table), where=history > 0)
    mixed = np.where(history > 0, MIX * share + (1 - MIX) * unigram, unigram)
    return -np.log(mixed).ravel()


@dataclass
class Model:
    """What tasks get (all of it bounded), and the words that stay distributed."""

    frequent: np.ndarray  # word hashes
    tables: np.ndarray  # losses of all cells (background, target)
    hot: np.ndarray  # sorted word hashes, no frequent ones
    hot_losses: np.ndarray  # within their symbol (background, target)
    rare: DataFrame  # (word, background, target): losses of all other words within their symbol

    def shared(self) -> tuple[np.ndarray, ...]:
        return self.frequent, self.tables, self.hot, self.hot_losses


def train_models(docs: DataFrame, labels: DataFrame, frequent_part: int = FREQUENT, hot_part: int = HOT) -> Model:
    """Both models; a word is frequent, or hot, from that part of all words on."""
    trusted = trusted_texts(docs, labels)
    counts = word_counts(docs, trusted)
    n_words = counts.agg(F.sum("background")).first()[0] or 0
    own = F.col("background") * frequent_part >= n_words
    frequent = counts.where(own).select("word").toArrow()["word"].to_numpy().astype(np.int64).view(np.uint64)
    tables = np.stack([losses(bigram_counts(t, frequent), len(frequent) + CLASSES) for t in (docs, trusted)])

    others = counts.where(~own)
    kinds = {r["kind"]: r for r in others.groupBy("kind").agg(F.count("*").alias("words"), F.sum("background").alias("background"), F.sum("target").alias("target")).collect()}

    def within(name: str):
        """Loss of a word within its symbol."""
        totals = [float(kinds[k][name] + ADDED * kinds[k]["words"]) if k in kinds else 1.0 for k in range(CLASSES)]
        return -F.log((F.col(name) + F.lit(ADDED)) / F.get(F.array(*map(F.lit, totals)), F.col("kind")))

    lost = others.select("word", within("background").alias("background"), within("target").alias("target"), (F.col("background") * hot_part >= n_words).alias("hot"))
    hot = lost.where("hot").toArrow()  # at most hot_part rows
    word = hot["word"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(word)
    hot_losses = np.stack([hot[c].to_numpy().astype(np.float64)[order] for c in ("background", "target")])
    return Model(frequent, tables, word[order], hot_losses, lost.where("not hot").drop("hot"))


SCORES = "struct<n_words:bigint,target:double,background:double>"


def _scorer(model: Broadcast):
    @F.arrow_udf(SCORES)
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        frequent, tables, hot, hot_losses = model.value
        symbols = Symbols(frequent)
        for texts in batches:
            n_words = np.zeros(len(texts), np.int64)
            sums = np.zeros((2, len(texts)))
            for chunk in _chunks(texts):
                rows = slice(chunk.first_row, chunk.first_row + chunk.n_rows)
                hashes = chunk.hashes()
                cells = symbols.cells(chunk, hashes)
                n_words[rows] = np.diff(chunk.first_word)
                at, is_hot = _places(hot, hashes)
                for k in range(2):
                    loss = tables[k][cells]
                    loss[is_hot] += hot_losses[k][at[is_hot]]
                    sums[k, rows] = np.bincount(chunk.row, loss, chunk.n_rows)
            yield pa.StructArray.from_arrays([pa.array(n_words), pa.array(sums[1]), pa.array(sums[0])], ["n_words", "target", "background"])

    return score


def _rare_words(model: Broadcast):
    """(d1, d2, word, n): the words of each text whose losses aren't broadcast."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, _, hot, _ = model.value
        known = np.sort(np.concatenate((frequent, hot)))
        for batch in batches:
            for chunk in _chunks(batch["text"]):
                hashes = chunk.hashes()
                rare = ~_places(known, hashes)[1]
                row, word = chunk.row[rare], hashes[rare]
                first, count = W.repeats(row, word)
                of = pa.array(chunk.first_row + row[first])
                columns = [batch["d1"].take(of), batch["d2"].take(of), pa.array(word[first].view(np.int64)), pa.array(count[first])]
                yield pa.RecordBatch.from_arrays(columns, ["d1", "d2", "word", "n"])

    return find


def _rare_sums(docs: DataFrame, model: Model, shared: Broadcast) -> DataFrame:
    """(d1, d2, target, background): the rare words' losses of each different text that has some."""
    texts = docs.select(*digest_columns(F.col("text")), "text").where(F.col("text").isNotNull())
    found = texts.mapInArrow(_rare_words(shared), "d1 bigint, d2 bigint, word bigint, n bigint")
    # by word, so that the join below finds its partitioning; equal texts become one there
    once = found.repartition("word").groupBy("word", "d1", "d2").agg(F.max("n").alias("n"))
    met = once.join(model.rare.hint("merge"), "word")
    sums = [F.sum(F.col("n") * F.col(c)).alias(c) for c in ("target", "background")]
    return met.groupBy("d1", "d2").agg(*sums)


def score_documents(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``n_words``, ``loss_target``, ``loss_background`` and ``score``, which replace columns of those names."""
    outputs = ("n_words", "loss_target", "loss_background", "score")
    own = [c for c in keep or docs.columns if c.lower() not in outputs]
    shared = docs.sparkSession.sparkContext.broadcast(model.shared())
    digests = [c.alias(f"__{k}") for k, c in enumerate(digest_columns(F.col("text")))]
    first = docs.select(*own, *digests, _scorer(shared)(F.col("text")).alias("__lm"))
    rare = materialized(_rare_sums(docs, model, shared), "rare-words").select("d1", "d2", F.struct("target", "background").alias("__rare"))
    joined = first.join(rare.hint("merge"), (F.col("__0") == F.col("d1")) & (F.col("__1") == F.col("d2")), "left")
    n_words = F.col("__lm.n_words")

    def mean(name: str):
        return F.when(n_words > 0, (F.col(f"__lm.{name}") + F.coalesce(F.col(f"__rare.{name}"), F.lit(0.0))) / n_words)

    target, background = mean("target"), mean("background")
    return joined.select(
        *own, n_words.alias("n_words"), target.alias("loss_target"), background.alias("loss_background"), (target - background).alias("score")
    )


def lm_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_documents(docs.select("doc_id", "text"), train_models(docs, labels), keep=["doc_id"])
    rounded = [F.round(c, 6).alias(c) for c in ("loss_target", "loss_background", "score")]
    return scored.select("doc_id", "n_words", *rounded)
