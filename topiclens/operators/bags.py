"""Articles as bags of words: what topic models read.

A row is a piece of the table, some articles together: their ids, the piece's distinct words, and
which article has which of them how often, as numbers. So a word is a string once in a piece, and
work on words (stop words, lemmas, stems, weights) is done once for each of a piece's words. Numbers
are bytes of 32-bit ones, which cross between Spark and Python whole and not one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topiclens.functions import words
from topiclens.functions.wordlists import STOP_WORDS
from topiclens.operators import terms

#: Bytes of text that make a piece, about.
TEXT_BYTES = 8 << 20
#: Entries of a table of terms up to which every task has a copy of it.
HELD = 1 << 18
NAMES = ["post_ids", "ends", "words", "numbers", "counts"]


@dataclass
class Piece:
    """`ids` of articles and `words`; article `owner` has the word `number` `n` times, in order."""

    ids: pa.Array
    words: pa.Array
    owner: np.ndarray
    number: np.ndarray
    n: np.ndarray

    def row(self) -> pa.RecordBatch:
        ends = np.searchsorted(self.owner, np.arange(len(self.ids)), "right")
        ends, number, n = (packed(x, np.int32) for x in (ends, self.number, self.n))
        return pa.RecordBatch.from_arrays([listed(self.ids), ends, listed(self.words), number, n], names=NAMES)


def listed(values: pa.Array) -> pa.ListArray:
    """A column of one row that has them all."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def packed(values: np.ndarray, kind: type) -> pa.Array:
    """A column of one row: the numbers' bytes."""
    return pa.array([values.astype(kind).tobytes()], pa.binary())


def unpacked(value: pa.BinaryScalar, kind: type) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), kind)


def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[Piece]:
    """The pieces of rows with the columns NAMES."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids, held = (batch.column(c)[i].values for c in (0, 2))
            ends, number, n = (unpacked(batch.column(c)[i], np.int32) for c in (1, 3, 4))
            owner = np.repeat(np.arange(len(ids)), np.diff(ends, prepend=0))
            yield Piece(ids, held, owner, number.astype(np.int64), n.astype(np.int64))


def is_bags(df: DataFrame) -> bool:
    return df.columns == NAMES


def _schema(kind: str) -> str:
    return f"post_ids array<{kind}>, ends binary, words array<string>, numbers binary, counts binary"


def kind_of(bags: DataFrame) -> str:
    """The type of the articles' ids."""
    return bags.schema["post_ids"].dataType.elementType.simpleString()


def _counted(ids: pa.Array, owner: np.ndarray, coded: pa.DictionaryArray) -> Piece:
    owner, number, n = terms.counted(owner, coded.indices.to_numpy().astype(np.int64), len(coded.dictionary))
    return Piece(ids, coded.dictionary, owner, number, n)


def of_tokens(tokens: DataFrame) -> DataFrame:
    """Bags of `post_id, tokens`; null tokens count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, sizes in terms.pieces(batch):
                found = rows.column(1).flatten()
                owner = np.repeat(np.arange(len(sizes)), sizes)[found.is_valid().to_numpy(zero_copy_only=False)]
                yield _counted(rows.column(0), owner, found.drop_null().dictionary_encode()).row()

    kind = tokens.schema["post_id"].dataType.simpleString()
    return tokens.select("post_id", "tokens").mapInArrow(run, _schema(kind))


def of_texts(articles: DataFrame, text: Column, split: Callable, stop_words: Iterable[str]) -> DataFrame:
    """Bags of a column of text by a function of `functions.words`, without stop words."""
    stop = sorted({w.lower() for w in stop_words})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left_out = pa.array(stop, pa.string())
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            for start, stop_at in terms.slices(sizes.astype(np.int64), TEXT_BYTES):
                rows = batch.slice(start, stop_at - start)
                owner, coded = split(rows.column(1))
                wanted = pc.invert(pc.is_in(coded.dictionary, value_set=left_out))
                wanted = wanted.to_numpy(zero_copy_only=False)
                number = coded.indices.to_numpy()
                kept = wanted[number]
                places = pa.array((np.cumsum(wanted) - 1)[number[kept]].astype(np.int32))
                held = coded.dictionary.filter(pa.array(wanted))
                yield _counted(rows.column(0), owner[kept], pa.DictionaryArray.from_arrays(places, held)).row()

    kind = articles.schema["post_id"].dataType.simpleString()
    return articles.select("post_id", text.alias("text")).mapInArrow(run, _schema(kind))


def of_articles(articles: DataFrame, stop_words: Iterable[str] = STOP_WORDS) -> DataFrame:
    """Bags of the tokens that `articles.with_tokens` gives, from the text itself."""
    return of_texts(articles, F.col("text"), words.article_words, stop_words)


def of(frame: DataFrame) -> DataFrame:
    """Bags as they are, those of `post_id, tokens` otherwise."""
    return frame if is_bags(frame) else of_tokens(frame)


def articles_in(bags: DataFrame) -> int:
    return bags.agg(F.sum(F.size("post_ids"))).first()[0] or 0


def terms_of(bags: DataFrame) -> DataFrame:
    """`term`: every piece's words."""
    return bags.select(F.explode("words").alias("term"))


def counts(bags: DataFrame) -> DataFrame:
    """`post_id, term, tf`: as `terms.term_counts` of the tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in opened(batches):
            for start in range(0, len(p.n), terms.TOGETHER):
                owner, number, n = (pa.array(x[start : start + terms.TOGETHER]) for x in (p.owner, p.number, p.n))
                yield pa.RecordBatch.from_arrays(
                    [p.ids.take(owner), p.words.take(number), n], names=["post_id", "term", "tf"]
                )

    return bags.mapInArrow(run, f"post_id {kind_of(bags)}, term string, tf bigint")


def totals(bags: DataFrame, min_tf: float) -> DataFrame:
    """`term, corpus_count, doc_freq, kept_docs`: as `terms.totals` of the counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in opened(batches):
            least = min_tf if min_tf >= 1 else min_tf * np.bincount(p.owner, weights=p.n)[p.owner]
            size = len(p.words)
            # Whole numbers far below 2^53, so these sums of doubles are exact.
            found = [np.bincount(p.number, weights=w, minlength=size) for w in (p.n, None, p.n >= least)]
            yield pa.RecordBatch.from_arrays(
                [p.words, *[pa.array(x.astype(np.int64)) for x in found]],
                names=["term", "corpus_count", "doc_freq", "kept_docs"],
            )

    made = bags.mapInArrow(run, "term string, corpus_count bigint, doc_freq bigint, kept_docs bigint")
    return made.groupBy("term").agg(*[F.sum(c).alias(c) for c in made.columns[1:]])


def _renamed(p: Piece, names: pa.Array) -> Piece:
    """The piece with other words; counts of words that become one are added up."""
    coded = pc.coalesce(names, p.words).dictionary_encode()
    size = max(len(coded.dictionary), 1)
    number = coded.indices.to_numpy().astype(np.int64)[p.number]
    pair, place = np.unique(p.owner * size + number, return_inverse=True)
    n = np.bincount(place, weights=p.n, minlength=len(pair)).astype(np.int64)
    return Piece(p.ids, coded.dictionary, *np.divmod(pair, size), n)


def with_terms(bags: DataFrame, table: DataFrame, target: str) -> DataFrame:
    """Bags with terms replaced by `target` of a (term, target) table; others stay.

    A table of up to HELD terms that change is copied to all tasks; a larger one is joined with
    the pieces' words. The bags are read again then, so they should be settled.
    """
    table = table.select("term", F.col(target).alias("target")).where("term <> target")
    held = table.limit(HELD + 1).toArrow()
    if held.num_rows > HELD:
        return joined_terms(bags, table)
    shared = bags.sparkSession.sparkContext.broadcast(held.combine_chunks())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, targets = (c.combine_chunks() for c in shared.value.columns)
        for p in opened(batches):
            found = pc.index_in(p.words, value_set=known, skip_nulls=True)
            changed = found.null_count < len(found)
            yield (_renamed(p, targets.take(found).cast(p.words.type)) if changed else p).row()

    return bags.mapInArrow(run, _schema(kind_of(bags)))


def joined_terms(bags: DataFrame, table: DataFrame) -> DataFrame:
    """The same by a join with a table (term, target): a piece gets back the words that change."""
    # Settled bags are read in the same parts and order each time, so these ids stay.
    numbered = bags.withColumn("piece", F.monotonically_increasing_id())
    changed = (
        numbered.select("piece", F.posexplode("words").alias("place", "term"))
        .join(table, "term")
        .groupBy("piece")
        .agg(F.collect_list("place").alias("places"), F.collect_list("target").alias("targets"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, p in enumerate(opened(iter([batch.select(NAMES)]))):
                places, targets = (batch.column(c)[i].values for c in ("places", "targets"))
                if places is None:
                    yield p.row()
                    continue
                at = np.full(len(p.words), -1)
                at[places.to_numpy()] = np.arange(len(places))
                yield _renamed(p, targets.take(pa.array(at, mask=at < 0)).cast(p.words.type)).row()

    joined = numbered.join(changed, "piece", "left").select(*NAMES, "places", "targets")
    return joined.mapInArrow(run, _schema(kind_of(bags)))
