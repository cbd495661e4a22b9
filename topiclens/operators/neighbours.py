"""Words used alike: co-occurrence counts, their weights, and few numbers for each word.

Counts of word pairs that stand near each other are one stripe for each word. Their weight is the positive
part of the pointwise mutual information. A word's weights over the commonest words are a
sparse row; randomised subspace iteration over all rows finds the directions that keep most of
them, and words are compared by the cosine of what the directions keep of them.

Rounds add up whole numbers, so the result is the same on any number of tasks. A row stays in
its task; the driver gets one number for each common word and direction, whatever the table's
size, and nothing for each word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclens import storage
from topiclens.operators.terms import MIN_DF, VOCAB_SIZE, pieces

WINDOW = 5
DIRECTIONS = 50
ROUNDS = 4
# Weights and directions are whole numbers of these parts.
_WEIGHT, _PART = 1 << 10, 1 << 16
# Tokens whose pairs are counted together; sums are sent in two parts, the higher in this unit.
TOGETHER, _HIGH = 1 << 20, 1 << 32


def _stripes(words: pa.Array, owner: np.ndarray, contexts: pa.Array, window: int) -> pa.RecordBatch:
    """`word, places, n`: of each distinct word, the places of contexts near it and how often."""
    coded = words.dictionary_encode()
    number = coded.indices.to_numpy().astype(np.int64)
    place = pc.index_in(words, value_set=contexts).fill_null(-1).to_numpy().astype(np.int64)
    size = max(len(contexts), 1)
    found, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for by in range(1, min(window, len(number) - 1) + 1):
        same = owner[by:] == owner[:-by]
        for word, context in ((number[:-by], place[by:]), (number[by:], place[:-by])):
            kept = same & (context >= 0)
            pair, n = np.unique(word[kept] * size + context[kept], return_counts=True)
            found.append(pair)
            times.append(n)
    pair, at = np.unique(np.concatenate(found), return_inverse=True)
    n = np.zeros(len(pair), np.int64)
    np.add.at(n, at, np.concatenate(times))
    return _striped(coded.dictionary, pair, size, n)


def _striped(words: pa.Array, pair: np.ndarray, size: int, n: np.ndarray) -> pa.RecordBatch:
    """Stripes from ordered pairs of a word's number and a place below `size`."""
    word, first = np.unique(pair // size, return_index=True)
    ends = pa.array(np.append(first, len(pair)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            words.take(pa.array(word)),
            pa.ListArray.from_arrays(ends, pa.array((pair % size).astype(np.int32))),
            pa.ListArray.from_arrays(ends, pa.array(n)),
        ],
        names=["word", "places", "n"],
    )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stripes in the order of their words to one stripe for each word."""
    last = None
    for batch in batches:
        parts = [batch] if last is None else [last, batch]
        rows = pa.Table.from_batches(parts).combine_chunks()
        if not rows.num_rows:
            continue
        coded = rows["word"].combine_chunks().dictionary_encode()
        owner = np.repeat(coded.indices.to_numpy(), pc.list_value_length(rows["places"]).to_numpy())
        place = rows["places"].combine_chunks().flatten().to_numpy().astype(np.int64)
        size = int(place.max(initial=0)) + 1
        pair, at = np.unique(owner * np.int64(size) + place, return_inverse=True)
        n = np.zeros(len(pair), np.int64)
        np.add.at(n, at, rows["n"].combine_chunks().flatten().to_numpy())
        made = _striped(coded.dictionary, pair, size, n)
        last = made.slice(made.num_rows - 1)
        yield made.slice(0, made.num_rows - 1)
    if last is not None:
        yield last


def common_words(contexts: DataFrame) -> pa.Array:
    """The contexts by their places in a stripe: by `term_id`, or as they come."""
    kept = contexts.where("term IS NOT NULL")
    ordered = kept.orderBy("term_id") if "term_id" in contexts.columns else kept
    return ordered.select("term").toArrow()["term"].combine_chunks()


def pair_stripes(tokens: DataFrame, contexts: pa.Array, window: int = WINDOW) -> DataFrame:
    """`word, places, n`: places of the contexts at most `window` places away, in order, and how often.

    Pairs are counted by numbers where the tokens are, by laying them beside themselves, moved
    by each distance; so the work is in proportion to the tokens. A word's counts travel once,
    as a stripe over the contexts, of which every task has a copy. Each pair counts in both
    directions; words without one have no stripe.
    """
    shared = tokens.sparkSession.sparkContext.broadcast(contexts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, sizes in pieces(batch, TOGETHER):
                words = rows.column(1).flatten()
                owner = np.repeat(np.arange(len(sizes)), sizes)[words.is_valid().to_numpy(zero_copy_only=False)]
                yield _stripes(words.drop_null(), owner, shared.value, window)

    kind = "word string, places array<int>, n array<bigint>"
    stripes = tokens.select(F.lit(0), "tokens").mapInArrow(run, kind)
    return stripes.repartition("word").sortWithinPartitions("word").mapInArrow(_merged, kind)


def pair_counts(tokens: DataFrame, contexts: DataFrame, window: int = WINDOW) -> DataFrame:
    """`word, context, n`: the same in long form, `contexts` being a table with `term`."""
    terms = common_words(contexts)
    names = F.array(*[F.lit(t) for t in terms.to_pylist()]) if len(terms) else F.array().cast("array<string>")
    long = pair_stripes(tokens, terms, window).select("word", F.inline(F.arrays_zip("places", "n")))
    return long.select("word", F.get(names, F.col("places")).alias("context"), "n")


def weighted_pairs(stripes: DataFrame, size: int, least: int = MIN_DF) -> DataFrame:
    """`word, places, n, weights`: weight = ln(n * all / (word's * context's)), if above 0.

    Words with fewer than `least` pairs are left out, with their pairs, and so are those
    without a weight. `stripes` are read twice: for the sums, at most one for each context
    from each task, and for the weights.
    """
    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size, np.int64)
        for batch in batches:
            _, place, n, whole = _entries(batch, least)
            np.add.at(sums, place, n)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["at", "n"])

    sent = stripes.mapInArrow(added, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    context = np.zeros(size, np.int64)
    context[sent["at"].to_numpy()] = sent["n"].to_numpy()
    every = sum(context.tolist())
    shared = stripes.sparkSession.sparkContext.broadcast(context.astype(np.float64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = shared.value
        for batch in batches:
            owner, place, n, whole = _entries(batch, least)
            weight = np.log(n.astype(np.float64) * every / (whole * context[place]))
            kept = weight > 0
            owner, place, n, weight = owner[kept], place[kept], n[kept], weight[kept]
            word, first = np.unique(owner, return_index=True)
            ends = pa.array(np.append(first, len(owner)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(word)),
                    *[pa.ListArray.from_arrays(ends, pa.array(x)) for x in (place.astype(np.int32), n, weight)],
                ],
                names=["word", "places", "n", "weights"],
            )

    return stripes.mapInArrow(run, "word string, places array<int>, n array<bigint>, weights array<double>")


def _entries(batch: pa.RecordBatch, least: int):
    """Of each entry of the words with `least` pairs: its row, place, count and the word's pairs."""
    sizes = np.diff(batch.column(1).offsets.to_numpy())
    owner = np.repeat(np.arange(batch.num_rows), sizes)
    n = batch.column(2).flatten().to_numpy()
    whole = np.zeros(batch.num_rows, np.int64)
    np.add.at(whole, owner, n)
    kept = (whole >= least)[owner]
    place = batch.column(1).flatten().to_numpy()
    return owner[kept], place[kept], n[kept], whole[owner[kept]].astype(np.float64)


def _rows(weighed: DataFrame) -> DataFrame:
    """`word, places, weights`: a word's whole weights over the contexts, in order."""
    whole = F.transform("weights", lambda w: F.floor(w * _WEIGHT + 0.5).cast("long"))
    return weighed.select("word", "places", whole.alias("weights"))


def _add(out: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """Add rows to those of `out` that ordered numbers name."""
    first = np.flatnonzero(np.diff(at, prepend=-1))
    if len(first):
        out[at[first]] += np.add.reduceat(values, first, axis=0)


def _kept_of(batch: pa.RecordBatch, first: int, directions: np.ndarray):
    """Of each row: places and weights in one list, and its whole coordinates along the directions."""
    sizes = np.diff(batch.column(first).offsets.to_numpy())
    place = batch.column(first).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    weight = batch.column(first + 1).flatten().to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(batch.num_rows), sizes)
    made = np.zeros((batch.num_rows, directions.shape[1]), np.int64)
    for a in range(0, len(place), 1 << 16):
        part = slice(a, a + (1 << 16))
        _add(made, owner[part], weight[part, None] * directions[place[part]])
    return place, weight, owner, made // _WEIGHT


def _image(rows: DataFrame, directions: np.ndarray) -> np.ndarray:
    """The rows' transposed matrix times what they keep of the directions."""
    shared = rows.sparkSession.sparkContext.broadcast(directions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions = shared.value
        added = np.zeros(directions.shape, np.int64)
        for batch in batches:
            place, weight, owner, made = _kept_of(batch, 0, directions)
            for a in range(0, len(place), 1 << 16):
                part = slice(a, a + (1 << 16))
                order = np.argsort(place[part], kind="stable")
                values = weight[part][order, None] * made[owner[part][order]]
                _add(added, place[part][order], values)
        at = np.flatnonzero(added)
        sums = added.reshape(-1)[at]
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(sums & (_HIGH - 1)), pa.array(sums // _HIGH)],
            names=["at", "low", "high"],
        )

    sent = rows.select("places", "weights").mapInArrow(run, "at bigint, low bigint, high bigint")
    table = sent.groupBy("at").agg(F.sum("low").alias("low"), F.sum("high").alias("high")).toArrow()
    out = np.zeros(directions.size)
    both = zip(table["low"].to_pylist(), table["high"].to_pylist())
    out[table["at"].to_numpy()] = [float(low + _HIGH * high) for low, high in both]
    return out.reshape(directions.shape)


def _orthogonal(matrix: np.ndarray) -> np.ndarray:
    q, _ = np.linalg.qr(matrix)
    return np.floor(q * _PART + 0.5).astype(np.int64)


def directions_of(rows: DataFrame, size: int, number: int = DIRECTIONS, rounds: int = ROUNDS, seed: int = 123) -> np.ndarray:
    """Directions, as columns, that keep most of the rows: whole numbers of 1 / 65536."""
    found = _orthogonal(np.random.default_rng(seed).normal(size=(size, min(number, size))))
    for _ in range(rounds):
        image = _image(rows, found)
        if not image.any():
            break
        found = _orthogonal(image)
    return found


def similar_words(
    tokens: DataFrame,
    word: str,
    n: int = 10,
    contexts: int = VOCAB_SIZE,
    window: int = WINDOW,
    directions: int = DIRECTIONS,
    least: int = MIN_DF,
    seed: int = 123,
) -> DataFrame:
    """`word, similarity`: the n words used most like `word`, ties by word.

    Only words that occur `least` times are compared, and none if `word` has fewer than `least`
    pairs. `contexts` commonest words tell words apart; so a row has at most as many entries.
    """
    kept = F.filter("tokens", lambda t: t.isNotNull())
    totals = storage.settle(tokens.select(F.explode(kept).alias("term")).groupBy("term").count())
    common = totals.orderBy(F.desc("count"), "term").limit(contexts).collect()
    spark = tokens.sparkSession
    words = pa.array([r["term"] for r in common], pa.string())
    stripes = storage.settle(pair_stripes(tokens, words, window))
    rows = _rows(weighted_pairs(stripes, len(common), least))
    found = directions_of(rows, len(common), directions, seed=seed) if common else np.zeros((0, 0), np.int64)
    shared = spark.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = _kept_of(batch, 1, shared.value)[3].astype(np.float64)
            made /= np.maximum(np.sqrt((made * made).sum(axis=1)), 1e-300)[:, None]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(made), pa.list_(pa.float64()))], names=["word", "v"]
            )

    if not found.size:
        return spark.createDataFrame([], "word string, similarity double")
    placed = rows.mapInArrow(run, "word string, v array<double>")
    own = placed.where(F.col("word") == word).select(F.col("v").alias("own"))
    both = F.zip_with("v", "own", lambda a, b: a * b)
    cosine = F.round(F.reduce(both, F.lit(0.0), lambda s, x: s + x), 9)
    frequent = totals.where(F.col("count") >= least).select(F.col("term").alias("word"))
    others = placed.where(F.col("word") != word).join(F.broadcast(own))
    # One number for each word travels, not its coordinates.
    near = others.select("word", cosine.alias("similarity")).join(frequent, "word", "left_semi")
    return near.orderBy(F.desc("similarity"), "word").limit(n)
