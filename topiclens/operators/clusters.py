"""k-means topics whose result depends on the articles alone.

TF-IDF weights are whole numbers of 1 / UNIT, and so are the centres. Each round adds up whole
numbers, so neither the order of rows nor the number of tasks changes a digit, and the parts of
the work come from the table itself. The start centres are the vectors of the articles with the
least hashes of their ids.

Articles never leave their tasks during a round: a task sends its sums, at most one number for
each topic and term, and the driver holds the model, which the vocabulary's limit bounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclens import storage
from topiclens.operators import bags, terms

#: Weights and centres are whole numbers of 1 / UNIT.
UNIT = 4096
# What follows a topic's terms in its sums.
_COUNT, _COST, _COST_HIGH = 0, 1, 2
#: Sums that travel together.
SPAN = 1 << 12
# Squared distances are added up in two parts, the higher one in units of _HIGH.
_HIGH = 1 << 32
#: Vectors of a piece's articles as one row: their ids, and bytes of where they end and what they hold.
BLOCKS = ["post_ids", "ends", "terms", "weights"]
# Entries of vectors that a task adds up in a round, if there are enough for all cores.
_ENTRIES = 1 << 24


@dataclass
class TopicModel:
    """A vocabulary with its weights, and the centres over it."""

    vocabulary: list[str]
    idf: list[float]
    min_tf: float
    centers: np.ndarray  # topics x terms, whole numbers of 1 / UNIT
    cost: float  # sum of the squared distances of the articles it was fitted on

    @property
    def k(self) -> int:
        return len(self.centers)

    def weights(self) -> np.ndarray:
        """The centres as TF-IDF weights."""
        return self.centers / UNIT


def entries(p: bags.Piece, words: pa.Array, min_tf: float):
    """Owner, term number and count of the vocabulary's terms that a piece's articles keep, in order."""
    found = pc.index_in(p.words, value_set=words, skip_nulls=True)
    known = found.fill_null(-1).to_numpy().astype(np.int64)
    term = known[p.number]
    least = min_tf if min_tf >= 1 else min_tf * np.bincount(p.owner, weights=p.n)[p.owner]
    kept = (term >= 0) & (p.n >= least)
    owner, term, n = p.owner[kept], term[kept], p.n[kept]
    order = np.lexsort((term, owner))
    return owner[order], term[order], n[order]


def _weighed(p: bags.Piece, words: pa.Array, idf: np.ndarray, min_tf: float):
    """Owner, term number and whole weight of what a piece's articles weigh, in order."""
    owner, term, n = entries(p, words, min_tf)
    # Weights are rounded half up.
    weight = (n * idf[term] * UNIT + 0.5).astype(np.int64)
    some = weight != 0
    return owner[some], term[some], weight[some]


def vectors(tokens: DataFrame, vocabulary: list[str], idf: list[float], min_tf: float) -> DataFrame:
    """`post_id, terms, weights`: numbers of an article's terms, in order, and whole TF-IDF weights.

    One row for each article of bags or of `post_id, tokens`; null tokens count as none.
    """
    found = bags.of(tokens)
    shared = found.sparkSession.sparkContext.broadcast((vocabulary, idf, min_tf))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, idf, min_tf = shared.value
        words, idf = pa.array(vocabulary, pa.string()), np.array(idf, np.float64)
        for p in bags.opened(batches):
            owner, term, weight = _weighed(p, words, idf, min_tf)
            ends = pa.array(np.searchsorted(owner, np.arange(len(p.ids) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    p.ids,
                    pa.ListArray.from_arrays(ends, pa.array(term.astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(weight)),
                ],
                names=["post_id", "terms", "weights"],
            )

    return found.mapInArrow(run, f"post_id {bags.kind_of(found)}, terms array<int>, weights array<bigint>")


def blocks(tokens: DataFrame, vocabulary: list[str], idf: list[float], min_tf: float) -> DataFrame:
    """The same vectors as BLOCKS, which rounds read faster: bytes need no conversion."""
    found = bags.of(tokens)
    shared = found.sparkSession.sparkContext.broadcast((vocabulary, idf, min_tf))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, idf, min_tf = shared.value
        words, idf = pa.array(vocabulary, pa.string()), np.array(idf, np.float64)
        for p in bags.opened(batches):
            owner, term, weight = _weighed(p, words, idf, min_tf)
            ends = np.searchsorted(owner, np.arange(len(p.ids)), "right")
            packed = [bags.packed(x, kind) for x, kind in ((ends, np.int32), (term, np.int32), (weight, np.int64))]
            yield pa.RecordBatch.from_arrays([bags.listed(p.ids), *packed], names=BLOCKS)

    kind = bags.kind_of(found)
    return found.mapInArrow(run, f"post_ids array<{kind}>, ends binary, terms binary, weights binary")


def _block(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kinds = {"ends": np.int32, "terms": np.int32, "weights": np.int64}
    return tuple(bags.unpacked(batch.column(name)[i], kind) for name, kind in kinds.items())


def opened(found: DataFrame) -> DataFrame:
    """Blocks as `vectors`, others as they are."""
    if found.columns != BLOCKS:
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ends, term, weight = _block(batch, i)
                ends = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (term, weight)]
                columns = [batch.column("post_ids")[i].values, *lists]
                yield pa.RecordBatch.from_arrays(columns, names=["post_id", "terms", "weights"])

    return found.mapInArrow(run, f"post_id {bags.kind_of(found)}, terms array<int>, weights array<bigint>")


def _nearest(owner, term, weight, rows: int, centers):
    """The nearest centre of each row, the first of equals, and the squared distance."""
    centers = centers.astype(np.float64)
    squares = (centers**2).sum(axis=1)
    w = weight.astype(np.float64)
    distance = np.empty((rows, len(centers)))
    for topic, center in enumerate(centers):
        dots = np.bincount(owner, weights=w * center[term], minlength=rows)
        distance[:, topic] = squares[topic] - 2 * dots
    topic = distance.argmin(axis=1)
    own = np.bincount(owner, weights=w * w, minlength=rows)
    return topic, distance[np.arange(rows), topic] + own


def _width(size: int) -> int:
    """Length of a topic's sums, in whole parts of SPAN."""
    return -(-(size + 3) // SPAN) * SPAN


def _flat(batches: Iterator[pa.RecordBatch]):
    """Number of articles, and owner, term and weight of their entries, for what is looked at together."""
    for batch in batches:
        if "ends" in batch.schema.names:
            for i in range(batch.num_rows):
                ends, term, weight = _block(batch, i)
                owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
                yield len(ends), owner, term.astype(np.int64), weight
            continue
        owner = np.repeat(np.arange(batch.num_rows), np.diff(batch.column(1).offsets.to_numpy()))
        term = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        yield batch.num_rows, owner, term, batch.column(2).flatten().to_numpy(zero_copy_only=False)


def sums(found: DataFrame, *models: np.ndarray) -> DataFrame:
    """`topic, part, totals`: summed weights of the articles nearest to each centre.

    Topics of several models are numbered one after the other. A part is the bytes of SPAN terms'
    sums, so a task sends few rows, however many terms there are; parts of nothing but zeros are
    left out. After the terms come the number of the topic's articles, and their squared distances
    added up: the lower and the higher part of each.
    """
    shared = found.sparkSession.sparkContext.broadcast(models)
    schema = "topic int, part int, totals binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        k, size = sum(map(len, models)), models[0].shape[1]
        added = np.zeros((k, _width(size)), np.int64)
        entries = added.reshape(-1)
        for rows, owner, term, weight in _flat(batches):
            before = 0
            for centers in models:
                topic, distance = _nearest(owner, term, weight, rows, centers)
                topic += before
                before += len(centers)
                np.add.at(entries, topic[owner] * added.shape[1] + term, weight)
                added[:, size + _COUNT] += np.bincount(topic, minlength=k)
                whole = distance.astype(np.int64)
                np.add.at(added[:, size + _COST], topic, whole & (_HIGH - 1))
                np.add.at(added[:, size + _COST_HIGH], topic, whole // _HIGH)
        parts = added.reshape(k, -1, SPAN)
        topic, part = np.nonzero(parts.any(axis=2))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(topic.astype(np.int32)),
                pa.array(part.astype(np.int32)),
                pa.array([parts[t, p].tobytes() for t, p in zip(topic, part)], pa.binary()),
            ],
            names=["topic", "part", "totals"],
        )

    def together(table: pa.Table) -> pa.Table:
        total = np.sum([bags.unpacked(x, np.int64) for x in table["totals"]], axis=0)
        return table.slice(0, 1).set_column(2, "totals", [bags.packed(total, np.int64)])

    columns = BLOCKS[1:] if found.columns == BLOCKS else ["post_id", "terms", "weights"]
    return found.select(*columns).mapInArrow(run, schema).groupBy("topic", "part").applyInArrow(together, schema)


def _moved(table: pa.Table, centers: np.ndarray, before: int) -> tuple[np.ndarray, int]:
    """What `step` returns for the centres whose topics are numbered from `before`."""
    k, size = centers.shape
    added = np.zeros((k, _width(size)), np.int64)
    for topic, part, totals in zip(*(table[name] for name in ("topic", "part", "totals"))):
        own, at = topic.as_py() - before, part.as_py() * SPAN
        if 0 <= own < k:
            added[own, at : at + SPAN] = bags.unpacked(totals, np.int64)
    cost = sum(added[:, size + _COST].tolist()) + _HIGH * sum(added[:, size + _COST_HIGH].tolist())
    count, moved = added[:, size + _COUNT], centers.copy()
    full = count > 0
    n = count[full, None]
    moved[full] = (2 * added[full, :size] + n) // (2 * n)
    return moved, cost


def step(found: DataFrame, centers: np.ndarray) -> tuple[np.ndarray, int]:
    """The means of the articles nearest to each centre, and their cost before the move.

    A centre without articles stays. Means are rounded half up.
    """
    return _moved(sums(found, centers).toArrow(), centers, 0)


def steps(found: DataFrame, models: list[np.ndarray]) -> list[tuple[np.ndarray, int]]:
    """`step` for several models in one pass over the articles."""
    if len(models) == 1:
        return [step(found, models[0])]
    table = sums(found, *models).toArrow()
    starts = np.cumsum([0, *map(len, models)])
    return [_moved(table, centers, int(before)) for centers, before in zip(models, starts)]


def start_centers(found: DataFrame, k: int, size: int) -> np.ndarray:
    """The first k distinct vectors by the hash of their articles' ids; all, if there are fewer."""
    found = opened(found)
    order = [F.md5(F.col("post_id").cast("string")), "post_id"]
    asked = 4 * k
    while True:
        rows = found.orderBy(*order).limit(asked).select("terms", "weights").collect()
        distinct = list(dict.fromkeys((tuple(r["terms"]), tuple(r["weights"])) for r in rows))
        if len(distinct) >= k or len(rows) < asked:
            break
        asked *= 4
    centers = np.zeros((min(k, len(distinct)), size), np.int64)
    for center, (where, weight) in zip(centers, distinct):
        center[list(where)] = weight
    return centers


def fit(found: DataFrame, ks: list[int], size: int, max_iter: int) -> list[tuple[np.ndarray, float]]:
    """For each k centres, and the sum of squared distances from them.

    A model stops when none of its centres moves; a round is one for all models that still do.
    """
    made = [start_centers(found, k, size) for k in ks]
    costs = [0] * len(ks)
    active = [i for i, centers in enumerate(made) if len(centers)]
    for turn in range(max_iter + 1):
        if not active:
            break
        found_now = zip(active, steps(found, [made[i] for i in active]))
        active = []
        for i, (moved, cost) in found_now:
            costs[i] = cost
            # The last pass is for the cost of the last move alone.
            if turn < max_iter and not np.array_equal(moved, made[i]):
                made[i] = moved
                active.append(i)
    return [(centers, cost / UNIT**2) for centers, cost in zip(made, costs)]


def learn_vocabulary(tokens: DataFrame, min_df: float, min_tf: float, vocab_size: int):
    """The commonest terms and their idf = ln((N + 1) / (documents that keep it + 1)).

    A `min_df` below 1 is a share of the articles, as a `min_tf` below 1 is one of an article.
    """
    found = bags.of(tokens)
    n = bags.articles_in(found)
    least = min_df if min_df >= 1 else min_df * n
    table = terms.commonest(bags.totals(found, min_tf), least, vocab_size).orderBy("term_id")
    rows = table.select("term", F.log((F.lit(n) + 1) / (F.col("kept_docs") + 1)).alias("idf")).collect()
    return [r["term"] for r in rows], [r["idf"] for r in rows]


def assign(model: TopicModel, tokens: DataFrame) -> DataFrame:
    """`post_id, topic`: the nearest centre, the first of equals; 0 without any centre."""
    found = bags.of(tokens)
    shared = found.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        words, idf = pa.array(model.vocabulary, pa.string()), np.array(model.idf, np.float64)
        for p in bags.opened(batches):
            topic = np.zeros(len(p.ids), np.int64)
            if model.k:
                owner, term, weight = _weighed(p, words, idf, model.min_tf)
                topic, _ = _nearest(owner, term, weight, len(p.ids), model.centers)
            yield pa.RecordBatch.from_arrays([p.ids, pa.array(topic, pa.int32())], names=["post_id", "topic"])

    return found.mapInArrow(run, f"post_id {bags.kind_of(found)}, topic int")


def save(spark: SparkSession, model: TopicModel, path: str) -> None:
    """The model as two tables: terms, and the centres' entries."""
    words = [(i, t, float(x)) for i, (t, x) in enumerate(zip(model.vocabulary, model.idf))]
    spark.createDataFrame(words, "term_id int, term string, idf double").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/terms")
    entries = [(-1, model.k, int(model.cost * UNIT**2 + 0.5), float(model.min_tf))]
    entries += [(int(t), int(j), int(model.centers[t, j]), 0.0) for t, j in zip(*np.nonzero(model.centers))]
    spark.createDataFrame(entries, "topic int, term_id int, weight long, min_tf double").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/centers")


def load(spark: SparkSession, path: str) -> TopicModel:
    words = sorted(tuple(r) for r in spark.read.parquet(f"{path}/terms").collect())
    entries = spark.read.parquet(f"{path}/centers").collect()
    head = next(r for r in entries if r["topic"] < 0)
    centers = np.zeros((head["term_id"], len(words)), np.int64)
    for r in entries:
        if r["topic"] >= 0:
            centers[r["topic"], r["term_id"]] = r["weight"]
    return TopicModel([w[1] for w in words], [w[2] for w in words], head["min_tf"], centers, head["weight"] / UNIT**2)


def learn(tokens: DataFrame, ks: list[int], max_iter: int, min_df: float, min_tf: float, vocab_size: int) -> list[TopicModel]:
    """A model for each k, over one set of vectors, which lie in the shared folder meanwhile.

    Bags are read more than once; those of `post_id, tokens` are settled here.
    """
    if not bags.is_bags(tokens):
        tokens = storage.settle(bags.of(tokens))
    vocabulary, idf = learn_vocabulary(tokens, min_df, min_tf, vocab_size)
    found = storage.settle(blocks(tokens, vocabulary, idf, min_tf))
    # Rounds read short vectors, so they need no more tasks than cores until these are many.
    entries = (found.agg(F.sum(F.length("terms"))).first()[0] or 0) // np.dtype(np.int32).itemsize
    parts = max(found.sparkSession.sparkContext.defaultParallelism, entries // _ENTRIES)
    made = fit(found.coalesce(parts), ks, len(vocabulary), max_iter)
    return [TopicModel(vocabulary, idf, min_tf, centers, cost) for centers, cost in made]
