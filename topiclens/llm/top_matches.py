"""Exact best inner products by multi-resolution segment statistics.

A vector is cut into segments; each has a mean and a deviation. For two vectors, the squared
distance is at least the sum over segments of length times the squared differences of means
and of deviations. With the norms this bounds their inner product from above. Bounds from
few segments are followed by bounds from more, and inner products are computed only for the
pairs that no bound rules out.

Queries are taken in blocks of a fixed size. A block goes to all executors, which read every
candidate; so no pair is shuffled. A first pass over a sample of candidates gives each query
a score that its k-th best reaches at least; the pass over all candidates then rules out most
pairs by their bounds, and shuffles only what reaches that score.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topiclens.llm.common import cut

#: Values of queries in a block: 16 MB.
BLOCK_VALUES = 2 << 20
#: Candidates in the first pass, about.
FIRST_PASS = 4096
#: Numbers of segments, coarse to fine.
LEVELS = (2, 8, 16)
#: Pairs that are looked at together in a task.
PAIRS = 1 << 18


def quantized(vector: Column, factor: int = 1024) -> Column:
    """floor(factor * x) of each component, or null if the vector takes no part."""
    usable = ~F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")),
    )
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(factor))))
    return F.when(usable, whole)


def _statistics(values, segments: int):
    """Means and deviations of segments, times the root of the segments' length."""
    import numpy as np

    out = []
    for part in np.array_split(values, max(1, min(segments, values.shape[1])), axis=1):
        root = np.sqrt(max(1, part.shape[1]))
        mean = part.sum(axis=1) / max(1, part.shape[1])
        off = part - mean[:, None]
        out += [mean * root, np.sqrt((off * off).sum(axis=1))]
    return np.stack(out, axis=1)


class _Queries:
    """Queries of one length, and each one's best candidates so far."""

    def __init__(self, ids, values, least, k: int):
        import numpy as np

        self.ids, self.whole, self.k = ids, values, k
        self.values = values.astype(np.float64)
        self.levels = [_statistics(self.values, s) for s in LEVELS]
        self.norms = np.sqrt((self.values * self.values).sum(axis=1))
        self.least = least.astype(np.float64)  # scores below are of no use
        self.scores = np.full((len(ids), k), np.iinfo(np.int64).min)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.largest = float(np.abs(self.values).max(initial=0))

    def offer(self, ids, whole) -> None:
        import numpy as np

        values = whole.astype(np.float64)
        # Bounds are rounded; a slack far above that keeps all that may be needed.
        norms = np.sqrt((values * values).sum(axis=1))
        slack = 1e-9 * self.norms[:, None] * norms[None, :] + 1e-6
        rows = columns = None
        for own, segments in zip(self.levels, LEVELS):
            theirs = _statistics(values, segments)
            if rows is None:
                rows, columns = np.nonzero(own @ theirs.T + slack >= self.least[:, None])
            else:
                bound = np.einsum("ij,ij->i", own[rows], theirs[columns])
                kept = bound + slack[rows, columns] >= self.least[rows]
                rows, columns = rows[kept], columns[kept]
        kept = self.ids[rows] != ids[columns]
        rows, columns = rows[kept], columns[kept]
        if self.largest * float(np.abs(values).max(initial=0)) * values.shape[1] < 2.0**53:
            made = np.einsum("ij,ij->i", self.values[rows], values[columns]).astype(np.int64)
        else:
            made = np.einsum("ij,ij->i", self.whole[rows], whole[columns])
        kept = made >= self.least[rows]
        rows, columns, made = rows[kept], columns[kept], made[kept]
        if not len(rows):
            return
        open_rows, at = np.unique(rows, return_inverse=True)
        scores = np.full((len(open_rows), len(ids)), np.iinfo(np.int64).min)
        scores[at, columns] = made
        found = np.where(scores == np.iinfo(np.int64).min, np.iinfo(np.int64).max, ids[None, :])
        scores = np.concatenate([self.scores[open_rows], scores], axis=1)
        found = np.concatenate([self.found[open_rows], found], axis=1)
        # ~ turns the order around without overflow.
        best = np.lexsort((found, ~scores), axis=-1)[:, : self.k]
        self.scores[open_rows] = np.take_along_axis(scores, best, axis=1)
        self.found[open_rows] = np.take_along_axis(found, best, axis=1)
        last = self.scores[open_rows, -1]
        full = self.found[open_rows, -1] != np.iinfo(np.int64).max
        self.least[open_rows[full]] = np.maximum(self.least[open_rows[full]], last[full])


def _search(candidates: DataFrame, block, k: int) -> DataFrame:
    """(query_id, vec_id, score): of each task, the best k candidates of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        sets = {values.shape[1]: _Queries(ids, values, least, k) for ids, values, least in block.value}
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            vectors = batch.column(1)
            ends = vectors.offsets.to_numpy()
            flat = vectors.values.to_numpy(zero_copy_only=False)
            sizes = np.diff(ends)
            for size, queries in sets.items():
                rows = np.flatnonzero(sizes == size)
                step = max(1, PAIRS // len(queries.ids))
                for a in range(0, len(rows), step):
                    some = rows[a : a + step]
                    values = flat[ends[some][:, None] + np.arange(size)[None, :]]
                    queries.offer(ids[some], values.reshape(len(some), size))
        for queries in sets.values():
            real = queries.found != np.iinfo(np.int64).max
            for a in range(0, len(queries.ids), 4096):
                part = real[a : a + 4096]
                columns = [
                    np.repeat(queries.ids[a : a + 4096], part.sum(axis=1)),
                    queries.found[a : a + 4096][part],
                    queries.scores[a : a + 4096][part],
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"]
                )

    return candidates.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_matches(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id: str = "vec_id",
    vector: str = "embedding",
    factor: int = 1024,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates with the highest inner product.

    Every row is a candidate for every query but its own; ties go to the lesser id; queries
    with fewer candidates list all. Vectors are quantized first. Null vectors, those with a
    null or non-finite component and rows without an id take no part; vectors of different
    length are not compared. If a query's id is repeated, the first of its vectors in order
    counts; candidates with the query's id are left out. Scores must fit a long.
    """
    import numpy as np

    spark = vectors.sparkSession
    usable = vectors.select(
        F.col(f"`{id}`").cast("long").alias("id"),
        quantized(F.col(f"`{vector}`"), factor).alias("v"),
        is_query.alias("asked"),
    ).where("id IS NOT NULL AND v IS NOT NULL")
    candidates = usable.select("id", "v")
    total, rows, values = usable.agg(
        F.count("*"), F.count(F.when(F.col("asked"), 1)), F.sum(F.when(F.col("asked"), F.size("v")))
    ).first()
    asked = usable.where("asked")
    n_blocks = max(1, -(-(values or 0) // BLOCK_VALUES))
    share = min(1.0, FIRST_PASS / max(1, total))
    place = F.pmod(F.xxhash64("id", F.lit("first")), F.lit(1 << 30))
    first = candidates.where(place <= int(share * (1 << 30)))
    results = []
    for number in range(n_blocks):
        # A block holds about BLOCK_VALUES values, whatever the table's size.
        own = asked.where(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == number).select("id", "v")
        held = {}
        for i, v in sorted((r["id"], r["v"]) for r in own.collect()):
            held.setdefault(i, v)
        by_size = {}
        for i, v in held.items():
            by_size.setdefault(len(v), []).append(i)

        def packed(least: dict) -> list:
            return [
                (
                    np.array(ids, np.int64),
                    np.array([held[i] for i in ids], np.int64).reshape(len(ids), size),
                    np.array([least.get(i, float("-inf")) for i in ids], np.float64),
                )
                for size, ids in by_size.items()
            ]

        start = _best(_search(first, spark.sparkContext.broadcast(packed({})), k), k)
        least = {r["query_id"]: r["score"] for r in start.where(F.col("rank") == k).collect()}
        block = spark.sparkContext.broadcast(packed(least))
        result = _best(_search(candidates, block, k), k)
        results.append(cut(result) if n_blocks > 1 else result)
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out.select("query_id", "rank", "vec_id", "score")
