"""Whitened embeddings: leading principal components, each with unit variance.

Vectors become whole numbers, and the fit is over the distinct ones. Sums and centred products
are added up as whole numbers in the tasks, so the covariance is the same whatever the order
and is rounded once, in its end. The eigenvalues come from a Householder tridiagonal form by
bisection on Sturm counts, the components by inverse iteration, made orthogonal within
clusters of eigenvalues. Only numbers of the dimension's square reach the driver; the
components go to all executors, which project their rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from topiclens.llm.common import free_name, scratch

#: Eigenvalues closer than this share of the greatest are a cluster.
CLUSTER = 1e-3
#: A component with less than this share of the variance, a dimension, is rounding.
ROUNDING = 2.0**-52
_LARGEST = (1 << 63) - 1
_HALF = 1 << 64


def whole_numbers(vectors: DataFrame, vector: str, factor: int = 256):
    """floor(factor * x) of each entry, as a column; null where the vector takes no part."""
    v = F.col(f"`{vector}`")
    unusable = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    made = F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(factor))))
    return F.when(~unusable & (F.size(v) > 0), made)


def _rows(batch: pa.RecordBatch, column: int):
    """A list column of equally long lists as a matrix."""
    lists = batch.column(column)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _exact_sums(fit: DataFrame, name: str, terms, size: int) -> list[int]:
    """Sums over the rows of `size` whole numbers each, exact whatever their size.

    terms(matrix) gives one list of Python's whole numbers for a batch. Tasks add up and send
    each sum in two halves, which then are added up in decimals.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import decimal

        sums = None
        for batch in batches:
            if batch.num_rows:
                made = terms(_rows(batch, 0))
                sums = made if sums is None else [a + b for a, b in zip(sums, made)]
        if sums is not None:
            kind = pa.decimal128(38, 0)
            halves = [[decimal.Decimal(f(s)) for s in sums] for f in (lambda s: s // _HALF, lambda s: s % _HALF)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(sums)), pa.int32()), *[pa.array(h, kind) for h in halves]],
                names=["place", "high", "low"],
            )

    added = fit.select(name).mapInArrow(run, "place int, high decimal(38,0), low decimal(38,0)")
    out = [0] * size
    # A row for each sum: the dimension, or its square.
    for place, high, low in added.groupBy("place").agg(F.sum("high"), F.sum("low")).collect():
        out[place] = int(high) * _HALF + int(low)
    return out


def _column_sums(rows) -> list[int]:
    import numpy as np

    if int(np.abs(rows.astype(np.float64)).max()) * len(rows) < 1 << 62:
        return [int(x) for x in rows.sum(axis=0)]
    return [sum(int(x) for x in column) for column in rows.T]


def _products(shift: list[int]):
    """A function from rows to the sums of the products of their distances from `shift`."""

    def terms(rows) -> list[int]:
        import numpy as np

        large = max(float(np.abs(rows.astype(np.float64)).max()), float(max(abs(s) for s in shift)))
        upper = np.triu_indices(rows.shape[1])
        if large < 1 << 25:
            # Below 2^53 products and sums of doubles are exact.
            off = (rows - np.array(shift, np.int64)).astype(np.float64)
            step = max(1, int(2.0**53 / max(1.0, float(np.abs(off).max()) ** 2)))
            sums = 0
            for a in range(0, len(off), step):
                part = off[a : a + step]
                made = (part.T @ part)[upper].astype(np.int64).astype(object)
                sums = sums + made
            return list(sums)
        off = rows.astype(object) - np.array(shift, object)
        return [sum((off[:, i] * off[:, j]).tolist()) for i, j in zip(*upper)]

    return terms


def tridiagonal(matrix):
    """Diagonal, next diagonal and reflections of a symmetric matrix's tridiagonal form."""
    import numpy as np

    a = np.array(matrix, np.float64)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        largest = np.abs(x).max()
        if largest == 0 or not np.abs(x[1:]).max():
            continue
        x /= largest
        x[0] += math.copysign(np.sqrt(x @ x), x[0])
        v = x / np.sqrt(x @ x)
        reflections.append((k + 1, v))
        a[k + 1 :, k:] -= 2 * np.outer(v, v @ a[k + 1 :, k:])
        a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def _below(diagonal, squares, x: float, least: float) -> int:
    """How many eigenvalues are less than x: the negative terms of the Sturm sequence."""
    count, q = 0, 1.0
    for i, d in enumerate(diagonal):
        q = d - x - (squares[i - 1] / q if i else 0.0)
        if abs(q) < least:
            q = -least
        count += q < 0
    return count


def leading_eigenvalues(diagonal, off, k: int) -> list[float]:
    """The k greatest eigenvalues of a tridiagonal matrix, falling, by bisection."""
    import numpy as np

    n = len(diagonal)
    around = np.abs(np.append(off, 0.0)) + np.abs(np.append(0.0, off))
    low, high = float((diagonal - around).min()), float((diagonal + around).max())
    large = max(abs(low), abs(high))
    least = max(large * 2.0**-60, 1e-300)
    d, squares = diagonal.tolist(), (off * off).tolist()
    out = []
    for nth in range(min(k, n)):
        # Eigenvalue number n - nth from below.
        a, b = low - large * 1e-12, out[-1] + large * 1e-12 if out else high + large * 1e-12
        while True:
            middle = a + (b - a) / 2
            if middle <= a or middle >= b:
                break
            if _below(d, squares, middle, least) >= n - nth:
                b = middle
            else:
                a = middle
        out.append(b)
    return out


def _solve(diagonal, off, shift: float, right):
    """x with (T - shift) x = right, by elimination with exchange of rows."""
    n = len(diagonal)
    large = max(abs(x) for x in [*diagonal, *off, shift, 1e-300])
    tiny = large * 2.0**-53
    # Rows of the upper triangle: main, next and the one after.
    p, q, r, b = [0.0] * n, [0.0] * n, [0.0] * n, list(right)
    main, after = diagonal[0] - shift, off[0] if n > 1 else 0.0
    for i in range(n - 1):
        below, next_main = off[i], diagonal[i + 1] - shift
        next_after = off[i + 1] if i + 2 < n else 0.0
        if abs(below) > abs(main):
            factor = main / below
            p[i], q[i], r[i] = below, next_main, next_after
            b[i], b[i + 1] = b[i + 1], b[i] - factor * b[i + 1]
            main, after = after - factor * next_main, -factor * next_after
        else:
            main = main or tiny
            factor = below / main
            p[i], q[i], r[i] = main, after, 0.0
            b[i + 1] -= factor * b[i]
            main, after = next_main - factor * after, next_after
    p[n - 1] = main
    x = [0.0] * (n + 2)
    for i in range(n - 1, -1, -1):
        pivot = p[i] if abs(p[i]) > tiny else math.copysign(tiny, p[i])
        x[i] = (b[i] - q[i] * x[i + 1] - r[i] * x[i + 2]) / pivot
        if abs(x[i]) > 1e200:
            scale = abs(x[i])
            x = [y / scale for y in x]
            b = [y / scale for y in b]
    return x[:n]


def eigenvectors(matrix, k: int):
    """The k greatest eigenvalues, falling, and their unit vectors as rows, of a symmetric matrix."""
    import numpy as np

    matrix = np.array(matrix, np.float64)
    scale = float(np.abs(matrix).max(initial=0.0))
    n = len(matrix)
    if not n or not scale:
        return np.zeros(0), np.zeros((0, n))
    matrix = matrix / scale
    diagonal, off, reflections = tridiagonal(matrix)
    values = leading_eigenvalues(diagonal, off, k)
    largest = max(abs(values[0]), 1e-300)
    found = []
    first = 0  # of the cluster
    for nth, value in enumerate(values):
        if nth and values[nth - 1] - value > CLUSTER * largest:
            first = nth
        # Equal shifts would give equal vectors; a start of its own and what follows part them.
        shift = value - (nth - first) * largest * 2.0**-51
        x = np.random.default_rng(nth + 1).uniform(0.5, 1.0, n)
        x /= np.sqrt(x @ x)
        for _ in range(5):
            x = np.array(_solve(diagonal.tolist(), off.tolist(), shift, x.tolist()))
            x /= np.abs(x).max()
            for _ in range(2):
                for other in found[first:nth]:
                    x -= (other @ x) * other
            x /= np.sqrt(x @ x)
        found.append(x)
    vectors = np.array(found)
    for start, v in reversed(reflections):
        vectors[:, start:] -= 2 * np.outer(vectors[:, start:] @ v, v)
    for i in range(len(vectors)):
        for _ in range(2):
            for j in range(i):
                vectors[i] -= (vectors[j] @ vectors[i]) * vectors[j]
        vectors[i] /= np.sqrt(vectors[i] @ vectors[i])
    found = np.array([v @ (matrix @ v) for v in vectors]) * scale
    order = np.argsort(-found, kind="stable")
    return found[order], vectors[order]


@dataclass
class Whitening:
    """What projects a vector of whole numbers."""

    n: int
    sums: list[int]
    components: list[list[float]]
    values: list[float]
    explained: list[float]
    #: Greatest entry of the whitened vectors' covariance minus the identity.
    identity_error: float = 0.0


def _covariance(n: int, sums: list[int], shift: list[int], products: list[int]) -> list[list[float]]:
    """Exact but for one rounding: the shift's distance from the mean is taken out."""
    size = len(sums)
    rest = [s - n * c for s, c in zip(sums, shift)]
    out = [[0.0] * size for _ in range(size)]
    at = iter(products)
    for i in range(size):
        for j in range(i, size):
            out[i][j] = out[j][i] = float(Fraction(n * next(at) - rest[i] * rest[j], n * n))
    return out


def _project(model: Whitening, rows):
    """n times the distances from the mean, exact, and the whitened values."""
    import numpy as np

    large = model.n * int(np.abs(rows.astype(np.float64)).max()) + max(abs(s) for s in model.sums)
    if large < 1 << 62:
        off = rows * np.int64(model.n) - np.array(model.sums, np.int64)
    else:
        off = rows.astype(object) * model.n - np.array(model.sums, object)
    weights = np.array(model.components).T / np.sqrt(np.array(model.values))
    return off, large, (off.astype(np.float64) / model.n) @ weights


def _fit(fit: DataFrame, name: str, size: int, k: int) -> Whitening:
    n = fit.count()
    sums = _exact_sums(fit, name, _column_sums, size)
    shift = [round(Fraction(s, n)) for s in sums]
    covariance = _covariance(n, sums, shift, _exact_sums(fit, name, _products(shift), size * (size + 1) // 2))
    values, vectors = eigenvectors(covariance, k)
    trace = math.fsum(covariance[i][i] for i in range(size))
    kept = [i for i, e in enumerate(values) if e > size * ROUNDING * trace]
    model = Whitening(
        n, sums, [vectors[i].tolist() for i in kept], [float(values[i]) for i in kept],
        [float(values[i]) / trace for i in kept],
    )
    if kept:
        model.identity_error = _identity_error(fit, name, model)
    return model


def _identity_error(fit: DataFrame, name: str, model: Whitening) -> float:
    places = range(len(model.values))
    schema = ", ".join(f"w{i} double" for i in places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = _project(model, _rows(batch, 0))[2]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in made.T], names=[f"w{i}" for i in places])

    pairs = [(i, j) for i in places for j in places if i <= j]
    # Centred products, merged pairwise.
    found = fit.select(name).mapInArrow(run, schema).agg(*[F.covar_pop(f"w{i}", f"w{j}") for i, j in pairs]).first()
    return max(abs(x - (i == j)) for x, (i, j) in zip(found, pairs))


def whitened(
    vectors: DataFrame, k: int = 4, id: str = "vec_id", vector: str = "embedding", factor: int = 256
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): k rows for each vector.

    Vectors that are null or empty, or hold a null or non-finite entry, take no part; nor do
    those of another length than most have (of equally frequent lengths, the greatest counts).
    An entry x becomes floor(factor * x); the fit is over the n distinct vectors that come out,
    so repeated rows count once, but each has its own rows here. deviation: the sum of
    (n x - S)^2, exact, S being the sums over the fit; null if it passes a long. Components are
    numbered from 1 by falling variance and come in either direction; those without variance
    are left out, so vectors that are all alike, and empty tables, give no rows.

    The distinct vectors lie in the shared folder during the fit. Tasks hold a batch and the
    products' sums. The driver gets one number for each pair of dimensions.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[id].dataType.simpleString()
    name = free_name(vectors.select(F.col(f"`{id}`")), "x")
    usable = vectors.select(F.col(f"`{id}`").alias("id"), whole_numbers(vectors, vector, factor).alias(name))
    usable = usable.where(F.col(name).isNotNull())
    schema = f"id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    lengths = usable.groupBy(F.size(name).alias("size")).count()
    size = (lengths.orderBy(F.col("count").desc(), F.col("size").desc()).first() or [0])[0]
    model = None
    if size:
        usable = usable.where(F.size(name) == size)
        with scratch(spark, "whitening") as folder:
            usable.select(name).distinct().write.parquet(folder)
            model = _fit(spark.read.parquet(folder), name, size, k)
    if model is None or not model.values:
        return spark.createDataFrame([], schema).withColumnRenamed("id", id)
    shared = spark.sparkContext.broadcast(model)  # k + 1 vectors
    types = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        model = shared.value
        parts = len(model.values)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.num_rows
            off, large, made = _project(model, _rows(batch, 1))
            if size * large * large <= _LARGEST:
                deviation = pa.array(np.repeat((off * off).sum(axis=1), parts), pa.int64())
            else:
                sums = [sum(int(x) ** 2 for x in r) for r in off]
                deviation = pa.array([s if s <= _LARGEST else None for s in sums for _ in range(parts)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(rows), parts))),
                    pa.array(np.tile(np.arange(1, parts + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * parts, model.n, np.int64)),
                    deviation,
                    pa.array(made.reshape(-1)),
                    pa.array(np.tile(np.array(model.explained), rows)),
                    pa.array(np.full(rows * parts, model.identity_error)),
                ],
                names=types.names,
            )

    return usable.mapInArrow(run, schema).withColumnRenamed("id", id)
