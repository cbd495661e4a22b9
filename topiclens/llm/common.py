"""Helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SETTING = "spark.checkpoint.dir"
CHUNK_BYTES = 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's checkpoint folder.

    Only where the session has none, a folder beside its tables is set as one.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get(SETTING, None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Compute a frame once and go on from its copy in the shared folder.

    Later jobs survive lost executors; Spark's cleaner removes the copy when it is unused.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder of its own in the shared one, deleted in the end, whatever happens."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid4().hex}"
    try:
        yield path
    finally:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def free_name(df: DataFrame, name: str) -> str:
    """A name that no column of df has."""
    return name + "_" * max((len(c) for c in df.columns), default=0)


def chunks(batch: pa.RecordBatch, column: int, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `most` bytes in a text column, and at least one row."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n) + 64
    if start < len(lengths):
        yield batch.slice(start)


def map_texts(
    df: DataFrame,
    columns: list[str],
    make: Callable[[], Callable[..., list]],
    schema: str,
    text: int = 1,
    most: int = CHUNK_BYTES,
) -> DataFrame:
    """Apply Python to chunks of rows, by Arrow batches.

    make() runs once a task and returns a function of lists, one for each column, which
    returns lists, one for each field of `schema`. Column number `text` bounds the chunks to
    about `most` bytes, so a task holds a few MB of text besides the longest one.
    """
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            for part in chunks(batch, text, most):
                made = apply(*(c.to_pylist() for c in part.columns))
                columns = [pa.array(v, type=f.type) for f, v in zip(fields, made, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=fields.names)

    return df.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(run, schema)


def with_results(
    df: DataFrame, text: str, make: Callable[[], Callable[[list], list]], schema: str
) -> DataFrame:
    """df with added columns that Python computes from a text column; all others stay.

    make() as in map_texts; its function takes the texts alone. The added columns must have
    names that df has not.
    """
    added = to_arrow_schema(StructType.fromDDL(schema))
    place = df.columns.index(text)
    whole = StructType([*df.schema.fields, *StructType.fromDDL(schema).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            for part in chunks(batch, place):
                made = apply(part.column(place).to_pylist())
                columns = [pa.array(v, type=f.type) for f, v in zip(added, made, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *columns], names=[*part.schema.names, *added.names]
                )

    return df.mapInArrow(run, whole)
