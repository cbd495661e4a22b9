"""Bounded samples of labelled rows for fitting."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PARTS = 1 << 30


def text_remainder(id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`."""
    return F.crc32(id.cast("string").cast("binary")) % parts


def bounded_sample(rows: DataFrame, label: str, id: str, per_label: int) -> DataFrame:
    """About `per_label` rows of each label, all where there are fewer; never many more.

    Rows are chosen by a hash of their id, so the choice does not depend on the partitions.
    Labels are counted first; only those counts, a row for each label, reach the driver.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect() if r[0] is not None}
    if not counts:
        return rows.where(F.lit(False))
    shares = {
        k: min(_PARTS, math.ceil(_PARTS * per_label / n)) for k, n in counts.items()
    }
    limits = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])
    place = F.pmod(F.xxhash64(F.col(id).cast("string"), F.lit("sample")), F.lit(_PARTS))
    return rows.where(place < F.element_at(limits, F.col(label)))
