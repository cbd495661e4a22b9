"""Near-duplicate documents by circulant MinHash.

Two permutations give all coordinates of a signature: the first scatters a set's elements
over a circle, the second, shifted by 1, 2, ... places, orders them. Coordinate k is the
least value of the second permutation, shifted by k, over the set. Groups of coordinates
are the keys of bands; documents that share a key are compared on their full sets.

How candidates are compared without emitting all pairs of a bucket:

1. Equal sets are one class; its least id stands for all copies.
2. Every class of a bucket is compared with the bucket's least class. Confirmed links make
   a first partition, which nearly all near copies enter.
3. Only buckets that still hold different parts are looked at again, for pairs of classes
   from different parts: buckets of up to SMALL classes pair by pair, and all larger ones
   through the least frequent shingles of their classes. Two sets with the wanted
   similarity must share a shingle among those, early in both; passages that many documents
   share are frequent and so lead to no pair. This is exact, so no link is lost to a
   bucket's size.

A pair with exactly the wanted similarity shares no band with a probability of
(1 - 0.75^5)^48 = 2e-6; with one of 0.8, 5e-9.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topiclens.llm.common import cut, map_texts
from topiclens.llm.components import components

WORDS = 5
PERCENT = 75
BANDS = 48
ROWS = 5
CIRCLE = 1 << 20
SMALL = 32


def _mix(x):
    """Scramble 64-bit values; a bijection."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list:
    """The distinct shingles of each text, as sorted 64-bit hashes.

    Words are runs without ASCII white space, A-Z in lower case. A text of fewer words is
    one shingle; one without words, or null, has none.
    """
    import numpy as np
    import xxhash

    digest = xxhash.xxh3_64_digest
    split = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    flat = np.frombuffer(b"".join([digest(w) for ws in split for w in ws]), dtype=">u8")
    flat = flat.astype(np.uint64)
    odd = np.uint64(0x9E3779B97F4A7C15)
    rolled = np.zeros(max(0, len(flat) - words + 1), np.uint64)
    for j in range(words):
        rolled = _mix(rolled * odd + flat[j : j + len(rolled)])
    sets, at = [], 0
    for ws in split:
        n = len(ws)
        if n >= words:
            sets.append(np.unique(rolled[at : at + n - words + 1]))
        elif n:
            one = np.full(1, n, np.uint64)
            for j in range(n):
                one = _mix(one * odd + flat[at + j : at + j + 1])
            sets.append(one)
        else:
            sets.append(flat[:0])
        at += n
    return sets


def _signer(bands: int, rows: int):
    """A function from sets to their band keys."""
    import numpy as np

    k = bands * rows
    rng = np.random.default_rng(20240501)
    scatter = rng.permutation(CIRCLE)
    order = rng.permutation(CIRCLE).astype(np.uint32)
    around = np.lib.stride_tricks.sliding_window_view(np.concatenate([order, order[:k]]), k)
    odd = np.uint64(0x9E3779B97F4A7C15)
    numbers = _mix(np.arange(1, bands + 1, dtype=np.uint64))

    def keys(values) -> list[int]:
        if not len(values):
            return []
        places = scatter[(values & np.uint64(CIRCLE - 1)).astype(np.int64)] + 1
        least = None
        for a in range(0, len(places), 2048):
            part = around[places[a : a + 2048]].min(axis=0)
            least = part if least is None else np.minimum(least, part)
        made = numbers.copy()
        grouped = least.reshape(bands, rows).astype(np.uint64)
        for j in range(rows):
            made = _mix(made * odd + grouped[:, j])
        return made.view(np.int64)

    return keys


def sketches(docs: DataFrame, id: str, text: str, words: int, bands: int, rows: int) -> DataFrame:
    """(id, n, whole, bands): set size, a 128-bit hash of the set, the keys of its bands."""

    def make():
        import hashlib

        import numpy as np

        keys = _signer(bands, rows)

        def apply(ids, texts):
            sets = shingle_sets(texts, words)
            whole = [hashlib.blake2b(s.astype("<u8").tobytes(), digest_size=16).digest() for s in sets]
            return [ids, [len(s) for s in sets], whole, [keys(s) for s in sets]]

        return apply

    kind = docs.schema[id].dataType.simpleString()
    return map_texts(docs, [id, text], make, f"id {kind}, n bigint, whole binary, bands array<bigint>")


def _sets(docs: DataFrame, id: str, text: str, words: int) -> DataFrame:
    """(id, items): full sets."""

    def make():
        import numpy as np

        return lambda ids, texts: [ids, [s.view(np.int64) for s in shingle_sets(texts, words)]]

    kind = docs.schema[id].dataType.simpleString()
    return map_texts(docs, [id, text], make, f"id {kind}, items array<bigint>")


def _similar(shared: Column, n: Column, m: Column, percent: int) -> Column:
    return 100 * shared >= percent * (n + m - shared)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("a_items"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("b_items"))
    shared = F.size(F.array_intersect("a_items", "b_items"))
    return (
        pairs.join(right, "b")
        .join(left, "a")
        .where(_similar(shared, F.size("a_items"), F.size("b_items"), percent))
        .select("a", "b")
    )


def _with_part(df: DataFrame, parts: DataFrame) -> DataFrame:
    """Add to rows of `id` the part they are in so far: their own, if in none."""
    parts = parts.withColumnRenamed("node", "id").withColumnRenamed("component", "part")
    return df.join(parts, "id", "left").withColumn("part", F.coalesce("part", "id"))


def _pairs_in_small(members: DataFrame) -> DataFrame:
    """Pairs of different parts in buckets of at most SMALL classes."""
    gathered = (
        members.where(F.col("size") <= SMALL)
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("id", "part"))).alias("all"))
    )
    return (
        gathered.select(F.explode("all").alias("x"), "all")
        .select("x", F.explode("all").alias("y"))
        .where("x.id < y.id AND x.part != y.part")
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    )


def _pairs_in_large(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of different parts among the classes of larger buckets that may be similar.

    Shingles are put in one order, the least frequent first. Similar sets share one that
    stands early enough in both, as no more can be shared than what follows it.
    """
    wanted = members.where(F.col("size") > SMALL).select("id", "part").distinct()
    own = sets.join(wanted, "id")
    items = own.select("id", F.explode("items").alias("item"))
    shared = items.groupBy("item").count().where("count > 1")
    # Only shared shingles are listed; the others come first, and their number is known.
    listed = (
        items.join(shared, "item")
        .groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct("count", "item"))).alias("listed"))
        .join(own.select("id", "part", F.size("items").alias("n")), "id")
        .withColumn("alone", F.col("n") - F.size("listed"))
    )
    # A similar set shares at least n * percent / 100, rounded up.
    prefix = F.floor(F.col("n") - F.col("n") * percent / 100 + 1 + 1e-6).cast("int") - F.col("alone")
    rows = (
        listed.where(prefix > 0)
        .select("id", "part", "n", "alone", F.posexplode(F.slice("listed", 1, prefix)))
        .select("id", "part", "n", (F.col("n") - F.col("alone") - F.col("pos")).alias("rest"), F.col("col.item").alias("item"))
    )
    x, y = rows.alias("x"), rows.alias("y")
    most = F.least("x.rest", "y.rest")
    return x.join(
        y,
        (F.col("x.item") == F.col("y.item"))
        & (F.col("x.id") < F.col("y.id"))
        & (F.col("x.part") != F.col("y.part"))
        & _similar(most, F.col("x.n"), F.col("y.n"), percent),
    ).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def duplicate_groups(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(id, n_shingles, component_id, kept), a row for each row of docs.

    Documents are linked if their sets of `words`-word shingles share at least `percent` of
    their union. component_id is the least id that can be reached over links. Texts without
    words, and null texts, are linked with nothing. Rows with one id are one document: of
    different texts under one id, links are confirmed on the least.
    A null id is linked with nothing: its component_id is null, and it is kept. An empty
    table gives an empty result; other columns are not looked at.
    """
    sketch = cut(sketches(docs, id, text, words, bands, rows))
    classes = cut(
        sketch.where("n > 0 AND id IS NOT NULL")
        .groupBy("whole")
        .agg(F.min("id").alias("id"), F.max("id").alias("last"))
    )
    # One row of each class stands for all its copies.
    keys = (
        sketch.where("n > 0")
        .join(classes.select("id", "whole").distinct(), ["id", "whole"], "left_semi")
        .select("id", F.explode("bands").alias("key"))
    )
    buckets = (
        keys.groupBy("key")
        .agg(F.min("id").alias("pivot"), F.max("id").alias("last"), F.count("*").alias("size"))
        .where("pivot != last")
        .drop("last")
    )
    members = cut(keys.join(buckets, "key"))
    wanted = members.select("id").distinct()
    chosen = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    chosen = chosen.join(wanted, "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    sets = cut(_sets(chosen, "id", "text", words).where(F.size("items") > 0))
    pairs = members.where("id != pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b"))
    links = cut(_confirmed(pairs.distinct(), sets, percent))
    parts = components(links)
    divided = _with_part(members.drop("pivot"), parts)
    open_keys = (
        divided.groupBy("key").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p != q")
    )
    divided = cut(divided.join(open_keys.select("key"), "key", "left_semi"))
    more = _pairs_in_small(divided).unionByName(_pairs_in_large(divided, sets, percent))
    found = cut(_confirmed(more.distinct(), sets, percent))
    # Links that were found later join whole parts.
    ends = _with_part(found.select(F.col("a").alias("id"), "b"), parts)
    ends = ends.select(F.col("part").alias("a"), F.col("b").alias("id"))
    whole = components(_with_part(ends, parts).select("a", F.col("part").alias("b")))
    final = (
        _with_part(classes, parts)
        .join(whole, F.col("part") == F.col("node"), "left")
        .select("whole", F.coalesce("component", "part").alias("component_id"), "id", "last")
        .where("component_id != id OR last != id")
        .select("whole", "component_id")
    )
    out = sketch.select("id", "n", "whole").join(final, "whole", "left")
    group = F.when(F.col("n") > 0, F.coalesce("component_id", "id")).otherwise(F.col("id"))
    group = F.when(F.col("id").isNotNull(), group)
    return out.select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        group.alias("component_id"),
        group.eqNullSafe(F.col("id")).alias("kept"),
    )


def without_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that are kept: one document of each group; all columns stay."""
    kept = duplicate_groups(docs, id, text).where("kept").select(F.col(f"`{id}`").alias("_kept"))
    kept = kept.distinct()
    return docs.join(kept, docs[id].eqNullSafe(kept["_kept"]), "left_semi")
