"""Polarity of texts, transitions between events, and how revenue is shared out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topiclens import storage
from topiclens.functions.text import ngrams
from topiclens.operators.articles import with_position
from topiclens.operators.terms import pieces

# Fixed value: words in the longest phrase of a lexicon.
LONGEST = 4
# Terms of a lexicon, and words in them, up to which every task has a copy of it: some 10 bytes a term.
HELD, WORDS = 1 << 24, 1 << 22
# Tokens, and terms, that are looked up together inside a task.
TOGETHER, TERMS = 1 << 20, 1 << 18
# Seconds of a session that are ordered together.
STRETCH = 3600


def polarity(articles: DataFrame, lexicon: DataFrame) -> DataFrame:
    """`post_id, polarity, matches` from `post_id, tokens` and a lexicon `term, polarity`.

    Terms are words or phrases of up to four words. A match within a longer one does not
    count. Articles without a match have polarity 0. A lexicon of up to HELD terms is copied to
    all tasks, as numbers, and looked up where the tokens are, so no token is shuffled; a larger
    one is joined.
    """
    terms = storage.settle(
        lexicon.where("term IS NOT NULL").groupBy("term").agg(
            F.sum("polarity").alias("polarity"), F.count(F.lit(1)).alias("times")
        )
    )
    known = articles.select("post_id", "tokens").where("post_id IS NOT NULL")
    phrases = _phrases(terms)
    found = _joined(known, terms) if phrases is None else _looked_up(known, phrases)
    sums = found.groupBy("post_id").agg(
        F.sum("polarity").alias("polarity"), F.sum("matches").alias("matches")
    )
    none = F.lit(0).cast("long")
    return articles.select("post_id").join(sums, "post_id", "left").select(
        "post_id",
        F.coalesce("polarity", none).alias("polarity"),
        F.coalesce("matches", none).alias("matches"),
    )


class _Phrases:
    """Terms as a tree of their words: of each length, its nodes' keys in order and their values.

    A node is a number; its key is that of the node before it and of its last word. Values and
    counts are of the least kind that holds them.
    """

    def __init__(self, words: pa.Array, whole: bool):
        self.words = words
        self.whole = whole  # whether values are whole numbers
        self.levels = []
        self.first = None  # a word's node of the first length, or -1

    def add(self, keys: np.ndarray, values: np.ndarray, counts: np.ndarray) -> None:
        if not self.levels:
            self.first = np.full(len(self.words), -1)
            self.first[keys] = np.arange(len(keys))
        self.levels.append((keys, values, counts))

    def places(self, n: int, keys: np.ndarray) -> np.ndarray:
        """The nodes of length n with these keys, or -1."""
        if n == 1:
            return self.first[keys]
        known = self.levels[n - 1][0]
        if not len(known):
            return np.full(len(keys), -1)
        # In order, so that neighbours are looked up near each other.
        order = np.argsort(keys)
        place = np.minimum(np.searchsorted(known, keys[order]), len(known) - 1)
        place[known[place] != keys[order]] = -1
        found = np.empty(len(keys), np.int64)
        found[order] = place
        return found

    def numbers(self, tokens: pa.Array) -> np.ndarray:
        """The words' numbers, -1 for others."""
        coded = tokens.dictionary_encode()
        # The words are looked up among the tokens', which are fewer than what a table of the words would hold.
        at = pc.index_in(self.words, value_set=coded.dictionary, skip_nulls=True)
        known = np.full(len(coded.dictionary) + 1, -1)
        known[at.drop_null().to_numpy()] = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
        return known[coded.indices.fill_null(len(coded.dictionary)).to_numpy()]

    def beginnings(self, terms: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of terms of n words or more: their places, the key of their first n, and whether that is all."""
        parts = pc.split_pattern(terms, " ")
        length = pc.list_value_length(parts).to_numpy().astype(np.int64)
        number = self.numbers(parts.flatten())
        at = np.flatnonzero(length >= n)
        start = (np.cumsum(length) - length)[at]
        key = number[start]
        for k in range(1, n):
            key = self.places(k, key) * len(self.words) + number[start + k]
        return at, key, length[at] == n

    def matches(self, owner: np.ndarray, number: np.ndarray):
        """Place, length, value and count of each match of words' numbers (-1: none), at its first word."""
        at = np.flatnonzero(number >= 0)
        key = number[at]
        for n, (_, values, counts) in enumerate(self.levels, 1):
            if n > 1:
                last = at + n - 1
                inside = last < len(number)
                at, node, last = at[inside], node[inside], last[inside]
                inside = (owner[last] == owner[at]) & (number[last] >= 0)
                at = at[inside]
                key = node[inside] * len(self.words) + number[last[inside]]
            node = self.places(n, key)
            hit = node >= 0
            at, node = at[hit], node[hit]
            whole = counts[node] > 0
            yield at[whole], n, values[node[whole]], counts[node[whole]]


def _kind(low: int, high: int) -> type:
    """The least kind of whole number that holds both."""
    kinds = (np.int8, np.int16, np.int32)
    return next((k for k in kinds if np.iinfo(k).min <= low and high <= np.iinfo(k).max), np.int64)


def _together(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _phrases(terms: DataFrame) -> _Phrases | None:
    """The tree of a settled table `term, polarity, times`, or none if it is too large to be held.

    Terms become numbers where they are: the driver gets the words, and each length's keys and values.
    """
    whole = isinstance(terms.schema["polarity"].dataType, T.IntegralType)
    kind = "bigint" if whole else "double"
    parts = F.split("term", " ", -1)
    value = F.coalesce(F.col("polarity").cast(kind), F.lit(0).cast(kind)).alias("polarity")
    short = terms.where(F.size(parts) <= LONGEST).select("term", value, "times")
    found = short.agg(
        F.count(F.lit(1)), F.max(F.size(parts)), F.min("polarity"), F.max("polarity"), F.max("times")
    ).first()
    if found[0] > HELD:
        return None
    words = short.select(F.explode(parts).alias("word")).distinct().limit(WORDS + 1).toArrow()["word"]
    if len(words) > WORDS:
        return None
    made = _Phrases(words.cast(pa.string()).combine_chunks(), whole)
    kinds = (np.int64, _kind(found[2] or 0, found[3] or 0) if whole else np.float64, _kind(0, found[4] or 0))
    for n in range(1, (found[1] or 0) + 1):
        made.add(*_level(short, made, n, kind, kinds))
    return made


def _level(terms: DataFrame, phrases: _Phrases, n: int, kind: str, kinds: tuple) -> list[np.ndarray]:
    """Keys in order, values and counts of the nodes of length n; one that no term ends at has the count 0."""
    shared = terms.sparkSession.sparkContext.broadcast(phrases)
    names = ["key", "polarity", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _together(batches, TERMS):
            at, key, ends = shared.value.beginnings(table["term"].combine_chunks(), n)
            value, times = (table[name].to_numpy()[at] for name in names[1:])
            columns = [key, np.where(ends, value, value.dtype.type(0)), np.where(ends, times, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _together(batches, TERMS):
            columns = [pa.array([table[c].to_numpy().astype(k).tobytes()], pa.binary()) for c, k in zip(names, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    keyed = terms.mapInArrow(run, f"key bigint, polarity {kind}, times bigint").groupBy("key")
    nodes = keyed.agg(F.sum("polarity").alias("polarity"), F.sum("times").alias("times")).orderBy("key")
    table = nodes.mapInArrow(packed, "key binary, polarity binary, times binary").toArrow()
    none = [np.empty(0, k) for k in kinds]
    made = [
        np.concatenate([empty, *(np.frombuffer(x.as_buffer(), empty.dtype) for x in table[c])])
        for c, empty in zip(names, none)
    ]
    if (made[0][1:] < made[0][:-1]).any():  # parts came in another order
        order = np.argsort(made[0])
        made = [x[order] for x in made]
    return made


def _looked_up(articles: DataFrame, phrases: _Phrases) -> DataFrame:
    """`post_id, polarity, matches`, a row for each article."""
    shared = articles.sparkSession.sparkContext.broadcast(phrases)
    whole = phrases.whole

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = shared.value
        for batch in batches:
            for rows, sizes in pieces(batch, TOGETHER):
                number = phrases.numbers(rows.column(1).flatten())
                owner = np.repeat(np.arange(len(sizes)), sizes)
                found = list(phrases.matches(owner, number))
                # Of matches that begin at most three words before, one that ends later or is
                # longer holds this one.
                reach = np.full(len(number) + LONGEST - 1, -1)
                for at, n, _, _ in found:
                    reach[at + LONGEST - 1] = (at + n) * 8 + n
                most = reach[LONGEST - 1 :].copy()
                for by in range(1, LONGEST):
                    before = reach[LONGEST - 1 - by : len(reach) - by].copy()
                    before[:by] = -1
                    before[by:][owner[by:] != owner[:-by]] = -1
                    most = np.maximum(most, before)
                value = np.zeros(len(sizes), np.int64 if whole else np.float64)
                count = np.zeros(len(sizes), np.int64)
                for at, n, values, counts in found:
                    kept = most[at] == (at + n) * 8 + n
                    np.add.at(value, owner[at[kept]], values[kept])
                    np.add.at(count, owner[at[kept]], counts[kept])
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(value), pa.array(count)], names=["post_id", "polarity", "matches"]
                )

    kind = articles.schema["post_id"].dataType.simpleString()
    value = "bigint" if whole else "double"
    return articles.mapInArrow(run, f"post_id {kind}, polarity {value}, matches bigint")


def _joined(articles: DataFrame, terms: DataFrame) -> DataFrame:
    """The same with a row for each match that counts; only phrases as long as a term travel."""
    length = F.size(F.split("term", " ", -1)).alias("n")
    lengths = sorted(r["n"] for r in terms.select(length).distinct().collect() if r["n"] <= LONGEST)
    runs = F.array(
        *[F.struct(F.lit(n).alias("n"), ngrams(F.col("tokens"), n).alias("terms")) for n in lengths or [1]]
    )
    found = (
        articles.select("post_id", F.inline(runs))
        .select("post_id", "n", F.posexplode("terms").alias("pos", "term"))
        .join(terms, "term")
    )
    reach = (F.col("pos") + F.col("n")) * 8 + F.col("n")
    near = Window.partitionBy("post_id").orderBy("pos").rangeBetween(1 - LONGEST, 0)
    kept = found.withColumn("_reach", reach).withColumn("_most", F.max("_reach").over(near))
    return kept.filter("_reach = _most").select("post_id", "polarity", F.col("times").alias("matches"))


def metrics_by_polarity(hits: DataFrame, polarities: DataFrame) -> DataFrame:
    """`bucket, articles, views, revenue`: negative (-1), neutral (0) and positive (1) articles.

    Hits are added up per post before the join.
    """
    per_post = hits.groupBy("post_id").agg(
        F.count(F.lit(1)).alias("views"), F.sum("hit_revenue").alias("revenue")
    )
    return (
        per_post.join(polarities, "post_id")
        .groupBy(F.signum(F.col("polarity")).cast("int").alias("bucket"))
        .agg(
            F.count(F.lit(1)).alias("articles"),
            F.sum("views").alias("views"),
            F.sum("revenue").alias("revenue"),
        )
    )


def event_transitions(hits: DataFrame, event: str = "keyword", id: str = "event_id") -> DataFrame:
    """`event, next_event, transitions, probability` of events that follow in a session.

    Hits are in order of time, then id. A session is ordered in stretches of an hour, so a
    very long one is not ordered in one task; the last event of a stretch is followed by the
    first of the next.
    """
    stretch = F.floor(F.unix_timestamp("ts") / STRETCH)
    rows = hits.filter(F.col("ts").isNotNull()).select(
        "session_id", "ts", F.col(id).alias("id"), F.col(event).alias("event"), stretch.alias("stretch")
    )
    within = Window.partitionBy("session_id", "stretch").orderBy("ts", "id")
    pairs = rows.select("event", F.lead("event").over(within).alias("next_event"))
    order = F.struct("ts", "id")
    ends = rows.groupBy("session_id", "stretch").agg(
        F.min_by("event", order).alias("first"), F.max_by("event", order).alias("event")
    )
    after = Window.partitionBy("session_id").orderBy("stretch")
    across = ends.select("event", F.lead("first").over(after).alias("next_event"))
    counts = (
        pairs.unionByName(across)
        .filter("next_event IS NOT NULL")
        .groupBy("event", "next_event")
        .agg(F.count(F.lit(1)).alias("transitions"))
    )
    whole = F.sum("transitions").over(Window.partitionBy("event"))
    return counts.withColumn("probability", F.col("transitions") / whole)


def top_share(hits: DataFrame, user: str = "uuid", share: float = 0.1) -> DataFrame:
    """`users, top_users, revenue, top_revenue, top_share` of the users who bring most.

    `share` of the users, rounded up; ties go to the lesser user. Users are numbered in the
    order of their revenue where they are, part by part.
    """
    totals = hits.groupBy(F.col(user).alias("user")).agg(
        F.coalesce(F.sum("hit_revenue"), F.lit(0.0)).alias("revenue")
    )
    ranked = with_position(totals, F.desc("revenue"), "user")
    users = F.count(F.lit(1)).alias("users")
    everyone = totals.agg(users).scalar()
    is_top: Column = F.col("position") < F.ceil(everyone * F.lit(share))
    sums = ranked.withColumn("_top", is_top).agg(
        users,
        F.count_if("_top").alias("top_users"),
        F.sum("revenue").alias("revenue"),
        F.sum(F.when(F.col("_top"), F.col("revenue"))).alias("top_revenue"),
    )
    return sums.withColumn("top_share", F.try_divide("top_revenue", "revenue"))
