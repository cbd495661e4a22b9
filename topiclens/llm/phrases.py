"""Phrases that occur together more often than their parts let expect, by stripes.

A stripe belongs to a prefix of words and counts the words that come next. Tasks make the
stripes of some megabytes of text, and equal prefixes' stripes are merged elementwise. From the
merged stripes come the numbers of all phrases (an element: the prefix and one word more), of
all words (the stripe of the empty prefix, whose total is the number of word occurrences), and,
as the greatest elements over a phrase's extensions, what subsumes a phrase.

Stripes of longer prefixes are made from frequent parts alone: a phrase is not frequent if one
of its parts is not. A filter of bits tells tasks which parts may be frequent; it never denies
one that is, and its size has a fixed bound, so it only saves work. The stripe of a prefix with
more than one of SHARES shares of all words is cut in as many parts, by a hash of the next word,
so that no task merges more than about a share; there are SHARES such prefixes at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topiclens.llm.common import cut, scratch

#: Word occurrences whose stripes a task makes at once.
CHUNK_WORDS = 2 << 20
#: Shares of all words that a part of a stripe may hold; so many parts has the empty prefix.
SHARES = 1 << 12
#: Stripes travel in bundles, by their prefixes' hashes; a bundle holds about as many words.
BUNDLE_WORDS = 1 << 18
#: Next words in a row, at most.
ROW_WORDS = 4096
#: Bits of the filter, at most: 8 MB. Fewer where 16 for each frequent phrase are less.
MOST_BITS = 1 << 26
#: Groups in which a language's phrases are ranked before all of them are.
RANKED_IN = 256

# Letters that become small, and characters that end a piece.
_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_ENDS = b".,;:!?\n\x0b\x0c\r"
# A byte that no text in UTF-8 has.
_END = b"\xff"

_FACTOR, _SPREAD = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


_BUNDLES = (
    "lang string, bundle bigint, prefixes array<string>, sizes array<bigint>, following string, counts array<bigint>"
)


def _word_hash(lang: str, word: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(lang.encode() + b"\0" + word)


def _bits(hashes, number: int):
    """Two places of each hash in a filter of `number` bits."""
    import numpy as np

    x = hashes ^ (hashes >> np.uint64(33))
    x = x * np.uint64(_SPREAD)
    x ^= x >> np.uint64(29)
    mask = np.uint64(number - 1)
    return (x & mask).astype(np.int64), ((x >> np.uint64(32)) & mask).astype(np.int64)


def _has(bits, hashes):
    import numpy as np

    out = np.ones(len(hashes), bool)
    for place in _bits(hashes, 8 * len(bits)):
        out &= (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
    return out


def _parts(hashes, large):
    """How many parts the stripes of the prefixes with these hashes have."""
    import numpy as np

    known, numbers = large
    out = np.ones(len(hashes), np.uint64)
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        same = known[at] == hashes
        out[same] = numbers[at[same]]
    return out


class _Chunk:
    """Word numbers of some texts, 0 between pieces."""

    def __init__(self):
        self.known: dict[str, dict[bytes, int]] = {}
        self.words: list[bytes] = [b""]
        self.langs: list[str] = [""]
        self.ids: list = []
        self.size = 0
        self.table = bytes.maketrans(_UPPER + _ENDS, _LOWER + _END * len(_ENDS))

    def add(self, lang: str, text: bytes) -> None:
        import numpy as np

        chunk = self

        class Numbers(dict):
            def __missing__(self, word: bytes) -> int:
                n = self[word] = len(chunk.words)
                chunk.words.append(word)
                chunk.langs.append(lang)
                return n

        numbers = self.known.get(lang)
        if numbers is None:
            numbers = self.known[lang] = Numbers({_END: 0})
        found = text.translate(self.table).replace(_END, b" \xff ").split()
        self.ids.append(np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)))
        self.ids.append(np.zeros(1, np.int64))
        self.size += len(found) + 1

    def stripes(self, length: int, bits, large, bundles: int) -> Iterator[pa.RecordBatch]:
        """Stripes of prefixes of `length` - 1 words, whose phrases pass the filter.

        large: hashes of the prefixes that have several parts, in order, and how many.
        """
        import numpy as np

        ids = np.concatenate([*self.ids, np.zeros(length, np.int64)])
        self.ids = []
        v = len(self.words)
        words = pa.array(self.words, pa.binary()).cast(pa.string())
        end = len(ids) - length
        whole = ids[:end] != 0
        for j in range(1, length):
            whole &= ids[j : end + j] != 0
        at = np.flatnonzero(whole)
        hashes = np.array([_word_hash(g, w) for g, w in zip(self.langs, self.words)], np.uint64)
        if length == 2:
            passed = _has(bits, hashes)
            at = at[passed[ids[at]] & passed[ids[at + 1]]]
        elif length > 2:
            # Of each place: whether the phrase of length - 1 words there may be frequent.
            places = np.unique(np.concatenate([at, at + 1]))
            h = hashes[ids[places]]
            for j in range(1, length - 1):
                h = h * np.uint64(_FACTOR) + hashes[ids[places + j]]
            passed = np.zeros(len(ids) + 1, bool)
            passed[places] = _has(bits, h)
            at = at[passed[at] & passed[at + 1]]
        if not len(at):
            return
        # Numbers of the prefixes, and a place where each is.
        if length == 1:
            # The empty prefix is one prefix in each language; its place is of no matter.
            _, number = np.unique(np.array(self.langs), return_inverse=True)
            prefix, where = number[ids[at]], None
            parts = np.full(v, SHARES, np.uint64)
        elif length == 2:
            prefix, where = ids[at], None
            parts = _parts(hashes, large)
        else:
            prefix = ids[at]
            for j in range(1, length - 1):
                _, first, prefix = np.unique(prefix * v + ids[at + j], return_index=True, return_inverse=True)
            where = at[first]
            h = hashes[ids[where]]
            for j in range(1, length - 1):
                h = h * np.uint64(_FACTOR) + hashes[ids[where + j]]
            parts = _parts(h, large)
        key, counts = np.unique(prefix * v + ids[at + length - 1], return_counts=True)
        del at, whole
        prefix, following = key // v, key % v
        del key
        # Another part of the hash than the filter's.
        part = ((hashes[following] >> np.uint64(20)) % parts[prefix]).astype(np.int64)
        if length == 1:
            bundle = part
        else:
            of_prefix = hashes if length == 2 else h
            bundle = (of_prefix[prefix] * np.uint64(_SPREAD) >> np.uint64(17)) + part.astype(np.uint64)
            bundle = (bundle % np.uint64(bundles)).astype(np.int64)
        spoken = np.unique(np.array(self.langs), return_inverse=True)[1][following]
        order = np.lexsort((prefix, bundle, spoken))
        prefix, following, bundle, counts, spoken = (x[order] for x in (prefix, following, bundle, counts, spoken))
        del order, part
        # A row is a bundle of one language, or a part of it; it has one or more stripes.
        new = np.ones(len(prefix), bool)
        new[1:] = (bundle[1:] != bundle[:-1]) | (spoken[1:] != spoken[:-1])
        firsts = np.flatnonzero(new)
        nth = np.arange(len(prefix)) - np.repeat(firsts, np.diff(np.append(firsts, len(prefix))))
        new = nth % ROW_WORDS == 0
        rows = np.flatnonzero(new)
        new[1:] |= prefix[1:] != prefix[:-1]
        starts = np.flatnonzero(new)
        of_row = np.searchsorted(starts, rows)
        del new, nth, spoken
        langs = np.array(self.langs, object)
        sizes = np.diff(np.append(starts, len(prefix)))
        if length == 1:
            prefixes = pa.array([""] * len(starts), pa.string())
        elif length == 2:
            prefixes = words.take(pa.array(prefix[starts]))
        else:
            places = where[prefix[starts]]
            columns = [words.take(pa.array(ids[places + j])) for j in range(length - 1)]
            prefixes = pc.binary_join_element_wise(*columns, " ")
        for a in range(0, len(rows), 1000):
            some, own = rows[a : a + 1000], of_row[a : a + 1000]
            stop = rows[a + 1000] if a + 1000 < len(rows) else len(following)
            last = of_row[a + 1000] if a + 1000 < len(rows) else len(starts)
            offsets = pa.array(np.append(some, stop) - some[0], pa.int32())
            places = pa.array(np.append(own, last) - own[0], pa.int32())
            here = slice(some[0], stop)
            lists = pa.ListArray.from_arrays(offsets, words.take(pa.array(following[here])))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(langs[following[some]], pa.string()),
                    pa.array(bundle[some], pa.int64()),
                    pa.ListArray.from_arrays(places, prefixes.slice(own[0], last - own[0])),
                    pa.ListArray.from_arrays(places, pa.array(sizes[own[0] : last], pa.int64())),
                    pc.binary_join(lists, " "),
                    pa.ListArray.from_arrays(offsets, pa.array(counts[here], pa.int64())),
                ],
                names=["lang", "bundle", "prefixes", "sizes", "following", "counts"],
            )


def _made(texts: DataFrame, length: int, bits: Broadcast | None, large, bundles: int) -> DataFrame:
    """(lang, bundle, prefixes, sizes, following, counts): tasks' stripes, in bundles.

    sizes: next words of each prefix; `following`: all of them, joined by spaces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        known = np.frombuffer(bits.value, np.uint8) if bits else None
        chunk = _Chunk()
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                chunk.add(lang.as_py(), text.as_py())
                if chunk.size >= CHUNK_WORDS:
                    yield from chunk.stripes(length, known, large, bundles)
                    chunk = _Chunk()
        yield from chunk.stripes(length, known, large, bundles)

    return texts.mapInArrow(run, _BUNDLES)


def _merged(stripes: DataFrame, least: int, totals: bool) -> DataFrame:
    """(lang, prefix, next, f): elements of merged stripes that are `least` at least.

    With `totals` also each bundle's total, with a null `next`. Bundles come sorted, so a task
    holds one of them besides a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def record(langs, prefixes, words, numbers):
            return pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(prefixes, pa.string()), pa.array(words, pa.string()), pa.array(numbers, pa.int64())],
                names=["lang", "prefix", "next", "f"],
            )

        def told(key, prefixes, words, numbers):
            kept = np.flatnonzero(numbers >= least)
            at = pa.array(kept)
            yield record([key[0]] * len(kept), prefixes.take(at), words.take(at), numbers[kept])
            if totals:
                yield record([key[0]], [""], [None], [int(numbers.sum())])

        key = held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = [batch.column(i) for i in range(2)]
            new = np.ones(batch.num_rows, bool)
            changed = [pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False) for c in names]
            new[1:] = changed[0] | changed[1]
            group = np.cumsum(new) - 1
            starts = np.flatnonzero(new)
            last = int(group[-1])
            lists = pc.split_pattern(batch.column(4), " ")
            owner = np.repeat(group, pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            every = pc.list_flatten(lists)
            counts = pc.list_flatten(batch.column(5)).to_numpy(zero_copy_only=False)
            sizes = pc.list_flatten(batch.column(3)).to_numpy(zero_copy_only=False)
            prefixes = pc.list_flatten(batch.column(2)).take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
            first = tuple(c[0].as_py() for c in names)
            if key == first:
                prefixes, every = pa.concat_arrays([held[0], prefixes]), pa.concat_arrays([held[1], every])
                counts = np.concatenate([held[2], counts])
                owner = np.concatenate([np.zeros(len(held[0]), np.int64), owner])
            elif key is not None:
                yield from told(key, *held)
            table = pa.table({"g": owner, "p": prefixes, "w": every, "c": counts})
            table = table.group_by(["g", "p", "w"]).aggregate([("c", "sum")]).combine_chunks()
            g, c = table["g"].to_numpy(), table["c_sum"].to_numpy()
            p, w = (pa.concat_arrays(table[x].chunks) for x in ("p", "w"))
            own = np.flatnonzero(g == last)
            at = pa.array(own)
            key, held = tuple(x[int(starts[last])].as_py() for x in names), (p.take(at), w.take(at), c[own])
            done = np.flatnonzero((g != last) & (c >= least))
            at = pa.array(done)
            yield record(names[0].take(pa.array(starts[g[done]])), p.take(at), w.take(at), c[done])
            if totals and last:
                sums = np.zeros(last + 1, np.int64)
                np.add.at(sums, g, c)
                yield record(names[0].take(pa.array(starts[:-1])), [""] * last, [None] * last, sums[:-1])
        if key is not None:
            yield from told(key, *held)

    dealt = stripes.repartition("lang", "bundle").sortWithinPartitions("lang", "bundle")
    return dealt.mapInArrow(run, "lang string, prefix string, next string, f bigint")


def _hash(lang: str, phrase: str) -> int:
    h = 0
    for j, word in enumerate(phrase.encode().split(b" ")):
        x = _word_hash(lang, word)
        h = (h * _FACTOR + x) % (1 << 64) if j else x
    return h


def _large(phrases: DataFrame, words: int):
    """Hashes, in order, of the phrases with more than a share of all words, and how many shares.

    There are SHARES of them at most.
    """
    import numpy as np

    share = max(1, words // SHARES)
    found = {_hash(r["lang"], r["phrase"]): -(-r["f"] // share) for r in phrases.where(F.col("f") > share).collect()}
    return np.array(sorted(found), np.uint64), np.array([found[h] for h in sorted(found)], np.uint64)


def _filter(phrases: DataFrame) -> Broadcast | None:
    """A filter of the phrases' bits, or None if there is no phrase; its size is bounded."""
    n = phrases.count()
    if not n:
        return None
    number = min(MOST_BITS, 1 << max(10, (16 * n - 1).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            hashes = [_hash(*r) for r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            places = np.concatenate(_bits(np.array(hashes, np.uint64), number))
            values = np.left_shift(np.uint64(1), (places & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(places >> 6), pa.array(values)], names=["place", "bit"]
            )

    import numpy as np

    found = phrases.select("lang", "phrase").mapInArrow(run, "place bigint, bit bigint")
    table = found.groupBy("place").agg(F.bit_or("bit").alias("bits")).toArrow()
    held = np.zeros(number // 64, np.int64)
    held[table["place"].to_numpy()] = table["bits"].to_numpy()
    return phrases.sparkSession.sparkContext.broadcast(held.tobytes())


def _scored(counted: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the candidates that no longer one subsumes."""
    total = counted.where("next IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    phrase = F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))
    every = counted.where("next IS NOT NULL").select("lang", phrase.alias("phrase"), "f")
    words = F.split("phrase", " ", -1)
    candidates = every.select("lang", "phrase", F.col("f").alias("a"), words.alias("w")).where(F.size("w") > 1)
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("rest"),
    )
    cuts = cuts.join(every.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(every.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.join(total, "lang")
    # 38 digits hold both products; the quotient fits a long.
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    above = (F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(15,0)") * wide("n")).cast("decimal(38,0)")
    below = (wide("l") * wide("r")).cast("decimal(38,0)")
    score = F.call_function("div", above, below)
    cuts = cuts.withColumn("score", score)
    lowest = cuts.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("m")
    ).select("lang", "phrase", "m.a", "m.l", "m.r", "m.n", "m.score")
    # A longer phrase that is as frequent has an extension by one word that is as frequent.
    longer = candidates.where(F.size("w") > 2)
    parts = longer.select(
        "lang", "a",
        F.explode(F.array(
            F.array_join(F.slice("w", F.lit(1), F.size("w") - 1), " "),
            F.array_join(F.slice("w", F.lit(2), F.size("w") - 1), " "),
        )).alias("phrase"),
    )
    greatest = parts.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = lowest.join(greatest, ["lang", "phrase"], "left")
    return kept.where("longer IS NULL OR longer < a").drop("longer")


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 100, longest: int = 5, top: int = 2000
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases by score.

    Texts are cut in pieces at . , ; : ! ? and line ends, and pieces into words at blanks and
    tabs; A to Z become small. A phrase has 2 to `longest` words of one piece and occurs at
    least `least` times. n: words of the language; a: the phrase's occurrences; l, r: its two
    parts', where it is cut; score: floor(1000 a n / (l r)), of the cut that scores lowest, or
    the first of such. Phrases inside a longer one with as many occurrences are left out. Order:
    score and a from the highest, then the phrase's bytes. A null language is `und`; null and
    empty texts have no words; repeated rows count each time; no rows give none.

    Counts are exact and over all rows. A task holds the words of CHUNK_WORDS occurrences and
    its longest text. One pass over the texts for each length of phrase; frequent phrases lie in
    the shared folder until the result does.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
        F.col(f"`{text}`").cast("binary").alias("text"),
    ).where(F.length("text") > 0)
    with scratch(spark, "phrases") as folder:
        bits, large, bundles, done, total = None, None, 1, [], 0
        for length in range(1, longest + 1):
            path = f"{folder}/{length}"
            _merged(_made(texts, length, bits, large, bundles), least, length == 1).write.parquet(path)
            done.append(path)
            written = spark.read.parquet(path)
            if length == 1:
                total = written.where("next IS NULL").agg(F.sum("f")).first()[0] or 0
                bundles = max(1, -(-total // BUNDLE_WORDS))
            if length == longest:
                break
            phrase = F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))
            found = written.where("next IS NOT NULL").select("lang", phrase.alias("phrase"), "f")
            bits, large = _filter(found), _large(found, total)
            if bits is None:
                break
        scored = _scored(spark.read.parquet(*done), least)
        best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
        group = F.pmod(F.xxhash64("phrase"), F.lit(RANKED_IN))
        some = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", group).orderBy(*best)))
        ranked = some.where(F.col("rank") <= top).withColumn(
            "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")
        )
        ranked = ranked.where(F.col("rank") <= top)
        return cut(ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
