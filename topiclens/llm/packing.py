"""Token sequences of one length from whole documents, by best-fit decreasing.

A document's ids are cut into full windows and a rest that is shorter. Rests are taken from
the longest to the shortest, and each goes to the open window with the least room that holds
it. A segment tree over the room that windows have left finds that window: a node tells how
many windows have as much room as its leaves say.

Only places, lengths and checksums are shuffled, never ids. Documents are dealt evenly, without
a key, to groups of about GROUP of them, and each group is packed by itself; so the work of a
task does not grow with the table, whatever ids or texts repeat.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import Model
from tokenizers.pre_tokenizers import CharDelimiterSplit

from topiclens.llm.common import free_name, map_texts

#: Documents packed together, about. A group leaves one short window at most.
GROUP = 1 << 14
#: A window that lacks more than this share of its length is packed anew, its rests cut.
MOST_LACKING = 1 / 64
#: Words whose ids a task remembers; when there are more, it starts anew.
REMEMBERED = 600_000
#: Chunks of a long text whose ids are joined at once.
AT_ONCE = 1 << 16
#: Bytes of texts that are encoded at once; more of them share more chunks.
TEXT_BYTES = 8 << 20
#: Group number's place in a sequence id.
_GROUP_BIT = 40

# Characters that are white space for every library, and such that are for some of them only.
_SURE = r" \t\n\r"
_ODD = r"\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff"

# What makes a space part of a chunk that began before it.
_WIDER = ("  ", "\t ", "\n ", "\r ")
_MARK = "\0"

# How byte-level tokenizers split texts of ASCII and Latin letters into words, and how
# they write bytes. These letters are the same in all versions of Unicode that libraries have.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_LATIN_WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^\s{_LATIN}0-9]+|\s+(?!\S)|\s+"
_AS_LETTERS = {b: 256 + n for n, b in enumerate([*range(33), *range(127, 161), 173])}


def _words_encoder(model: Model) -> Callable[[str], list[int]]:
    """A function from words parted by spaces to their ids, by a tokenizer's model alone."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are parallel
    alone = Tokenizer(model)
    alone.pre_tokenizer = CharDelimiterSplit(" ")
    return lambda words: alone.encode_batch_fast([words], add_special_tokens=False)[0].ids


def _texts_encoder(definition: str) -> Callable[[list[str]], list[bytes]]:
    """A function from texts to their ids, four bytes each; `definition`: a tokenizer as JSON.

    A byte-level tokenizer's words never reach over a place where white space begins, so such
    texts are cut into chunks there, and each of their chunks and words is encoded once. New
    words go to the library in one call; their letters tell where each one's ids end. Others
    are encoded whole. Special tokens' strings are ordinary text.
    """
    import json
    import re
    import struct
    from codecs import charmap_build, charmap_decode, charmap_encode
    from itertools import islice

    import numpy as np
    import tokenizers

    tokenizer = tokenizers.Tokenizer.from_str(definition)
    tokenizer.encode_special_tokens = True
    made = json.loads(definition)
    how, model = made.get("pre_tokenizer") or {}, made["model"]
    by_bytes = how.get("type") == "ByteLevel" and how.get("use_regex", True) and not how.get("add_prefix_space")
    letters = "".join(chr(_AS_LETTERS.get(b, b)) for b in range(256))
    if (
        not by_bytes or made.get("normalizer") or model["type"] != "BPE"
        or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")
        or not all(x in model["vocab"] for x in letters)
    ):

        def whole(text: str) -> bytes:
            ids = tokenizer.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)

        return lambda texts: [whole(t) for t in texts]
    split = tokenizer.pre_tokenizer.pre_tokenize_str
    latin_words = re.compile(_LATIN_WORDS, re.A).findall
    latin = re.compile(rf"[\x00-\x7f{_LATIN}]*").fullmatch
    as_bytes = charmap_build(letters)
    # No UTF-8 has this byte, and no byte is written as a space.
    apart, parted = b"\xff", letters[:255] + " "
    ids_of = _words_encoder(tokenizer.model)
    length = np.zeros(max(model["vocab"].values()) + 1, np.int64)
    for token, i in model["vocab"].items():
        length[i] = len(token)
    known: dict[bytes, bytes] = {}

    def split_words(c: str) -> list[bytes]:
        return [charmap_encode(w, "strict", as_bytes)[0] for w, _ in split(c)]

    def learn(words: list[bytes]) -> None:
        if len(known) > REMEMBERED:
            known.clear()
        new = [w for w in words if w not in known]
        if not new:
            return
        ids = np.array(ids_of(charmap_decode(apart.join(new), "strict", parted)[0]), "<u4")
        ends = length[ids].cumsum().searchsorted(np.cumsum([len(w) for w in new])) + 1
        held, start = ids.tobytes(), 0
        for w, end in zip(new, (4 * ends).tolist()):
            known[w] = held[start:end]
            start = end

    def encoded(chunks: pa.Array, places: np.ndarray) -> list[bytes]:
        """The ids of the chunks from each of these places to the next."""
        found = chunks.dictionary_encode()
        words, ends = [], [0]
        for c in found.dictionary.to_numpy(zero_copy_only=False):
            # As the library splits them; it takes ten times as long for a short text.
            words += latin_words(c) if c.isascii() or latin(c) else split_words(c)
            ends.append(len(words))
        some = pa.array(words, pa.large_binary()).dictionary_encode()
        distinct = some.dictionary.to_numpy(zero_copy_only=False).tolist()
        learn(distinct)
        ids = pa.array([known[w] for w in distinct], pa.large_binary()).take(some.indices)
        # The words' ids lie one after the other, so they are the chunks' ids, too.
        _, offsets, held = ids.buffers()
        ends = np.frombuffer(offsets, np.int64)[ends] if words else np.zeros(len(ends), np.int64)
        of_chunks = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), held or pa.py_buffer(b"")]
        )
        _, offsets, held = of_chunks.take(found.indices).buffers()
        at, held = np.frombuffer(offsets, np.int64)[places].tolist(), memoryview(held or b"")
        return [bytes(held[a:b]) for a, b in zip(at, at[1:])]

    odd = re.compile(f"[{_ODD}]")
    plain = re.compile(f"[{_SURE}]*[^{_SURE}]+|[{_SURE}]+")
    careful = re.compile(
        f"[{_SURE}{_ODD}]*[^{_SURE}{_ODD}]+(?:[{_ODD}][{_SURE}{_ODD}]*[^{_SURE}{_ODD}]*)*|[{_SURE}{_ODD}]+"
    )

    def by_spaces(texts: list[str]) -> list[bytes]:
        # The mark is in none of them.
        marked = (t.replace(" ", _MARK + " ") for t in texts)
        parts = pc.split_pattern(pa.array(marked, pa.large_string()), _MARK)
        return encoded(parts.flatten(), parts.offsets.to_numpy())

    def by_chunks(text: str) -> bytes:
        # The careful pattern finds the same where there is no odd character.
        found, out = (careful if odd.search(text) else plain).finditer(text), []
        while some := [m.group() for m in islice(found, AT_ONCE)]:
            out += encoded(pa.array(some, pa.large_string()), np.array([0, len(some)]))
        return b"".join(out)

    def encode(texts: list[str]) -> list[bytes]:
        # Where each space begins a chunk, splitting at spaces is faster.
        easy = [len(t) < AT_ONCE and not any(x in t for x in (_MARK, *_WIDER)) and not odd.search(t) for t in texts]
        ready = iter(by_spaces([t for t, x in zip(texts, easy) if x]) if any(easy) else ())
        return [next(ready) if x else by_chunks(t) for t, x in zip(texts, easy)]

    return encode


def _encoder(definition: str) -> Callable[[str], bytes]:
    """_texts_encoder() for one text at a time."""
    encode = _texts_encoder(definition)
    return lambda text: encode([text])[0]


def _powers(n: int) -> list[int]:
    """The powers of two that add up to n, from the greatest."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pieces(
    docs: DataFrame, tokenizer: str, end: int = 1, size: int = 2048, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, parts_crc32) of each document's pieces.

    A document is its text's ids by the tokenizer file, which the driver reads, and then `end`.
    Pieces are full windows of `size` ids and a shorter rest, if there is one. parts_crc32: of
    a rest cut at the powers of two that add up to its length, from the greatest; it lets a rest
    be cut later, without its ids. Null texts count as empty, so every row has a piece; repeated
    rows are documents of their own. A task holds the ids and chunks of
    TEXT_BYTES of texts, or of the longest, and what it remembers.
    """
    with open(tokenizer, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())  # bounded by the vocabulary
    kind = docs.schema[id].dataType.simpleString()

    def make():
        import struct
        from zlib import crc32

        encode = _texts_encoder(shared.value)
        last = struct.pack("<I", end)

        def apply(ids, texts):
            rows = []
            for i, held in zip(ids, encode([t or "" for t in texts])):
                held = memoryview(held + last)
                whole = len(held) // 4
                for start in range(0, whole, size):
                    part = held[4 * start : 4 * (start + size)]
                    n, at, parts = len(part) // 4, 0, []
                    if n < size:
                        for p in _powers(n):
                            parts.append(crc32(part[4 * at : 4 * (at + p)]))
                            at += p
                    rows.append((i, start, n, crc32(part), whole, parts))
            return list(zip(*rows)) if rows else [[] for _ in range(6)]

        return apply

    schema = f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, parts_crc32 array<bigint>"
    return map_texts(docs, [id, text], make, schema, most=TEXT_BYTES).withColumnRenamed("id", id)


class _Windows:
    """Open windows by the room they have left, and the tree that finds the tightest."""

    def __init__(self, size: int):
        self.size = size
        self.leaves = 1 << size.bit_length()
        self.tree = [0] * (2 * self.leaves)  # windows under each node
        self.open: list[list[list]] = [[] for _ in range(size + 1)]

    def _count(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.tree[node] += by
            node >>= 1

    def tightest(self, length: int) -> int | None:
        """The least room of an open window that is `length` at least."""
        tree, node = self.tree, self.leaves + length
        if not tree[node]:
            # Up to the first node whose right neighbour has windows, then down on the left.
            while node & 1 or not tree[node + 1]:
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            while node < self.leaves:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        return node - self.leaves

    def put(self, piece: tuple, length: int) -> list | None:
        """Put a piece where it fits best; the window, if that is now full."""
        room = self.tightest(length)
        if room is None:
            room, window = self.size, []
        else:
            window = self.open[room].pop()
            self._count(room, -1)
        window.append(piece)
        room -= length
        if not room:
            return window
        self.open[room].append(window)
        self._count(room, 1)
        return None


def _cut_at_powers(window: list[tuple]) -> Iterator[list[tuple]]:
    """A window of parts whose lengths are powers of two, falling, as windows that are such, too."""
    wanted, held, part = iter(_powers(sum(p[2] for p in window))), 0, []
    goal = next(wanted)
    for p in window:
        part.append(p)
        held += p[2]
        if held == goal:
            yield part
            held, part, goal = 0, [], next(wanted, 0)


def _best_fit(rows: Iterator[tuple], size: int, most_lacking: int) -> Iterator[list[tuple]]:
    """Windows, as lists of pieces, for pieces from the longest to the shortest.

    Windows that then lack more than `most_lacking`, and are no power of two long, are packed
    anew: their rests are cut at powers of two, which leave no gaps.
    """
    windows = _Windows(size)
    for row in rows:
        full = windows.put(row, row[2])
        if full:
            yield full
    parts = []
    for room, some in enumerate(windows.open):
        used = size - room
        for window in some:
            if room <= most_lacking or not used & (used - 1):
                yield window
                continue
            for i, start, length, _, whole, crcs in window:
                for p, crc in zip(_powers(length), crcs):
                    parts.append((i, start, p, crc, whole, crcs))
                    start += p
    parts.sort(key=lambda p: -p[2])
    windows = _Windows(size)
    for part in parts:
        full = windows.put(part, part[2])
        if full:
            yield full
    for room, some in enumerate(windows.open):
        for window in some:
            yield from [window] if room <= most_lacking else _cut_at_powers(window)


def packed(
    docs: DataFrame,
    tokenizer: str,
    end: int = 1,
    size: int = 2048,
    id: str = "doc_id",
    text: str = "text",
    group: int = GROUP,
    most_lacking: float = MOST_LACKING,
) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset): where each piece is.

    Each id of each document, as pieces() has them, lies in one piece; a sequence holds `size`
    ids at most, its pieces one after the other from 0. A sequence lacks `most_lacking` of
    `size` at most, or is a power of two long: rests that best fit leaves in emptier windows are
    cut at powers of two. Documents are dealt in turn to as many groups as needed; a task holds
    the rests of its group, some 200 bytes each. No documents: no pieces.
    """
    groups = max(1, -(-docs.count() // group))
    found = pieces(docs, tokenizer, end, size, id, text).withColumnRenamed(id, "id")
    # Without a key: Spark sorts before it deals, so a task that runs again deals alike.
    dealt = found.repartition(groups)
    dealt = dealt.sortWithinPartitions(F.col("length").desc(), "id", "start", "ids_crc32", "doc_tokens")
    dealt = dealt.withColumn(free_name(found, "group"), F.spark_partition_id())
    kind = docs.schema[id].dataType.simpleString()
    schema = f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    lacking = int(most_lacking * size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = []

        def rows():
            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns]
                seen[:] = columns[6][:1]
                yield from zip(*columns[:6])

        out, number = [[] for _ in range(7)], 0

        def record():
            types = [out_types[0], *[pa.int64()] * 6]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)

        for window in _best_fit(rows(), size, lacking):
            offset, sequence = 0, (seen[0] << _GROUP_BIT) + number
            number += 1
            for i, start, length, crc, whole, _ in window:
                for column, x in zip(out, (i, start, length, crc, whole, sequence, offset)):
                    column.append(x)
                offset += length
            if len(out[0]) > 20_000:
                yield record()
                out = [[] for _ in range(7)]
        yield record()

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    out_types, names = [f.type for f in arrow], arrow.names
    return dealt.mapInArrow(run, schema).withColumnRenamed("id", id)
