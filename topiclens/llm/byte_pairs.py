"""Byte-level BPE by recursive SQL inside each task.

Each task keeps the merge table in an in-process database. The distinct words of a few MB
of text are encoded by one recursive query: token-position rows join the merge table, the
leftmost pair of the least rank of each word is contracted, until no pair of a word is in
the table. Ordered aggregation turns the ids back into bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Callable

from pyspark.sql import DataFrame

from topiclens.llm.common import map_texts

#: Words whose ids a task remembers; when there are more, it starts anew.
REMEMBERED = 600_000
#: Words of more bytes contract all places of a pair in one step, where the order allows it.
LONG = 200

_STEPS = """
WITH RECURSIVE state(word, toks, done) AS (
  SELECT word, bytes, false FROM words
  UNION ALL
  SELECT s.word,
    CASE WHEN b.best IS NULL THEN s.toks
      ELSE s.toks[:(b.best & 16777215) - 1] || [(b.best >> 24)::INTEGER] || s.toks[(b.best & 16777215) + 2:] END,
    b.best IS NULL
  FROM state s LEFT JOIN (
    SELECT word, min((m.made::BIGINT << 24) | i) AS best
    FROM (
      SELECT word, unnest(toks[:-2]) AS l, unnest(toks[2:]) AS r, unnest(range(1, len(toks))) AS i
      FROM state WHERE NOT done AND len(toks) > 1
    ) JOIN merges m ON m.pair = ((l::BIGINT << 32) | r)
    GROUP BY word
  ) b ON b.word = s.word
  WHERE NOT s.done
)
SELECT word, toks FROM state WHERE done
"""

# As above, but with all places of the least pair, from the left, none overlapping, if no pair
# with the new token comes before it in the order: then one at a time would do the same.
_LONG_STEPS = """
WITH RECURSIVE state(word, toks, done) AS (
  SELECT word, bytes, false FROM words
  UNION ALL
  SELECT word, list(CASE WHEN here THEN made ELSE tok END ORDER BY i), NOT bool_or(here)
  FROM (
    SELECT t.word, t.i, t.tok, c.made, c.i IS NOT NULL AS here,
      lag(c.i IS NOT NULL, 1, false) OVER (PARTITION BY t.word ORDER BY t.i) AS gone
    FROM (
      SELECT word, unnest(toks) AS tok, unnest(range(1, len(toks) + 1)) AS i FROM state WHERE NOT done
    ) t LEFT JOIN (
      SELECT word, i, made FROM (
        SELECT word, i, made, safe, i - min(i) OVER (PARTITION BY word, island) AS nth,
          min(i) OVER (PARTITION BY word) AS leftmost
        FROM (
          SELECT word, i, made, safe, i - row_number() OVER (PARTITION BY word ORDER BY i) AS island
          FROM (
            SELECT word, i, made, safe, min(made) OVER (PARTITION BY word) AS least
            FROM (
              SELECT word, unnest(toks[:-2]) AS l, unnest(toks[2:]) AS r, unnest(range(1, len(toks))) AS i
              FROM state WHERE NOT done AND len(toks) > 1
            ) JOIN merges m ON m.pair = ((l::BIGINT << 32) | r)
          ) WHERE made = least
        )
      ) WHERE CASE WHEN safe THEN nth % 2 = 0 ELSE i = leftmost END
    ) c ON c.word = t.word AND c.i = t.i
  ) WHERE NOT gone GROUP BY word
)
SELECT word, toks FROM state WHERE done
"""

_DECODE = """
SELECT len(toks), array_to_string(toks, ' '), unhex(bytes)
FROM found JOIN (
  SELECT word, string_agg(hex, '' ORDER BY i) AS bytes
  FROM (SELECT word, unnest(toks) AS tok, unnest(range(1, len(toks) + 1)) AS i FROM found)
  JOIN vocabulary ON id = tok GROUP BY word
) USING (word) ORDER BY word
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def _database(ranks: dict[bytes, int]):
    """A database with the vocabulary and the merge table: pairs of tokens that make a token."""
    import duckdb
    import pyarrow as pa

    con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "600MB"})
    pairs, made = [], []
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                pairs.append((left << 32) | right)
                made.append(rank)
    rows = pa.table({"pair": pa.array(pairs, pa.int64()), "made": pa.array(made, pa.int32())})
    con.register("rows", rows)
    con.execute("""
        CREATE TABLE merges AS SELECT pair, made, coalesce(least_after, made + 1) > made AS safe
        FROM rows LEFT JOIN (
          SELECT part, min(made) AS least_after FROM (
            SELECT pair >> 32 AS part, made FROM rows UNION ALL SELECT pair & 4294967295, made FROM rows
          ) GROUP BY part
        ) ON part = made
    """)
    con.unregister("rows")
    words = pa.table({"id": pa.array(ranks.values(), pa.int32()), "hex": [t.hex() for t in ranks]})
    con.register("rows", words)
    con.execute("CREATE TABLE vocabulary AS SELECT * FROM rows")
    con.unregister("rows")
    return con


def _word_encoder(ranks: dict[bytes, int]) -> Callable[[list[str]], list[tuple[int, str, bytes]]]:
    """A function from distinct words to (number of ids, ids as text, decoded bytes)."""
    import numpy as np
    import pyarrow as pa

    con = _database(ranks)
    single = np.array([ranks[bytes([i])] for i in range(256)], np.int32)

    def contracted(numbers: list[int], raw: list[bytes], steps: str) -> None:
        flat = single[np.frombuffer(b"".join(raw), np.uint8)]
        ends = np.cumsum([0] + [len(w) for w in raw]).astype(np.int32)
        rows = pa.table(
            {"word": pa.array(numbers, pa.int32()), "bytes": pa.ListArray.from_arrays(ends, flat)}
        )
        con.register("words", rows)
        con.execute("INSERT INTO found " + steps)
        con.unregister("words")

    def encode(words: list[str]) -> list[tuple[int, str, bytes]]:
        raw = [w.encode() for w in words]
        con.execute("CREATE OR REPLACE TEMP TABLE found (word INTEGER, toks INTEGER[])")
        whole, short, long = [], [], []
        for i, w in enumerate(raw):
            (whole if w in ranks else short if len(w) <= LONG else long).append(i)
        if whole:
            rows = pa.table({
                "word": pa.array(whole, pa.int32()),
                "toks": pa.array([[ranks[raw[i]]] for i in whole], pa.list_(pa.int32())),
            })
            con.register("words", rows)
            con.execute("INSERT INTO found SELECT * FROM words")
            con.unregister("words")
        if short:
            contracted(short, [raw[i] for i in short], _STEPS)
        if long:
            contracted(long, [raw[i] for i in long], _LONG_STEPS)
        return con.execute(_DECODE).fetchall()

    return encode


def _text_encoder(ranks: dict[bytes, int], pattern: str):
    """A function from texts to (number of ids, ids as text, decoded bytes) of each."""
    import regex

    encode = _word_encoder(ranks)
    words_in = regex.compile(pattern).findall
    known: dict[str, tuple[int, str, bytes]] = {}

    def apply(texts: list[str | None]) -> list[tuple[int, str, bytes]]:
        split = [words_in(t) if t else [] for t in texts]
        if len(known) > REMEMBERED:
            known.clear()
        new = list(set().union(*split).difference(known))
        if new:
            known.update(zip(new, encode(new), strict=True))
        out = []
        for words in split:
            counts, ids, decoded = zip(*map(known.__getitem__, words)) if words else ((), (), ())
            out.append((sum(counts), " ".join(ids), b"".join(decoded)))
        return out

    return apply


def encoded(docs: DataFrame, ranks_path: str, pattern: str, id: str = "doc_id", text: str = "text", digests: bool = False) -> DataFrame:
    """(id, ids, decoded), a row for each row of docs: token ids, and the text they decode to.

    With `digests`: (id, n_tokens, ids_sha256, decoded_sha256), where ids_sha256 is of the
    decimal ids joined by spaces, and decoded_sha256 of the decoded bytes, both in lower-case
    hex. Null and empty texts have no ids. Special tokens are ordinary text. The rank file is
    read once, by the driver; its size bounds what is copied to the executors.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    kind = docs.schema[id].dataType.simpleString()

    def make():
        import hashlib

        apply = _text_encoder(shared.value, pattern)
        sha = lambda b: hashlib.sha256(b).hexdigest()

        def as_rows(ids, texts):
            made = apply(texts)
            if digests:
                return [ids, [n for n, _, _ in made], [sha(x.encode()) for _, x, _ in made], [sha(d) for _, _, d in made]]
            return [ids, [[int(i) for i in x.split()] for _, x, _ in made], [d.decode() for _, _, d in made]]

        return as_rows

    fields = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    out = map_texts(docs, [id, text], make, f"id {kind}, {fields}")
    return out.withColumnRenamed("id", id)
