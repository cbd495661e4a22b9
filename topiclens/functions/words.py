"""Words of texts, as numbers: what `functions.text` finds, by tables of bytes.

For text that is counted and not shown. Each function gives the place of every word's text in an
array of texts, and the words in order, dictionary-encoded. All separators but ASCII ones are
bytes beyond it, so bytes tell as much as characters do.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# No byte of UTF-8; it stands between texts, and becomes 0 as all other separators become 1.
_BETWEEN = b"\xff"


def _table(letters: str) -> bytes:
    table = bytearray([1]) * 256
    table[0xFF] = 0
    for x in letters:
        table[ord(x)] = ord(x.lower())
    return bytes(table)


_LETTERS = _table(string.ascii_letters)
_WORDS = _table(string.ascii_letters + string.digits + "'")


def _joined(texts: pa.Array) -> bytes:
    held = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
    whole = _BETWEEN + _BETWEEN.join(held) + _BETWEEN
    if whole.count(_BETWEEN) != len(held) + 1:
        whole = _BETWEEN + _BETWEEN.join([t.replace(_BETWEEN, b" ") for t in held]) + _BETWEEN
    return whole


def _runs(whole: bytes) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Runs of bytes above 1, between the places of zeros."""
    data = np.frombuffer(whole, np.uint8)
    inside = data > 1
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    before = np.searchsorted(starts, np.flatnonzero(data == 0))
    owner = np.repeat(np.arange(len(before) - 1), np.diff(before))
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    found = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[inside]))
    coded = found.dictionary_encode()
    return owner, pa.DictionaryArray.from_arrays(coded.indices, coded.dictionary.cast(pa.string()))


def article_words(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """`text.article_words(text.straighten_apostrophes(...))` of each text."""
    whole = _joined(texts)
    for old, new in (("‘", "'"), ("’", "'"), ("ʼ", "'"), ("\n", ""), ("&nbsp", " ")):
        whole = whole.replace(old.encode(), new.encode())
    owner, coded = _runs(whole.translate(_WORDS, b"."))
    # Numbers are no words.
    wanted = pc.match_substring_regex(coded.dictionary, "[^0-9]").to_numpy(zero_copy_only=False)
    number = coded.indices.to_numpy()
    kept = wanted[number]
    places = pa.array((np.cumsum(wanted) - 1)[number[kept]].astype(np.int32))
    return owner[kept], pa.DictionaryArray.from_arrays(places, coded.dictionary.filter(pa.array(wanted)))


def letter_words(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Lower-cased runs of ASCII letters of each text."""
    return _runs(_joined(texts).translate(_LETTERS))
