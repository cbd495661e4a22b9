import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from fixtures import documents, prose, rows_of
from tokenizers import Tokenizer

from topiclens.llm import packing
from topiclens.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
ROWS = [
    (1, None), (2, ""), (3, "a"), (4, prose(4, 9000)), (5, prose(5, 700)), (5, prose(5, 700)), (6, "word " * 2047),
    (None, "no id"), (7, " lead  and　odd \x1c.\x1c \x85 space  \n\n tail \t "), (8, "<|endoftext|> 'll it's\r\n"),
    (9, "x" * 5000), (10, "é漢字🎉 " * 50), (11, "   "), (12, "a. . b"), (13, "​ a b"),
]


def known():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda t: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")


def check(rows, docs, size, most):
    """Every id in one piece, pieces gapless in sequences, and little padding."""
    encode = known()
    texts = {}
    for i, t in docs:
        texts.setdefault(i, []).append(encode(t))
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for i, found in by_doc.items():
        wanted = []
        for ids in texts[i]:
            wanted.append(len(ids))
            assert any(r.doc_tokens == len(ids) for r in found)
        assert sum(r.length for r in found) == sum(wanted)
        for r in found:
            assert any(len(x) == r.doc_tokens and crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for x in texts[i])
        if len(wanted) == 1:
            at = 0
            for r in sorted(found, key=lambda r: r.start):
                assert r.start == at
                at += r.length
    padding = 0
    for found in by_sequence.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= size
        padding += size - at if at & (at - 1) else 0
    assert padding <= most * len(by_sequence) * size


def test_edges(spark):
    rows = packing.packed(documents(spark, ROWS), PATH).collect()
    check(rows, ROWS, 2048, 1 / 64)
    assert packing.packed(documents(spark, ROWS), PATH).columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    ]


def test_empty(spark):
    assert packing.packed(documents(spark, []), PATH).collect() == []


@pytest.mark.parametrize("group", [7, 1000])
def test_rests_over_half_a_window(spark, group):
    # Whole rests of these lengths would leave nearly half of every window empty.
    docs = [(i, "a " * random.Random(i).randrange(33, 40)) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    check(packing.packed(df, PATH, size=64, group=group).collect(), docs, 64, 1 / 64)


def test_tree_finds_what_a_scan_finds():
    r = random.Random(1)
    size = 100
    for _ in range(50):
        lengths = sorted((r.randrange(1, size + 1) for _ in range(80)), reverse=True)
        rooms = []
        windows = packing._Windows(size)
        for n in lengths:
            fitting = [x for x in rooms if x >= n]
            assert windows.tightest(n) == (min(fitting) if fitting else None)
            windows.put((0, 0, n), n)
            if fitting:
                rooms.remove(min(fitting))
                rooms.append(min(fitting) - n)
            else:
                rooms.append(size - n)
            rooms = [x for x in rooms if x]


def test_best_fit_packs_whole_rests_where_they_fit():
    rows = [(i, 0, n, 0, n, [0] * 8) for i, n in enumerate([60, 50, 40, 30, 20])]
    found = sorted(sorted(p[2] for p in w) for w in packing._best_fit(iter(rows), 100, 0))
    assert found == [[20, 30, 50], [40, 60]]


def test_encoder_equals_the_library():
    encode = packing._encoder(open(PATH, encoding="utf-8").read())
    whole = known()
    r = random.Random(3)
    alphabet = "ab1 .'\t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u1680\u180e\u2000\u200a\u200b\u2028\u2029\u202f\u205f\u3000\ufeffé漢🎉"
    for _ in range(3000):
        t = "".join(r.choice(alphabet) for _ in range(r.randrange(12)))
        assert encode(t) == whole(t)[:-1].tobytes(), repr(t)


def test_long_text_is_encoded_in_parts():
    encode = packing._encoder(open(PATH, encoding="utf-8").read())
    t = prose(1, 30_000)
    assert len(t) > packing.AT_ONCE and encode(t) == known()(t)[:-1].tobytes()


def test_other_tokenizers_encode_whole_texts(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    got = packing.pieces(documents(spark, [(1, "Some words, twice.")], extra=False), path).collect()
    ids = np.array([*tokenizer.encode("Some words, twice.", add_special_tokens=False).ids, 1], "<u4")
    assert [(r.length, r.ids_crc32) for r in got] == [(len(ids), crc32(ids.tobytes()))]


def test_query(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    check(QUERIES["op12_best_fit"](spark, small).collect(), docs, 2048, 1 / 64)


def test_same_pieces_in_any_partitions(spark):
    docs = documents(spark, ROWS[:9], extra=False)
    a, b = (packing.pieces(docs.repartition(n), PATH) for n in (1, 5))
    assert rows_of(a) == rows_of(b)


def test_latin_words_are_split_without_the_library(monkeypatch):
    import tokenizers

    class Watched:
        """The library's tokenizer, and the short texts that its splitter is given."""

        given = []

        @classmethod
        def from_str(cls, definition):
            made = cls()
            made.model = Tokenizer.from_str(definition).model
            splitter = Tokenizer.from_str(definition).pre_tokenizer
            made.pre_tokenizer = made
            made.pre_tokenize_str = lambda text: cls.given.append(text) or splitter.pre_tokenize_str(text)
            return made

    monkeypatch.setattr(tokenizers, "Tokenizer", Watched)
    encode, whole = packing._encoder(open(PATH, encoding="utf-8").read()), known()
    r = random.Random(1)
    parts = [*"aéßĀɏɐÿ×÷ª² '1.\n\t\x1c\x7f日Ł\u01c1\xa0\xad", "'s", "'re", " Straße", "été,"]
    for _ in range(2000):
        t = "".join(r.choices(parts, k=r.randrange(1, 12)))
        assert encode(t) == whole(t)[:-1].tobytes(), repr(t)
    Watched.given.clear()
    encode(" Łódź, naïve Größe's (élan) 12 déjà-vu\n")
    assert not Watched.given


def test_texts_split_at_spaces_have_the_librarys_ids():
    # Spaces begin chunks in the first two; in the others, one that began before holds a space.
    with open(PATH, encoding="utf-8") as file:
        encode = packing._encoder(file.read())
    library = Tokenizer.from_file(PATH)
    texts = ["It's 5 words.\nÉté 'll don't", " a b\tc ", "a  b", "a\n b", "a \nb", "'s  's", " ", "", "a\r b\t c", "日 本 x"]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert encode(text) == b"".join(i.to_bytes(4, "little") for i in ids), text
    assert not any(w in t for w in packing._WIDER for t in texts[:2])


def test_new_words_of_texts_go_to_the_library_in_one_call(monkeypatch):
    given, one = [], packing._words_encoder
    monkeypatch.setattr(packing, "_words_encoder", lambda model: lambda words: given.append(words) or one(model)(words))
    with open(PATH, encoding="utf-8") as file:
        encode = packing._texts_encoder(file.read())
    library = known()
    texts = ["Some words, été twice", "", "some new words", " 日本 words\n", "words\0 twice", "twice  \xff \u0120a", " "]
    for _ in range(2):
        assert encode(texts) == [library(t)[:-1].tobytes() for t in texts]
    # One call for the texts that are split at spaces, one for each of the two others.
    assert len(given) == 3
    of_all = " ".join(given).split(" ")
    assert len(of_all) == len({*of_all})


def test_texts_encoded_together_have_the_librarys_ids(monkeypatch):
    with open(PATH, encoding="utf-8") as file:
        encode = packing._texts_encoder(file.read())
    library, r = known(), random.Random(5)
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    parts = [*"aéĠ漢🎉 '1.\n\t\r\0\x1c\xa0\xadÿ\u3000", "the ", " of", ", and ", "'s ", " ", " "]
    for n in [0, 1, *range(2, 60)]:
        texts = ["".join(r.choices(parts, k=r.randrange(30))) for _ in range(n)]
        assert encode(texts) == [library(t)[:-1].tobytes() for t in texts]
