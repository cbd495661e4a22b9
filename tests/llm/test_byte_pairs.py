import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from fixtures import documents

from topiclens.llm import byte_pairs

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def known():
    ranks = byte_pairs.read_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


PIECES = ["a", "b", " ", "  ", "\n", " \n", "\t", "é", "ß", "日", "🙂", "\x1c", "\x85", "　", "'s", "'T", "1", "½",
          "٣", "--", "##", "́", "the", "ing", "\x00", "​", "\r\n", "ſ", "İ", "<|endoftext|>"]


def test_same_ids_as_the_library(spark, known):
    r = random.Random(1)
    texts = ["".join(r.choice(PIECES) for _ in range(r.randint(0, 60))) for _ in range(800)]
    texts += [None, "", " ", "a" * 3000, "ab" * 500, " " * 777 + "x", "-" * 1001, "aaab" * 300 + "b",
              "".join(r.choice("abcdefghij") for _ in range(1200)), "word " * 50_000]
    docs = documents(spark, list(enumerate(texts)))
    out = {x.doc_id: x for x in byte_pairs.encoded(docs, PATH, public_tokenizers.PATTERN).collect()}
    sums = {x.doc_id: x for x in byte_pairs.encoded(docs, PATH, public_tokenizers.PATTERN, digests=True).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for i, text in enumerate(texts):
        ids = known.encode_ordinary(text or "")
        assert out[i].ids == ids and out[i].decoded == (text or ""), text
        assert sums[i].n_tokens == len(ids)
        assert sums[i].ids_sha256 == sha(" ".join(map(str, ids)).encode())
        assert sums[i].decoded_sha256 == sha((text or "").encode())


def test_repeated_rows_and_empty_table(spark):
    docs = documents(spark, [(1, "a b"), (1, "a b"), (None, "c")])
    out = byte_pairs.encoded(docs, PATH, public_tokenizers.PATTERN, digests=True)
    assert sorted(r.n_tokens for r in out.collect()) == [1, 2, 2]
    assert byte_pairs.encoded(documents(spark, []), PATH, public_tokenizers.PATTERN).collect() == []


def test_words_are_forgotten_when_there_are_many(known, monkeypatch):
    monkeypatch.setattr(byte_pairs, "REMEMBERED", 3)
    encode = byte_pairs._text_encoder(byte_pairs.read_ranks(PATH), public_tokenizers.PATTERN)
    for text in ["some words here", "other words there", "some words here"]:
        assert encode([text])[0][1] == " ".join(map(str, known.encode_ordinary(text)))
