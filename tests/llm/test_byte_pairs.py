"""Chunks and stitches against the library on whole texts."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from monthspan.llm import byte_pairs
from tests.llm.data import ODD_TEXTS, docs, empty, n_odd, odd, table

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def encoder():
    return byte_pairs.Encoder(VOCABULARY)


def ids(blob):
    return np.frombuffer(blob, dtype="<u4").tolist()


@given(st.text(alphabet="aet 's've\n\t.,é日😀1²֋\U00011de1\x1c\x85　", max_size=60))
@settings(max_examples=400, deadline=None)
def test_ids_are_those_of_the_library(encoder, library, text):
    assert ids(encoder.encode([text])[0]) == library.encode_ordinary(text)
    assert encoder.decode(encoder.encode([text])[0]) == text.encode()


def test_characters_that_the_library_does_not_know_as_letters(encoder, library):
    late = list(map(chr, np.flatnonzero(encoder.late)))
    assert len(late) > 1000
    for i in range(0, len(late), 50):
        text = "a" + "b ".join(late[i : i + 50]) + "1"
        assert ids(encoder.encode([text])[0]) == library.encode_ordinary(text)


def random_texts(n):
    chance = random.Random(7)
    parts = ["a", "bc", "def", " ", "  ", "\n", " \n", "'", "'s", "'ll", "'re", "12", "...", "é", "日本", "😀", "֋"]
    texts = ["".join(chance.choices(parts, k=chance.randint(0, 60))) for _ in range(n)]
    long_words = ["x" * 40 + " y" * 9, " " * 50 + "a", "a" + " " * 33, "'re" * 20, "1" * 64, "ab" * 8 + "\n" * 21 + "c"]
    return texts + long_words


@pytest.mark.parametrize("chunk, overlap", [(8, 4), (11, 7), (16, 16), (30, 9)])
def test_stitched_chunks_give_the_ids_of_the_whole(spark, library, chunk, overlap):
    texts = random_texts(400)
    rows = byte_pairs.encode(docs(spark, texts), VOCABULARY, chunk=chunk, overlap=overlap).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    for row in rows:
        text = texts[row["doc_id"]]
        assert ids(row["ids"]) == library.encode_ordinary(text), text
        assert row["n_tokens"] == len(row["ids"]) // 4
        assert bytes(row["decoded"]) == text.encode()


def test_chunks_without_a_common_border_go_together(spark):
    long = docs(spark, ["a " * 10 + "x" * 60 + " b" * 20])
    long = byte_pairs.whole_texts(long)
    chunks = byte_pairs.chunked(long, 16, 8)
    cut = chunks.mapInArrow(lambda b: byte_pairs._cut(b, VOCABULARY, 16, 8), byte_pairs._CUT)
    sizes = [r["size"] for r in byte_pairs.stitches(cut, 16).orderBy("chunk").collect()]
    assert max(sizes) > 1 and sizes[0] == 1 and sizes[-1] == 1


def test_documents(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, "documents").collect()}
    rows = byte_pairs.digests(table(spark, "documents"), VOCABULARY, chunk=2000, overlap=200).collect()
    assert len(rows) == len(texts)
    for row in rows:
        found = library.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(found)
        assert row["ids_sha256"] == hashlib.sha256(np.array(found, dtype="<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_odd_tables(spark, library):
    rows = byte_pairs.encode(odd(spark), VOCABULARY).collect()
    assert len(rows) == n_odd()
    for row in rows:
        if row["doc_id"] is not None:
            text = ODD_TEXTS[row["doc_id"]] or ""
            assert ids(row["ids"]) == library.encode_ordinary(text)
            assert bytes(row["decoded"]) == text.encode()
    assert byte_pairs.encode(empty(spark), VOCABULARY).collect() == []


def test_an_overlap_has_room(spark):
    with pytest.raises(ValueError, match="overlap"):
        byte_pairs.encode(empty(spark), VOCABULARY, chunk=100, overlap=2)
