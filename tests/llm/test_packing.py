"""Packing against the library's ids of whole texts."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from monthspan.llm import packing
from tests.llm.data import ODD_TEXTS, docs, empty, n_odd, odd, table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def words():
    return packing.WordIds(VOCABULARY)


def plain(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


@given(st.text(alphabet="aeTß \n.,!'é日😀1_́İΣ|sक़ ", max_size=60))
@settings(max_examples=300, deadline=None)
def test_words_give_the_ids_of_the_whole_text(library, words, text):
    ids = np.frombuffer(words.encode([text])[0], dtype="<u4").tolist()
    assert ids == library.encode(text, add_special_tokens=False).ids


@given(st.integers(1, 10_000))
def test_pieces_are_powers_of_two_in_falling_order(n):
    found = list(packing.pieces(n, 2048))
    lengths = [length for _, length in found]
    assert sum(lengths) == n and lengths == sorted(lengths, reverse=True)
    assert all(length & (length - 1) == 0 and length <= 2048 for length in lengths)
    rest = [length for length in lengths if length < 2048]
    assert len(rest) == len(set(rest))


def test_every_id_lies_in_one_piece(spark, library):
    rows = packing.pack(table(spark, "documents"), VOCABULARY).collect()
    texts = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    for doc_id, text in texts.items():
        own = sorted((r for r in rows if r["doc_id"] == doc_id), key=lambda r: r["start"])
        ids = np.frombuffer(b"".join(r["ids"] for r in own), dtype="<u4").tolist()
        assert ids == plain(library, text)
        assert all(r["doc_tokens"] == len(ids) and r["offset"] == 0 for r in own)
        assert all(r["ids_crc32"] == zlib.crc32(r["ids"]) and r["length"] == 1 << r["bucket"] for r in own)


def test_odd_tables(spark, library):
    rows = packing.pack(odd(spark), VOCABULARY).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 5) == 3 * len(plain(library, ODD_TEXTS[5]))
    assert [(r["length"], r["ids"]) for r in rows if r["doc_id"] == 0] == [(1, b"\x01\0\0\0")]
    for i, text in enumerate(ODD_TEXTS):
        assert next(r["doc_tokens"] for r in rows if r["doc_id"] == i) == len(plain(library, text))
    assert {r["doc_id"] for r in rows} == {*range(n_odd() - 4), None}
    assert packing.pack(empty(spark), VOCABULARY).collect() == []


def test_buckets_hold_one_length(spark, tmp_path):
    packed = packing.pack(docs(spark, ["a b c", "d e"]), VOCABULARY)
    packing.write_buckets(packed, str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").glob("bucket=*")} == {"bucket=0", "bucket=1", "bucket=2"}


def test_the_longest_piece_is_a_power_of_two(spark):
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(empty(spark), VOCABULARY, longest=1000)
