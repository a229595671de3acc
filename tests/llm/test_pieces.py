"""The agenda against the library, on whole texts."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from monthspan.llm import pieces
from tests.llm.data import ODD_TEXTS, empty, n_odd, odd, table

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(VOCABULARY)


def library(encoder, text):
    return encoder.vocabulary.library.encode(text or "", add_bos=True, add_eos=True)


@given(st.text(alphabet="aet \n▁.,é日😀1_'́İ²", max_size=80))
@settings(max_examples=300, deadline=None)
def test_ids_are_those_of_the_library(encoder, text):
    assert np.frombuffer(encoder.encode([text])[0], dtype="<u4").tolist() == library(encoder, text)


@given(st.text(alphabet="aetinors▁.1", min_size=1, max_size=60))
@settings(max_examples=200, deadline=None)
def test_both_kinds_of_agenda_agree(encoder, segment):
    assert encoder.vocabulary._short(segment) == encoder.vocabulary._long(segment)


def test_cuts_are_only_made_where_no_piece_lies_across(encoder):
    vocabulary = encoder.vocabulary
    assert vocabulary.segments("The cat, sat.\nOn") == ["▁The", "▁cat", ",", "▁sat", ".", "\n", "On"]
    vocabulary.ids["a.b"] = 0
    assert not vocabulary._whole(vocabulary.cut)
    del vocabulary.ids["a.b"]


def test_a_disagreement_is_an_error(encoder):
    with pytest.raises(ValueError, match="different ids"):
        encoder.vocabulary.check(["▁cat"], [[1]])


def test_documents(spark, encoder):
    texts = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    for row in pieces.digests(table(spark, "documents"), VOCABULARY).collect():
        ids = library(encoder, texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        decoded = encoder.vocabulary.library.decode(ids)
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_odd_tables(spark, encoder):
    rows = pieces.encode(odd(spark), VOCABULARY).collect()
    assert len(rows) == n_odd()
    for row in rows:
        if row["doc_id"] is not None:
            ids = library(encoder, ODD_TEXTS[row["doc_id"]])
            assert np.frombuffer(row["ids"], dtype="<u4").tolist() == ids
            assert row["decoded"] == encoder.vocabulary.library.decode(ids)
    assert pieces.encode(empty(spark), VOCABULARY).collect() == []
