"""Packing against the plain vocabulary and an exact round trip."""

from __future__ import annotations

from array import array

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wattline.llm.packing import encoder, pack, sequences

PLAIN = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def plain(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def fast(text):
    ids = array("H")
    ids.frombytes(encoder("byte_bpe_50k").ids(text))
    return list(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'st1 \n\t é漢.!\U0001f600")), max_size=40))
def test_words_one_by_one_give_the_ids_of_the_text(text):
    assert fast(text) == plain(text)


@pytest.mark.parametrize("text", ["", " ", "a", " a", "a ", "x<|endoftext|>y", "don't you'll", "a  b", "a\n b", "x" * 5000, "a b\r\n"])
def test_awkward_texts_give_the_ids_of_the_text(text):
    assert fast(text) == plain(text)


@pytest.mark.parametrize("text", [" " * 10**6, "\n" * 10**6, "a" + " \t" * 10**5 + "b c", "x" * 300_000])
def test_very_long_stretches_give_the_ids_of_the_text(text):
    assert fast(text) == plain(text)


@pytest.mark.parametrize("length", [16, 1024])
def test_pieces_and_sequences_hold_every_id_once(documents, length):
    pieces = pack(documents, length=length)
    rows = pieces.collect()
    wanted = sorted((r.doc_id is None, r.doc_id or 0, [*plain(r.text), 0]) for r in documents.select("doc_id", "text").collect())
    by_place, run = {r.sequence_id * length + r.offset: r for r in rows}, []
    assert len(by_place) == len(rows)
    found, held, at = [], [], 0
    for place in sorted(by_place):
        r = by_place[place]
        ids = array("I")
        ids.frombytes(bytes(r.ids))
        assert (place, r.length, r.start) == (at, len(ids), len(held))
        at += len(ids)
        held += ids
        run += ids
        if len(held) == r.doc_tokens:
            found.append((r.doc_id is None, r.doc_id or 0, held))
            held = []
    assert not held
    assert sorted(found) == wanted

    windows = {r.sequence_id: r for r in sequences(pieces, length).collect()}
    assert sorted(windows) == list(range(-(-len(run) // length)))
    whole = array("I")
    for sequence in sorted(windows):
        whole.frombytes(bytes(windows[sequence].ids))
        assert windows[sequence].n == min(length, len(run) - sequence * length)
    assert list(whole) == run


def test_an_empty_table_has_no_pieces(empty):
    assert pack(empty).count() == 0
    assert sequences(pack(empty)).count() == 0
