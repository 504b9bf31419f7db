"""Token counts, and pieces both ways, against the vocabularies' own libraries."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tests.llm.conftest import SMALL
from tradewind.llm import sentencepiece_fst, token_counts

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

ODD = [
    "", " ", "\n\n", "a  b", "İstanbul ΣΑΣ Σ naïve café", "日本語テキスト 中文 한국어", "x²½ '’s I'll IT'S ''s 'S", "😀 a😀b​",
    "<|startoftext|>a<|endoftext|> <|endoftext|", "\x1c\x85   ①Ⅷ \x00", "ǅ Ⱥ ß ſ K", "é ́", "<s> <unk> <0x0A>", "▁a ▁▁",
    "ab" * 500, " " * 300, "a" * 3000, "tab\tnew\nline", "1234567890 12.5e-3",
]


@pytest.fixture(scope="module")
def counter():
    return token_counts.counter(WORDS), Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def machine():
    return sentencepiece_fst.transducer(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)


def count(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_count_as_the_library_does(counter, text):
    assert counter[0](text) == count(counter[1], text)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.text("abcABC'st ré12.,;\n<|endof>", max_size=60)))
def test_any_text_counts_as_the_library_does(counter, text):
    assert counter[0](text) == count(counter[1], text)


def test_forgetting_changes_nothing(counter, monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    fresh = token_counts.Counter(WORDS)
    text = " ".join(f"zq{i}xj" for i in range(200))
    assert fresh(text) == fresh(text) == count(counter[1], text)


def test_count_query_equals_the_library(spark, counter):
    got = {r.doc_id: r for r in entry.queries()["op7_token_counts"](spark, SMALL).collect()}
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        n = count(counter[1], r.text or "")
        assert tuple(got[r.doc_id]) == (r.doc_id, len((r.text or "").encode()), n, n > 2048)


def test_counts_of_awkward_rows(awkward, nothing, counter):
    got = token_counts.token_counts(awkward, WORDS).collect()
    want = [(r.doc_id, len((r.text or "").encode()), count(counter[1], r.text or "")) for r in awkward.collect()]
    assert sorted(map(str, (tuple(r)[:3] for r in got))) == sorted(map(str, want))
    assert token_counts.token_counts(nothing, WORDS).collect() == []


def ids(machine, text):
    return np.frombuffer(machine.encode(text), np.int32).tolist()


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_encode_as_the_library_does(machine, text):
    assert ids(machine[0], text) == machine[1].encode(text)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.text("abcdehilnorst  ▁\n.é日", max_size=80)))
def test_any_text_encodes_and_decodes(machine, text):
    found = ids(machine[0], text)
    assert found == machine[1].encode(text)
    assert machine[0].decode(found) == text.replace("▁", " ")


def test_any_ids_decode_as_the_library_does(machine):
    rnd = random.Random(1)
    for low, high in ((0, 32000), (3, 259), (0, 700)):
        for _ in range(100):
            some = [rnd.randrange(low, high) for _ in range(rnd.randrange(30))]
            assert machine[0].decode(some) == machine[1].decode(some)


def test_an_arc_is_open_iff_merging_keeps_it(machine):
    fst = machine[0]
    assert fst.merge("▁the") == ["▁the"] and fst.path("▁the") == ["▁the"]
    assert not fst._open("▁t", "he") and fst._open("▁the", "▁the")


def test_a_word_is_worked_out_once_whatever_sign_follows(machine):
    fresh = sentencepiece_fst.Transducer(PIECES)
    text = "zqxj, zqxj. zqxj"
    assert ids(fresh, text) == machine[1].encode(text)
    assert list(fresh.known) == ["▁zqxj", ",", "."]


def test_letters_beside_signs_encode_as_the_library_does(machine, monkeypatch):
    monkeypatch.setattr(sentencepiece_fst, "REMEMBERED", 50)
    rnd, some = random.Random(2), ["ab", "é", "日", "”", ",", ".", "...", "12", "-", "_", "'s", "½", "😀", " ", "  ", "\n", "▁", "²"]
    fresh = sentencepiece_fst.Transducer(PIECES)
    for _ in range(500):
        text = "".join(rnd.choices(some, k=rnd.randrange(12)))
        assert ids(fresh, text) == machine[1].encode(text), text


def test_piece_query_equals_the_library(spark, machine):
    got = {r.doc_id: r for r in entry.queries()["op8_pieces"](spark, SMALL).collect()}
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        assert got[r.doc_id].piece_ids == machine[1].encode(r.text or "") and got[r.doc_id].lossless
        assert got[r.doc_id].n_pieces == len(got[r.doc_id].piece_ids)


def test_pieces_of_awkward_rows_and_back(awkward, nothing):
    pieces = sentencepiece_fst.encode(awkward, PIECES)
    assert set(pieces.columns) == set(awkward.columns) - {"text"} | {"piece_ids", "n_pieces", "lossless"}
    back = sentencepiece_fst.decode(pieces, PIECES)
    assert sorted(str((r.doc_id, r.text)) for r in back.collect()) == sorted(str((r.doc_id, r.text or "")) for r in awkward.collect())
    assert sentencepiece_fst.encode(nothing, PIECES).collect() == []
