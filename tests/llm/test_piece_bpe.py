"""Sentence-piece encoding against the library and against plain merging."""

import random

import public_tokenizers
import pytest
import sentencepiece

from __spark_entry__ import queries
from tillroll.llm import piece_bpe
from tillroll.llm.common import Kept
from tillroll.llm.queries import PIECES

PATH = public_tokenizers.path(PIECES)
ODD = [
    "", " ", "  ", " a  b ", "a\tb\nc", "▁x", "▁▁ ▁", "a\0b", "ﬁ ½ é é", "日本語テキスト", "😀 ok​",
    " " * 37 + "x", "the the", "͸ unassigned", "x" * 500, "aaaaaaa" * 9, "﻿a　b",
]


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as file:
        return piece_bpe.PieceBpe(file.read())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_odd_texts(model, library):
    for text in ODD:
        ids = library.encode(text, add_eos=True)
        assert model.encode(text).tolist() == ids, text
        assert model.decode(model.encode(text)) == library.decode(ids), text


def test_random_texts(model, library):
    rng = random.Random(3)
    kinds = ["ab cde", "▁ a\n\t", "".join(map(chr, range(32, 591))), "".join(map(chr, range(0x900, 0x3100)))]
    for _ in range(3000):
        letters = rng.choice(kinds)
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 50)))
        assert model.encode(text).tolist() == library.encode(text, add_eos=True)


def test_backtracking_equals_plain_merging(model):
    rng = random.Random(4)
    for _ in range(500):
        chunk = "".join(rng.choice("▁aeinorst") for _ in range(rng.randint(1, 24)))
        assert [model.pieces[i] for i in model.split(chunk)] == model.merged(chunk)


def test_blocks_and_a_cache_that_turns_over(model, library, monkeypatch):
    monkeypatch.setattr(piece_bpe, "BLOCK", 7)
    monkeypatch.setattr(model, "known", Kept(3))
    monkeypatch.setattr(model, "pairs", Kept(2))
    text = "one two  three four\nfive six seven   eight nine ten one two"
    assert model.encode(text).tolist() == library.encode(text, add_eos=True)
    assert len(model.known.young) <= 3 and len(model.known.old) <= 3


def test_other_models_are_refused():
    with pytest.raises(ValueError, match="merge model"):
        piece_bpe.PieceBpe(b"")


def test_rows(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, None, None), (2, "", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    made = piece_bpe.encode(docs, PATH).collect()
    assert sorted((r.doc_id or 0, list(r.ids), r.decoded) for r in made) == [
        (0, [2], ""), (1, [264, 287, 2], "a b"), (1, [264, 287, 2], "a b"), (2, [2], ""),
    ]
    assert piece_bpe.digests(docs.limit(0), PATH).collect() == []
    assert piece_bpe.digests(docs, PATH).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_query_equals_the_library(spark, sf_dir, library):
    from hashlib import sha256

    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    for row in queries()["op12_sentencepiece"](spark, sf_dir).collect():
        ids = library.encode(texts[row.doc_id] or "", add_eos=True)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == sha256(library.decode(ids).encode()).hexdigest()
