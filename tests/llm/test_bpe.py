"""BPE with forced boundaries against the library on whole texts."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from attrition.llm import bpe
from attrition.llm.common import read

SMALL = "/root/testdata/sf0.001"
ODD = [
    None, "", " \t\n", "\x85\xa0", "a\x85b\xa0c \x1c\x1d d\x1f", "<|endoftext|>", "a<|startoftext|>b <|endoftext|>C", "<|endoftext|",
    "İIΣσς ŸKÅ", "é ́é", "x" * 70_000, "日本語" * 3000, "don't DON'T it'S'll''ve 'tis'there rock'n'roll", "Ⅷ½²٣9 10",
    "👍🏽👨‍👩‍👧", "﻿​", "\x00a\x00", "a.b,c;d" * 500, "ÀÉß×÷µª",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(bpe.tokenizer_path())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def random_texts(n: int) -> list[str]:
    rng = random.Random(11)
    latin = "aAbB'stve''dlmr \n\t.,!éÉ½²0123\xa0\x85\x1cßªµÀ×÷"
    wide = latin + "İ日本👍‍Σς́<|>"
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(1, 60))) for a in (latin, wide) for _ in range(n)]
    return texts + ["".join(chr(rng.choice([rng.randint(1, 0x36F), rng.randint(1, 0xD7FF), rng.randint(0x10000, 0x1FFFF)])) for _ in range(40)) for _ in range(n)]


def test_fragments_give_the_ids_of_whole_texts(library):
    codec = bpe.Codec(bpe.tokenizer_path())
    texts, back = ODD + random_texts(2000), bpe.Decoder(bpe.tokenizer_path())
    for text, got in zip(texts, codec.encode(texts)):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(got, "<u4").tolist() == want, repr(text)[:200]
        assert back.decode(got) == library.decode(want, skip_special_tokens=False)
    assert codec.latin


def test_no_token_crosses_a_cut():
    codec = bpe.Codec(bpe.tokenizer_path())
    for token in codec.library.get_vocab():
        if token.endswith(codec.suffix) and token != codec.suffix:
            texts, each = codec.fragments([token.removesuffix(codec.suffix)])
            assert texts == [token.removesuffix(codec.suffix) + " "] and each.tolist() == [1]
    assert codec.fragments(["ab", "", "c"])[1].tolist()[1] == 0
    assert len(codec.fragments(["qzx" * 50])[0]) > 1


def test_what_is_remembered_changes_nothing(monkeypatch):
    texts = random_texts(600)
    want = bpe.Codec(bpe.tokenizer_path()).encode(texts)
    monkeypatch.setattr(bpe, "KEPT", 40)
    small = bpe.Codec(bpe.tokenizer_path())
    assert [i for n in range(0, len(texts), 50) for i in small.encode(texts[n : n + 50])] == want
    assert len(small.of_latin.strings) <= 40 and len(small.of_pieces.strings) <= 40


def test_special_tokens_as_text():
    plain = bpe.Codec(bpe.tokenizer_path(), special=False)
    library = Tokenizer.from_file(bpe.tokenizer_path())
    library.encode_special_tokens = True
    text = "one<|endoftext|>Two"
    assert np.frombuffer(plain.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_another_tokenizer():
    path = public_tokenizers.path("byte_bpe_50k.json")
    codec, library = bpe.Codec(path), Tokenizer.from_file(path)
    assert not codec.latin and not codec.suffix
    texts = ["hello", "internationalization", "x1y2z3", "日本語", "...", " two  words \n x", "don't  "]
    for text, got in zip(texts, codec.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(got, "<u4").tolist() == want
        assert bpe.Decoder(path).decode(got) == library.decode(want, skip_special_tokens=False)


def test_query_equals_the_library(spark, library):
    rows = {r.doc_id: r for r in bpe.op13_bpe(spark, SMALL).collect()}
    docs = read(spark, SMALL, "documents").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        ids = library.encode(doc.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        row = rows[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_rows_keys_and_clashing_names(spark):
    rows = [(None, t, 1, "x") for t in ODD[:4]] + [(5, "Same text", 2, "y")] * 3 + [(2**62 + 1, "big key", 2, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, _IDS string")
    out = bpe.encoded(df)
    assert sorted(out.columns) == sorted(df.columns) and dict(out.dtypes)["ids"] == "binary"
    back = bpe.decoded(out, text="_text")
    assert [r["_text"] for r in back.where("doc_id = 5").collect()] == ["same</w> text</w>"] * 3
    assert back.count() == len(rows) and bpe.decoded(bpe.encoded(df.limit(0))).count() == 0
    both = bpe.round_trip(df).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in both) == sorted((str(r.doc_id), r["_text"]) for r in back.collect())
    assert 2**62 + 1 in {r.doc_id for r in both}
    assert bpe.round_trip(df.limit(0)).count() == 0
    wrong = spark.createDataFrame([(b"\xff\xff\xff\x7f",)], "ids binary")
    with pytest.raises(Exception, match="no id"):
        bpe.decoded(wrong).select(F.length("decoded")).collect()
