import random

import numpy as np
import pyarrow as pa
import pytest

from attrition.llm import token_files

ODDITIES = [
    " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", " ", "　", " ", " ",
    "'", "'s", "'re", "'ll", "'ve", "don't", "we'LL", "a", "Zz", "é", "É", "×", "÷", "ß", "ÿ", "1", "42", "²", "½", "٣", "%", "&*",
    ".", ",", "…", "—", "’s", "中文", "かな", "слово", "ਅ", "́", "😀", "<|endoftext|>", "\x00", "\x7f", "the", "ing", "http://", "_",
]


@pytest.fixture(scope="module")
def path():
    return token_files.tokenizer_path()


def whole(path, texts):
    tokenizer = token_files._tokenizer(path)
    return [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_pieces_give_the_ids_of_whole_texts(path, monkeypatch):
    rng = random.Random(3)
    texts = ["", *ODDITIES, *(a + b for a in ODDITIES for b in ODDITIES)]
    texts += ["".join(rng.choices(ODDITIES, k=rng.randint(3, 40))) for _ in range(3000)]
    assert token_files.Encoder(path).of_all(texts) == whole(path, texts)
    monkeypatch.setattr(token_files, "KEPT", 50)
    encoder = token_files.Encoder(path)
    found = [encoder.of_array(pa.array(texts[i : i + 100]).slice(1)) for i in range(0, len(texts), 100)]
    assert sum(found, []) == [ids for i, ids in enumerate(whole(path, texts)) if i % 100]


def test_runs_of_signs_share_their_pieces(path):
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("%&*!$|", k=8)) for _ in range(50)) for _ in range(80)]
    encoder = token_files.Encoder(path)
    assert encoder.of_all(texts) == whole(path, texts)
    assert len(encoder.known) < 400  # of some 4,000 different runs


def test_what_occurs_in_most_texts_is_remembered(path, monkeypatch):
    monkeypatch.setattr(token_files, "KEPT", 100)
    encoder = token_files.Encoder(path)
    asked = []
    encoded = encoder._encoded
    monkeypatch.setattr(encoder, "_encoded", lambda pieces: asked.extend(pieces) or encoded(pieces))
    often = " ".join(f"often{c}" for c in "abcdefghij")
    letters = "abcdefghijklmnopqrst"
    for i in range(20):
        encoder.of_all([often] if i % 2 else [" ".join(f"x{letters[i]}{a}{b}" for a in "abcde" for b in "fghij")])
    assert asked.count(b" oftenb") == 1


def test_a_tokenizer_that_splits_otherwise_gets_whole_texts(path, tmp_path):
    import json

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    spec["pre_tokenizer"]["use_regex"] = False
    other = tmp_path / "other.json"
    other.write_text(json.dumps(spec))
    texts = ["", "one two  three", "in the\n\nend. 12%"]
    assert token_files.Encoder(str(other)).of_all(texts) == whole(str(other), texts)
