"""BPE encoding and decoding with forced boundaries.

A merge joins two neighbouring symbols to a token of the vocabulary. Two neighbouring bytes that stand
side by side inside no token are therefore never joined, whatever surrounds them: between them lies a
certain cut. The tables of such pairs are read off the vocabulary once, one for the inside of words and
one for a word's last two bytes, whose second carries the mark of the word's end. Words are cut there, each
fragment is merged on its own, and the ids of the fragments are put together. Fragments are short,
however long a word is, and few of them are distinct.

Each distinct fragment goes through the merges once and is remembered by the Python worker, at most
``KEPT`` of them, as arrays. Texts of Latin-1 characters, which are their own normal form, are
split into words and cut by array operations over millions of characters, if the tokenizer splits by ``WORDS``.
Other texts, and all texts of other tokenizers, go through the tokenizer's own normalizer and splitting;
if that drops white space, they are cut at spaces and line ends, which no normal form reaches across, and each distinct
piece goes through it once.
The work is one pass over the rows without a shuffle, so no key and no source can be a hot spot, and a
task that is lost is done again from its input.

Decoding looks the ids up in the table of tokens, and puts together what the tokenizer's own decoder would.

Cases: null and empty texts, and texts of white space alone, have no ids and decode to empty text;
the strings of special tokens in a text are those tokens, as in the library, unless ``special=False``;
repeated rows, null keys and further columns stay as they are; an empty table gives an empty result.
Ids beyond the vocabulary raise an error in ``decoded``.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.llm.common import fresh, give_back, read, without

KEPT = 400_000
#: Characters that are encoded together; a longer text is a part of its own.
TOGETHER = 1_000_000
CUT = re.compile("[^ \n]+")
#: The preparation of texts that the array operations stand for.
NORMAL = ["NFC", "Replace", "Lowercase"]
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LETTER, NUMBER, SPACE, OTHER = range(4)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def inner_pairs(tokens, suffix: str) -> tuple[np.ndarray, np.ndarray]:
    """Two tables over pairs of symbols, given by code point: which pairs stand side by side inside a token, and
    which do so as the last two of a token that ends a word."""
    n = 1 + max((ord(c) for t in tokens for c in t), default=0)
    inside, last = np.zeros((n, n), bool), np.zeros((n, n), bool)
    for token in tokens:
        ends = bool(suffix) and token.endswith(suffix) and token != suffix
        symbols = token[: -len(suffix)] if ends else token
        for i, (a, b) in enumerate(pairwise(symbols)):
            (last if ends and i == len(symbols) - 2 else inside)[ord(a), ord(b)] = True
    return inside, last if suffix else inside


class Known:
    """Arrays of ids by string. What is remembered are at most ``KEPT`` strings, or the last ones."""

    def __init__(self, ids_of, kind: pa.DataType) -> None:
        self.ids_of = ids_of
        self._keep(pa.array([], kind), np.zeros(0, "<u4"), np.zeros(0, np.int64))

    def _keep(self, strings: pa.Array, pool: np.ndarray, sizes: np.ndarray) -> None:
        self.strings, self.pool, self.sizes = strings, pool, sizes
        self.starts = np.cumsum(sizes) - sizes

    def __call__(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all strings, one after another, and how many each has."""
        coded = strings.dictionary_encode()
        found = pc.index_in(coded.dictionary, value_set=self.strings)
        new = coded.dictionary.filter(found.is_null())
        if len(new):
            pool, sizes = self.ids_of(new)
            known = pa.concat_arrays([self.strings, new])
            self._keep(known, np.concatenate([self.pool, pool]), np.concatenate([self.sizes, sizes]))
            found = pc.index_in(coded.dictionary, value_set=known)
        at = found.to_numpy()[coded.indices.to_numpy()]
        ids, sizes = copied(self.pool, self.starts[at], self.sizes[at]), self.sizes[at]
        if len(self.strings) > KEPT:
            last = np.unique(at)
            last = last if len(last) <= KEPT else last[:0]
            kept = copied(self.pool, self.starts[last], self.sizes[last])
            self._keep(self.strings.take(pa.array(last)), kept, self.sizes[last])
        return ids, sizes


def copied(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of ``pool``, one after another."""
    ends = np.cumsum(sizes)
    return pool[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


class Codec:
    """One tokenizer file, for texts of all lengths."""

    def __init__(self, path: str, special: bool = True) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        vocabulary = spec["model"]["vocab"]
        self.inside, self.last = inner_pairs(vocabulary, self.suffix)
        self.library = Tokenizer.from_file(path)
        bare = spec | {"normalizer": None, "pre_tokenizer": None, "added_tokens": [], "truncation": None, "padding": None}
        inner = bare | {"model": spec["model"] | {"end_of_word_suffix": None}}
        #: The merges alone: of fragments that end a word, and of others.
        self.ending, self.inner = (Tokenizer.from_str(json.dumps(s)) for s in (bare, inner))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]} if special else {}
        self.apart = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.spaces_go = not self._words(" \n")
        self.of_fragments = Known(self._merged, pa.large_string())
        self.of_pieces = Known(self._pieces, pa.large_string())
        self.latin = _splits_alike(spec) and self._latin_tables()
        self.of_latin = Known(self._latin_merged, pa.large_binary())

    def _merged(self, fragments: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Fragments that end a word carry a space at their end, which no symbol is."""
        texts = fragments.to_pylist()
        out: list = [None] * len(texts)
        for model, ends in ((self.ending, True), (self.inner, False)):
            own = [i for i, t in enumerate(texts) if t.endswith(" ") == ends]
            found = model.encode_batch_fast([texts[i].rstrip(" ") for i in own], add_special_tokens=False)
            for i, e in zip(own, found):
                out[i] = e.ids
        return np.fromiter(chain.from_iterable(out), "<u4"), np.fromiter(map(len, out), np.int64, len(out))

    def fragments(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """What the words, in symbols, fall into at the certain cuts, and how many fragments each has."""
        joined = "".join(words)
        if not joined:
            return [], np.zeros(len(words), np.int64)
        code = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        ends = np.cumsum([len(w) for w in words])
        final = np.zeros(len(code) + 1, bool)
        final[ends] = True
        known = np.minimum(code, len(self.inside) - 1)
        a, b = known[:-1], known[1:]
        whole = np.where(final[2:], self.last[a, b], self.inside[a, b])
        strange = code >= len(self.inside)
        whole &= ~(strange[:-1] | strange[1:])
        cut = np.r_[True, final[1:-1] | ~whole, True]
        at = np.flatnonzero(cut)
        texts = [joined[i:j] + " " * e for i, j, e in zip(at[:-1].tolist(), at[1:].tolist(), final[at[1:]].tolist())]
        each = np.searchsorted(at, ends) - np.searchsorted(at, np.r_[0, ends[:-1]])
        return texts, each

    def _words(self, piece: str) -> list[str]:
        normal = self.library.normalizer.normalize_str(piece) if self.library.normalizer else piece
        split = self.library.pre_tokenizer
        return [w for w, _ in split.pre_tokenize_str(normal)] if split else [normal]

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words: list[str] = []
        parts: list[tuple[int, int]] = []  # what a piece has: words, or a special id
        owner: list[int] = []
        for i, piece in enumerate(pieces.to_pylist()):
            for part in self.apart.split(piece) if self.apart and "<" in piece else (piece,):
                if part in self.special:
                    parts.append((0, self.special[part]))
                    owner.append(i)
                elif part:
                    found = self._words(part)
                    words += found
                    parts.append((len(found), -1))
                    owner.append(i)
        texts, each = self.fragments(words)
        ids, sizes = self.of_fragments(pa.array(texts, pa.large_string()))
        ends = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(each)]]  # after each word
        n_words = np.array([n for n, _ in parts], np.int64)
        after = ends[np.r_[0, np.cumsum(n_words)]] if len(parts) else np.zeros(1, np.int64)
        length = np.diff(after)
        singles = np.array([s for _, s in parts], np.int64)
        marked = np.flatnonzero(singles >= 0)
        ids = np.insert(ids, after[marked], singles[marked].astype("<u4")) if len(marked) else ids
        length[marked] = 1
        return ids.astype("<u4"), np.bincount(np.array(owner, np.int64), length, len(pieces)).astype(np.int64)

    def _latin_tables(self) -> bool:
        """The class of each Latin-1 character, its symbols, and the pairs of characters that tokens hold."""
        symbols = [self.library.pre_tokenizer.pre_tokenize_str(chr(c)) for c in range(256)]
        self.kind = np.full(256, OTHER, np.uint8)
        for c in range(256):
            if not symbols[c]:
                self.kind[c] = SPACE
            elif len(self._words("a" + chr(c).lower())) == 1:
                self.kind[c] = LETTER
            elif len(self._words(chr(c) * 2)) == 2:
                self.kind[c] = NUMBER
        self.symbols = {c: found[0][0] if found else " " for c, found in enumerate(symbols)}
        first = np.minimum([ord(self.symbols[c][0]) for c in range(256)], len(self.inside) - 1)
        last = np.minimum([ord(self.symbols[c][-1]) for c in range(256)], len(self.inside) - 1)
        one = np.array([len(self.symbols[c]) == 1 for c in range(256)])
        inner, ending = self.inside[np.ix_(last, first)], self.last[np.ix_(last, first)]
        #: By left and right character: the right one inside a word, and as its end.
        self.joined = np.stack([inner, np.where(one[None, :], ending, inner)])
        return True

    def _latin_merged(self, fragments: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = [f.decode("latin-1").translate(self.symbols) for f in fragments.to_pylist()]
        return self._merged(pa.array(texts, pa.large_string()))

    def _latin_ids(self, texts: list[bytes]) -> list[bytes]:
        """The ids of texts in lower case and Latin-1."""
        code = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        kind = self.kind[code]
        start = np.r_[True, (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)] if len(code) else np.zeros(0, bool)
        self._contractions(code, kind, start)
        keep = np.flatnonzero(kind != SPACE)
        if not len(keep):
            return [b""] * len(texts)
        # From here on without white space.
        code, start = code[keep], start[keep] | np.r_[True, np.diff(keep) != 1]
        ends = np.r_[start[1:], True]
        whole = self.joined[ends[1:].astype(np.intp), code[:-1], code[1:]]
        begin = np.flatnonzero(np.r_[True, start[1:] | ~whole])
        place = np.arange(len(code)) + np.cumsum(ends) - ends  # with a space after each word
        data = np.full(len(code) + int(ends.sum()), ord(" "), np.uint8)
        data[place] = code
        offsets = np.r_[place[begin], len(data)].astype(np.int64)
        fragments = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        )
        ids, sizes = self.of_latin(fragments)
        last = np.cumsum([len(t) + 1 for t in texts])
        after = np.searchsorted(keep[begin], last)
        at = np.r_[0, np.r_[0, np.cumsum(sizes)][after]] * 4
        raw = ids.tobytes()
        return [raw[i:j] for i, j in pairwise(at.tolist())]

    @staticmethod
    def _contractions(code: np.ndarray, kind: np.ndarray, start: np.ndarray) -> None:
        """A quotation mark that begins a word takes the letters of a contraction along."""
        padded = np.r_[code, np.zeros(3, np.uint8)]
        at = np.flatnonzero((code == ord("'")) & np.r_[True, kind[:-1] != OTHER])
        one, two = padded[at + 1], padded[at + 2]
        short = np.isin(one, list(b"stmd"))
        long = np.isin(one, list(b"rv")) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        start[at[short | long] + 1] = False
        after = np.r_[at[short] + 2, at[long] + 3]
        start[after[after < len(start)]] = True

    def _pieced_ids(self, texts: list[str]) -> list[bytes]:
        """The ids of any texts."""
        cut = [CUT.findall(t) if self.spaces_go else [t] * bool(t) for t in texts]
        ids, sizes = self.of_pieces(pa.array(chain.from_iterable(cut), pa.large_string()))
        ends = np.r_[0, np.cumsum(sizes)][np.cumsum([0, *map(len, cut)])] * 4
        raw = ids.tobytes()
        return [raw[i:j] for i, j in pairwise(ends.tolist())]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        plain: dict[int, bytes] = {}
        others: dict[int, str] = {}
        for i, text in enumerate(texts):
            text = text or ""
            if self.latin and _is_latin(text) and not any(s in text for s in self.special):
                plain[i] = text.lower().encode("latin-1")
            else:
                others[i] = text
        found = dict(zip(plain, self._latin_ids(list(plain.values())))) if plain else {}
        found |= zip(others, self._pieced_ids(list(others.values())))
        return [found[i] for i in range(len(texts))]


class Decoder:
    """The tokens of one tokenizer file by id."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        table = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.tokens = [table.get(i) for i in range(1 + max(table))]
        self.library = None
        if spec.get("decoder"):
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(path)

    def decode(self, ids: bytes | None) -> str:
        numbers = np.frombuffer(ids or b"", "<u4")
        if len(numbers) and int(numbers.max()) >= len(self.tokens):
            raise ValueError(f"{int(numbers.max())} is no id")
        if self.library is None:
            return " ".join(map(self.tokens.__getitem__, numbers.tolist()))
        return self.library.decode(numbers.tolist(), skip_special_tokens=False)


def _is_latin(text: str) -> bool:
    try:
        return bool(text.encode("latin-1")) or not text
    except UnicodeEncodeError:
        return False


def _splits_alike(spec: dict) -> bool:
    """Whether the tokenizer prepares texts as the array operations do."""
    normal = [n.get("type") for n in (spec["normalizer"] or {}).get("normalizers", [])]
    split, *rest = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    alike = split.get("pattern") == {"Regex": WORDS} and split.get("behavior") == "Removed" and split.get("invert")
    return normal == NORMAL and bool(alike) and [(r["type"], r.get("use_regex")) for r in rest] == [("ByteLevel", False)]


@lru_cache(maxsize=2)
def codec(path: str, special: bool = True) -> Codec:
    return Codec(path, special)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def parts(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Successive texts of about ``TOGETHER`` characters."""
    held, n = [], 0
    for text in texts:
        held.append(text)
        n += len(text or "")
        if n >= TOGETHER:
            yield held
            held, n = [], 0
    if held:
        yield held


def encoded_column(text: Column, path: str | None = None, special: bool = True) -> Column:
    """The ids of a text column as binary, four bytes each, little-endian."""
    file = path or tokenizer_path()

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(file, special)
        for batch in batches:
            yield pd.Series(list(chain.from_iterable(map(own.encode, parts(batch.tolist())))), dtype=object)
        give_back()

    return encode(text)


def decoded_column(ids: Column, path: str | None = None) -> Column:
    """The text of a column of ids."""
    file = path or tokenizer_path()

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = decoder(file)
        for batch in batches:
            yield pd.Series([own.decode(i) for i in batch], dtype=object)
        give_back()

    return decode(ids)


def encoded(docs: DataFrame, path: str | None = None, text: str = "text", ids: str = "ids", special: bool = True) -> DataFrame:
    """``docs`` with the column ``ids``; a column of that name is replaced."""
    own = fresh(docs, "_ids")
    made = docs.withColumn(own, encoded_column(F.col(f"`{text}`"), path, special))
    return made.select(*without(docs, ids), F.col(own).alias(ids))


def decoded(rows: DataFrame, path: str | None = None, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the column ``text``, decoded from ``ids``; a column of that name is replaced."""
    own = fresh(rows, "_text")
    made = rows.withColumn(own, decoded_column(F.col(f"`{ids}`"), path))
    return made.select(*without(rows, text), F.col(own).alias(text))


def round_trip(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: key, ``ids``, and ``decoded``, the text that these ids give. Both in one pass, which
    hands on the results of about ``TOGETHER`` characters at a time."""
    file = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, back = codec(file), decoder(file)
        for batch in batches:
            first = 0
            for some in parts(batch.column("text").to_pylist()):
                ids = own.encode(some)
                keys = batch.column("key").slice(first, len(some))
                found = pa.array(ids, pa.binary()), pa.array(map(back.decode, ids), pa.string())
                yield pa.RecordBatch.from_arrays([keys, *found], ["key", "ids", "decoded"])
                first += len(some)
        give_back()

    kind = docs.schema[key].dataType
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([T.StructField("key", kind), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
    )
