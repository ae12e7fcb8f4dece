"""Token-ID files with Re-Pair grammar compression.

Documents are range-partitioned by key, so the files hold them in ascending order, or left in the
order in which they come, and encoded with a public tokenizer; each document ends with ``END``. Successive documents of a partition form shards
of about ``shard_tokens`` ids; a document is never split. In each shard, frequent pairs of ids are
replaced by nonterminals, again and again: in each round the pairs that occur at least ``LEAST`` times,
the most frequent ``MOST_RULES`` of them, until no pair occurs so often. The end id takes part in no pair, so documents stay separate.

File format: a Parquet table with one row for each shard, so that Spark's readers and writers move
it to any store: partition, number in it, ids in the shards before it in its partition, the keys and
symbol and id counts of its documents, its alphabet (the ids that occur), the symbols (16 bits if
that is enough, else 32: first the alphabet, then the rules), the rules (pairs of symbols) and the
expansion length of each rule. A document is decoded alone from
its symbols; a place in it is found from the running sum of expansion lengths without decoding what
comes before.

The tokenizer sees a distinct piece of the texts once while it is remembered. Texts are cut, by array operations
on their bytes, where the tokenizer joins nothing whatever stands around: before white space that follows something visible,
where letters, digits and signs meet, after a line end that stands alone, and between two visible characters whose bytes are
side by side in no token. A piece that is one word of the tokenizer goes to the library's merges, all others go to the
library whole; a tokenizer that splits its texts in another way gets them whole.

Cases: null and empty texts consist of the end id; null keys come first; rows repeated in the key
stay and are ordered by text; special tokens in a text are ordinary text; an empty table gives no
shards and an empty result; of the input only key and text are read, so other columns may have any name.
"""

from __future__ import annotations

import codecs
import json
import os
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import pairwise, repeat
from operator import attrgetter
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attrition.llm.bpe import copied
from attrition.llm.common import give_back, partitions, read, written

END = 2
BASE = 1 << 16
SHARD_TOKENS, MOST_RULES, LEAST = 1_000_000, 8192, 8
SLOTS = 1 << 20
#: Bytes that are encoded together; a longer text is a part of its own.
TOGETHER, KEPT = 2_000_000, 300_000
#: What a byte is part of: unknown (also white space beyond ASCII), a space, other white space, a letter, a digit, a
#: sign, something visible of any kind, an apostrophe.
UNKNOWN, BLANK, LINE, LETTER, DIGIT, SIGN, VISIBLE, QUOTE = range(8)
FILES = (
    "part int, number int, before long, keys array<long>, symbol_counts array<int>, "
    "token_counts array<int>, alphabet binary, width int, symbols binary, rules binary, lengths binary"
)
KINDS = {
    "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
}
LAYOUT = pa.schema([(name, KINDS[kind]) for name, kind in map(str.split, FILES.split(", "))])


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, UNKNOWN, np.uint8)
    kinds[33:127], kinds[128:] = SIGN, VISIBLE
    kinds[9:14], kinds[ord(" ")], kinds[ord("'")] = LINE, BLANK, QUOTE
    kinds[ord("0") : ord("9") + 1] = DIGIT
    kinds[ord("A") : ord("Z") + 1] = kinds[ord("a") : ord("z") + 1] = LETTER
    return kinds


def _kind_pairs(pairs) -> np.ndarray:
    table = np.zeros(64, bool)
    table[[8 * a + b for a, b in pairs]] = True
    return table


BYTE_KINDS = _byte_kinds()
SEEN = (LETTER, DIGIT, SIGN, VISIBLE, QUOTE)
#: Neighbours between which a word of the tokenizer always ends. A quotation mark may begin a contraction.
PARTED = _kind_pairs(
    [(a, b) for a in SEEN for b in (BLANK, LINE)]
    + [(LETTER, DIGIT), (LETTER, SIGN), (LETTER, QUOTE), (DIGIT, LETTER), (DIGIT, SIGN), (DIGIT, QUOTE)]
    + [(SIGN, LETTER), (SIGN, DIGIT), (QUOTE, DIGIT)]
)
AFTER_LINE = _kind_pairs([(LINE, b) for b in SEEN])
#: Kinds that make up words of the tokenizer, in groups.
GROUPS = np.zeros(8, np.uint8)
GROUPS[[LETTER, DIGIT, SIGN, QUOTE]] = 1, 2, 3, 3
#: Neighbours that may be cut if no token holds them side by side.
BESIDE = _kind_pairs([(a, b) for a in SEEN[:-1] for b in SEEN[:-1]])


def _kinds(code: np.ndarray) -> np.ndarray:
    """The kind of the character that each byte of UTF-8 is part of."""
    kinds = BYTE_KINDS[code]
    lead = np.flatnonzero(code == 0xC3)
    lead = lead[(code[lead + 1] != 0x97) & (code[lead + 1] != 0xB7)]
    kinds[lead] = kinds[lead + 1] = LETTER
    # What begins with these bytes may be white space.
    lead = np.flatnonzero((code == 0xC2) | (code >= 0xE1) & (code <= 0xE3))
    kinds[lead] = kinds[lead + 1] = UNKNOWN
    long = lead[code[lead] != 0xC2]
    kinds[long + 2] = UNKNOWN
    return kinds


def _are_words(kinds: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which pieces are one word of the tokenizer each: letters, digits or signs after a space or none, or a line end."""
    first, last = ends[:-1], ends[1:]
    begin = first + (kinds[first] == BLANK)
    groups = GROUPS[kinds]
    changes = np.r_[0, np.cumsum(groups[1:] != groups[:-1]), 0]
    within = np.minimum(begin, last - 1)
    alike = (begin < last) & (groups[within] > 0) & (changes[within] == changes[last - 1])
    return alike | (kinds[first] == LINE) & (last - first == 1)


def _alphabet() -> str:
    """The characters with which tokens of a byte-level tokenizer are written, by byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return "".join(chr(b if b in plain else 256 + others.index(b)) for b in range(256))


def _apart(tokens: Sequence[str]) -> np.ndarray:
    """By left << 8 | right: whether two bytes stand side by side in no token, and the right one begins a character."""
    back = np.full(1 << 16, 256, np.uint32)
    back[[ord(c) for c in _alphabet()]] = np.arange(256)
    code = back[np.frombuffer("\n".join(tokens).encode("utf-16-le"), "<u2")]
    left, right = code[:-1], code[1:]
    both = (left < 256) & (right < 256)
    apart = np.ones((256, 256), bool)
    apart[left[both], right[both]] = False
    apart[:, 0x80:0xC0] = False
    for a, b in ("re", "ve", "ll"):  # the ends of contractions
        apart[ord(a), ord(b)] = False
    return apart.ravel()


def _by_bytes(tokenizer) -> bool:
    """Whether a tokenizer splits and merges as the cuts assume."""
    split = json.loads(tokenizer.pre_tokenizer.__getstate__()) if tokenizer.pre_tokenizer else {}
    model = tokenizer.model
    return (
        tokenizer.normalizer is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
        and not split.get("add_prefix_space") and type(model).__name__ == "BPE" and not model.dropout
        and not model.continuing_subword_prefix and not model.end_of_word_suffix
    )


class Encoder:
    """Ids of many texts at once. The texts are cut into pieces that the tokenizer never joins, and
    each distinct piece is encoded once while it is remembered. What is remembered are at most
    ``KEPT`` pieces, as arrays; when there are more, the half that occurs in most texts stays."""

    def __init__(self, path: str) -> None:
        self.tokenizer = _tokenizer(path)
        vocabulary = self.tokenizer.get_vocab()
        if max(vocabulary.values()) >= BASE:
            raise ValueError(f"ids of {BASE} and above stand for rules")
        self.by_bytes = _by_bytes(self.tokenizer)
        self.model, self.alphabet = self.tokenizer.model, _alphabet()
        self.apart = _apart(list(vocabulary))
        #: Numbers of the pieces, their ids one after another, how many each has, and in how many parts it was.
        self.known: dict[bytes, int] = {}
        self.pool, self.sizes, self.seen = np.zeros(0, "<u2"), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def of_all(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers, without the end id."""
        return self.of_array(pa.array(texts, pa.large_string()))

    def of_array(self, texts: pa.Array) -> list[bytes]:
        """The same of an array of texts without nulls."""
        if not self.by_bytes:
            return [np.array(e.ids, "<u4").tobytes() for e in self._whole(texts.to_pylist())]
        _, offsets, data = texts.buffers()
        kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        bounds = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        first, bounds = int(bounds[0]), bounds - bounds[0]
        if not bounds[-1]:
            return [b""] * len(texts)
        data = data.slice(first, int(bounds[-1]))
        at = self._cuts(np.frombuffer(data, np.uint8), bounds)
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), data])
        coded = pieces.dictionary_encode()
        pool, starts, sizes = self._looked_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        codes = coded.indices.to_numpy()
        ids = copied(pool, starts[codes], sizes[codes]).astype("<u4").tobytes()
        last = np.r_[0, np.cumsum(sizes[codes], dtype=np.int64)][np.searchsorted(at, bounds)] * 4
        return [ids[i:j] for i, j in pairwise(last.tolist())]

    def _cuts(self, code: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where the pieces of texts with these bounds begin, and where the last one ends."""
        kinds = _kinds(code)
        pairs = kinds[:-1] << 3 | kinds[1:]
        cut = np.zeros(len(code) + 1, bool)
        inner = cut[1:-1]
        np.take(PARTED, pairs, out=inner)
        inner[1:] |= inner[:-1] & AFTER_LINE[pairs[1:]]
        near = code[:-1].astype(np.uint16) << 8 | code[1:]
        inner |= BESIDE[pairs] & self.apart[near]
        cut[bounds] = True
        return np.flatnonzero(cut)

    def _looked_up(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids in one array, and where those of each piece begin and how many they are."""
        at = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new, n = [pieces[i] for i in missing.tolist()], len(self.known)
            pool, sizes = self._encoded(new)
            self.pool, self.sizes = np.concatenate([self.pool, pool]), np.concatenate([self.sizes, sizes])
            self.seen = np.concatenate([self.seen, np.zeros(len(new), np.int32)])
            self.known.update(zip(new, range(n, n + len(new))))
            at[missing] = np.arange(n, n + len(new))
        self.seen[at] += 1
        pool, starts = self.pool, np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        found = pool, starts[at], self.sizes[at]
        if len(self.known) > KEPT:
            # Of those seen equally often the latest.
            best = np.sort(np.lexsort((-np.arange(len(starts)), -self.seen))[: KEPT // 2])
            names = list(self.known)
            self.known = {names[i]: n for n, i in enumerate(best.tolist())}
            self.pool = copied(pool, starts[best], self.sizes[best])
            self.sizes, self.seen = self.sizes[best], (self.seen[best] + 1) // 2
        return found

    def _whole(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def _encoded(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces that are not known, and how many each has."""
        raw = b"".join(pieces)
        ends = np.cumsum([0, *map(len, pieces)])
        text, merged, number = codecs.charmap_decode(raw, "strict", self.alphabet)[0], self.model.tokenize, attrgetter("id")
        is_word = _are_words(_kinds(np.frombuffer(raw, np.uint8)), ends)
        others = np.flatnonzero(~is_word).tolist()
        apart: dict[int, list[int]] = {}
        for some in (others[i : i + 1000] for i in range(0, len(others), 1000)):
            apart.update(zip(some, (e.ids for e in self._whole([pieces[i].decode() for i in some]))))
        ids: list[int] = []
        after = []
        for i, (word, (begin, end)) in enumerate(zip(is_word.tolist(), pairwise(ends.tolist()))):
            ids += map(number, merged(text[begin:end])) if word else apart[i]
            after.append(len(ids))
        return np.array(ids, "<u2"), np.diff(np.array([0, *after], np.int32))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _pair_slots(symbols: np.ndarray) -> np.ndarray:
    """A slot below ``SLOTS`` for each pair of neighbours."""
    left, right = symbols[:-1] * np.uint32(0x9E3779B1), symbols[1:] * np.uint32(0x85EBCA6B)
    return ((left ^ right) >> np.uint32(12)).astype(np.intp)


def _packed(symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
    return symbols[at].astype(np.uint64) << np.uint64(32) | symbols[at + 1]


def _frequent(symbols: np.ndarray, slots: np.ndarray, most: int, least: int) -> np.ndarray:
    """The most frequent pairs, as left << 32 | right. A table of hashed counts leaves out the rare
    ones before the exact count. The slot ``SLOTS`` is for pairs that are not to be counted."""
    likely = np.bincount(slots, minlength=SLOTS + 1) >= least
    likely[SLOTS] = False
    pairs, n = np.unique(_packed(symbols, np.flatnonzero(likely[slots])), return_counts=True)
    pairs, n = pairs[n >= least], n[n >= least]
    pairs = pairs[np.lexsort((pairs, -n))][:most]
    # Of pairs that share a slot the most frequent goes first; the others have their turn later.
    own = _pair_slots(_both(pairs).ravel())[::2]
    return pairs[np.sort(np.unique(own, return_index=True)[1])]


def _both(pairs: np.ndarray) -> np.ndarray:
    return np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)


def _replace(symbols: np.ndarray, slots: np.ndarray, pairs: np.ndarray, first: int) -> np.ndarray:
    """Replace the pairs from left to right by the symbols from ``first`` on. In a row of overlapping
    matches every other one counts."""
    own = _pair_slots(_both(pairs).ravel())[::2]
    taken, rule_of = np.zeros(SLOTS + 1, bool), np.zeros(SLOTS + 1, np.int32)
    taken[own], rule_of[own] = True, np.arange(len(pairs))
    at = np.flatnonzero(taken[slots])
    rule = rule_of[slots[at]]
    exact = pairs[rule] == _packed(symbols, at)
    at, rule = at[exact], rule[exact]
    if not len(at):
        return symbols
    starts = np.flatnonzero(np.r_[True, np.diff(at) != 1])
    odd = (np.arange(len(at)) - np.repeat(starts, np.diff(np.r_[starts, len(at)]))) % 2 == 1
    at, rule = at[~odd], rule[~odd]
    out = symbols.copy()
    out[at] = (first + rule).astype(np.uint32)
    keep = np.ones(len(out), bool)
    keep[at + 1] = False
    return out[keep]


def _sizes(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many ids each symbol stands for."""
    padded = np.r_[lengths, np.uint32(1)].astype(np.int64)
    return padded[np.where(symbols >= BASE, symbols.astype(np.int64) - BASE, len(lengths))]


def compress(ids: np.ndarray, most: int = MOST_RULES, least: int = LEAST):
    """Symbols, rules (n by 2) and expansion lengths of ids below ``BASE``. Each round makes the
    symbols fewer, so the rounds come to an end."""
    symbols = ids.astype(np.uint32)
    rules, lengths = np.zeros((0, 2), np.uint32), np.zeros(0, np.uint32)
    while len(symbols) > least:
        slots, ends = _pair_slots(symbols), np.flatnonzero(symbols == END)
        slots[ends[ends < len(slots)]] = SLOTS
        slots[ends[ends > 0] - 1] = SLOTS
        pairs = _frequent(symbols, slots, most, least)
        if not len(pairs):
            break
        symbols = _replace(symbols, slots, pairs, BASE + len(rules))
        new = _both(pairs)
        each = _sizes(new, lengths).sum(1).astype(np.uint32)
        rules, lengths = np.concatenate([rules, new]), np.concatenate([lengths, each])
    return symbols, rules, lengths


def _unfolded(symbols: np.ndarray, rules: np.ndarray) -> np.ndarray:
    while (composed := symbols >= BASE).any():
        sizes = np.where(composed, 2, 1)
        out = np.repeat(symbols, sizes)
        at = (np.cumsum(sizes) - sizes)[composed]
        pair = rules[symbols[composed] - np.uint32(BASE)]
        out[at], out[at + 1] = pair[:, 0], pair[:, 1]
        symbols = out
    return symbols


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ids behind the symbols: the rules are unfolded once and copied where they stand."""
    unfolded = _unfolded(BASE + np.arange(len(rules), dtype=np.uint32), rules)
    pool = np.concatenate([unfolded, np.arange(BASE, dtype=np.uint32)])
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    composed = symbols >= BASE
    rule = np.where(composed, symbols.astype(np.int64) - BASE, 0)
    each = _sizes(symbols, lengths)
    begin = np.where(composed, np.r_[starts, 0][rule], len(unfolded) + symbols.astype(np.int64))
    ends = np.cumsum(each)
    return pool[np.repeat(begin - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)]


def token_at(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, place: int) -> int:
    """The id at a place of a document, expanding only the symbol that covers it."""
    sizes = _sizes(symbols, lengths)
    ends = np.cumsum(sizes)
    if place < 0 or not len(ends) or place >= ends[-1]:
        raise IndexError(place)
    i = int(np.searchsorted(ends, place, side="right"))
    symbol, rest = int(symbols[i]), int(place - (ends[i] - sizes[i]))
    while symbol >= BASE:
        left, right = (int(x) for x in rules[symbol - BASE])
        size = 1 if left < BASE else int(lengths[left - BASE])
        symbol, rest = (left, rest) if rest < size else (right, rest - size)
    return symbol


def _shard(part: int, number: int, before: int, keys: list, documents: list[bytes]) -> tuple:
    ids = np.frombuffer(b"".join(documents), "<u4")
    symbols, rules, lengths = compress(ids)
    # The end id may also occur inside a text. It is in no pair, so its occurrences keep their order.
    last = np.cumsum([len(d) // 4 for d in documents]) - 1
    nth = np.searchsorted(np.flatnonzero(ids == END), last)
    counts = np.diff(np.r_[-1, np.flatnonzero(symbols == END)[nth]])
    alphabet = np.flatnonzero(np.bincount(ids, minlength=1))
    width = 2 if len(alphabet) + len(rules) <= 1 << 16 else 4
    code = np.zeros(BASE + len(rules), np.uint32)
    code[alphabet] = np.arange(len(alphabet))
    code[BASE:] = len(alphabet) + np.arange(len(rules))
    return (
        part, number, before, keys, counts.tolist(), [len(d) // 4 for d in documents],
        alphabet.astype("<u4").tobytes(), width, code[symbols].astype(f"<u{width}").tobytes(),
        code[rules].astype(f"<u{width}").tobytes(), lengths.astype("<u4").tobytes(),
    )


def opened(width: int, alphabet: bytes, symbols: bytes, rules: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and rules of a row of the files, with ids as they are and nonterminals from BASE."""
    ids = np.frombuffer(alphabet, "<u4")
    table = np.r_[ids, BASE + np.arange(len(rules) // (2 * width), dtype=np.uint32)].astype(np.uint32)
    kind = f"<u{width}"
    return table[np.frombuffer(symbols, kind)], table[np.frombuffer(rules, kind).reshape(-1, 2)]


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows whose texts have about ``TOGETHER`` bytes; a longer text is a part of its own."""
    number = np.cumsum(pc.binary_length(batch.column("_text")).to_numpy(), dtype=np.int64) // TOGETHER
    bounds = np.flatnonzero(np.diff(number)) + 1
    for i, j in pairwise([0, *bounds.tolist(), len(number)]):
        yield batch.slice(i, j - i)


def _encoded(path: str, shard_tokens: int):
    end = np.array([END], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(path).of_array, TaskContext.get().partitionId()
        number = before = held = 0
        keys: list = []
        documents: list[bytes] = []

        def shard() -> pa.RecordBatch:
            nonlocal number, before, held
            row = _shard(part, number, before, list(keys), documents)
            number, before, held = number + 1, before + held, 0
            keys.clear()
            documents.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, LAYOUT)], schema=LAYOUT)

        for batch in batches:
            for some in _parts(batch):
                for key, ids in zip(some.column("_key").to_pylist(), encode(some.column("_text"))):
                    keys.append(key)
                    documents.append(ids + end)
                    held += len(documents[-1]) // 4
                    if held >= shard_tokens:
                        yield shard()
        if documents:
            yield shard()
        give_back()

    return run


def token_files(
    docs: DataFrame,
    path: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    shard_tokens: int = SHARD_TOKENS,
    ascending: bool = True,
) -> DataFrame:
    """Write the files to the shared folder and return the table read from them. ``ascending`` keys
    take a shuffle; without it the documents stay in the order of the input and of its partitions."""
    name = F.col(f"`{key}`").cast("long")
    ordered = docs.select(name.alias("_key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    if ascending:
        ordered = ordered.repartitionByRange(
            partitions(docs.sparkSession), "_key", F.xxhash64("_text")
        ).sortWithinPartitions("_key", "_text")
    return written(ordered.mapInArrow(_encoded(path or tokenizer_path(), shard_tokens), FILES), "token-files")


def _decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples(index=False):
            symbols, rules = opened(row.width, row.alphabet, row.symbols, row.rules)
            ids = expand(symbols, rules, np.frombuffer(row.lengths, "<u4")).astype("<u4")
            ends = np.cumsum(np.asarray(row.token_counts, np.int64))
            starts = ends - np.asarray(row.token_counts, np.int64)
            raw = memoryview(ids.tobytes())
            frame = pd.DataFrame(
                {
                    "part": row.part,
                    "_start": starts + row.before,
                    "n_tokens": ends - starts,
                    "ids_crc32": [crc32(raw[4 * a : 4 * b]) for a, b in zip(starts, ends)],
                }
            )
            frame["_key"] = pd.array(list(row.keys), dtype="Int64")
            yield frame
    give_back()


def token_report(files: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row for each document in the files, decoded: key, ids before it, ids, their CRC-32."""
    totals = files.groupBy("part").agg(F.sum(F.aggregate("token_counts", F.lit(0).cast("long"), lambda a, n: a + n)).alias("_n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row for each partition
    offsets = totals.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    decoded = files.mapInPandas(
        _decoded, "part int, _start long, n_tokens long, ids_crc32 long, _key long"
    )
    return decoded.join(offsets, "part").select(
        F.col("_key").alias(key), (F.col("_before") + F.col("_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_report(token_files(read(spark, sf_dir, "documents").select("doc_id", "text")))
