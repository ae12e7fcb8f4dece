"""Secret scans: fixed patterns, and a character convolutional network over candidates.

The patterns find assignments of secrets, access keys and long runs of hex digits; what they find
always stays. Candidates are all runs of twelve or more of the characters that secrets consist of.
Each is scored by a small network on windows of its characters and the ones around them: characters
are embedded, convolved, rectified, pooled by maximum and weighed. A run of more than ``INSIDE``
characters has overlapping windows from end to end, and the largest of their scores counts.
Candidates beside the patterns' findings that reach the threshold are findings of kind ``net``.

The network is trained on labelled findings, on all documents: candidates inside a pattern's finding are positive and
others negative; each such positive is also shown with the words before it replaced, so that the characters count and
not the keyword alone. As the patterns know three kinds only, seeded code makes findings of further kinds (``MADE``: keys
of several alphabets, lengths and prefixes) and decoys (``DECOYS``: identifiers, paths, numbers, joined words), and puts
both between words of every document, with a keyword before them or none. Equal windows count once. They are dealt by
hash to shards of about ``SHARD_WINDOWS``; in each epoch every shard is a task's own run of Adam from the common state, and
the shards' states are averaged, as sums of integers so that any partitioning gives the same network. A third of all windows
is kept apart: the scores are calibrated on it, and the threshold is the largest at which at least ``RECALL`` of its
positives are found, an exact order statistic; ``precision`` and ``recall`` of the network say what that costs. Only
states of fixed size (about 130 kB) and numbers come to the driver; scanning is one pass without a shuffle over whole texts, and the
model has a fixed size (about 15 kB).

Cases: null and empty texts have no spans; with too few labelled findings to train on, only patterns
count, as on a table without texts; positions are code points and ends exclusive; repeated rows get equal results; very long
texts are scanned whole, with candidates scored in bounded groups; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Any
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.llm.common import read, written
from attrition.operators.order_stats import OrderStatistics

#: The kinds in their order, their patterns, and the shortest match (of the value).
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "net")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
BEFORE, INSIDE, AFTER = 20, 40, 4
STEP = 20
WIDTH = BEFORE + INSIDE + AFTER
SYMBOLS, EMBEDDED, TAPS, FILTERS = 100, 8, 5, 24
SHAPES = {"embedding": (SYMBOLS, EMBEDDED), "kernel": (TAPS * EMBEDDED, FILTERS), "offsets": (FILTERS,), "weights": (FILTERS,), "bias": ()}
SHARD_WINDOWS, BATCH, EPOCHS = 16_384, 128, 12
#: States are averaged in units of this part of one.
UNIT = 2.0**-50
RECALL = 0.95
#: Made findings and decoys at least, together. Every document gets one of each at least.
N_MADE = 16_000

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def _random(rng: random.Random, alphabet: str, low: int, high: int) -> str:
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(low, high)))


def _parted(rng: random.Random, alphabet: str, sizes: tuple[int, ...]) -> str:
    return "-".join(_random(rng, alphabet, n, n) for n in sizes)


def _joined(rng: random.Random, words: list[str], between: str) -> str:
    return between.join(rng.choice(words) for _ in range(rng.randint(2, 6)))


#: What secrets of further kinds look like.
MADE = {
    "mixed": lambda rng: _random(rng, _LOWER + _UPPER + _DIGITS, 16, 48),
    "base64": lambda rng: _random(rng, _LOWER + _UPPER + _DIGITS + "+/", 20, 60) + rng.choice(("", "=", "==")),
    "url64": lambda rng: _random(rng, _LOWER + _UPPER + _DIGITS + "-_", 20, 60),
    "lower": lambda rng: _random(rng, _LOWER + _DIGITS, 16, 40),
    "upper": lambda rng: _random(rng, _UPPER + _DIGITS, 16, 40),
    "prefixed": lambda rng: _random(rng, _LOWER, 2, 4) + rng.choice("_-") + _random(rng, _LOWER + _UPPER + _DIGITS, 16, 40),
    "parted": lambda rng: _parted(rng, _UPPER + _DIGITS, rng.choice(((5, 5, 5, 5), (4, 4, 4, 4), (8, 8, 8)))),
    "uuid": lambda rng: _parted(rng, _DIGITS + "abcdef", (8, 4, 4, 4, 12)),
    "hex": lambda rng: _random(rng, _DIGITS + "abcdef", 16, 64),
}
#: What is no secret, of a text's own words.
DECOYS = {
    "snake": lambda rng, words: _joined(rng, words, "_"),
    "camel": lambda rng, words: rng.choice(words) + "".join(rng.choice(words).capitalize() for _ in range(rng.randint(1, 4))),
    "path": lambda rng, words: rng.choice(("/", "")) + _joined(rng, words, "/"),
    "hyphens": lambda rng, words: _joined(rng, words, "-"),
    "joined": lambda rng, words: _joined(rng, words, ""),
    "loud": lambda rng, words: _joined(rng, words, rng.choice(("_", ""))).upper(),
    "counted": lambda rng, words: _joined(rng, words, rng.choice(("_", "-", ""))) + rng.choice(("", "_", "-")) + _random(rng, _DIGITS, 1, 4),
    "number": lambda rng, words: _random(rng, _DIGITS, 12, 30),
    "date": lambda rng, words: f"{rng.randint(1990, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}_{rng.randint(0, 23):02d}{rng.randint(0, 59):02d}",
    "line": lambda rng, words: rng.choice("-=_/+") * rng.randint(12, 60),
}
KEYWORDS = ("key", "auth", "credential", "login", "bearer", "access", "private", "hook", "id", "value", "use", "see")


#: What a text must hold, in lower case, for an assignment; what a candidate consists of; symbols of the network.
LEADS = ("passw", "secret", "token", "apikey", "api_key")
RUN, BETWEEN_RUNS = b"x", b" "
IN_RUN = bytes(RUN[0] if CANDIDATE.match(chr(c) * 12) else BETWEEN_RUNS[0] for c in range(256))
SYMBOL = bytes(0 if c == 0 else c - 31 if 32 <= c < 127 else 97 if c < 127 else 96 for c in range(256))


def characters(text: str) -> bytes:
    """One byte for each character; 128 for all beyond ASCII."""
    if text.isascii():
        return text.encode()
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), 128).astype(np.uint8).tobytes()


def candidates(text: str) -> list[tuple[int, int]]:
    """The matches of ``CANDIDATE``, by search for twelve characters of a run."""
    marked, found, end = characters(text).translate(IN_RUN), [], 0
    while (start := marked.find(RUN * 12, end)) >= 0:
        end = marked.find(BETWEEN_RUNS, start)
        end = len(marked) if end < 0 else end
        found.append((start, end))
    return found


def base_spans(text: str, runs: list[tuple[int, int]] | None = None) -> list[tuple[int, int, int]]:
    """Start, kind, end of what the patterns find, by start, then kind. ``runs`` are the text's candidates: every long run of
    hex digits lies inside one."""
    found, low = [], text.lower()
    if any(lead in low for lead in LEADS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    for run in candidates(text) if runs is None else runs:
        if run[1] - run[0] >= 24:
            found += [(m.start(), 2, m.end()) for m in HEX.finditer(text, *run)]
    return sorted(found)


def pieces(start: int, end: int) -> list[tuple[int, int]]:
    """What of a run each of its windows shows."""
    if end - start <= INSIDE:
        return [(start, end)]
    return [(a, a + INSIDE) for a in (*range(start, end - INSIDE, STEP), end - INSIDE)]


def window(text: str, start: int, end: int) -> bytes:
    """Characters around a candidate as symbols: 0 where there is none, 96 for non-ASCII."""
    return _window(characters(text).translate(SYMBOL), start, end)


def _window(symbols: bytes, start: int, end: int) -> bytes:
    return (
        symbols[max(0, start - BEFORE) : start].rjust(BEFORE, b"\x00")
        + symbols[start : min(end, start + INSIDE)].ljust(INSIDE, b"\x00")
        + symbols[end : end + AFTER].ljust(AFTER, b"\x00")
    )


def covered(start: int, end: int, spans: list[tuple[int, int, int]]) -> bool:
    return any(s < end and start < e for s, _, e in spans)


@dataclass
class Network:
    """Embedding, convolution, maximum pooling, weights; calibrated by slope and shift."""

    embedding: np.ndarray
    kernel: np.ndarray  # TAPS * EMBEDDED by FILTERS
    offsets: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 1.0
    precision: float = 0.0
    recall: float = 0.0

    def _signal(self, windows: np.ndarray) -> np.ndarray:
        """Each filter at each place of the windows, without the filter's offset: places, n, FILTERS."""
        taps = (self.embedding @ self.kernel.reshape(TAPS, EMBEDDED, FILTERS)).astype(np.float32)
        shown, places = np.ascontiguousarray(windows.T).astype(np.intp), WIDTH - TAPS + 1
        signal = taps[0].take(shown[:places], axis=0, mode="clip")
        part = np.empty_like(signal)
        for t in range(1, TAPS):
            signal += taps[t].take(shown[t : t + places], axis=0, mode="clip", out=part)
        return signal

    def _weighed(self, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pooled = np.maximum(best + self.offsets, 0)
        # By row, so that a window's score does not hang on its neighbours.
        return pooled, (pooled * self.weights).sum(axis=1) + self.bias

    def forward(self, windows: np.ndarray):
        signal = self._signal(windows)
        best = signal.max(0)
        place = np.arange(len(signal), dtype=np.uint8)[:, None, None]
        top = np.where(signal == best, place, np.uint8(len(signal))).min(0)  # n, FILTERS
        return top, *self._weighed(best)

    def raw(self, windows: np.ndarray) -> np.ndarray:
        parts = [self._weighed(self._signal(windows[i : i + BATCH]).max(0))[1] for i in range(0, len(windows), BATCH)]
        return np.concatenate([*parts, np.zeros(0)])

    def scores(self, windows: np.ndarray) -> np.ndarray:
        return self.calibrated(self.raw(windows))

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * raw + self.shift)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _network(values: np.ndarray) -> Network:
    """The network whose parts stand one after the other."""
    ends = np.cumsum([int(np.prod(shape)) for shape in SHAPES.values()])
    parts = np.split(values, ends[:-1])
    return Network(*(part.reshape(shape) for part, shape in zip(parts, SHAPES.values())))


def _start(rng: np.random.Generator) -> np.ndarray:
    """The state before the first step: the network's values, first and second moments of their gradients."""
    values = np.concatenate([
        rng.normal(0, 0.3, SYMBOLS * EMBEDDED),
        rng.normal(0, (2 / (TAPS * EMBEDDED)) ** 0.5, TAPS * EMBEDDED * FILTERS),
        np.zeros(FILTERS), rng.normal(0, 0.2, FILTERS), np.zeros(1),
    ])
    return np.stack([values, np.zeros_like(values), np.zeros_like(values)])


def _gradient(values: np.ndarray, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    net = _network(values)
    top, pooled, raw = net.forward(x)
    error = (_sigmoid(raw) - y) * weight / len(x)
    into = np.outer(error, net.weights) * (pooled > 0)  # n, FILTERS
    seen = x[np.arange(len(x))[:, None, None], top[:, :, None].astype(np.intp) + np.arange(TAPS)]  # n, FILTERS, TAPS
    # What reaches each filter through each symbol at each of its taps.
    cell = (seen.astype(np.int64) * FILTERS + np.arange(FILTERS)[None, :, None]) * TAPS + np.arange(TAPS)
    reached = np.bincount(cell.ravel(), np.repeat(into.ravel(), TAPS), SYMBOLS * FILTERS * TAPS)
    reached = reached.reshape(SYMBOLS, FILTERS, TAPS)
    kernel = net.kernel.reshape(TAPS, EMBEDDED, FILTERS)
    return np.concatenate([
        np.tensordot(reached, kernel, ([2, 1], [0, 2])).ravel(),
        np.tensordot(reached, net.embedding, ([0], [0])).transpose(1, 2, 0).ravel(),
        into.sum(0), pooled.T @ error + 1e-4 * net.weights, [error.sum()],
    ])


def _epoch(
    state: np.ndarray, done: int, x: np.ndarray, y: np.ndarray, share: float, rng: np.random.Generator
) -> np.ndarray:
    """Adam over all windows once, after ``done`` steps. ``share`` is that of the positives, so that both classes weigh alike."""
    values, first, second = state
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    for part in np.array_split(rng.permutation(len(x)), max(1, len(x) // BATCH)):
        gradient = _gradient(values, x[part], y[part], weight[part])
        done += 1
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        values = values - 0.005 * first / (1 - 0.9**done) / (np.sqrt(second / (1 - 0.999**done)) + 1e-8)
    return np.stack([values, first, second])


def _with_bare(x: np.ndarray, y: np.ndarray, made: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Adds the positives that are not made, with what stands before others."""
    bare = x[(y == 1) & ~made].copy()
    bare[:, :BEFORE] = x[rng.integers(0, len(x), len(bare)), :BEFORE]
    return np.concatenate([x, bare]), np.concatenate([y, np.ones(len(bare))])


def train_network(
    windows: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 5, made: np.ndarray | None = None
) -> Network | None:
    """Adam on the logistic loss with both classes weighted alike; a third calibrates. ``made`` marks windows that
    show their characters in many surroundings already. For windows that fit one process; see ``train_on``."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(windows))
    windows, labels = windows[order], labels[order].astype(np.float64)
    made = np.zeros(len(windows), bool) if made is None else made[order]
    cut = len(windows) * 2 // 3
    if min(labels[:cut].sum(), (1 - labels[:cut]).sum(), labels[cut:].sum(), (1 - labels[cut:]).sum()) < 3:
        return None
    state, done = _start(rng), 0
    x, y = _with_bare(windows[:cut], labels[:cut], made[:cut], rng)
    for _ in range(epochs):
        state = _epoch(state, done, x, y, y.mean(), rng)
        done += max(1, len(x) // BATCH)
    net = _network(state[0])
    raw, y = net.raw(windows[cut:]), labels[cut:]
    net.slope, net.shift = _platt(raw, y)
    scores = net.scores(windows[cut:])
    found = np.sort(scores[y == 1])
    net.threshold = float(found[int((1 - RECALL) * len(found))])
    reached = scores >= net.threshold
    net.precision, net.recall = float(y[reached].mean()), float(reached[y == 1].mean())
    return net


def _platt(raw: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic calibration; smoothed targets keep them finite."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    slope, shift = 1.0, 0.0
    for _ in range(500):
        error = _sigmoid(slope * raw + shift) - target
        slope -= 0.05 * float((error * raw).mean()) + 1e-4 * (slope - 1)
        shift -= 0.5 * float(error.mean())
    return max(slope, 1e-3), shift


def made_windows(text: str, n: int, kinds: Sequence[str] = tuple(MADE)) -> list[tuple[bool, bytes]]:
    """``n`` made findings and as many decoys, each between two words of the text; the same for the same text."""
    rng = random.Random(crc32(text.encode("utf-8", "surrogatepass")))
    spaces = [m.start() for m in re.finditer(" ", text)] or [0]
    words = re.findall("[a-z]{2,}", text) or ["word", "other"]
    rows = []
    for i in range(2 * n):
        secret = i < n
        body = MADE[rng.choice(kinds)](rng) if secret else DECOYS[rng.choice(tuple(DECOYS))](rng, words)
        at = rng.choice(spaces)
        lead = rng.choice(("", "", f"{rng.choice(KEYWORDS)}{rng.choice((': ', '=', ' ', ' = '))}", rng.choice(("(", '"', "<", "\n"))))
        before = text[max(0, at - BEFORE) : at + 1] + lead
        # Only what a scan of that text would take for one run.
        for m in CANDIDATE.finditer(body):
            whole = before + body + rng.choice((" ", ".", ",", ")", '"', "\n")) + text[at + 1 : at + 1 + AFTER]
            start, end = len(before) + m.start(), len(before) + m.end()
            rows += [(secret, window(whole, a, b)) for a, b in pieces(start, end)]
    return rows


def _shown(made: int, kinds: Sequence[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                runs = candidates(text)
                if runs:
                    spans, symbols = base_spans(text, runs), characters(text).translate(SYMBOL)
                    rows += [(covered(s, e, spans), False, _window(symbols, s, e)) for run in runs for s, e in pieces(*run)]
                rows += [(secret, True, w) for secret, w in made_windows(text, made, kinds)]
            yield pd.DataFrame(rows, columns=["positive", "made", "window"])

    return run


def _matrix(windows: Sequence[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(windows), np.uint8).reshape(-1, WIDTH)


def _packed(seed: int):
    def run(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        """One row for a shard: its windows and their labels, with bare ones."""
        rows = rows.sort_values("window")
        x, y = _with_bare(
            _matrix(rows["window"]), rows["positive"].to_numpy(np.float64), rows["made"].to_numpy(bool),
            np.random.default_rng((seed, int(key[0]))),
        )
        row = (int(key[0]), len(x), int(y.sum()), x.tobytes(), y.astype(np.uint8).tobytes())
        return pd.DataFrame([row], columns=["shard", "n", "positives", "windows", "labels"])

    return run


def _next_state(shards: DataFrame, state: np.ndarray, done: int, n: int, share: float, seed: tuple[int, int]) -> np.ndarray:
    """The mean of the shards' states after one more epoch, each weighted by its windows."""
    shared = shards.sparkSession.sparkContext.broadcast(state)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(shared.value.size, np.int64)
        for batch in batches:
            for shard, size, windows, labels in zip(batch["shard"], batch["n"], batch["windows"], batch["labels"]):
                y = np.frombuffer(labels, np.uint8).astype(np.float64)
                new = _epoch(shared.value, done, _matrix([windows]), y, share, np.random.default_rng((*seed, shard)))
                total += np.rint(new.ravel() * (size / n / UNIT)).astype(np.int64)
        yield pd.DataFrame({"place": np.arange(len(total), dtype=np.int32), "value": total})

    sums = shards.mapInPandas(run, "place int, value long").groupBy("place").agg(F.sum("value").alias("value"))
    mean = sums.toPandas().sort_values("place")["value"].to_numpy() * UNIT
    shared.unpersist()
    return mean.reshape(state.shape)


def _calibrate(net: Network, held: DataFrame) -> None:
    """Slope, shift, threshold, precision and recall from windows that the network has not learnt."""
    model = held.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"raw": model.value.raw(_matrix(batch["window"])), "positive": batch["positive"]})

    judged = written(held.mapInPandas(run, "raw double, positive boolean"), "secret-judged")
    n1, n = judged.agg(F.count_if("positive"), F.count("*")).first()
    # Platt's smoothed targets: each is both classes, with its weight.
    target = F.when(F.col("positive"), (n1 + 1) / (n1 + 2)).otherwise(1 / (n - n1 + 2))
    both = F.array(F.struct(F.lit(1).alias("y"), target.alias("w")), F.struct(F.lit(0).alias("y"), (1 - target).alias("w")))
    soft = judged.select(array_to_vector(F.array("raw")).alias("x"), F.explode(both).alias("t")).select("x", "t.y", "t.w")
    curve = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w").fit(soft)
    net.slope, net.shift = max(float(curve.coefficients[0]), 1e-3), float(curve.intercept)
    rank = int((1 - RECALL) * n1)
    least = OrderStatistics(judged.where("positive"), ["raw"]).at({"raw": [rank]})["raw"][rank].value
    net.threshold = float(net.calibrated(np.array([least]))[0])
    reached = F.col("raw") >= least
    hits, every = judged.agg(F.count_if(reached & F.col("positive")), F.count_if(reached)).first()
    net.precision, net.recall = hits / every, hits / n1


def labelled_windows(docs: DataFrame, text: str = "text", kinds: Sequence[str] = tuple(MADE)) -> DataFrame:
    """What the network learns from: the distinct windows of all candidates of all documents and of the made findings and
    decoys between their words, and whether one is a finding, is only made, and is kept apart."""
    rows = docs.select(F.col(f"`{text}`").alias("text")).where("text IS NOT NULL")
    made = -(-N_MADE // (2 * max(1, rows.count())))
    shown = rows.mapInPandas(_shown(made, kinds), "positive boolean, made boolean, window binary")
    one = shown.groupBy("window").agg(F.max("positive").alias("positive"), F.min("made").alias("made"))
    return written(one.withColumn("apart", F.pmod(F.xxhash64("window", F.lit(1)), F.lit(3)) == 2), "secret-windows")


def train_on(
    docs: DataFrame,
    text: str = "text",
    kinds: Sequence[str] = tuple(MADE),
    shard_windows: int = SHARD_WINDOWS,
    epochs: int = EPOCHS,
    seed: int = 5,
) -> Network | None:
    """The network for these documents, learnt from all of them, or None if there are too few windows. ``kinds`` are the made
    findings to learn."""
    one = labelled_windows(docs, text, kinds)
    sizes = {(r.apart, r.positive): r["count"] for r in one.groupBy("apart", "positive").count().collect()}
    if min(sizes.get((apart, positive), 0) for apart in (False, True) for positive in (False, True)) < 3:
        return None
    n_shards = -(-(sizes[False, False] + sizes[False, True]) // shard_windows)
    dealt = one.where(~F.col("apart")).withColumn("shard", F.pmod(F.xxhash64("window", F.lit(2)), F.lit(n_shards)).cast("int"))
    shards = written(
        dealt.groupBy("shard").applyInPandas(_packed(seed), "shard int, n long, positives long, windows binary, labels binary"),
        "secret-shards",
    )
    total, positives, n_shards = shards.agg(F.sum("n"), F.sum("positives"), F.count("*")).first()
    state = _start(np.random.default_rng(seed))
    steps = max(1, total // n_shards // BATCH)
    for epoch in range(epochs):
        state = _next_state(shards, state, epoch * steps, total, positives / total, (seed, epoch))
    net = _network(state[0])
    _calibrate(net, one.where("apart"))
    return net


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_secrets(
    docs: DataFrame, net: Network | None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row for each document: counts by kind, a digest of the patterns' spans, all spans."""
    model = docs.sparkSession.sparkContext.broadcast(net)

    @F.pandas_udf("n_assign long, n_access long, n_hex long, n_net long, base_sha256 string, spans string")
    def scan(texts: pd.Series) -> pd.DataFrame:
        net, rows, waiting = model.value, [], []
        for i, text in enumerate(texts):
            runs = candidates(text or "")
            base = base_spans(text or "", runs)
            rows.append(([*base], base))
            if net is not None and runs:
                symbols = characters(text).translate(SYMBOL)
                for s, e in runs:
                    if not covered(s, e, base):
                        for a, b in pieces(s, e):
                            waiting.append((i, s, e, _window(symbols, a, b)))
                            if len(waiting) >= 4096:
                                _judge(net, waiting, rows)
        if waiting:
            _judge(net, waiting, rows)
        out = []
        for every, base in rows:
            n = np.bincount([k for _, k, _ in every], minlength=4) if every else np.zeros(4, int)
            out.append((*n.tolist(), hashlib.sha256(listed(base).encode()).hexdigest(), listed(sorted(every))))
        return pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "n_net", "base_sha256", "spans"])

    return docs.select(F.col(f"`{key}`").alias(key), scan(F.col(f"`{text}`")).alias("_found")).select(
        key, "_found.*"
    )


def _judge(net: Network, waiting: list, rows: list) -> None:
    scores = net.scores(_matrix([w for *_, w in waiting]))
    for (i, s, e, _), score in zip(waiting, scores):
        found = (s, KINDS.index("net"), e)
        if score >= net.threshold and rows[i][0][-1:] != [found]:
            rows[i][0].append(found)
    waiting.clear()


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_secrets(docs, train_on(docs))
