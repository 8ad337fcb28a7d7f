"""Secret scans: fixed patterns, and a character convolutional network for what they miss."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle
from .common import slices
from .registry import query, table

# The base patterns and the least lengths of what they find.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
#: Every match of ASSIGN holds one of these in lower case.
MARKS = ("assw", "ecret", "oken", "apikey", "api_key")

#: Runs of key characters at least as long as what the fixed patterns take for a secret are candidates for the network.
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_.=-]{{{LEAST_ASSIGN},}}")
DIGIT = re.compile(r"[0-9]")
#: Characters of a candidate and of the context on each side that the network sees; a longer candidate is seen in windows.
SEEN, CONTEXT = 48, 24
WIDTH = SEEN + 2 * CONTEXT
#: Bytes of text that a task scans together, and places whose convolutions it holds.
BATCH_BYTES, PLACES = 2_000_000, 1 << 13
#: Places whose maximum is made once for all windows; a window has at least as many and at most three times as many.
SHARED = 32
#: The group of findings in training; candidates without a digit are group 0, the others 1.
FOUND = 2
#: Bytes of text that give the network its first values, and rounds in which all training texts are then read once.
START_BYTES, ROUNDS = 64 << 20, 3
#: Characters of text in a training step, windows of each rare group that a step repeats and that a task keeps for that.
STEP, REPEATED, KEPT = 1 << 16, 16, 4_096
#: Held-out logits are counted in bins of this width up to this size.
BIN, LARGEST = 1 / 64, 40


def base_spans(text: str, runs: list[tuple[int, int]] | None = None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start and kind. ``runs`` are the text's runs of key characters, if known; a hex value lies in one."""
    runs, lowered, found = _runs(text) if runs is None else runs, text.lower(), []
    if any(mark in lowered for mark in MARKS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST_ASSIGN]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), m.end(), "hex") for start, end in runs if end - start >= LEAST_HEX for m in HEX.finditer(text, start, end)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _runs(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CANDIDATE.finditer(text)]


def candidates(text: str, base: list[tuple[int, int, str]] = (), runs: list[tuple[int, int]] | None = None) -> list[tuple[int, int]]:
    """Every run of key characters long enough to be a secret, without what the sorted ``base`` spans cover; pieces that are left count if they are long enough themselves."""
    runs = _runs(text) if runs is None else runs
    if not base:
        return runs
    out, k, covered = [], 0, 0
    for start, end in runs:
        while True:
            while k < len(base) and base[k][0] < start:  # what began before this piece may still cover it
                covered, k = max(covered, base[k][1]), k + 1
            start = max(start, covered)
            if start >= end:
                break
            if k < len(base) and base[k][0] < end:
                if base[k][0] - start >= LEAST_ASSIGN:
                    out.append((start, base[k][0]))
                covered, k = max(covered, base[k][1]), k + 1
                start = covered
                continue
            if end - start >= LEAST_ASSIGN:
                out.append((start, end))
            break
    return out


def _codes() -> np.ndarray:
    """Character classes by code point, for ASCII; 0 stands before and after the text, 1 for other characters."""
    codes = np.ones(128, np.uint8)
    codes[32:127] = np.arange(2, 97)
    codes[9:14] = 2
    return codes


CODES, CLASSES = _codes(), 97


def classes(text: str) -> np.ndarray:
    """Character classes of a text with room for the context on both sides."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros(len(points) + 2 * CONTEXT, np.uint8)
    out[CONTEXT:CONTEXT + len(points)] = np.where(points < 128, CODES[np.minimum(points, 127)], 1)
    return out


def windows(start: int, end: int) -> list[tuple[int, int]]:
    """(start, length) of a candidate's windows: all of a long candidate, in steps of SEEN characters."""
    return [(at, min(SEEN, end - at)) for at in range(start, end, SEEN)]


def window_row(coded: np.ndarray, start: int, length: int) -> np.ndarray:
    """The character classes of a window and the context on both sides, filled up to WIDTH with zeros that the network does not look at."""
    row = np.zeros(WIDTH, np.uint8)
    row[:length + 2 * CONTEXT] = coded[start:start + length + 2 * CONTEXT]
    return row


def window_rows(coded: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``window_row`` of many windows, of coded texts with WIDTH more places at the end."""
    rows = np.lib.stride_tricks.sliding_window_view(coded, WIDTH)[starts]
    rows[np.arange(WIDTH) >= lengths[:, None] + 2 * CONTEXT] = 0
    return rows


def all_windows(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and span number of the windows of all (start, end) rows."""
    size = spans[:, 1] - spans[:, 0]
    times = -(-size // SEEN)
    owner = np.repeat(np.arange(len(spans)), times)
    step = (np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times)) * SEEN
    return spans[owner, 0] + step, np.minimum(SEEN, size[owner] - step), owner


@dataclass
class CharNet:
    """Embedding, one convolution with ReLU, maximum over the places of a window, logistic output, and a Platt scaling of it.

    The places of a window are those whose whole kernel lies in the window and its context.
    """

    embed: np.ndarray   # classes x e
    kernel: np.ndarray  # width * e x filters
    bias: np.ndarray
    out: np.ndarray
    shift: float
    scale: tuple[float, float] = (1.0, 0.0)
    threshold: float = 1.0
    #: Of the held-out windows: findings at or over the threshold, and findings among all windows there.
    recall: float = 0.0
    precision: float = 0.0

    @staticmethod
    def fresh(seed: int = 1, e: int = 8, width: int = 7, filters: int = 24) -> CharNet:
        r = np.random.default_rng(seed)
        return CharNet(r.normal(0, 0.3, (CLASSES, e)), r.normal(0, (2 / (width * e)) ** 0.5, (width * e, filters)), np.zeros(filters), r.normal(0, 0.3, filters), 0.0)

    @property
    def width(self) -> int:
        return self.kernel.shape[0] // self.embed.shape[1]

    def _made(self, part: np.ndarray) -> np.ndarray:
        """The convolution at every place, without bias. Places that are a kernel's width apart are rows of one matrix product."""
        e, w = self.embed.shape[1], self.width
        n = len(part) - w + 1
        m = -(-n // w)
        wide = np.zeros(((m + 1) * w, e), np.float32)
        wide[:len(part)] = self.embed.astype(np.float32)[part]
        wide, kernel, made = wide.ravel(), self.kernel.astype(np.float32), np.empty((m, w, self.kernel.shape[1]), np.float32)
        for o in range(w):
            np.matmul(wide[o * e:(o + m * w) * e].reshape(m, w * e), kernel, out=made[:, o])
        return made.reshape(m * w, -1)[:n]

    def _highest(self, made: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The maximum over each window's places: the maxima of SHARED places from every place on, of which three cover a window."""
        step = 1
        while step < SHARED:
            made, step = np.maximum(made[:-step], made[step:]), 2 * step
        last = begin + lengths + 2 * CONTEXT - self.width + 1 - SHARED
        return np.maximum(np.maximum(made[begin], made[np.minimum(begin + SHARED, last)]), made[last])

    def _blocks(self, coded: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """(first window, end, place of the first, convolution) of windows within PLACES starts."""
        at = 0
        while at < len(starts):
            first = int(starts[at])
            end = int(np.searchsorted(starts, first + PLACES))
            yield at, end, first, self._made(coded[first:first + PLACES + WIDTH])
            at = end

    def raw(self, coded: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Logits of windows, given by start and length in increasing order of start, of coded texts that follow one another.

        The convolution of every place is made once, whatever windows share it. PLACES starts are looked at together.
        """
        bias, last, out = self.bias.astype(np.float32), self.out.astype(np.float32), np.zeros(len(starts))
        for at, end, first, made in self._blocks(coded, starts):
            out[at:end] = np.maximum(self._highest(made, starts[at:end] - first, lengths[at:end]) + bias, 0) @ last + self.shift
        return out

    def rows(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Logits of window rows."""
        return self.raw(x.ravel(), np.arange(len(x)) * WIDTH, np.asarray(lengths))

    def gradient(self, coded: np.ndarray, starts: np.ndarray, lengths: np.ndarray, y: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        """Of the logistic loss of all windows, as ``raw`` takes them.

        The low seven bits of a value carry its place, so that the maximum as an integer also says where it lies; negative
        values are below all others then, and what the ReLU makes of them is zero.
        """
        e, w, filters = self.embed.shape[1], self.width, self.kernel.shape[1]
        bias, top = self.bias.astype(np.float32), np.zeros((len(starts), filters), np.int32)
        for at, end, first, made in self._blocks(coded, starts):
            bits = np.add(made, bias, out=made).view(np.int32)
            bits &= ~127
            bits |= (np.arange(first, first + len(bits), dtype=np.int32) & 127)[:, None]
            top[at:end] = self._highest(bits, starts[at:end] - first, lengths[at:end])
        value = np.maximum((top & ~127).view(np.float32), 0)
        where = (starts[:, None] + ((top - starts[:, None]) & 127)).astype(np.int32)
        err = (1 / (1 + np.exp(-np.clip(value @ self.out + self.shift, -40, 40))) - y) * weights
        back = err[:, None] * self.out * (value > 0)
        rows, columns, flat = coded.astype(np.int64) * filters, np.arange(filters), back.ravel()
        grads = {"out": value.T @ err, "bias": back.sum(0), "shift": err.sum(), "kernel": np.empty_like(self.kernel), "embed": np.zeros_like(self.embed)}
        for o in range(w):  # by the class under each part of the kernel
            seen = np.bincount((rows[where + o] + columns).ravel(), flat, CLASSES * filters).reshape(CLASSES, filters)
            grads["kernel"][o * e:(o + 1) * e] = self.embed.T @ seen
            grads["embed"] += seen @ self.kernel[o * e:(o + 1) * e].T
        return grads

    def values(self) -> np.ndarray:
        """All parameters in a row."""
        return np.concatenate([getattr(self, n).ravel() for n in NAMES] + [[self.shift]])

    def with_values(self, row: np.ndarray) -> CharNet:
        """A network of this shape with other parameters."""
        parts = np.split(np.asarray(row, float), np.cumsum([getattr(self, n).size for n in NAMES]))
        return CharNet(*[p.reshape(getattr(self, n).shape) for n, p in zip(NAMES, parts, strict=False)], float(parts[-1][0]))

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * logits + self.scale[1], -40, 40)))

    def fit(self, x: np.ndarray, y: np.ndarray, lengths: np.ndarray, epochs: int = 6, batch: int = 128, rate: float = 0.01, seed: int = 2) -> CharNet:
        """Adam on the logistic loss of window rows, both classes weighing the same."""
        r, weights = np.random.default_rng(seed), np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
        learner = Learner(self, rate)
        for _ in range(epochs):
            order = r.permutation(len(x))
            for i in range(0, len(x), batch):
                rows = order[i:i + batch]
                learner.step(x[rows].ravel(), np.arange(len(rows)) * WIDTH, np.asarray(lengths)[rows], y[rows], weights[rows] / len(rows))
        return self

    def calibrate(self, x: np.ndarray, y: np.ndarray, lengths: np.ndarray, recall: float) -> CharNet:
        """Platt scaling and threshold from held-out window rows."""
        return self.settle(self.rows(x, lengths), np.asarray(y, float), np.ones(len(x)), recall)

    def settle(self, z: np.ndarray, y: np.ndarray, times: np.ndarray, recall: float) -> CharNet:
        """Platt scaling by Newton steps on held-out logits that occur ``times``, then the highest threshold that keeps ``recall`` of the findings."""
        a, b, n, found = 1.0, 0.0, times.sum(), times[y > 0].sum()
        target = np.where(y > 0, (found + 1) / (found + 2), 1 / (n - found + 2))
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
            d, w = times * (p - target), times * np.maximum(p * (1 - p), 1e-9)
            h = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
            step = np.linalg.solve(h, [(d * z).sum() + 1e-3 * (a - 1), d.sum()])
            a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
        self.scale = (max(float(a), 1e-3), float(b))
        p = self.probability(z)
        if found:
            order = np.flatnonzero(y > 0)[np.argsort(p[y > 0], kind="stable")]
            passed = np.cumsum(times[order])
            self.threshold = float(p[order[np.searchsorted(passed, int((1 - recall) * found), side="right")]])
            over = p >= self.threshold
            self.recall, self.precision = float(times[over & (y > 0)].sum() / found), float(times[over & (y > 0)].sum() / times[over].sum())
        return self


NAMES = ("embed", "kernel", "bias", "out")


class Learner:
    """Adam steps on a network, which they change."""

    def __init__(self, net: CharNet, rate: float):
        self.net, self.rate, self.t = net, rate, 0
        self.m, self.v = ({n: 0.0 for n in NAMES} for _ in range(2))

    def step(self, coded: np.ndarray, starts: np.ndarray, lengths: np.ndarray, y: np.ndarray, weights: np.ndarray) -> None:
        grads, self.t = self.net.gradient(coded, starts, lengths, y, weights), self.t + 1
        self.net.shift -= self.rate * float(grads["shift"])
        for n in NAMES:
            self.m[n] = 0.9 * self.m[n] + 0.1 * grads[n]
            self.v[n] = 0.999 * self.v[n] + 0.001 * grads[n] ** 2
            setattr(self.net, n, getattr(self.net, n) - self.rate * (self.m[n] / (1 - 0.9 ** self.t)) / ((self.v[n] / (1 - 0.999 ** self.t)) ** 0.5 + 1e-8))


@dataclass
class Read:
    """Texts laid out one after another: coded, the base spans of each, and the candidates as rows of text number, start and end in the text."""

    coded: np.ndarray
    offsets: np.ndarray
    base: list[list[tuple[int, int, str]]]
    spans: np.ndarray

    @staticmethod
    def of(texts: list[str | None], findings: bool = False) -> Read:
        """A text without candidates is laid out only where ``findings`` are wanted and it has some."""
        coded, offsets, base, spans, size = [], [], [], [], 0
        for k, text in enumerate(texts):
            text = text or ""
            runs = _runs(text)
            base.append(base_spans(text, runs))
            own = candidates(text, base[-1], runs)
            offsets.append(size)
            if own or findings and base[-1]:
                coded.append(classes(text))
                size += len(coded[-1])
                if own:
                    spans.append(np.column_stack([np.full(len(own), k), np.array(own)]))
        return Read(np.concatenate([*coded, np.zeros(WIDTH, np.uint8)]), np.array(offsets, np.int64), base, np.concatenate([np.zeros((0, 3), np.int64), *spans]))

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start in ``coded``, length and candidate number of the candidates' windows."""
        return all_windows(self.spans[:, 1:] + self.offsets[self.spans[:, 0]][:, None])

    def findings(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Start in ``coded`` and length of the window of each finding: the first of the value that its pattern finds."""
        values = [(int(offset) + start, min(end - start, SEEN)) for text, offset, base in zip(texts, self.offsets, self.base, strict=True) for start, end in _values(text, base)]
        found = np.array(values, np.int64).reshape(-1, 2)
        return found[:, 0], found[:, 1]


def _values(text: str | None, base: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """(start, end) of the values in the base spans."""
    return [(ASSIGN.match(text, start).start(1) if kind == "assign" else start, end) for start, end, kind in base]


def _labelled(text: str) -> list[tuple[int, int, int]]:
    """(start, end, group) of the values that the fixed patterns find, and of the candidates that they don't touch."""
    base = base_spans(text)
    return [(start, end, FOUND) for start, end in _values(text, base)] + [(start, end, int(DIGIT.search(text, start, end) is not None)) for start, end in candidates(text, base)]


def _varied(x: np.ndarray, y: np.ndarray, n: np.ndarray, seed: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows, and copies of the findings in the contexts of other candidates, with random letters and digits and with letters alone.

    So the network also learns the look of a key by itself, and not only the key formats and the contexts of the fixed patterns.
    """
    r = np.random.default_rng(seed)
    signs = CODES[np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", np.uint8)]
    is_sign = np.isin(np.arange(CLASSES), signs)
    found, others = np.flatnonzero(y > 0), np.flatnonzero(y == 0)
    at, copies = np.arange(WIDTH), []
    for allowed in (signs, signs[10:]) if len(others) else ():
        near, size = r.choice(others, len(found)), n[found][:, None]
        inside = (at >= CONTEXT) & (at < CONTEXT + size)
        after = np.where(at < CONTEXT, at, at - size + n[near][:, None])  # the place in the other candidate's row
        around = np.take_along_axis(x[near], np.clip(after, 0, WIDTH - 1), 1)
        moved = np.where(inside, x[found], np.where(at < 2 * CONTEXT + size, around, 0)).astype(np.uint8)
        mixed = inside & is_sign[moved]
        moved[mixed] = r.choice(allowed, int(mixed.sum()))
        copies.append(moved)
    return np.concatenate([x, *copies]), np.concatenate([y, *[y[found]] * len(copies)]), np.concatenate([n, *[n[found]] * len(copies)])


def _smallest(found: DataFrame, sample: int) -> list:
    """The ``sample`` rows with the smallest hashes. A histogram on a logarithmic scale cuts the tasks' rows to a few more than that before they are collected."""
    octave = F.floor(F.log2(F.col("h").cast("double") + float(1 << 63) + 1) * 16)
    seen, cut = 0, None
    for row in found.groupBy(octave.alias("b")).count().orderBy("b").collect():  # 1,025 rows at most
        seen, cut = seen + row["count"], row.b
        if seen >= sample:
            break
    rows = found.filter(octave <= cut).collect() if cut is not None else []
    return sorted(rows, key=lambda r: (r.h, bytes(r.x)))[:sample]


def _first(given: DataFrame, sample: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window rows, groups, lengths): at most ``sample`` windows of each group, those with the smallest hashes of id, text and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list[tuple[int, bytes, int]]] = {g: [] for g in range(FOUND + 1)}
        last = dict.fromkeys(kept, 1 << 63)  # hashes from here on are not among the smallest
        for batch in batches:
            for text, h in zip(batch.column("text"), batch.column("h"), strict=True):
                text, h, coded = text.as_py() or "", h.as_py(), None
                for k, (start, end, group) in enumerate(_labelled(text)):
                    mixed = int.from_bytes(hashlib.blake2b(f"{h}:{group}:{k}".encode(), digest_size=8).digest(), "little", signed=True)
                    if mixed >= last[group]:
                        continue
                    coded = classes(text) if coded is None else coded
                    kept[group].append((mixed, window_row(coded, start, min(end - start, SEEN)).tobytes(), min(end - start, SEEN)))
                    if len(kept[group]) >= 2 * sample:
                        kept[group] = sorted(kept[group])[:sample]
                        last[group] = kept[group][-1][0]
        rows = [(x, n, g, h) for g, found in kept.items() for h, x, n in sorted(found)[:sample]]
        out = {c: [r[i] for r in rows] for i, c in enumerate(("x", "n", "g", "h"))}
        yield pa.RecordBatch.from_pydict(out, pa.schema([("x", pa.binary()), ("n", pa.int32()), ("g", pa.int32()), ("h", pa.int64())]))

    found = settle(given.select("text", "h").mapInArrow(run, "x binary, n int, g int, h long"), "windows")
    rows = [r for g in range(FOUND + 1) for r in _smallest(found.filter(F.col("g") == g), sample)]
    x = np.array([np.frombuffer(r.x, np.uint8) for r in rows], np.uint8).reshape(len(rows), WIDTH)
    return x, np.array([r.g for r in rows], int), np.array([r.n for r in rows], int)


def _learn(learner: Learner, texts: list[str | None], pools: list[tuple[np.ndarray, np.ndarray]], seed: int) -> int:
    """Steps over every window of the texts; the number of windows.

    A step takes the candidates without a digit from STEP characters, and of the two rare groups its share of
    those in the texts and REPEATED of the ``pools``, which keep the latest. Each finding comes with its copies.
    The candidates of each group weigh a quarter of a step, the findings half.
    """
    read, r = Read.of(texts, findings=True), np.random.default_rng(seed)
    starts, lengths, owner = read.windows()
    digits = np.flatnonzero((read.coded >= CODES[48]) & (read.coded <= CODES[57]))
    before, after = np.searchsorted(digits, read.spans[:, 1:] + read.offsets[read.spans[:, 0]][:, None] + CONTEXT).T
    marked = (before < after)[owner]
    new = [(window_rows(read.coded, s, n), n) for s, n in ((starts[marked], lengths[marked]), read.findings(texts))]
    starts, lengths = starts[~marked], lengths[~marked]
    steps = max(-(-len(read.coded) // STEP), *[-(-len(n) // (16 * REPEATED)) for _, n in new])
    for k in range(steps if len(starts) + sum(len(n) for _, n in new) else 0):
        i, j = np.searchsorted(starts, [k * STEP, (k + 1) * STEP])
        rare = []
        for (x, n), (old_x, old_n) in zip(new, pools, strict=True):
            again = r.integers(0, len(old_n), REPEATED if len(old_n) else 0)
            rare.append((np.concatenate([x[k::steps], old_x[again]]), np.concatenate([n[k::steps], old_n[again]])))
        near = r.integers(i, j, REPEATED if j > i else 0)  # contexts for copies; they are in the step anyway
        x = np.concatenate([window_rows(read.coded, starts[near], lengths[near]), rare[0][0], rare[1][0]])
        n = np.concatenate([lengths[near], rare[0][1], rare[1][1]])
        x, y, n = (c[len(near):] for c in _varied(x, np.r_[np.zeros(len(x) - len(rare[1][1])), np.ones(len(rare[1][1]))], n, int(r.integers(1 << 31))))
        block = read.coded[k * STEP:(k + 1) * STEP + WIDTH] if j > i else np.zeros(0, np.uint8)
        at = np.concatenate([starts[i:j] - k * STEP, len(block) + np.arange(len(x)) * WIDTH])
        weights = np.concatenate([np.full(j - i, 0.25 / max(j - i, 16 * REPEATED)), np.where(y > 0, 0.5 / max(y.sum(), 1), 0.25 / max((1 - y).sum(), 1))])
        if len(at):
            learner.step(np.concatenate([block, x.ravel()]), at, np.concatenate([lengths[i:j], n]), np.concatenate([np.zeros(j - i), y]), weights)
    for g, (x, n) in enumerate(new):
        pools[g] = tuple(np.concatenate(c)[-KEPT:] for c in zip(pools[g], (x, n), strict=True))
    return len(starts) + sum(len(n) for _, n in new)


def _round(given: DataFrame, net: CharNet, pools: list[tuple[np.ndarray, np.ndarray]], rate: float, turn: int) -> CharNet:
    """Every task learns from all its texts, starting from ``net``; the parameters are averaged, weighed by their windows.

    They are added up in whole steps of 2^-40, so the order of the tasks does not matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner, own, seen = Learner(net.with_values(net.values()), rate), list(pools), 0
        for k, batch in enumerate(slices(batches, "text", BATCH_BYTES)):
            seen += _learn(learner, batch.column("text").to_pylist(), own, 1_000 * turn + k)
        if seen:
            row = learner.net.values()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(row))), pa.array(np.full(len(row), seen)), pa.array(np.rint(row * 2.0 ** 40).astype(np.int64))], ["k", "n", "v"])

    whole = lambda name: F.col(name).cast("decimal(19,0)")
    found = given.select("text").mapInArrow(run, "k long, n long, v long").groupBy("k").agg(F.sum(whole("v") * whole("n")).alias("v"), F.sum("n").alias("n"))
    mixed = sorted(found.collect(), key=lambda r: r.k)
    return net.with_values(np.array([int(r.v) / r.n / 2.0 ** 40 for r in mixed])) if mixed else net


def _logits(given: DataFrame, net: CharNet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lower end of the bin, finding or not, windows) of the logits of every window of the texts, and of the findings' copies."""
    half = int(LARGEST / BIN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 2 * half + 1), np.int64)

        def add(label: int, z: np.ndarray) -> None:
            counts[label] += np.bincount(np.clip(np.floor(z / BIN), -half, half).astype(np.int64) + half, minlength=2 * half + 1)

        for k, batch in enumerate(slices(batches, "text", BATCH_BYTES)):
            texts = batch.column("text").to_pylist()
            read = Read.of(texts, findings=True)
            starts, lengths, _ = read.windows()
            add(0, net.raw(read.coded, starts, lengths))
            at, n = read.findings(texts)
            if len(at):
                near = np.random.default_rng(k).integers(0, len(starts), len(at) if len(starts) else 0)
                x = np.concatenate([window_rows(read.coded, starts[near], lengths[near]), window_rows(read.coded, at, n)])
                x, _, n = _varied(x, np.r_[np.zeros(len(near)), np.ones(len(at))], np.concatenate([lengths[near], n]), k)
                add(1, net.rows(x[len(near):], n[len(near):]))
        label, place = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(label), pa.array(place - half), pa.array(counts[label, place])], ["y", "b", "n"])

    rows = given.select("text").mapInArrow(run, "y long, b long, n long").groupBy("y", "b").agg(F.sum("n").alias("n")).collect()  # two rows a bin at most
    y, b, n = np.array(sorted(map(tuple, rows)), float).reshape(-1, 3).T
    return b * BIN, y, n


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 3_000, recall: float = 0.95) -> CharNet:
    """A network fitted on labelled windows: findings of the fixed patterns against all other candidates.

    A fifth of the texts, by hash, is held out. ``sample`` windows of each group (findings, candidates with a digit,
    candidates without) from about START_BYTES of the others only give the first parameters. Then every window of
    every training text is learned from, by iterative parameter mixing in ROUNDS, each over another share of the
    texts. The scaling and the threshold come from the logits of all held-out windows, counted in bins, so the
    threshold is the lower end of a bin. Without a finding among them all texts stand in for the held-out ones, and
    for the training texts where those lack a label. Without both labels the network finds nothing.
    """
    given = docs.select(F.col(text_col).alias("text"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"))
    share = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), F.col("text")), F.lit(n))
    held, training = given.filter(share(5, 5) == 0), given.filter(share(5, 5) != 0)
    size = training.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    both = lambda groups: (groups == FOUND).any() and (groups != FOUND).any()
    x, groups, n = _first(training.filter(share(11, max(1, size // START_BYTES)) == 0), sample)
    if not both(groups):
        training = given
        x, groups, n = _first(training, sample)
    net = CharNet.fresh()
    if not both(groups):
        return net
    net.fit(*_varied(x, (groups == FOUND).astype(float), n))
    pools = [(x[groups == g], n[groups == g]) for g in (1, FOUND)]
    for turn in range(ROUNDS):
        net = _round(training.filter(share(13, ROUNDS) == turn), net, pools, 0.004 / 2 ** turn, turn)
    z, y, times = _logits(held, net)
    if not y.any():
        z, y, times = _logits(given, net)
    return net.settle(z, y, times, recall)


def scan(docs: DataFrame, net: CharNet, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, added): the spans of each row's whole text as arrays of (kind, start, end), in code points.

    ``base`` are the fixed patterns' findings by start and kind. ``added`` are the candidates outside them whose
    calibrated probability, the highest of their windows, reaches the net's threshold; their kind is "net".
    Null and empty texts have no spans; each row is judged by itself, whatever repeats.
    """
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            read = Read.of(batch.column("text").to_pylist())
            base = [[{"kind": kind, "start": s, "end": e} for s, e, kind in found] for found in read.base]
            added = [[] for _ in base]
            starts, lengths, owner = read.windows()
            best = np.zeros(len(read.spans))
            np.maximum.at(best, owner, net.probability(net.raw(read.coded, starts, lengths)))
            for k, s, e in read.spans[best >= net.threshold].tolist():
                added[k].append({"kind": "net", "start": s, "end": e})
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(base, span), pa.array(added, span)], ["id", "base", "added"])

    kind = "array<struct<kind:string,start:long,end:long>>"
    return given.mapInArrow(run, f"id {given.schema['id'].dataType.simpleString()}, base {kind}, added {kind}")


def _joined(spans) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query()
def op10_secret_charnet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the spans of its secrets."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, train(docs))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    every = F.array_sort(F.concat("base", "added"), lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0))
    return found.select(F.col("id").alias("doc_id"), *[count(k) for k in KINDS], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(every).alias("spans"))
