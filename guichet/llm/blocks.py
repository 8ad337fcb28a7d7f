"""The main text of web pages: leaf blocks, labelled by a bidirectional LSTM that reads the whole page."""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle
from .common import slices
from .layouts import MAIN, SKIP, varied_page
from .registry import query, table

# How HTML names its elements.
BLOCKS = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
UNSEEN = frozenset("template svg select object canvas audio video datalist map".split())
#: What an opening tag ends, up to the elements after the bar.
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}
#: Opening one of these ends an open paragraph.
ENDS_P = BLOCKS - {"button", "body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option", "legend", "dd", "dt", "li"} | {"li", "dd", "dt"}
FRAMES = frozenset("button table caption td th html body article section div main aside nav footer header form fieldset blockquote details figure ul ol dl".split())

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
RAW_END = {name: re.compile(f"</{name}(?=[\\s/>]|\\Z)", re.I) for name in RAW}

PATH_SLOTS, WORD_SLOTS = 1_024, 2_048
PATH_SIZE, WORD_SIZE, FACTS, HIDDEN = 16, 8, 8, 20
#: Pages that the labeller is fitted on at most, and how many rearranged copies each gives.
SAMPLE, COPIES = 400, 3
#: Bytes of pages that a task reads together, and block places of a padded group of pages.
BATCH_BYTES, PLACES = 4_000_000, 16_384


def slot(token: str, slots: int) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) % slots


@dataclass
class Leaf:
    """A stretch of text without block elements inside: its decoded text, the tokens of the elements around it, and how much is link text."""

    text: str
    path: frozenset[str]
    linked: float


def _tokens(name: str, attributes: str) -> frozenset[str]:
    """An element as tokens: its name, and the parts of its class, id and role."""
    out = {f"<{name}>"}
    if "=" in attributes:
        for _, a, b, c in ATTRIBUTE.findall(attributes):
            out.update(p.lower() for p in PIECE.findall(a or b or c))
    return frozenset(out)


def leaves(page: str | None) -> list[Leaf]:
    """The text blocks of a page in order; no text outside scripts, styles, hidden elements, comments and tags is lost.

    A block ends where a block element begins or ends. Character references are decoded, white space inside a
    block becomes one blank, ``<br>`` too; blocks without other characters are left out. Broken markup is read as
    browsers do where that matters here: unclosed paragraphs and list items end at the next one, an end tag closes
    everything inside its element, and one without its element is ignored. A tag that the page ends in is dropped.
    """
    page = page or ""
    out: list[Leaf] = []
    stack: list[tuple[str, frozenset[str]]] = []  # name, tokens of the path down to it
    nothing: frozenset[str] = frozenset()
    parts: list[str] = []
    linked = links = unseen = at = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                path = stack[-1][1] if stack else nothing
                out.append(Leaf(text, path | {f"/{block}"} if (block := next((n for n, _ in reversed(stack) if n in BLOCKS), None)) else path, min(1.0, linked / len(raw))))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not unseen:
            parts.append(text)
            if links:
                linked += len(text)

    def pop() -> None:
        nonlocal links, unseen
        name, _ = stack.pop()
        links -= name == "a"
        unseen -= name in UNSEEN

    while at < len(page):
        begin = page.find("<", at)
        if begin < 0:
            add(page[at:])
            break
        add(page[at:begin])
        m = TAG.match(page, begin)
        if m is None:  # not a tag
            add("<")
            at = begin + 1
            continue
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if name in BLOCKS:
            flush()
        elif name == "br":
            add(" ")
        if m[1]:
            if any(n == name for n, _ in reversed(stack)):
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if name in RAW:
            end = RAW_END[name].search(page, at)
            at = end.start() if end else len(page)
            continue
        if name in VOID:
            continue
        inner, outer = CLOSES.get(name, (nothing, nothing))
        if name in ENDS_P and not inner:
            inner, outer = frozenset({"p"}), FRAMES
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in inner:
                while len(stack) > k:
                    pop()
                break
            if stack[k][0] in outer:
                break
        above = stack[-1][1] if stack else nothing
        own = _tokens(name, m[3])
        stack.append((name, above if own <= above else above | own))
        links += name == "a"
        unseen += name in UNSEEN
    flush()
    return out


@dataclass
class Page:
    """What the network reads of a page: per block the slots of its path and words, and its facts; labels if known."""

    paths: list[np.ndarray]
    words: list[np.ndarray]
    facts: np.ndarray
    labels: np.ndarray | None = None


class Reader:
    """Leaves as slots and numbers. Slots of words and paths seen before are remembered, up to a bound."""

    def __init__(self):
        self.word_slots: dict[str, int] = {}
        self.path_slots: dict[frozenset[str], np.ndarray] = {}

    def page(self, found: list[Leaf]) -> Page:
        if len(self.word_slots) > 1 << 18:
            self.word_slots.clear()
        if len(self.path_slots) > 1 << 14:
            self.path_slots.clear()
        paths, words, facts = [], [], np.zeros((len(found), FACTS), np.float32)
        for k, leaf in enumerate(found):
            if (path := self.path_slots.get(leaf.path)) is None:
                path = np.array(sorted({slot(t, PATH_SLOTS) for t in leaf.path - {MAIN, SKIP}}), np.int64)
                self.path_slots[leaf.path] = path
            paths.append(path)
            text = leaf.text
            split = text.lower().split(" ")
            known = self.word_slots
            words.append(np.array([known[w] if w in known else known.setdefault(w, slot(w, WORD_SLOTS)) for w in split], np.int64))
            n = len(text)
            facts[k] = (np.log1p(n) / 8, np.log1p(len(split)) / 6, leaf.linked, sum(map(text.count, ".,;:!?")) / n * 10, text[-1] in ".!?…", sum(map(text.count, "0123456789")) / n * 5, k / len(found), min(k, len(found) - 1 - k, 10) / 10)
        return Page(paths, words, facts)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class BlockLabeller:
    """Embeddings of path and word slots, an LSTM in each direction, and for every block a logistic output of both states and its own input."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(seed: int = 1) -> BlockLabeller:
        r, width = np.random.default_rng(seed), PATH_SIZE + WORD_SIZE + FACTS
        w = {"path": r.normal(0, 0.1, (PATH_SLOTS, PATH_SIZE)), "word": r.normal(0, 0.1, (WORD_SLOTS, WORD_SIZE)), "out": r.normal(0, 0.2, (2 * HIDDEN,)), "direct": np.zeros(width), "shift": np.zeros(1)}
        for side in "fb":
            w[f"x{side}"] = r.normal(0, width ** -0.5, (width, 4 * HIDDEN))
            w[f"h{side}"] = r.normal(0, HIDDEN ** -0.5, (HIDDEN, 4 * HIDDEN))
            w[f"c{side}"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)  # input, forget, output, candidate
        return BlockLabeller({k: v.astype(np.float32) for k, v in w.items()})

    def _inputs(self, pages: list[Page]) -> np.ndarray:
        """Inputs of all blocks of the pages, one after another: sum of path vectors, mean of word vectors, facts."""
        paths, words = [p for page in pages for p in page.paths], [x for page in pages for x in page.words]
        out = np.zeros((len(paths), PATH_SIZE + WORD_SIZE + FACTS), np.float32)
        for lists, name, at, size in ((paths, "path", 0, PATH_SIZE), (words, "word", PATH_SIZE, WORD_SIZE)):
            lengths = np.array([len(x) for x in lists])
            some = np.flatnonzero(lengths)
            for i in range(0, len(some), 512):  # bounded by 512 blocks
                part = some[i:i + 512]
                starts = np.r_[0, np.cumsum(lengths[part])[:-1]]
                out[part, at:at + size] = np.add.reduceat(self.weights[name][np.concatenate([lists[k] for k in part])], starts)
            if name == "word":
                out[:, at:at + size] /= np.maximum(lengths, 1)[:, None]
        out[:, PATH_SIZE + WORD_SIZE:] = np.concatenate([page.facts for page in pages])
        return out

    def _read(self, x: np.ndarray, mask: np.ndarray, side: str, keep: bool = False):
        """Hidden states (T, B, h) of one direction over padded inputs (T, B, width); outside the mask the state stays."""
        wx, wh, c0 = (self.weights[k + side] for k in "xhc")
        steps, rows, n = len(x), x.shape[1], HIDDEN
        h, c = np.zeros((rows, n), np.float32), np.zeros((rows, n), np.float32)
        states = np.zeros((steps, rows, n), np.float32)
        kept = []
        order = range(steps) if side == "f" else range(steps - 1, -1, -1)
        for t in order:
            z = x[t] @ wx + h @ wh + c0
            gates, new = _sigmoid(z[:, :3 * n]), np.tanh(z[:, 3 * n:])
            i, f, o, m = gates[:, :n], gates[:, n:2 * n], gates[:, 2 * n:], mask[t][:, None]
            c_next = f * c + i * new
            flat = np.tanh(c_next)
            if keep:
                kept.append((t, h, c, i, f, o, new, flat))
            c, h = np.where(m, c_next, c), np.where(m, o * flat, h)
            states[t] = h
        return states, kept

    def _output(self, states: np.ndarray, own: np.ndarray) -> np.ndarray:
        return _sigmoid(states @ self.weights["out"] + own @ self.weights["direct"] + self.weights["shift"])

    @staticmethod
    def _padded(lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """mask (T, B), and the place of every block in the padded order."""
        mask = np.arange(max(lengths))[:, None] < np.array(lengths)
        places = np.concatenate([np.arange(n) * len(lengths) + k for k, n in enumerate(lengths)])
        return mask, places

    def probabilities(self, pages: list[Page]) -> list[np.ndarray]:
        """For every page the probability of each block to be main text. Pages of like length are read together, padded to bounded groups."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((k for k in range(len(pages)) if pages[k].paths), key=lambda k: len(pages[k].paths))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end + 1 - at) * len(pages[order[end]].paths) <= PLACES:
                end += 1
            group = [pages[k] for k in order[at:end]]
            lengths = [len(p.paths) for p in group]
            mask, places = self._padded(lengths)
            x = np.zeros((mask.size, PATH_SIZE + WORD_SIZE + FACTS), np.float32)
            x[places] = own = self._inputs(group)
            x = x.reshape(*mask.shape, -1)
            both = np.concatenate([self._read(x, mask, s)[0] for s in "fb"], 2).reshape(mask.size, -1)[places]
            p = self._output(both, own)
            for k, part in zip(order[at:end], np.split(p, np.cumsum(lengths)[:-1]), strict=True):
                out[k] = part
            at = end
        return out

    def gradients(self, pages: list[Page], weights: np.ndarray | None = None) -> tuple[float, dict[str, np.ndarray]]:
        """The mean logistic loss over the blocks of labelled pages, and its gradients through time."""
        lengths = [len(p.paths) for p in pages]
        mask, places = self._padded(lengths)
        flat_x = np.zeros((mask.size, PATH_SIZE + WORD_SIZE + FACTS), np.float32)
        flat_x[places] = own = self._inputs(pages)
        x = flat_x.reshape(*mask.shape, -1)
        (hf, kf), (hb, kb) = (self._read(x, mask, s, keep=True) for s in "fb")
        both = np.concatenate([hf, hb], 2).reshape(mask.size, -1)[places]
        p = self._output(both, own)
        y = np.concatenate([page.labels for page in pages])
        loss = float(-np.mean(y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7)))
        err = (p - y) / len(y)
        g = {"out": both.T @ err, "direct": own.T @ err, "shift": np.array([err.sum()])}
        back = np.zeros((mask.size, 2 * HIDDEN), np.float32)
        back[places] = err[:, None] * self.weights["out"]
        back = back.reshape(*mask.shape, -1)
        dx = np.zeros_like(x)
        for side, kept, part in (("f", kf, back[:, :, :HIDDEN]), ("b", kb, back[:, :, HIDDEN:])):
            wx, wh = self.weights[f"x{side}"], self.weights[f"h{side}"]
            gx, gh, gc = np.zeros_like(wx), np.zeros_like(wh), np.zeros(4 * HIDDEN, np.float32)
            dh = dc = np.zeros((mask.shape[1], HIDDEN), np.float32)
            for t, h, c, i, f, o, new, flat in reversed(kept):
                m = mask[t][:, None]
                now = dh + part[t]
                dh_in, dc_in = now * m, dc * m
                dct = dc_in + dh_in * o * (1 - flat * flat)
                dz = np.concatenate([dct * new * i * (1 - i), dct * c * f * (1 - f), dh_in * flat * o * (1 - o), dct * i * (1 - new * new)], 1)
                gx += x[t].T @ dz
                gh += h.T @ dz
                gc += dz.sum(0)
                dx[t] += dz @ wx.T
                dh, dc = dz @ wh.T + now * ~m, dct * f + dc * ~m
            g |= {f"x{side}": gx, f"h{side}": gh, f"c{side}": gc}
        dflat = dx.reshape(mask.size, -1)[places] + err[:, None] * self.weights["direct"]
        paths, words = [q for page in pages for q in page.paths], [q for page in pages for q in page.words]
        for lists, name, at, size in ((paths, "path", 0, PATH_SIZE), (words, "word", PATH_SIZE, WORD_SIZE)):
            n = np.array([len(q) for q in lists])
            per = dflat[:, at:at + size] / (np.maximum(n, 1)[:, None] if name == "word" else 1)
            g[name] = np.zeros_like(self.weights[name])
            np.add.at(g[name], np.concatenate(lists), np.repeat(per, n, 0))
        return loss, g

    def fit(self, pages: list[Page], epochs: int = 12, batch: int = 16, rate: float = 0.01, drop: float = 0.2, seed: int = 2) -> BlockLabeller:
        """Adam, pages of like length together. In each step a share of the pages loses its words, or a smaller one its paths, so that neither alone decides."""
        r = np.random.default_rng(seed)
        pages = sorted((p for p in pages if p.paths), key=lambda p: len(p.paths))
        m, v, t = {k: 0.0 for k in self.weights}, {k: 0.0 for k in self.weights}, 0
        none = np.zeros(0, np.int64)
        steps = [pages[i:i + batch] for i in range(0, len(pages), batch)]
        for epoch in range(epochs):
            now = rate * (1 - epoch / epochs) + rate / 20
            for k in r.permutation(len(steps)):
                seen = []
                for page, u in zip(steps[k], r.random(len(steps[k])), strict=True):
                    seen.append(Page([none] * len(page.paths) if u < drop / 4 else page.paths, [none] * len(page.words) if drop / 4 <= u < drop else page.words, page.facts, page.labels))
                _, g = self.gradients(seen)
                norm = sum(float((x * x).sum()) for x in g.values()) ** 0.5
                t += 1
                for name, x in g.items():
                    x = x * min(1.0, 1.0 / max(norm, 1e-9))
                    m[name] = 0.9 * m[name] + 0.1 * x
                    v[name] = 0.999 * v[name] + 0.001 * x * x
                    self.weights[name] = (self.weights[name] - now * (m[name] / (1 - 0.9 ** t)) / (np.sqrt(v[name] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
        return self


#: Elements that mark main text, and names that mark something else inside it.
MAIN_NAMES = frozenset({"<article>", "<main>"})
OTHER_NAMES = frozenset("<nav> <aside> <footer> <form> <button> ad ads advert advertisement comments comment sidebar menu share related".split())


def labelled(found: list[Leaf]) -> np.ndarray | None:
    """1 for blocks that the page's own elements mark as main text, 0 for the others; None where the page marks none."""
    if not any(MAIN_NAMES & leaf.path for leaf in found):
        return None
    return np.array([bool(MAIN_NAMES & leaf.path) and not OTHER_NAMES & leaf.path for leaf in found], np.float32)


def training_pages(page: str, seed: int, copies: int = COPIES) -> list[Page]:
    """A labelled page as the network reads it, and copies of its blocks in other layouts with labels of their own; none for a page without labels."""
    found = leaves(page)
    labels = labelled(found)
    if labels is None:
        return []
    read = Reader()
    first = read.page(found)
    first.labels = labels
    out = [first, first]  # seen twice: its markup decides where it is given
    main, other = ([leaf.text for leaf, y in zip(found, labels, strict=True) if bool(y) is kind] for kind in (True, False))
    for k in range(copies):
        made = leaves(varied_page(main, other, np.random.default_rng([seed, k])))
        variant = read.page(made)
        variant.labels = np.array([MAIN in leaf.path and SKIP not in leaf.path for leaf in made], np.float32)
        out.append(variant)
    return out


def sample_pages(pages: DataFrame, id_col: str, html_col: str, sample: int) -> list[str]:
    """The ``sample`` pages with the smallest hashes. A cut of the hashes leaves about twice as many before they are sorted."""
    given = pages.select(F.col(html_col).alias("html"), F.xxhash64(F.col(id_col), F.col(html_col)).alias("h")).filter(F.length("html") > 0)
    hashes = settle(given.select("h"), "page-hashes")
    n = hashes.count()
    cut = F.col("h") <= F.lit(min((1 << 63) - 1, -(1 << 63) + (1 << 64) * (2 * sample + 100) // max(n, 1)))
    last = hashes.filter(cut).orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    rows = given.filter(F.col("h") <= F.lit(last)).orderBy("h", "html").limit(sample) if last is not None else given.limit(0)
    return [r.html for r in rows.select("html").collect()]


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE, copies: int = COPIES) -> BlockLabeller:
    """A labeller fitted on ``sample`` pages that mark their main text themselves, and on their blocks in ``copies`` other layouts.

    Without any such page the copies of built-in phrases teach it, so that it still knows common layouts.
    """
    made: list[Page] = []
    for k, page in enumerate(sample_pages(pages, id_col, html_col, sample)):
        made += training_pages(page, k, copies)
    if not made:
        text = " ".join(f"word{i}" for i in range(40)) + "."
        made = [p for k in range(60) for p in training_pages(f"<body><article>{f'<p>{text}</p>' * (2 + k % 5)}</article></body>", k, copies)]
    return BlockLabeller.fresh().fit(made)


def main_text(pages: DataFrame, labeller: BlockLabeller, id_col: str = "page_id", html_col: str = "html", least: float = 0.5) -> DataFrame:
    """(id, text, n_blocks, n_kept) for every row: its blocks with a probability of ``least`` or more, in page order, one a line.

    Every block of the whole page is judged; none is cut. Null and empty pages have the empty text. Each row is
    judged by itself, whatever repeats, so nothing is shuffled.
    """
    given = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader()
        for batch in slices(batches, "html", BATCH_BYTES):
            found = [leaves(page) for page in batch.column("html").to_pylist()]
            chances = labeller.probabilities([read.page(page) for page in found])
            kept = [[leaf.text for leaf, p in zip(page, chance.tolist(), strict=True) if p >= least] for page, chance in zip(found, chances, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(["\n".join(k) for k in kept], pa.string()), pa.array([len(p) for p in found], pa.int64()), pa.array([len(k) for k in kept], pa.int64())], ["id", "text", "n_blocks", "n_kept"])

    return given.mapInArrow(run, f"id {given.schema['id'].dataType.simpleString()}, text string, n_blocks long, n_kept long")


@query()
def op11_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    pages = table(spark, sf_dir, "pages")
    key = F.struct("page_id", "url")  # the url stays with its page
    found = main_text(pages.select(key.alias("page"), "html"), train(pages), "page")
    return found.select("id.page_id", "id.url", "text", F.length("text").cast("long").alias("n_chars"))
