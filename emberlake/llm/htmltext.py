"""Main-text extraction from HTML with a recurrent block labeller.

A page is a sequence of leaf blocks: runs of text between block-level tags, each with the path of open
elements (tags, classes, ids). A bidirectional LSTM in numpy reads the sequence, a block as hashed vectors of
its path and of its words and a few numbers, and judges each block with the whole page as context. The main
text is the blocks it keeps, joined by newlines.

It is trained here: on labelled pages if given, else on pages whose markup says what a block is (inside
article or main, inside nav, aside, form, or a class or id that names one), together with copies of these
pages in which paths are replaced by other usual ones and blocks are put in, so that one site's markup is not
all it knows, and copies in which telling elements are plain ones and all names are replaced by made ones, so that it
also learns from words, lengths, links and the order of blocks what names do not say.

Scale: training takes at most ``MAX_TRAIN`` pages, those with the least hash of their html, in one task. All
pages are labelled in one pass without shuffle; a task holds ``BATCH_PAGES`` parsed pages at a time.

Defined results: null and empty html, and pages without kept blocks, have empty text; broken markup is read
as far as it goes (unclosed elements end with their parents); repeated rows and null ids are extracted alike;
an empty table gives an empty result; if no page can be trained on, the markup's own rule decides.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import blank_table, hash_words, mix64

# Fixed values of HTML: elements that end a block, that hold no markup, that have no end tag.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav noscript ol optgroup option p pre "
    "section select summary table tbody td template textarea tfoot th thead title tr ul video".split()
)
RAW = frozenset("script style".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag ends an open element of these (and what is open in it), up to the nearest list or table.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table select body html".split())
#: Words in tags, classes and ids by which the markup itself says what is in them.
CONTENT_NAMES = frozenset("article main post entry story".split())
OTHER_NAMES = frozenset(
    "ad ads advert adverts advertisement aside banner breadcrumb breadcrumbs button comment comments consent cookie cookies footer "
    "form head header menu nav navbar navigation newsletter notice popup promo related replies select share sidebar social "
    "sponsor sponsored subscribe textarea title widget".split()
)

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>"[^"]*"|'[^']*'|[^'">])*)>|<(/?)([a-zA-Z][^\s/>]*)()[^>]*>|<[!?/][^>]*>""",
    re.DOTALL,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_SPLIT = re.compile(r"[^a-z0-9]+")

MAX_TRAIN = 400
SEQUENCES = 1500
UNNAMED = 3
BATCH_PAGES = 128
PATH_DIM, WORD_DIM, NUMBERS, HIDDEN = 128, 48, 4, 24
EPOCHS, RATE, TRAIN_BATCH, TRAIN_BLOCKS = 10, 0.01, 32, 60


@dataclass(slots=True)
class Block:
    path: tuple[str, ...]  # from the outermost: tags, classes and ids after their tag
    text: str
    linked: int  # characters inside links


def parse_blocks(page: str | None) -> list[Block]:
    """The leaf blocks in page order, references decoded and white space collapsed."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    linked = links = at = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                path = tuple(n for tag, names in stack if tag in BLOCKS for n in (tag, *names))
                out.append(Block(path, text, min(linked, len(text))))
            pieces.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            piece = html.unescape(raw) if "&" in raw else raw
            pieces.append(piece)
            linked += len(piece) if links else 0

    def pop_to(index: int) -> None:
        nonlocal links
        flush()
        links -= sum(tag == "a" for tag, _ in stack[index:])
        del stack[index:]

    while match := _TAG.search(page, at):
        add(page[at : match.start()])
        at = match.end()
        closing, name = match[1] or match[4], match[2] or match[5]
        if not name:
            continue
        tag = name.lower()
        if closing:
            found = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if found is None:
                if tag in BLOCKS:
                    flush()
            elif tag in BLOCKS:
                pop_to(found)
            elif not any(stack[i][0] in BLOCKS for i in range(found, len(stack))):
                links -= tag == "a"
                del stack[found]
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in BLOCKS:
            flush()
            open_tags = [t for t, _ in stack]
            if "p" in open_tags and tag not in ("button", "option", "optgroup", "select", "textarea", "video"):
                pop_to(open_tags.index("p"))
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ENDS.get(tag, ()):
                    pop_to(i)
                    break
                if stack[i][0] in SCOPES:
                    break
        if tag == "br":
            pieces.append(" ")
        if tag in VOID or (match[3] or "").endswith("/") and tag not in BLOCKS:
            continue
        names = tuple(w for m in _NAMES.findall(match[3] or "") for w in _SPLIT.split(m.strip("\"'").lower()) if w)
        links += tag == "a"
        stack.append((tag, tuple("." + w for w in names)))
    add(page[at:])
    flush()
    return out


def markup_label(path: tuple[str, ...]) -> int | None:
    """What the innermost telling name of a path says: 1 main text, 0 other, None nothing."""
    for name in reversed(path):
        word = name.lstrip(".")
        if word in OTHER_NAMES:
            return 0
        if word in CONTENT_NAMES:
            # Reader comments are often articles of their own.
            return 0 if {"comment", "comments", "replies"} & {n.lstrip(".") for n in path} else 1
    return None


def _hash_names(names: list[str]) -> np.ndarray:
    table = blank_table()
    hashes, starts = hash_words(pa.array([n.replace(" ", "_") for n in names], pa.large_string()), table)
    out = np.zeros(len(names), np.uint64)
    some = np.diff(starts) > 0
    out[some] = hashes[starts[:-1][some]]
    return out


def vectors(blocks: list[Block]) -> np.ndarray:
    """One row per block: hashed path (inner elements weigh more), hashed words, and four numbers."""
    out = np.zeros((len(blocks), PATH_DIM + WORD_DIM + NUMBERS), np.float32)
    if not blocks:
        return out
    names = sorted({n for b in blocks for n in b.path})
    hashed = dict(zip(names, _hash_names(names).tolist(), strict=True)) if names else {}
    for row, block in zip(out, blocks, strict=True):
        for depth, name in enumerate(reversed(block.path)):
            h = hashed[name]
            row[(h >> 8) % PATH_DIM] += (1.0 if h & 1 else -1.0) * (1.0 if depth < 4 else 0.5)
    words, starts = hash_words(pa.array([b.text for b in blocks], pa.large_string()), blank_table())
    words = mix64(words + np.uint64(1))
    owner = np.repeat(np.arange(len(blocks)), np.diff(starts))
    slot = owner * WORD_DIM + ((words >> np.uint64(8)) % np.uint64(WORD_DIM)).astype(np.int64)
    sign = np.where(words & np.uint64(1), 1.0, -1.0)
    sums = np.bincount(slot, sign, minlength=len(blocks) * WORD_DIM).reshape(len(blocks), WORD_DIM)
    out[:, PATH_DIM : PATH_DIM + WORD_DIM] = sums / np.maximum(1, np.sqrt((sums * sums).sum(axis=1)))[:, None]
    size = np.array([len(b.text) for b in blocks], float)
    ends = np.array([b.text[-1] in ".!?…:;\"”" for b in blocks], float)
    out[:, -4:] = np.stack([np.log1p(size) / 6, np.log1p(np.diff(starts)) / 5, [b.linked / len(b.text) for b in blocks], ends], axis=1)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM with a logistic output for each step."""

    def __init__(self, inputs: int, hidden: int = HIDDEN, seed: int = 1):
        random = np.random.default_rng(seed)
        self.hidden = hidden
        self.weights = {}
        for side in ("f", "b"):
            self.weights[f"x{side}"] = random.normal(0, 1 / np.sqrt(inputs), (inputs, 4 * hidden)).astype(np.float32)
            self.weights[f"h{side}"] = random.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden)).astype(np.float32)
            self.weights[f"c{side}"] = np.zeros(4 * hidden, np.float32)
            self.weights[f"c{side}"][hidden : 2 * hidden] = 1  # remember at first
        self.weights["o"] = random.normal(0, 0.1, 2 * hidden).astype(np.float32)
        self.weights["oc"] = np.zeros(1, np.float32)

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str) -> tuple[np.ndarray, list]:
        """Hidden states of (time, page, input); a page keeps its state where the mask is 0."""
        h = self.hidden
        steps, pages, _ = x.shape
        projected = x @ self.weights[f"x{side}"] + self.weights[f"c{side}"]
        state, cell = np.zeros((pages, h), np.float32), np.zeros((pages, h), np.float32)
        out, kept = np.zeros((steps, pages, h), np.float32), []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            gates = projected[t] + state @ self.weights[f"h{side}"]
            i, f, o = (_sigmoid(gates[:, k * h : (k + 1) * h]) for k in range(3))
            g = np.tanh(gates[:, 3 * h :])
            m = mask[t][:, None]
            new = f * cell + i * g
            tanh = np.tanh(new)
            kept.append((t, i, f, o, g, cell, tanh, state, m))
            cell = m * new + (1 - m) * cell
            state = m * (o * tanh) + (1 - m) * state
            out[t] = state
        return out, kept

    def _back(self, x: np.ndarray, kept: list, grad: np.ndarray, side: str, into: dict) -> None:
        h = self.hidden
        d_gates = np.zeros((x.shape[0], x.shape[1], 4 * h), np.float32)
        d_state, d_cell = np.zeros_like(kept[0][5]), np.zeros_like(kept[0][5])
        into[f"h{side}"] = np.zeros_like(self.weights[f"h{side}"])
        for t, i, f, o, g, cell, tanh, state, m in reversed(kept):
            d = (d_state + grad[t]) * m
            passed = (d_state + grad[t]) * (1 - m)
            d_new = d * o * (1 - tanh * tanh) + d_cell * m
            parts = (d_new * g * i * (1 - i), d_new * cell * f * (1 - f), d * tanh * o * (1 - o), d_new * i * (1 - g * g))
            d_gates[t] = np.concatenate(parts, axis=1)
            into[f"h{side}"] += state.T @ d_gates[t]
            d_state = d_gates[t] @ self.weights[f"h{side}"].T + passed
            d_cell = d_new * f + d_cell * (1 - m)
        flat = d_gates.reshape(-1, 4 * h)
        into[f"x{side}"] = x.reshape(-1, x.shape[2]).T @ flat
        into[f"c{side}"] = flat.sum(axis=0)

    @staticmethod
    def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        steps = max(len(p) for p in pages)
        x = np.zeros((steps, len(pages), pages[0].shape[1]), np.float32)
        mask = np.zeros((steps, len(pages)), np.float32)
        for i, page in enumerate(pages):
            x[: len(page), i] = page
            mask[: len(page), i] = 1
        return x, mask

    def probabilities(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Of each block of each page. Pages of like length are run together."""
        out: list[np.ndarray] = [np.empty(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            to = at + 1
            while to < len(order) and (to + 1 - at) * len(pages[order[to]]) <= 8192:
                to += 1
            some = order[at:to]
            x, mask = self.padded([pages[i] for i in some])
            forward, _ = self._run(x, mask, "f")
            backward, _ = self._run(x, mask, "b")
            chance = _sigmoid(np.concatenate((forward, backward), axis=2) @ self.weights["o"] + self.weights["oc"])
            for column, i in enumerate(some):
                out[i] = chance[: len(pages[i]), column]
            at = to
        return out

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS, rate: float = RATE, batch: int = TRAIN_BATCH) -> None:
        """Adam on the mean cross-entropy. A label below 0 is not learnt from."""
        moment = {k: (np.zeros_like(w), np.zeros_like(w)) for k, w in self.weights.items()}
        step = 0
        for epoch in range(epochs):
            random = np.random.default_rng(epoch)
            order = sorted(random.permutation(len(pages)), key=lambda i: len(pages[i]))
            starts = np.arange(0, len(order), batch)
            for at in random.permutation(starts):
                some = order[at : at + batch]
                x, mask = self.padded([pages[i] for i in some])
                y, use = np.zeros_like(mask), np.zeros_like(mask)
                for column, i in enumerate(some):
                    y[: len(labels[i]), column] = labels[i] == 1
                    use[: len(labels[i]), column] = labels[i] >= 0
                if not use.any():
                    continue
                grads: dict[str, np.ndarray] = {}
                forward, kept_f = self._run(x, mask, "f")
                backward, kept_b = self._run(x, mask, "b")
                both = np.concatenate((forward, backward), axis=2)
                error = (_sigmoid(both @ self.weights["o"] + self.weights["oc"]) - y) * use / use.sum()
                grads["o"] = np.tensordot(error, both, axes=([0, 1], [0, 1]))
                grads["oc"] = np.array([error.sum()])
                d = error[:, :, None] * self.weights["o"]
                self._back(x, kept_f, d[:, :, : self.hidden], "f", grads)
                self._back(x, kept_b, d[:, :, self.hidden :], "b", grads)
                step += 1
                for key, grad in grads.items():
                    first, second = moment[key]
                    np.clip(grad, -1, 1, out=grad)
                    first += 0.1 * (grad - first)
                    second += 0.001 * (grad * grad - second)
                    move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
                    self.weights[key] = (self.weights[key] - move).astype(np.float32)


#: Usual paths of main text and of the rest, for training copies.
_MAIN_PATHS = [
    ("main", "article"), ("main",), ("article",), ("div", ".content"), ("div", ".main", "div", ".post"), ("div", ".entry", ".content"),
    ("main", "section"), ("div", ".container", "article"), ("article", "section"), ("section", ".story"), ("div", ".wrapper", "main", "article"),
]
_OTHER_PATHS = [
    ("nav", "ul", "li"), ("header",), ("header", "div"), ("footer",), ("footer", "div"), ("aside",), ("aside", ".sidebar"), ("div", ".sidebar"),
    ("div", ".ad"), ("div", ".advert"), ("div", ".ads"), ("form",), ("form",), ("form", "fieldset"), ("div", ".cookie", ".notice"), ("div", ".notice"),
    ("div", ".banner"), ("section", ".comments"), ("div", ".comments", "div", ".comment"), ("section", ".comments", "article"), ("ul", ".menu", "li"),
    ("div", ".menu"), ("div", ".newsletter", "form"), ("div", ".related", "ul", "li"), ("div", ".share"), ("div", ".promo"), ("div", ".popup"),
    ("div", ".breadcrumb"), ("div", ".header"), ("div", ".footer"), ("div", ".navigation", "ul", "li"), ("div", ".widget"), ("div", ".social"),
    ("div", ".comments", "ul", "li", "p"), ("button",), ("select", "option"), ("section", ".comments", "p"), ("aside", "p"), ("div", ".sponsored", "p"),
]
_LEAVES = [("p",), ("h1",), ("h2",), ("h3",), ("ul", "li"), ("ol", "li"), ("blockquote",), ("blockquote", "p"), ("pre",), ("table", "tr", "td"), ("figure", "figcaption"), ("div",)]
_INNER = [("p",), ("p",), ("div",), ("div", "p"), ("h3",), ("ul", "li")]


def _varied(blocks: list[Block], labels: list[int], others: list[str], random: np.random.Generator) -> tuple[list[Block], list[int]]:
    """A copy of a page with other paths, and with blocks put in that are not main text."""
    base = ("html", "body") if random.random() < 0.8 else ("html", "body", "div", ".page")
    main = base + _MAIN_PATHS[random.integers(len(_MAIN_PATHS))]
    out, marks = [], []

    def inner() -> tuple[str, ...]:
        return _INNER[random.integers(len(_INNER))] if random.random() < 0.5 else ()

    def put() -> None:
        # Inside the main text's element or outside it.
        root = main if random.random() < 0.4 else base
        path = root + _OTHER_PATHS[random.integers(len(_OTHER_PATHS))] + inner()
        for _ in range(random.integers(1, 4)):
            words = others[random.integers(len(others))]
            text = words if random.random() < 0.5 else " ".join(words.split()[: random.integers(1, 8)])
            if text:
                out.append(Block(path, text, len(text) if random.random() < 0.3 else 0))
                marks.append(0)

    leaf = _LEAVES[0]
    for block, label in zip(blocks, labels, strict=True):
        if random.random() < 0.15:
            put()
        if label == 1:
            if random.random() < 0.3:  # a list or table goes on for some blocks
                leaf = _LEAVES[random.integers(len(_LEAVES))] if random.random() < 0.5 else _LEAVES[0]
            path = main if random.random() < 0.05 else main + leaf
        else:
            path = (main if random.random() < 0.2 else base) + _OTHER_PATHS[random.integers(len(_OTHER_PATHS))] + inner()
        text = block.text if random.random() < 0.8 else " ".join(block.text.split()[: random.integers(1, 6)])
        out.append(Block(path, text, min(block.linked, len(text))))
        marks.append(label)
    put()
    return out, marks


#: Elements that say nothing about whether a block is main text.
_PLAIN = frozenset("html body div p ul ol li dl dt dd table tr td th h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption".split())


def unnamed(blocks: list[Block], random: np.random.Generator) -> list[Block]:
    """The page with divisions for its telling elements and, for each class or id, one made name or none."""
    names = sorted({n for b in blocks for n in b.path if n.startswith(".")})
    made = {n: f".{chr(97 + random.integers(26))}{random.integers(1 << 20):x}" if random.random() < 0.5 else "" for n in names}

    def path(old: tuple[str, ...]) -> tuple[str, ...]:
        new = (made[n] if n.startswith(".") else n if n in _PLAIN else "div" for n in old)
        return tuple(n for n in new if n)

    return [Block(path(b.path), b.text, b.linked) for b in blocks]


def fit_pages(pages: list[list[Block]], labels: list[list[int]], copies: int | None = None, seed: int = 1) -> Labeller:
    """A labeller from parsed pages with a label for each block (below 0: unknown), and varied copies: at
    least 3 of each page, more of few pages."""
    copies = max(3, -(-SEQUENCES // max(1, len(pages)))) if copies is None else copies
    random = np.random.default_rng(seed)
    others = [b.text for blocks in pages for b in blocks[:6]] or [""]
    x, y = [], []
    for blocks, marks in zip(pages, labels, strict=True):
        versions = [(blocks, marks)] + [_varied(blocks, marks, others, random) for _ in range(copies)]
        versions += [(unnamed(blocks, random), marks) for _ in range(UNNAMED)]
        for own, own_marks in versions:
            if own:
                cut = max(0, len(own) - TRAIN_BLOCKS)
                at = int(random.integers(cut + 1))
                x.append(vectors(own)[at : at + TRAIN_BLOCKS])
                y.append(np.array(own_marks[at : at + TRAIN_BLOCKS]))
    model = Labeller(PATH_DIM + WORD_DIM + NUMBERS)
    model.fit(x, y)
    return model


def train(pages: DataFrame, html_col: str = "html", max_train: int = MAX_TRAIN) -> Labeller | None:
    """Trained in one task on at most ``max_train`` pages by what their markup says; None if it says nothing."""
    import pickle

    rows = pages.select(F.col(html_col).alias("html")).filter("length(html) > 0")
    hashes = rows.select(F.xxhash64("html").alias("h")).distinct().orderBy("h").limit(max_train)
    picked = rows.join(F.broadcast(hashes), F.xxhash64("html") == F.col("h")).dropDuplicates(["h"])

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        parsed, labels = [], []
        for page in part.sort_values("h")["html"]:
            blocks = parse_blocks(page)
            marks = [markup_label(b.path) for b in blocks]
            if 1 in marks and 0 in marks:
                parsed.append(blocks)
                labels.append([-1 if m is None else m for m in marks])
        if not parsed:
            return pd.DataFrame({"model": pd.Series([], dtype=object)})
        return pd.DataFrame({"model": [pickle.dumps(fit_pages(parsed, labels).weights)]})

    found = picked.groupBy(F.lit(1).alias("one")).applyInPandas(learn, "model binary").collect()
    if not found:
        return None
    model = Labeller(PATH_DIM + WORD_DIM + NUMBERS)
    model.weights = pickle.loads(found[0]["model"])
    return model


def extract(pages: DataFrame, model: Labeller | None, html_col: str = "html", threshold: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``pages`` (all but the html unless named), text and n_chars, which replace
    columns of these names."""
    keep = [c for c in (pages.columns if keep is None else keep) if c.lower() not in (html_col.lower(), "text", "n_chars")]
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_PAGES):
                part = batch.slice(at, BATCH_PAGES)
                parsed = [parse_blocks(page) for page in part.column(part.num_columns - 1).to_pylist()]
                if labeller is None:
                    kept = [np.array([markup_label(b.path) == 1 for b in blocks], bool) for blocks in parsed]
                else:
                    ends = np.r_[0, np.cumsum([len(b) for b in parsed])]
                    x = vectors([b for blocks in parsed for b in blocks])
                    chances = labeller.probabilities([x[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)])
                    kept = [c >= threshold for c in chances]
                texts = ["\n".join(b.text for b, k in zip(blocks, ok, strict=True) if k) for blocks, ok in zip(parsed, kept, strict=True)]
                yield pa.record_batch(
                    [*(part.column(i) for i in range(len(keep))), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=[*keep, "text", "n_chars"],
                )

    schema = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in keep)
    return pages.select(*keep, F.col(html_col)).mapInArrow(run, f"{schema}text string, n_chars long")
