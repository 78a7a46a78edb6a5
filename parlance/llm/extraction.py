"""Main text of web pages by a recurrent labeller of leaf blocks.

A page becomes its sequence of leaf blocks: runs of text between block-level tags. Each block is a vector of its
hashed tag path (names, classes and ids of the elements around it), its hashed words and a few shape figures. A
bidirectional LSTM in numpy reads the whole sequence both ways and labels every block as main text or not, so a block
is judged by its place in the document. It is trained at run time on a bounded sample of the pages themselves: blocks are
labelled by the meaning of the tags around them, and sections that pages may carry (menus, comments, notices, forms
and the like, under various tags and class names) are mixed in so that the network also knows those.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose content is no text, that hold no content, and that do not end a block.
HIDDEN = frozenset("script style noscript template svg math iframe object canvas textarea select option datalist head title".split())
RAW = frozenset("script style textarea title iframe noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small
span strike strong sub sup time tt u var br wbr img""".split())
#: Elements that end an open one of the same group, as HTML's optional end tags say.
CLOSES = {**dict.fromkeys(("li",), ("li",)), **dict.fromkeys(("dt", "dd"), ("dt", "dd")), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
ENDS_P = frozenset("""address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main
menu nav ol p pre section table ul""".split())
SCOPES = frozenset("article aside body div footer form header html main nav section table td th ul ol dl blockquote figure".split())
TAG = re.compile(r"""(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
NAMED = re.compile(r"""\b(?:class|id|role)\s*+=\s*+("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
NAME_WORD = re.compile(r"[A-Za-z]+")

#: Words in tags, classes, ids and roles that say what a section is, for the training labels.
BOILERPLATE = frozenset("""nav menu navbar navigation header masthead footer aside sidebar side widget ad ads advert advertisement
adverts banner sponsor sponsored promo promotion cookie cookies consent notice alert popup modal newsletter subscribe signup login
search form fieldset button comment comments respond reply replies discussion disqus share sharing social related recommended breadcrumb
breadcrumbs pagination pager copyright legal disclaimer toolbar complementary contentinfo""".split())
MAIN = frozenset("article main content post entry story body text prose".split())

PATH_SLOTS, WORD_SLOTS, SHAPES = 96, 48, 6
WIDTH = PATH_SLOTS + WORD_SLOTS + SHAPES
HIDDEN_UNITS = 24
#: Of the pages to fit on: their number, the size above which others are preferred, the consecutive blocks taken of a page.
FIT_PAGES, FIT_BYTES, FIT_BLOCKS = 160, 100_000, 400
#: Blocks, padding included, that are labelled together, and those turned into vectors at once.
STEPS, CHUNK = 20_000, 4_096
Block = tuple[tuple[str, ...], str, float]  # names on the path, text, share of it inside links


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order; character references decoded, white space made single."""
    out: list[Block] = []
    path: list[tuple[str, tuple[str, ...]]] = []
    names: tuple[str, ...] = ()
    text: list[str] = []
    linked = hidden = in_link = 0

    def flush() -> None:
        nonlocal text, linked
        if text:
            joined = "".join(text)
            joined = " ".join((entities.unescape(joined) if "&" in joined else joined).split())
            if joined:
                out.append((names, joined, min(1.0, linked / len(joined))))
            text, linked = [], 0

    def pop_to(n: int) -> None:
        nonlocal names, hidden
        for tag, _ in path[n:]:
            hidden -= tag in HIDDEN
        del path[n:]
        names = tuple(w for _, own in path for w in own)

    def close(tags: tuple[str, ...], scopes: frozenset[str]) -> None:
        for n in range(len(path) - 1, -1, -1):
            if path[n][0] in tags:
                flush()
                pop_to(n)
                return
            if path[n][0] in scopes:
                return

    at, size = 0, len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            lt = size
        if lt > at and not hidden:
            piece = page[at:lt]
            text.append(piece)
            if in_link:
                linked += len(piece)
        if lt == size:
            break
        m = TAG.match(page, lt + 1)
        if m is None:
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 4)
                at = size if end < 0 else end + 3
            elif page[lt + 1:lt + 2] in ("!", "?", "/") or page[lt + 1:lt + 2].isalpha():
                end = page.find(">", lt)
                at = size if end < 0 else end + 1
            else:  # a bare < is text
                if not hidden:
                    text.append("<")
                at = lt + 1
            continue
        at = m.end()
        tag, ending = m[2].lower(), m[1]
        if tag in INLINE:
            if tag in ("br", "wbr", "img"):
                if not hidden and tag == "br":
                    text.append(" ")
            elif tag == "a":
                in_link = 0 if ending else 1
            continue
        if ending:
            if tag in RAW or tag in HIDDEN or any(t == tag for t, _ in path):
                flush()
                n = next((n for n in range(len(path) - 1, -1, -1) if path[n][0] == tag), None)
                if n is not None:
                    pop_to(n)
            elif not hidden:
                flush()
            continue
        flush()
        if tag in ENDS_P:
            close(("p",), SCOPES)
        if tag in CLOSES:
            close(CLOSES[tag], SCOPES if tag != "li" else frozenset(("ul", "ol", "menu")))
        if tag == "body" and hidden:
            close(("head",), frozenset())
        if tag in VOID or m[3].endswith("/") and tag in HIDDEN:
            continue
        if tag in RAW:  # its content is read to its own end tag only
            end = re.compile(f"</{re.escape(tag)}[\\s/>]", re.I).search(page, at)
            if end is None:
                break
            close_ = page.find(">", end.start())
            at = size if close_ < 0 else close_ + 1
            continue
        own = (tag,)
        if m[3]:
            own += tuple(w.lower() for v in NAMED.findall(m[3]) for w in NAME_WORD.findall(v))
        path.append((tag, own))
        names += own
        hidden += tag in HIDDEN
    flush()
    return out


def _slot(word: str, slots: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % slots


POWERS = np.array([pow(0x01000193, i + 1, 1 << 31) for i in range(32)], dtype=np.int64)


class Features:
    """Vectors of blocks; slots of path names and of words are remembered, KEEP of them at most."""

    KEEP = 200_000

    def __init__(self) -> None:
        self.paths: dict[tuple[str, ...], np.ndarray] = {}

    def path(self, names: tuple[str, ...]) -> np.ndarray:
        known = self.paths.get(names)
        if known is None:
            known = np.zeros(PATH_SLOTS, dtype=np.float32)
            for depth, name in enumerate(reversed(names)):
                known[_slot(name, PATH_SLOTS)] += 1.0 if depth < 4 else 0.5
            known = np.minimum(known, 2.0)
            if len(self.paths) >= self.KEEP:
                self.paths.clear()
            self.paths[names] = known
        return known

    def matrix(self, page: list[Block], low: int = 0, high: int | None = None) -> np.ndarray:
        """Vectors of the blocks from ``low`` to ``high`` of a page."""
        part = page[low:high]
        out = np.zeros((len(part), WIDTH), dtype=np.float32)
        for at, (names, text, linked) in enumerate(part):
            i = low + at
            out[at, :PATH_SLOTS] = self.path(names)
            data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
            starts = np.flatnonzero(data == 32)
            ends = np.append(starts, len(data))
            starts = np.append(0, starts + 1)
            # a word's slot is a polynomial of its bytes
            inside = np.arange(len(data)) - np.repeat(starts, np.append(starts[1:], len(data)) - starts)
            sums = np.add.reduceat(data * POWERS[inside % len(POWERS)], np.minimum(starts, len(data) - 1)) if len(data) else np.zeros(1, dtype=np.int64)
            slots = (sums ^ (sums >> 15)) % WORD_SLOTS
            count = len(starts)
            out[at, PATH_SLOTS:PATH_SLOTS + WORD_SLOTS] = np.bincount(slots, minlength=WORD_SLOTS) / count
            out[at, -SHAPES:] = (
                np.log1p(count) / 5, linked, text[-1:] in ".!?", i / len(page), (len(page) - i) / len(page), 1.0
            )
        return out

    def parts(self, page: list[Block]) -> Iterator[np.ndarray]:
        for low in range(0, len(page), CHUNK):
            yield self.matrix(page, low, low + CHUNK)


def _parts(page) -> Iterator[np.ndarray]:
    return iter([page]) if isinstance(page, np.ndarray) else page


class Labeller:
    """Bidirectional LSTM with one logistic output per block; forward, and training by gradients through time."""

    def __init__(self, seed: int = 5, hidden: int = HIDDEN_UNITS) -> None:
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.weights = {}
        for way in ("f", "b"):
            self.weights[f"x{way}"] = rng.normal(0, 0.15, (WIDTH, 4 * hidden)).astype(np.float32)
            self.weights[f"h{way}"] = rng.normal(0, 0.15, (hidden, 4 * hidden)).astype(np.float32)
            bias = np.zeros(4 * hidden, dtype=np.float32)
            bias[hidden:2 * hidden] = 1  # open the forget gates at first
            self.weights[f"c{way}"] = bias
        self.weights["o"] = rng.normal(0, 0.15, (2 * hidden, 1)).astype(np.float32)
        self.weights["p"] = np.zeros(1, dtype=np.float32)

    def _scan(self, inputs: np.ndarray, way: str, keep: list | None) -> np.ndarray:
        """States over (time, page, gates); steps are remembered in ``keep`` for training."""
        steps, pages = inputs.shape[:2]
        n = self.hidden
        h, c = np.zeros((pages, n), dtype=np.float32), np.zeros((pages, n), dtype=np.float32)
        out = np.zeros((steps, pages, n), dtype=np.float32)
        recur = self.weights[f"h{way}"]
        for t in range(steps):
            gates = inputs[t] + h @ recur
            opened = 1 / (1 + np.exp(-np.clip(gates[:, :3 * n], -30, 30)))
            new = np.tanh(gates[:, 3 * n:])
            before = c
            c = opened[:, n:2 * n] * c + opened[:, :n] * new
            bent = np.tanh(c)
            if keep is not None:
                keep.append((h, before, opened, new, bent))
            h = opened[:, 2 * n:] * bent
            out[t] = h
        return out

    def _batch(self, pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Padded inputs, forward and reversed, as (time, page, width), and the mask."""
        lengths = np.array([len(p) for p in pages])
        steps = int(lengths.max())
        ahead = np.zeros((steps, len(pages), WIDTH), dtype=np.float32)
        back = np.zeros_like(ahead)
        for i, p in enumerate(pages):
            ahead[:len(p), i] = p
            back[:len(p), i] = p[::-1]
        return ahead, back, np.arange(steps)[:, None] < lengths[None, :]

    def scores(self, pages: list) -> list[np.ndarray]:
        """Log-odds of main text for each block of each page.

        A page is a matrix of block vectors, or yields it in parts; only what the gates take of a part is held for all blocks.
        """
        if not pages:
            return []
        w = self.weights
        taken = [[np.concatenate(x) for x in zip(*[(p @ w["xf"] + w["cf"], p @ w["xb"] + w["cb"]) for p in _parts(page)])] for page in pages]
        lengths, kind = [len(f) for f, _ in taken], taken[0][0].dtype
        scans = []
        for k, way in enumerate("fb"):
            inputs = np.zeros((max(lengths), len(pages), 4 * self.hidden), dtype=kind)
            for i, both in enumerate(taken):
                inputs[:lengths[i], i] = both[k][::-1] if k else both[k]
                both[k] = None
            scans.append(self._scan(inputs, way, None))
        f, b = scans
        return [(np.hstack([f[:n, i], b[:n, i][::-1]]) @ w["o"] + w["p"])[:, 0] for i, n in enumerate(lengths)]

    def _gradients(self, pages: list[np.ndarray], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        ahead, back, mask = self._batch(pages)
        w, n = self.weights, self.hidden
        kept: dict[str, list] = {"f": [], "b": []}
        f = self._scan(ahead @ w["xf"] + w["cf"], "f", kept["f"])
        b = self._scan(back @ w["xb"] + w["cb"], "b", kept["b"])
        turned = np.zeros_like(b)
        wanted = np.zeros(mask.shape, dtype=np.float32)
        for i, (p, y) in enumerate(zip(pages, labels)):
            turned[:len(p), i] = b[:len(p), i][::-1]
            wanted[:len(p), i] = y
        both = np.concatenate([f, turned], axis=2)
        odds = 1 / (1 + np.exp(-np.clip((both @ w["o"])[:, :, 0] + w["p"], -30, 30)))
        off = ((odds - wanted) * mask / mask.sum()).astype(np.float32)
        grads = {"o": np.einsum("tph,tp->h", both, off)[:, None], "p": np.array([off.sum()])}
        down = off[:, :, None] * w["o"][:, 0]
        away = np.zeros_like(turned)
        for i, p in enumerate(pages):
            away[:len(p), i] = down[:len(p), i, n:][::-1]
        for way, given, inputs in (("f", down[:, :, :n], ahead), ("b", away, back)):
            recur = w[f"h{way}"]
            dh, dc = np.zeros_like(given[0]), np.zeros_like(given[0])
            gx, gh, gc = (np.zeros_like(w[f"{k}{way}"]) for k in "xhc")
            for t in range(len(inputs) - 1, -1, -1):
                h, before, opened, new, bent = kept[way][t]
                dh = dh + given[t]
                dc = dc + dh * opened[:, 2 * n:] * (1 - bent * bent)
                gates = np.hstack([
                    dc * new * opened[:, :n] * (1 - opened[:, :n]),
                    dc * before * opened[:, n:2 * n] * (1 - opened[:, n:2 * n]),
                    dh * bent * opened[:, 2 * n:] * (1 - opened[:, 2 * n:]),
                    dc * opened[:, :n] * (1 - new * new),
                ])
                gx += inputs[t].T @ gates
                gh += h.T @ gates
                gc += gates.sum(axis=0)
                dh, dc = gates @ recur.T, dc * opened[:, n:2 * n]
            grads |= {f"x{way}": gx, f"h{way}": gh, f"c{way}": gc}
        return grads

    def train(self, pages: list[np.ndarray], labels: list[np.ndarray], rounds: int = 14, batch: int = 24, rate: float = 0.01,
              seed: int = 5) -> None:
        """Adam over shuffled batches."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for _ in range(rounds):
            order = rng.permutation(len(pages))
            for at in range(0, len(order), batch):
                chosen = order[at:at + batch]
                step += 1
                for k, g in self._gradients([pages[i] for i in chosen], [labels[i] for i in chosen]).items():
                    g = np.clip(g, -1, 1)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    move = first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-7)
                    self.weights[k] = (self.weights[k] - rate * move).astype(np.float32)


#: Sections mixed into training pages: (path, is main text).
SECTIONS = (
    *((("nav", "ul", "li"), False), (("div", "menu", "ul", "li"), False), (("div", "navbar"), False), (("header",), False)),
    *((("header", "h1"), False), (("header", "p"), False), (("div", "header"), False), (("footer",), False), (("footer", "p"), False)),
    *((("div", "footer", "p"), False), (("aside",), False), (("aside", "p"), False), (("aside", "h2"), False), (("aside", "ul", "li"), False)),
    *((("div", "sidebar", "p"), False), (("div", "widget"), False), (("div", "ad"), False), (("div", "ads", "p"), False)),
    *((("div", "advert", "p"), False), (("section", "sponsored", "p"), False), (("div", "banner"), False), (("div", "promo", "p"), False)),
    *((("div", "cookie", "notice"), False), (("div", "cookie", "consent", "p"), False), (("div", "notice", "p"), False)),
    *((("div", "alert"), False), (("div", "popup", "p"), False), (("div", "newsletter", "p"), False), (("form",), False), (("form", "p"), False)),
    *((("form", "div"), False), (("form", "button"), False), (("div", "comments", "p"), False), (("section", "comments", "div", "comment", "p"), False)),
    *((("div", "comment"), False), (("ol", "comment", "list", "li", "p"), False), (("section", "id", "comments", "article", "p"), False)),
    *((("div", "share"), False), (("div", "social"), False), (("div", "related", "ul", "li"), False), (("div", "breadcrumb"), False)),
    *((("div", "pagination"), False), (("div", "copyright"), False), (("div", "legal", "p"), False), (("div", "search"), False)),
    *((("article", "h2"), True), (("article", "p"), True), (("article", "ul", "li"), True), (("article", "ol", "li"), True)),
    *((("article", "blockquote", "p"), True), (("article", "pre"), True), (("article", "table", "tr", "td"), True)),
    *((("article", "div", "p"), True), (("article", "section", "p"), True), (("article", "figure", "figcaption"), True), (("article", "dl", "dd"), True)),
    *((("article", "h3"), True), (("article",), True), (("article", "header", "h1"), True)),
)
HOLDERS = (("main",), ("article",), ("div", "content"), ("main", "article"), ("div", "post", "content"), ("div", "story"),
           ("div", "entry", "content"), ("section", "article", "body"), ("div", "main"))


def tag_label(names: tuple[str, ...]) -> bool:
    """Main text by the meaning of the tags around it, for training only."""
    return not BOILERPLATE.intersection(names) and bool(MAIN.intersection(n for n in names if n != "body"))


def training_set(pages: list[list[Block]], seed: int = 3) -> tuple[list[list[Block]], list[np.ndarray]]:
    """Each page as it is, and twice with its article under another holder and sections mixed in."""
    rng = np.random.default_rng(seed)
    out, labels = [], []
    pool: list[str] = []
    for page in pages:
        own = page
        if not own:
            continue
        marks = [tag_label(n) for n, _, _ in own]
        if not any(marks):
            marks = [not BOILERPLATE.intersection(n) for n, _, _ in own]
        out.append(own)
        labels.append(np.array(marks, dtype=np.float32))
        pool = (pool + [t for _, t, _ in own])[-400:]
        for _ in range(2):
            holder = HOLDERS[rng.integers(len(HOLDERS))]
            root = ("html", "body") + (("div",) * int(rng.integers(3)))
            mixed: list[tuple[Block, bool]] = []
            for (names, text, linked), mark in zip(own, marks):
                if mark and names and "article" in names:
                    names = root + holder + names[names.index("article") + 1:]
                mixed.append(((names, text, linked), mark))
            for _ in range(int(rng.integers(1, 7))):
                path, mark = SECTIONS[rng.integers(len(SECTIONS))]
                main = [i for i, (_, m) in enumerate(mixed) if m] or [0]
                if mark:
                    spot, path = int(rng.choice(main)) + 1, root + holder + path[1:]
                else:
                    spot = int(rng.choice([0, main[0], main[-1] + 1, len(mixed), int(rng.choice(main))]))
                    path = root + (holder if rng.random() < 0.4 else ()) + path
                size = int(rng.integers(1, 6))
                linked = float(rng.random() < 0.3) * (not mark)
                mixed[spot:spot] = [((path, pool[rng.integers(len(pool))], linked), mark) for _ in range(size)]
            out.append([b for b, _ in mixed])
            labels.append(np.array([m for _, m in mixed], dtype=np.float32))
    return out, labels


def train(pages: list[list[Block]], seed: int = 5) -> Labeller:
    labeller = Labeller(seed)
    chosen, labels = training_set(pages)
    features = Features()
    if chosen:
        labeller.train([features.matrix(p) for p in chosen], labels)
    return labeller


def fit_windows(rows: DataFrame, fit_pages: int, fit_bytes: int, fit_blocks: int) -> list[list[Block]]:
    """Blocks of the pages to fit on, equal pages once: those of at most ``fit_bytes`` bytes by hash, then the smallest of the others.

    A page gives at most ``fit_blocks`` consecutive blocks from a hashed place on, and as many as ``fit_bytes`` bytes of text hold.
    """
    sized = rows.where(F.octet_length("html") > 0).select("html", F.octet_length("html").alias("size"), F.xxhash64("html").alias("hash"))
    over = F.greatest(F.col("size") - fit_bytes, F.lit(0))
    chosen = sized.select(over.alias("over"), "size", "hash").distinct().orderBy("over", "hash", "size").limit(fit_pages)
    pages = sized.join(F.broadcast(chosen.select("size", "hash")), ["size", "hash"]).groupBy("size", "hash").agg(F.min("html").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hash_, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                page = blocks(html)
                start = hash_ % max(1, len(page) - fit_blocks + 1)
                names, texts, linked, left = [], [], [], fit_bytes
                for n, t, x in page[start:start + fit_blocks]:
                    left -= len(t)
                    if left < 0 and texts:
                        break
                    names.append(list(n))
                    texts.append(t[:fit_bytes])
                    linked.append(x)
                kinds = (pa.list_(pa.list_(pa.string())), pa.list_(pa.string()), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([hash_]), *[pa.array([v], k) for v, k in zip((names, texts, linked), kinds)]], names=["hash", "names", "texts", "linked"]
                )

    told = pages.select("hash", "html").mapInArrow(run, "hash long, names array<array<string>>, texts array<string>, linked array<double>")
    return [
        [(tuple(n), t, x) for n, t, x in zip(r.names, r.texts, r.linked)] for r in sorted(told.collect(), key=lambda r: (r.hash, r.texts))
    ]


def main_text(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", fit_pages: int = FIT_PAGES,
              fit_bytes: int = FIT_BYTES, seed: int = 5, fit_blocks: int = FIT_BLOCKS) -> DataFrame:
    """One row per row of ``df``: key, url, text (empty if none), n_chars.

    The network is fitted on at most ``fit_pages`` pages, see ``fit_windows``; every block of every page is labelled, pages of
    any size and key. A null page is an empty one; empty pages alone give nothing to fit on and have no text. Pages
    are labelled together as far as ``STEPS`` blocks go, a longer one alone, its vectors made in parts. Repeated rows come back as
    often as they went in; other columns are not read.
    """
    rows = df.select(F.col(key).alias("key"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    sample = fit_windows(rows.select("html"), fit_pages, fit_bytes, fit_blocks)
    weights = train(sample, seed).weights if any(sample) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller, features = Labeller(seed), Features()
        labeller.weights = weights or labeller.weights
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                pages = [blocks(h) for h in part.column(2).to_pylist()]
                order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
                texts = [""] * len(pages)
                if weights is not None:
                    while order:  # pages of like length share a batch, the longest go first
                        most = max(1, min(32, STEPS // len(pages[order[-1]])))
                        chosen, order = order[-most:], order[:-most]
                        scores = labeller.scores([features.parts(pages[i]) for i in chosen])
                        for i, s in zip(chosen, scores):
                            texts[i] = " ".join(b[1] for b, v in zip(pages[i], s.tolist()) if v > 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=[key, "url", "text", "n_chars"],
                )

    return rows.mapInArrow(run, f"`{key}` {dict(df.dtypes)[key]}, url string, text string, n_chars long")
