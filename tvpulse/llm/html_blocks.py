"""HTML extraction by a recurrent block labeller (operator 1).

A page becomes the sequence of its leaf blocks. Each block has a tag-path
vector (hashed tags, class, id and role words of its ancestors, and whether
they name page furniture or an article) and a hashed-word vector. A numpy
bidirectional LSTM reads the whole sequence and labels every block as main
text or not; main blocks are joined in page order.

The labeller is trained here, on a bounded sample of the pages: labels come
from the names of the ancestors, a part of the path evidence is hidden, and
blocks of other kinds of furniture are mixed in, so that it also uses words
and neighbours. Scripts, styles, comments, templates and the head never become
blocks; a head without an end tag ends at the body or the first block element.
Text in math, svg, object, noscript, canvas, audio and video is text like any
other. Defined results: a null or empty page, or one without a main block,
gives the empty text; unclosed and stray tags are tolerated, but a script,
style, title, template, frame or text area without its end tag takes the rest
of the page, as in a browser; pages of any length and nesting are read whole, in
time linear in their length and with the vectors of one stretch in memory;
repeated rows each get a row; other columns are ignored; an empty table gives no
rows. A null id or url is an id or url like any other.
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

from tvpulse.llm.common import weighed

#: Pages that the labeller is trained on at most, taken by a hash of the id.
SAMPLE = 240
PATH_DIM, WORD_DIM, HIDDEN = 48, 32, 16
DIM = PATH_DIM + WORD_DIM + 8
#: Ancestors whose names enter the path vector, nearest first.
DEPTH = 6
#: Blocks that are read together (some 30 MB of vectors).
CELLS = 1 << 15
#: Blocks of a training sequence, and sequences that a long page gives at most,
#: spread over its whole length.
SPAN, SPANS = 160, 8

#: HTML element names by the role they play here.
SKIP = "script style template iframe title textarea".split()
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
            "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol option p pre section "
            "select summary table tbody td tfoot th thead tr ul".split())
#: Elements whose start ends an open paragraph or an open element of the same kind.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"},
            "option": {"option"}}
PARAGRAPHS = set("p h1 h2 h3 h4 h5 h6".split())
FURNITURE_TAGS = set("nav header footer aside form button menu dialog label legend option".split())
FURNITURE = set("ad ads adv advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie "
                "cookies disqus discussion footer form header login masthead menu menubar modal nav navbar navigation newsletter "
                "notice notices overlay pagination popup promo promoted promotion recommended related reply replies responses "
                "search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar warning "
                "widget complementary contentinfo alert paywall".split())
MAIN_TAGS = {"article", "main"}
MAIN = set("article main content post story entry body text".split())

#: Attributes up to the end of a tag: a quote counts after an equals sign, where
#: it closes. Possessive, so a tag is read once.
ATTRIBUTES = r"(?:[^>=]|=\s*+\"[^\"]*\"|=\s*+'[^']*'|=)*+"
TOKEN = re.compile(
    # <title/> of an svg is closed by its slash
    r"<!--.*?(?:-->|\Z)|<(?!title\s*/>)(" + "|".join(SKIP) + r")(?=[\s/>])" + ATTRIBUTES + r">.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)(" + ATTRIBUTES + r")>|<[!?/][^>]*(?:>|\Z)|[^<]+|<", re.S | re.I)
#: A swallowed element or comment that is closed.
CLOSED = re.compile(r"(?:-->|</[a-zA-Z]+\s*>)\Z")
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PART = re.compile(r"[a-z]+")


class _Open:
    """The open elements. Every step is bounded by what it opens or closes, so
    a page is read in linear time however deep it nests."""

    def __init__(self):
        self.stack: list[tuple] = []  # tag, names, nearest furniture and nearest article at or above
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def path(self) -> tuple[tuple[str, ...], ...]:
        """Names of the nearest ancestors, and what marks one further up."""
        near = tuple(names for _, names, _, _ in self.stack[:-DEPTH - 1:-1])
        return near + tuple(m for m in self.stack[-DEPTH - 1][2:] if m) if len(self.stack) > DEPTH else near

    def last(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else -1

    def push(self, tag: str, names: tuple[str, ...]) -> None:
        above = self.stack[-1][2:] if self.stack else (None, None)
        one = (names,)
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, names, names if furniture(one) else above[0], names if article(one) else above[1]))

    def cut(self, at: int) -> None:
        while len(self.stack) > at:
            tag = self.stack.pop()[0]
            self.places[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()

    def end(self, tag: str) -> None:
        at = self.last(tag)
        if at >= 0 and (tag in BLOCK or not self.blocks or self.blocks[-1] < at):
            self.cut(at)

    def start(self, tag: str) -> None:
        """What the start of a block element ends: an unclosed list of choices,
        an open paragraph or heading, an open element of the same kind."""
        if tag not in ("select", "option") and self.places.get("select"):
            self.cut(self.places["select"][0])
        if self.blocks and self.stack[self.blocks[-1]][0] in SIBLINGS.get(tag, set()) | PARAGRAPHS:
            self.cut(self.blocks[-1])


def blocks(page: str | None) -> list[tuple[tuple[tuple[str, ...], ...], str, int]]:
    """Leaf blocks in page order: (names of the nearest ancestors, nearest first,
    and of what marks one further up; text; characters inside links)."""
    page = page or ""
    tree, out, text, linked, head = _Open(), [], [], 0, False
    whole = page.rfind(">") + 1  # beyond it no tag is complete
    swallowed = False

    def close(keep: bool = True):
        nonlocal linked
        if keep and (body := " ".join(entities.unescape("".join(text)).split())):
            out.append((tree.path(), body, linked))
        text.clear()
        linked = 0

    def add(part: str):
        nonlocal linked
        text.append(part)
        if any(tag == "a" for tag, *_ in tree.stack[-4:]):
            linked += len(part)

    for t in TOKEN.finditer(page, 0, whole):
        skipped, ends, tag, attributes = t.groups()
        if tag is None:
            if skipped or t[0].startswith("<!--"):
                swallowed = t.end() == whole and not CLOSED.search(t[0])
            elif not t[0].startswith(("<!", "<?", "</")):
                add(t[0])
            continue
        tag = tag.lower()
        if tag == "head":
            close(keep=not head)
            head = not ends and not out
            continue
        if tag in BLOCK:
            close(keep=not (head and tag == "body"))
            head = False
        elif tag == "br":
            text.append(" ")
        if ends:
            tree.end(tag)
            continue
        if tag in VOID or attributes.endswith("/"):
            continue
        if tag in BLOCK:
            tree.start(tag)
        named = PART.findall(" ".join("".join(m) for m in NAMES.findall(attributes)).lower()) if "=" in attributes else []
        tree.push(tag, (tag, *named))
    if not swallowed:  # an incomplete end tag or declaration takes the rest
        rest = re.split("<[!?/]", page[whole:], maxsplit=1)[0]
        if rest:
            add(rest)
    close()
    return out


def furniture(path) -> bool:
    return any(names[0] in FURNITURE_TAGS or not FURNITURE.isdisjoint(names[1:]) for names in path)


def article(path) -> bool:
    return any(names[0] in MAIN_TAGS or not MAIN.isdisjoint(names[1:]) for names in path)


class _Slots(dict):
    """word -> slot of the hashed-word vector; forgets when it grows large."""

    def __missing__(self, word):
        if len(self) > 100_000:
            self.clear()
        self[word] = slot = zlib.crc32(word.encode()) % WORD_DIM
        return slot


SLOTS = _Slots()


def vector(block, hide: bool = False) -> np.ndarray:
    """Path, word and shape features of a block; ``hide`` leaves out its path."""
    path, text, linked = block
    x = np.zeros(DIM)
    words = text.lower().split()
    if not hide:
        for depth, names in enumerate(path[:DEPTH]):
            for name in names:
                h = zlib.crc32(name.encode())
                x[h % PATH_DIM] += (1 if h >> 16 & 1 else -1) / (1 + depth)
        x[-1], x[-2] = 2.0 * furniture(path), 2.0 * article(path)
    x[PATH_DIM:PATH_DIM + WORD_DIM] = np.bincount([SLOTS[w] for w in words], minlength=WORD_DIM) / max(1, len(words)) ** 0.5
    x[-3], x[-4] = min(2.0, linked / len(text)), np.log1p(len(words)) / 4
    x[-5], x[-6] = sum(map(text.count, ".!?")) / len(words), float(text[-1:] in ".!?")
    x[-7] = sum(map(text.count, "|©»•")) / len(words)
    x[-8] = 1.0
    return x


class BlockLabeller:
    """Bidirectional LSTM over block vectors, logistic output for every block."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        scale = 1 / np.sqrt(DIM + HIDDEN)
        self.p = {f"w{d}": rng.normal(0, scale, (DIM + HIDDEN, 4 * HIDDEN)) for d in "fb"}
        self.p |= {f"b{d}": np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN) for d in "fb"}
        self.p |= {"out": rng.normal(0, 0.2, DIM + 2 * HIDDEN), "bias": np.zeros(1)}

    def _pass(self, x: np.ndarray, d: str, keep: bool, state: list | None = None):
        """x (time, page, DIM), already in reading order; states of every step.
        ``state`` carries the last state from one stretch to the next."""
        steps, n, _ = x.shape
        w, out, saved = self.p[f"w{d}"], np.empty((steps, n, HIDDEN)), []
        h, c = state if state else (np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN)))
        fed = x @ w[:DIM] + self.p[f"b{d}"]
        for t in range(steps):
            z = fed[t] + h @ w[DIM:]
            i, f, o = (1 / (1 + np.exp(-z[:, k * HIDDEN:(k + 1) * HIDDEN])) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN:])
            old, before = c, h
            c = f * c + i * g
            h = o * np.tanh(c)
            out[t] = h
            if keep:
                saved.append((i, f, o, g, old, c, before))
        if state is not None:
            state[:] = h, c
        return out, saved

    def _back(self, x, d, saved, dh_out, grads):
        w, dh, dc = self.p[f"w{d}"], 0.0, 0.0
        for t in range(len(saved) - 1, -1, -1):
            i, f, o, g, old, c, before = saved[t]
            dh = dh_out[t] + dh
            tc = np.tanh(c)
            dc = dh * o * (1 - tc ** 2) + dc
            dz = np.hstack([dc * g * i * (1 - i), dc * old * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g ** 2)])
            grads[f"w{d}"] += np.hstack([x[t], before]).T @ dz
            grads[f"b{d}"] += dz.sum(axis=0)
            dh, dc = dz @ w[DIM:].T, dc * f

    @staticmethod
    def _turn(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Every page's steps in reverse, padding left in place."""
        out = x.copy()
        for k, n in enumerate(lengths):
            out[:n, k] = x[:n, k][::-1]
        return out

    def forward(self, x: np.ndarray, lengths: np.ndarray, keep: bool = False):
        forth, sf = self._pass(x, "f", keep)
        turned = self._turn(x, lengths)
        back, sb = self._pass(turned, "b", keep)
        joined = np.concatenate([x, forth, self._turn(back, lengths)], axis=2)
        return 1 / (1 + np.exp(-np.clip(joined @ self.p["out"] + self.p["bias"], -30, 30))), (joined, turned, sf, sb)

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], rounds: int = 12, batch: int = 24, rate: float = 0.02) -> None:
        """Adam on the mean log loss of all blocks."""
        moments, step, rng = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}, 0, np.random.default_rng(5)
        for _ in range(rounds):
            order = rng.permutation(len(pages))
            for at in range(0, len(order), batch):
                own = [pages[i] for i in order[at:at + batch]]
                lengths = np.array([len(y) for _, y in own])
                x, y, on = (np.zeros((lengths.max(), len(own), *s)) for s in ((DIM,), (), ()))
                for k, (v, labels) in enumerate(own):
                    x[:len(v), k], y[:len(v), k], on[:len(v), k] = v, labels, 1
                p, (joined, turned, sf, sb) = self.forward(x, lengths, keep=True)
                dz = (p - y) * on / on.sum()
                grads = {k: np.zeros_like(v) for k, v in self.p.items()}
                grads["out"], grads["bias"] = np.einsum("tb,tbd->d", dz, joined), np.array([dz.sum()])
                dj = dz[:, :, None] * self.p["out"]
                self._back(x, "f", sf, dj[:, :, DIM:DIM + HIDDEN], grads)
                self._back(turned, "b", sb, self._turn(dj[:, :, DIM + HIDDEN:], lengths), grads)
                step += 1
                for k, g in grads.items():
                    m, v = moments[k]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    self.p[k] = self.p[k] - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)

    def label(self, pages: list[list]) -> list[np.ndarray]:
        """True for main blocks; pages of like length are read together, as many
        as CELLS blocks allow; a longer page is read alone in stretches."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        while order and len(pages[order[-1]]) > CELLS:
            i = order.pop()
            out[i] = self._label_long(pages[i])
        at = 0
        while at < len(order):
            own = order[at:at + 32]
            while len(own) * len(pages[own[-1]]) > CELLS:
                own.pop()
            at += len(own)
            lengths = np.array([len(pages[i]) for i in own])
            x = np.zeros((lengths.max(), len(own), DIM))
            for k, i in enumerate(own):
                x[:lengths[k], k] = [vector(b) for b in pages[i]]
            p, _ = self.forward(x, lengths)
            for k, i in enumerate(own):
                out[i] = p[:lengths[k], k] >= 0.5
        return out

    def _label_long(self, page: list) -> np.ndarray:
        """The same labels with the vectors of one stretch at a time: both passes
        carry their state, and only the sums of the output are kept."""
        z, cuts = np.full(len(page), self.p["bias"][0]), list(range(0, len(page), CELLS))
        for d, stretches, weight in (("f", cuts, self.p["out"][DIM:DIM + HIDDEN]), ("b", cuts[::-1], self.p["out"][DIM + HIDDEN:])):
            state: list = []
            for at in stretches:
                x = np.array([vector(b) for b in page[at:at + CELLS]])
                if d == "f":
                    z[at:at + CELLS] += x @ self.p["out"][:DIM]
                step = 1 if d == "f" else -1
                states, _ = self._pass(x[::step, None], d, False, state)
                z[at:at + CELLS] += (states[:, 0] @ weight)[::step]
        return z >= 0


#: Names that training puts in place of others, so that the labeller sees each.
RENAMED = {"article": [("article",), ("main",), ("div", "content"), ("section", "post"), ("div", "story"), ("div", "entry", "content")],
           "h1": [("h1",), ("h2",), ("h3",), ("h4",)], "p": [("p",), ("p",), ("li",), ("blockquote",), ("td",), ("div",)],
           "nav": [("nav",), ("div", "menu"), ("div", "navbar"), ("ul", "breadcrumb")], "footer": [("footer",), ("div", "footer")]}


def _renamed(path, rng):
    return tuple(RENAMED[n[0]][rng.integers(len(RENAMED[n[0]]))] + n[1:] if n[0] in RENAMED and rng.random() < 0.4 else n for n in path)


def spans(n: int) -> list[slice]:
    """SPAN blocks each, the first and the last ones of a long page among them."""
    if n <= SPAN:
        return [slice(0, n)]
    count = min(SPANS, -(-n // SPAN))
    return [slice(at, at + SPAN) for at in (round(k * (n - SPAN) / (count - 1)) for k in range(count))]


def lessons(pages: list[list], seed: int = 3) -> list[tuple[np.ndarray, np.ndarray]]:
    """Training sequences: every page as it is, and twice with names
    changed, furniture of other kinds mixed in and a tenth of the paths hidden."""
    rng, out = np.random.default_rng(seed), []
    kinds = sorted(FURNITURE), sorted(FURNITURE_TAGS)
    spare = [b for page in pages for b in page]
    stretches = []
    for page in pages:
        bare = not any(article(path) for path, _, _ in page)
        whole = [(b, not furniture(b[0]) and (bare or article(b[0]))) for b in page]
        stretches += [whole[s] for s in spans(len(whole))] if whole else []
    for own in stretches:
        for mixed in range(3):
            seq = [((_renamed(path, rng), text, linked), y) for (path, text, linked), y in own] if mixed else list(own)
            for _ in range(3 * bool(mixed)):
                name = (rng.choice(["div", "section", "ul", "p"]), str(rng.choice(kinds[0]))) if rng.random() < 0.7 else (
                    str(rng.choice(kinds[1])),)
                inside = rng.integers(0, len(seq) + 1)
                around = seq[min(inside, len(seq) - 1)][0][0]
                group = [spare[i] for i in rng.integers(0, len(spare), rng.integers(1, 4))]
                path = (("p",), tuple(map(str, name)), *around)
                seq[inside:inside] = [((path, text, linked), False) for _, text, linked in group]
            x = np.array([vector(b, hide=bool(mixed) and rng.random() < 0.1) for b, _ in seq])
            out.append((x, np.array([float(y) for _, y in seq])))
    return out


def train(pages: DataFrame, sample: int = SAMPLE) -> BlockLabeller:
    """Fit on at most ``sample`` distinct pages, the least by a hash of id and url.

    Pages count by id, url and content, so a repeated id brings no more of
    them; a table without html gives a labeller that is never asked."""
    digest = F.md5("html")
    filled = pages.select("page_id", "url", F.col("html").cast("string").alias("html")).filter("html <> ''")
    named = filled.select(F.col("page_id").alias("id"), F.col("url").alias("at"), digest.alias("digest")).distinct().orderBy(
        F.xxhash64("id", "at"), "id", "at", "digest").limit(sample)
    same = [F.col("page_id").eqNullSafe(F.col("id")), F.col("url").eqNullSafe(F.col("at")), digest == F.col("digest")]
    texts = filled.join(F.broadcast(named), same).select("page_id", "url", "html").distinct().collect()
    labeller = BlockLabeller()
    texts.sort(key=lambda r: (r["page_id"] is None, r["page_id"] or 0, r["url"] or "", r["html"]))
    learned = lessons([blocks(r["html"]) for r in texts])
    if learned:
        labeller.train(learned)
    return labeller


def extract(pages: DataFrame, labeller: BlockLabeller) -> DataFrame:
    """page_id, url, text (main blocks joined by newlines) and n_chars."""
    shared = pages.sparkSession.sparkContext.broadcast(labeller)

    def run(batches: Iterator[pa.RecordBatch]):
        model = shared.value
        for b in weighed(batches, 2, size=4 << 20, rows=128):
            found = [blocks(h) for h in b.column(2).to_pylist()]
            texts = ["\n".join(t for (_, t, _), y in zip(own, on) if y) for own, on in zip(found, model.label(found))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                              pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    src = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    kinds = [src.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return src.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
