"""Main text of web pages by a recurrent block labeller.

``blocks`` cuts whole HTML into its leaf blocks in page order, each with the tags, classes and ids
around it. Every block becomes a vector of hashed path tokens, hashed words and a few counts;
a bidirectional LSTM in numpy reads the sequence of a page and labels every block with the context
of the whole document. ``fit`` trains it on a bounded sample of pages: their blocks inside article
or main elements are text, others are not; copies in other layouts (renamed containers, menus,
notices, adverts, forms, sidebars and reader comments from the same pages' blocks) teach the names
that sites use. Training is seeded and runs on the driver; labelling runs in Arrow batches.

Null html gives an empty text. Character references are decoded, white space inside a block becomes
one space, blocks are joined by line feeds. Repeated rows are labelled alike. A table without pages
gives no model and no rows.
"""

import html as htmllib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from delaylens.llm.common import appended, with_fields
from delaylens.llm.kernels import slices

SAMPLE_PAGES = 400
#: Copies of each sampled page in other layouts.
RELAID = 3
#: Sizes of the hashed path, the hashed words, the numbers, and the state of each direction.
PATHS, WORDS, NUMBERS, HIDDEN = 512, 32, 5, 16
EPOCHS = 20
#: Blocks of a training sequence; longer pages are cut into sequences that share OVERLAP blocks.
SEQUENCE, OVERLAP = 400, 50
BATCH = 32
SEED = 3

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[a-zA-Z/!?](?:[^>"']|"[^"]*"|'[^']*')*+>|<[a-zA-Z/!?][^>]*>""", re.S)
_NAME = re.compile(r"</?\s*([a-zA-Z][^\s/>]*)")
#: Ends of elements whose content is not shown.
_RAW = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I)
        for name in ("script", "style", "noscript", "template", "iframe", "svg")}
_SVG = re.compile(r"""<(/?)svg(?=[\s/>])(?:[^>"']|"[^"]*"|'[^']*')*+>""", re.I)
_MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
#: Label of a container in re-laid pages. No attribute of HTML has a NUL in its name, and only
#: ``blocks(..., relaid=True)`` reads it.
_LABEL = re.compile(r'\0label="([01])"')
_PART = re.compile(r"[a-z]+")
_INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small "
    "span strike strong sub sup time tt u var wbr input".split())
_VOID = frozenset("br img hr input meta link wbr area base col embed source track param".split())
#: Elements that end an open element of the same kind.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements whose blocks are dropped when their own end tag comes; without one they hide nothing.
_CONTROLS = frozenset(("select", "textarea", "button"))


class Block:
    __slots__ = ("path", "text", "linked", "label")

    def __init__(self, path, text, linked, label):
        self.path, self.text, self.linked, self.label = path, text, linked, label


def _title_ends(source, at):
    """Whether </title> comes before any tag but inline ones."""
    for m in _TOKEN.finditer(source, at):
        name = _NAME.match(m[0])
        if name and name[1].lower() not in _INLINE:
            return name[1].lower() == "title" and m[0][1] == "/"
    return False


def _svgs(source):
    """Start and end of every svg with an end tag; /> leaves none open."""
    ends, starts = {}, []
    for m in _SVG.finditer(source):
        if m[1] and starts:
            ends[starts.pop()] = m.end()
        elif not m[1] and not m[0].endswith("/>"):
            starts.append(m.start())
    return ends


def blocks(source, relaid=False):
    """Leaf blocks of a page with a visible text; ``label`` is the nearest one of a re-laid page."""
    out, stack, text, linked, links = [], [], [], 0, 0

    def close_head():
        nonlocal in_head
        for i in range(len(stack)) if in_head else ():
            if stack[i][0] == "head":
                del stack[i:]
                break
        in_head = False

    def flush(shown=True):
        nonlocal linked
        joined = " ".join(htmllib.unescape("".join(text)).split())
        text.clear()
        if joined and shown:
            close_head()
            label = next((m for _, _, m, _ in reversed(stack) if m is not None), None)
            out.append(Block([t for _, tokens, _, _ in stack for t in tokens], joined, linked, label))
        linked = 0

    at, in_head, svgs = 0, False, None
    title = None  # whether the open title has an end tag
    while m := _TOKEN.search(source, at):
        if m.start() > at:
            piece = source[at:m.start()]
            text.append(piece)
            linked += len(piece) if links else 0
        at = m.end()
        tag = m[0]
        name = _NAME.match(tag)
        if not name:
            continue
        name, closing = name[1].lower(), tag[1] == "/"
        if title is not None:
            if title and name in _INLINE:
                continue
            flush(shown=False)
            title = None
        if name in _RAW and not closing:
            if name != "svg":
                end = _RAW[name].search(source, at)
                at = end.end() if end else len(source)
            else:  # one without an end tag hides nothing
                svgs = _svgs(source) if svgs is None else svgs
                at = svgs.get(m.start(), at)
            continue
        if name == "title":
            if not closing:
                flush()
                links, title = 0, _title_ends(source, at)
            continue
        if name in _INLINE:
            links = max(0, links + (-1 if closing else 1)) if name == "a" else links
            if name == "br":
                text.append(" ")
            continue
        flush()
        links = 0
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    if name in _CONTROLS:
                        del out[stack[i][3]:]
                    del stack[i:]
                    break
        elif name not in _VOID:
            close_head()
            in_head = name == "head"
            ends = _CLOSES.get(name)
            if ends and stack and stack[-1][0] in ends:
                stack.pop()
            tokens, label = name.split("-"), None
            if " " in tag or "\n" in tag:
                for value in _MARKS.findall(tag):
                    tokens += _PART.findall(value.lower())
                mark = _LABEL.search(tag) if relaid else None
                label = int(mark[1]) if mark else None
            stack.append((name, tokens, label, len(out)))
    text.append(source[at:])
    flush(shown=title is None)
    return out


_HASHED = {}


def bucket(token, size):
    key = token, size
    got = _HASHED.get(key)
    if got is None:
        if len(_HASHED) > 500_000:
            _HASHED.clear()
        got = _HASHED[key] = xxhash.xxh32_intdigest(token.encode("utf-8", "replace"), size) % size
    return got


def vectors(page):
    """Feature rows of the blocks of a page."""
    out = np.zeros((len(page), PATHS + WORDS + NUMBERS), np.float32)
    for i, b in enumerate(page):
        for t in b.path:
            out[i, bucket(t, PATHS)] = 1
        words = b.text.split(" ")
        hashed = np.fromiter((bucket(w.lower(), WORDS) for w in words), np.intp, len(words))
        out[i, PATHS:PATHS + WORDS] = np.bincount(hashed, minlength=WORDS) / len(words)
        out[i, PATHS + WORDS:] = (
            np.log1p(len(words)) / 5, b.linked / max(1, len(b.text)),
            np.log1p(len(b.text)) / 8, len(b.text) / len(words) / 10, b.text[-1] in ".!?:;")
    return out


# --- the network -------------------------------------------------------------------------

def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Labeller:
    """Bidirectional LSTM with a logistic output; parameters in ``p``."""

    def __init__(self, inputs, hidden=HIDDEN, seed=SEED):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.p = {}
        for d in "fb":
            scale = 1 / np.sqrt(inputs + hidden)
            self.p[f"W{d}"] = rng.normal(0, scale, (inputs, 4 * hidden))
            self.p[f"U{d}"] = rng.normal(0, scale, (hidden, 4 * hidden))
            self.p[f"c{d}"] = np.repeat([0.0, 1.0, 0.0, 0.0], hidden)  # forget gates start open
        self.p["V"] = rng.normal(0, 0.3, (2 * hidden, 1))
        self.p["S"] = np.zeros((inputs, 1))
        self.p["d"] = np.zeros(1)

    def _run(self, x, mask, d, keep):
        n, steps, _ = x.shape
        h = np.zeros((n, self.hidden), x.dtype)
        c = np.zeros_like(h)
        out, memory = np.zeros((n, steps, self.hidden), x.dtype), []
        pre = x @ self.p[f"W{d}"].astype(x.dtype) + self.p[f"c{d}"].astype(x.dtype)
        u = self.p[f"U{d}"].astype(x.dtype)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            i, f, o, g = np.split(pre[:, t] + h @ u, 4, axis=1)
            i, f, o, g = _sigmoid(i), _sigmoid(f), _sigmoid(o), np.tanh(g)
            m = mask[:, t:t + 1]
            new = f * c + i * g
            tanh = np.tanh(new)
            if keep:
                memory.append((t, i, f, o, g, c, h, tanh, m))
            c = np.where(m, new, c)
            h = np.where(m, o * tanh, h)
            out[:, t] = h
        return out, memory

    def forward(self, x, mask, keep=False):
        f, mf = self._run(x, mask, "f", keep)
        b, mb = self._run(x, mask, "b", keep)
        both = np.concatenate([f, b], axis=2)
        z = both @ self.p["V"].astype(x.dtype) + x @ self.p["S"].astype(x.dtype) + self.p["d"]
        return z[..., 0], both, mf, mb

    def gradients(self, x, mask, y):
        z, both, mf, mb = self.forward(x, mask, True)
        dz = np.where(mask, _sigmoid(z) - y, 0)[..., None] / max(1, mask.sum())
        grads = {"V": np.einsum("nth,nto->ho", both, dz), "S": np.einsum("nti,nto->io", x, dz),
                 "d": dz.sum((0, 1))}
        dboth = dz @ self.p["V"].T
        for d, memory, part in (("f", mf, dboth[..., :self.hidden]), ("b", mb, dboth[..., self.hidden:])):
            dw, du = np.zeros_like(self.p[f"W{d}"]), np.zeros_like(self.p[f"U{d}"])
            dc_, dh_ = np.zeros((len(x), self.hidden)), np.zeros((len(x), self.hidden))
            bias = np.zeros(4 * self.hidden)
            for t, i, f, o, g, c, h, tanh, m in reversed(memory):
                dh = part[:, t] + dh_
                dnew = np.where(m, dh, 0)
                dc = np.where(m, dc_ + dnew * o * (1 - tanh ** 2), 0)
                gates = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f),
                                        dnew * tanh * o * (1 - o), dc * i * (1 - g ** 2)], axis=1)
                dw += x[:, t].T @ gates
                du += h.T @ gates
                bias += gates.sum(0)
                dh_ = gates @ self.p[f"U{d}"].T + np.where(m, 0, dh)
                dc_ = np.where(m, dc * f, dc_)
            grads |= {f"W{d}": dw, f"U{d}": du, f"c{d}": bias}
        return grads

    def train(self, pages, labels, epochs=EPOCHS, rate=0.01, seed=SEED):
        """Adam on batches of pages of similar length."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        order = np.argsort([len(p) for p in pages], kind="stable")
        groups = [order[i:i + BATCH] for i in range(0, len(order), BATCH)]
        step = 0
        for _ in range(epochs):
            for k in rng.permutation(len(groups)):
                x, mask = padded([pages[i] for i in groups[k]])
                y = np.zeros(mask.shape)
                for row, i in enumerate(groups[k]):
                    y[row, :len(labels[i])] = labels[i]
                grads = self.gradients(x.astype(float), mask, y)
                step += 1
                for name, g in grads.items():
                    first[name] += 0.1 * (g - first[name])
                    second[name] += 0.01 * (g * g - second[name])
                    self.p[name] -= rate * first[name] / (1 - 0.9 ** step) / (
                        np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-8)

    def label(self, pages):
        """Whether each block of each page is main text."""
        out = [np.zeros(0, bool)] * len(pages)
        order = [i for i in np.argsort([len(p) for p in pages], kind="stable") if len(pages[i])]
        at = 0
        while at < len(order):
            n = max(1, min(64, 60_000 // len(pages[order[min(at + 63, len(order) - 1)]])))
            part = order[at:at + n]
            z = self.forward(*padded([pages[i] for i in part]))[0]
            for row, i in enumerate(part):
                out[i] = z[row, :len(pages[i])] > 0
            at += n
        return out


def padded(pages):
    steps = max(len(p) for p in pages)
    x = np.zeros((len(pages), steps, pages[0].shape[1]), np.float32)
    mask = np.zeros((len(pages), steps), bool)
    for i, p in enumerate(pages):
        x[i, :len(p)], mask[i, :len(p)] = p, True
    return x, mask


# --- training pages ----------------------------------------------------------------------

#: Names of containers in the re-laid training pages.
MAIN = ["<article>", "<main>", '<div class="content">', '<div id="main-content">', '<div class="post">',
        '<div class="post-body">', '<div class="entry-content">', '<div class="article-body">',
        '<section class="story">', '<div class="text">', '<div itemprop="articleBody" class="article">',
        '<td class="body">', '<div id="article">', '<div class="page-content">', "<article class='post'>",
        '<div role="main">', "<div>", "<section>"]
MENUS = ["<nav>", '<div class="menu">', '<ul class="nav">', '<div id="navigation">',
         '<div class="breadcrumbs">', '<div class="topbar">', '<div role="navigation">',
         '<aside class="sidebar">', '<div class="related">', '<div class="tags">', '<div class="pagination">']
JUNK = ["<header>", '<div class="header">', '<div id="masthead">', "<footer>", '<div class="footer">',
        '<div id="footer">', "<aside>", '<div class="sidebar">', '<div id="sidebar">',
        '<div class="ad">', '<div class="advert">', '<div class="ads">', '<div class="banner">',
        '<div class="sponsored">', '<div class="promo">', '<div class="cookie-notice">',
        '<div class="cookies">', '<div class="notice">', '<div class="consent">', '<div class="popup">',
        '<div class="alert">', "<form>", '<form class="newsletter">', '<div class="subscribe">',
        '<div class="share">', '<div class="social">', '<div class="widget">', '<div class="copyright">',
        '<div class="disclaimer">', '<div class="login">', '<div class="search">', '<div class="author">']
TALK = ['<section class="comments">', '<div id="comments">', '<div class="comment-list">',
        '<ol class="commentlist">', '<div class="replies">', '<div class="discussion">',
        '<div class="responses">', '<div class="reader-comments">', '<div class="comment">']


def _inside(open_tag, body, label):
    name = _NAME.match(open_tag)[1]
    return f'{open_tag[:-1]} \0label="{label}">{body}</{name}>'


def relaid(page, other, rng):
    """A page in a random layout from the blocks of ``page``; ``other`` lends comments and notices."""
    def some(items, most):
        return [items[k] for k in rng.integers(0, len(items), int(rng.integers(1, most + 1)))] if items else []

    def prose(items, tag="p"):
        return "".join(f"<{tag}>{htmllib.escape(b.text)}</{tag}>" for b in items)

    def short(b):
        words = b.text.split()
        return htmllib.escape(" ".join(words[:int(rng.integers(1, 18))]))

    def pick(names):
        return names[int(rng.integers(len(names)))]

    def junk():
        body = "".join(rng.choice(["<p>%s</p>", "<div>%s</div>", "%s", "<span>%s</span>"]) % short(b)
                       for b in some(other, 3))
        if rng.random() < 0.2:
            body = prose(some(other, 1))
        return _inside(pick(JUNK), body, 0)

    def menu():
        return _inside(pick(MENUS), "".join(
            f'<li><a href="/">{short(b)}</a></li>' for b in some(other, 8)), 0)

    text = [b for b in page if b.label]
    if not text:
        return None
    inner = []
    for k, b in enumerate(text):
        body = short(b) if rng.random() < 0.15 else htmllib.escape(b.text)
        tag = "h1" if k == 0 and rng.random() < 0.8 else pick(["p", "p", "p", "p", "div", "h2", "li", "blockquote"])
        inner.append(f"<{tag}>{body}</{tag}>")
        if rng.random() < 0.12:
            inner.append(rng.choice([junk(), menu()]))
    parts = [_inside(pick(MAIN), "".join(inner), 1)]
    for _ in range(int(rng.integers(0, 4))):
        parts.insert(0, rng.choice([junk(), menu()]))
    for _ in range(int(rng.integers(0, 4))):
        parts.append(rng.choice([junk(), menu()]))
    if rng.random() < 0.5:
        said = some(other, 4)
        said = prose(said) if rng.random() < 0.4 else "".join(_inside(
            pick(['<div class="comment">', "<li>", "<div>"]), prose([b]), 0) for b in said)
        parts.insert(len(parts) - int(rng.integers(0, 2)), _inside(pick(TALK), said, 0))
    whole = "".join(parts)
    return f'<div class="{pick(["wrap", "page", "container", "site"])}">{whole}</div>' if rng.random() < 0.5 else whole


_TEXT, _OTHER = {"article", "main"}, {"nav", "footer", "aside", "form", "header", "ad", "ads", "comments"}


def weak_labels(page):
    for b in page:
        names = set(b.path)
        b.label = int(bool(names & _TEXT) and not names & _OTHER)
    if not any(b.label for b in page):  # no such elements: long blocks of prose
        for b in page:
            b.label = int(len(b.text.split()) >= 20 and b.linked < len(b.text) / 3
                          and not set(b.path) & _OTHER)


def fit(pages: DataFrame, page_id="page_id", html="html", sample_pages=SAMPLE_PAGES):
    """Labeller trained on ``sample_pages`` whole pages, chosen by hash; None without pages."""
    sample = pages.where(F.col(html).isNotNull()).select(html).orderBy(
        F.xxhash64(page_id, html)).limit(sample_pages)
    return fit_on([r[0] for r in sample.toLocalIterator()])


def sequences(page):
    """A page cut into sequences of at most SEQUENCE blocks that overlap by OVERLAP."""
    step = SEQUENCE - OVERLAP
    return [page[at:at + SEQUENCE] for at in range(0, max(1, len(page) - OVERLAP), step)] if page else []


def fit_on(sources):
    parsed = [p for p in map(blocks, sources) if p]
    if not parsed:
        return None
    rng = np.random.default_rng(SEED)
    for page in parsed:
        weak_labels(page)
    every = list(parsed)
    for page in parsed:
        for _ in range(RELAID):
            source = relaid(page, parsed[int(rng.integers(len(parsed)))], rng)
            if source:
                again = blocks(source, relaid=True)
                for b in again:
                    b.label = b.label or 0
                every.append(again)
    every = [part for p in every for part in sequences(p)]
    net = Labeller(PATHS + WORDS + NUMBERS)
    net.train([vectors(p) for p in every], [np.array([b.label for b in p], float) for p in every])
    return net


def extract(pages: DataFrame, net, html="html", out="text") -> DataFrame:
    """Add ``out``, the main text, and ``n_chars``, its code points."""
    schema = with_fields(pages.schema, **{out: T.StringType(), "n_chars": T.LongType()})

    def run(batches):
        for batch in slices(batches, html, 4_000_000):
            parsed = [blocks(s or "") for s in batch.column(batch.schema.get_field_index(html)).to_pylist()]
            if net is None:
                keep = [np.ones(len(p), bool) for p in parsed]
            else:
                keep = net.label([vectors(p) for p in parsed])
            texts = ["\n".join(b.text for b, k in zip(p, flags) if k) for p, flags in zip(parsed, keep)]
            yield appended(batch, {out: pa.array(texts, pa.string()),
                                   "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    return pages.mapInArrow(run, schema)
