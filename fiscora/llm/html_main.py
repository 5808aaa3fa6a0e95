"""Main-text extraction by a linear-chain conditional random field over the leaf blocks of a page.

A page is cut into leaf blocks: runs of text between block-level tags, with inline markup kept together.  Features of
a block are its ancestor tags with their classes, ids and roles (and the page part that these name), its innermost page
part, and shape features of its text and its neighbours' (length, links, punctuation).  The field is trained on labelled
pages and decoded by Viterbi; the text of blocks labelled as content is the result.

Labelled pages are made by `labelled_pages`, a seeded generator of page layouts (by elements, by divs, by tables, with
parts nested in the article) whose blocks are known to be content or not; callers may pass pages of their own.

Defined cases: null html is empty; scripts, styles, comments and other raw elements hold no text; svg and object are
elements like others, math is inline text, and self-closing counts in svg and object; unclosed and stray tags, cut-off
tags, quotes and character references are taken as browsers take them, so an attribute's quote without an end takes what
follows, and markup is never text; header, footer, aside, nav and form elements are no content within an article either;
captions and data tables of an article are content; no content gives an empty text.
"""

from __future__ import annotations

import html as html_lib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title".split())
MATH = frozenset(
    "math annotation annotation-xml maction menclose merror mfenced mfrac mglyph mi mlabeledtr mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
INLINE = MATH | frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup textpath time tspan tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())

# A tag's attributes: a quote opens a value only after an equals sign, and a value without its end takes the rest.
_ATTRIBUTE = r"""[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)?+)?+|="""
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^\s/>]*+(?:{_ATTRIBUTE})*+(?:>|\Z)|</[^a-zA-Z>][^>]*(?:>|\Z)|</>|<|[^<]+", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_ROLE_WORD = re.compile(r"[a-z]+")
#: The slash of an unquoted attribute value closes nothing.
_OPEN_SLASH = re.compile(r"=\s*[^\s\"'>]*/>\Z")


class Block:
    __slots__ = ("links", "path", "text")

    def __init__(self, path: tuple[str, ...], text: str, links: int):
        self.path, self.text, self.links = path, text, links


def leaf_blocks(page: str) -> list[Block]:
    """The page's leaf blocks in order, each with its ancestors' names, classes, ids and roles."""
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    links = in_link = 0

    def flush() -> None:
        nonlocal links
        text = " ".join(html_lib.unescape("".join(parts)).split())
        parts.clear()
        if text:
            path = [m for _, marks in stack for m in marks]
            blocks.append(Block(tuple(dict.fromkeys(path)), text, min(links, len(text))))
        links = 0

    def in_svg() -> bool:
        """Whether the innermost element is of svg: HTML's own blocks and foreignObject hold HTML again."""
        for name, _ in reversed(stack):
            if name == "svg":
                return True
            if name == "foreignobject" or name in CLOSES_P:
                return False
        return False

    def pop_to(name: str, stop: frozenset = frozenset()) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == name:
                del stack[i:]
                return
            if stack[i][0] in stop:
                return

    pos, end = 0, len(page)
    while pos < end:
        m = _TOKEN.match(page, pos)
        tok, pos = m.group(), m.end()
        if tok[0] != "<" or tok == "<":
            parts.append(tok)
            links += len(tok) if in_link else 0
            continue
        name = _NAME.match(tok)
        if not name:
            continue
        tag, closing = name.group(1).lower(), tok[1] == "/"
        if tok[-1] != ">" and pos >= end:
            break  # a cut-off tag holds nothing
        if not closing and tok.endswith("/>") and not _OPEN_SLASH.search(tok) and (tag in ("svg", "object") or (tag not in CLOSES_P and in_svg())):
            if tag not in INLINE:
                flush()
            continue
        if not closing and tag in RAW and not (tag == "title" and in_svg()):
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, pos)
            pos = close.end() if close else end
            if tag not in INLINE:
                flush()
            continue
        if tag == "a":
            in_link = 0 if closing else 1
        if tag in INLINE:
            continue
        flush()
        in_link = in_link and tag not in CLOSES_P
        if closing:
            pop_to(tag)
        elif tag not in VOID:
            if tag in CLOSES_P:
                pop_to("p", CLOSES_P - {"p"})
            elif tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                pop_to(tag, frozenset(("ul", "ol", "dl", "table", "select")))
            marks = [f"t:{tag}"]
            for a in _ATTR.finditer(tok):
                value = next(v for v in a.groups()[1:] if v is not None)
                marks += [f"w:{w}" for w in _ROLE_WORD.findall(value.lower())]
            stack.append((tag, tuple(marks)))
    flush()
    return blocks


# Words of class, id and role names that mark page parts.  Those of four letters or more count also within
# a longer name.
PARTS = {
    "content": "article content post entry story main body text", "nav": "nav menu navbar navigation breadcrumb breadcrumbs toc topnav pager pagination", "header": "header masthead banner top logo branding",
    "footer": "footer copyright legal bottom colophon contentinfo", "side": "aside sidebar side widget related recommended rail complementary trending popular more", "ad": "ad ads adv advert advertisement sponsored sponsor promo promotion outbrain taboola dfp",
    "notice": "cookie consent notice gdpr popup modal alert overlay paywall disclaimer", "form": "form search subscribe subscription newsletter login signin signup", "comments": "comments comment replies reply reader discussion respond disqus",
    "meta": "share sharing social tags tag meta byline author date timestamp follow",
}
_PART_OF = {word: part for part, words in PARTS.items() for word in words.split()}
#: Elements that are a part of the page by themselves.
_LANDMARKS = frozenset("article main nav header footer aside form section figure table".split())


def part_of(word: str) -> str | None:
    """The page part that a word of a class, id or role names."""
    found = _PART_OF.get(word)
    if found or len(word) < 5:
        return found
    return next((p for w, p in _PART_OF.items() if len(w) >= 4 and w in word and p != "content"), None) or next((p for w, p in _PART_OF.items() if len(w) >= 4 and w in word), None)


def path_features(path: tuple[str, ...]) -> list[str]:
    """Features of a block's ancestors: every mark, the parts they name, the innermost of each."""
    parts = [p for m in path if m[0] == "w" and (p := part_of(m[2:]))]
    landmarks = [m[2:] for m in path if m[0] == "t" and m[2:] in _LANDMARKS]
    leaf = next((m for m in reversed(path) if m[0] == "t"), "")
    inner = landmarks[-1] if landmarks else ""
    return ["bias", *path, *(f"g:{p}" for p in dict.fromkeys(parts)), f"inner:{inner}", f"last:{parts[-1] if parts else ''}", f"leaf:{leaf}", f"leaf-inner:{leaf}:{inner}"]


def shape(b: Block) -> tuple[int, int]:
    return min(b.text.count(" ") + 1, 64).bit_length(), 4 * b.links // max(1, len(b.text))


def text_features(b: Block, before: Block | None, after: Block | None) -> list[str]:
    length, links = shape(b)
    out = [f"len:{length}", f"link:{links}", f"end:{b.text[-1] in '.!?:;…\"”'}", f"comma:{min(3, b.text.count(','))}", f"len-link:{length}:{links}", f"copy:{b.text[0] == chr(169)}"]
    for name, other in (("before", before), ("after", after)):
        out.append(f"{name}:" + ("{}:{}".format(*shape(other)) if other else "none"))
    return out


def block_features(blocks: list[Block], t: int) -> tuple[list[str], list[str]]:
    b = blocks[t]
    return path_features(b.path), text_features(b, blocks[t - 1] if t else None, blocks[t + 1] if t + 1 < len(blocks) else None)


class Field:
    """A linear chain over labels 0 (boilerplate) and 1 (content)."""

    #: Paths whose weights are remembered.
    REMEMBERED = 20_000

    def __init__(self, names: dict[str, int], weights: np.ndarray, trans: np.ndarray):
        self.names, self.weights, self.trans = names, weights, trans
        self.paths: dict[tuple[str, ...], np.ndarray] = {}

    def _sum(self, features: list[str]) -> np.ndarray:
        return self.weights[[i for f in features if (i := self.names.get(f)) is not None]].sum(axis=0)

    def _path(self, path: tuple[str, ...]) -> np.ndarray:
        known = self.paths.get(path)
        if known is None:
            if len(self.paths) >= self.REMEMBERED:
                self.paths.clear()
            known = self.paths[path] = self._sum(path_features(path))
        return known

    def unary(self, blocks: list[Block]) -> np.ndarray:
        out = np.zeros((len(blocks), 2))
        for t, b in enumerate(blocks):
            around = blocks[t - 1] if t else None, blocks[t + 1] if t + 1 < len(blocks) else None
            out[t] = self._path(b.path) + self._sum(text_features(b, *around))
        return out

    def viterbi(self, blocks: list[Block]) -> list[int]:
        if not blocks:
            return []
        score, (stay0, up), (down, stay1) = self.unary(blocks).tolist(), *self.trans.tolist()
        a, b = score[0]
        back = []
        for u0, u1 in score[1:]:
            from0, from1 = a + stay0 >= b + down, a + up >= b + stay1
            a, b = u0 + (a + stay0 if from0 else b + down), u1 + (a + up if from1 else b + stay1)
            back.append((0 if from0 else 1, 0 if from1 else 1))
        path = [0 if a >= b else 1]
        for step in reversed(back):
            path.append(step[path[-1]])
        return path[::-1]


def train(pages: list[tuple[list[Block], list[int]]], rounds: int = 80, l2: float = 1e-3, rate: float = 0.3) -> Field:
    """Conditional maximum likelihood by AdaGrad; gradients come from forward-backward over all pages at once."""
    pages = [p for p in pages if p[0]]
    names: dict[str, int] = {}
    flat, owner, page, place, label = [], [], [], [], []
    for n, (blocks, labels) in enumerate(pages):
        for t in range(len(blocks)):
            for f in (f for some in block_features(blocks, t) for f in some):
                flat.append(names.setdefault(f, len(names)))
                owner.append(len(page))
            page.append(n)
            place.append(t)
            label.append(labels[t])
    flat, owner, page, place, label = (np.array(x, np.int64) for x in (flat, owner, page, place, label))
    w, tr = np.zeros((len(names), 2)), np.zeros((2, 2))
    gw, gt = np.full_like(w, 1e-8), np.full_like(tr, 1e-8)
    if not pages:
        return Field(names, w, tr)
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    size = np.bincount(page)
    most, rows = int(size.max()), len(pages)
    goal = np.zeros((len(page), 2))
    goal[np.arange(len(page)), label] = 1
    steps = place[1:] > 0
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[:-1][steps], label[1:][steps]), 1)
    alive = np.arange(most)[:, None] < size[None, :]
    for _ in range(rounds):
        u = np.zeros((most, rows, 2))
        u[place, page] = np.add.reduceat(w[flat], first, axis=0)
        fwd, bwd, ahead = u.copy(), np.zeros_like(u), np.zeros((2, 2))
        for t in range(1, most):
            fwd[t] += np.logaddexp(fwd[t - 1][:, :1] + tr[0], fwd[t - 1][:, 1:] + tr[1])
        for t in range(most - 2, -1, -1):
            later = u[t + 1] + bwd[t + 1]
            step = np.logaddexp(later[:, :1] + tr[:, 0], later[:, 1:] + tr[:, 1])
            bwd[t] = np.where(alive[t + 1][:, None], step, 0.0)
        z = np.logaddexp.reduce(fwd[size - 1, np.arange(rows)], axis=1)
        for t in range(1, most):
            on = alive[t]
            both = fwd[t - 1][on][:, :, None] + tr[None] + (u[t] + bwd[t])[on][:, None, :] - z[on][:, None, None]
            ahead += np.exp(both).sum(axis=0)
        diff = goal - np.exp(fwd + bwd - z[None, :, None])[place, page]
        dw = np.stack([np.bincount(flat, diff[owner, y], len(names)) for y in (0, 1)], axis=1) - l2 * rows * w
        dt = seen - ahead - l2 * tr
        gw += dw * dw
        gt += dt * dt
        w += rate * dw / np.sqrt(gw)
        tr += rate * dt / np.sqrt(gt)
    return Field(names, w, tr)


# Elements and marks that carry each part of the made pages, and headings of lists beside an article.
_OTHER = (
    ("nav", "nav"), ("header", "header"), ("footer", "footer"), ("aside", "side"), ("div", "side"), ("div", "ad"), ("div", "notice"), ("form", "form"), ("div", "form"), ("section", "comments"), ("div", "comments"), ("div", "meta"), ("ul", "nav"),
    ("div", "nav"), ("div", "header"), ("div", "footer"), ("section", "side"),
)
_HEADINGS = "Related|Related articles|Read also|More news|Most read|Popular|Trending|Comments|Leave a reply|Share this|Subscribe|Newsletter|Categories|Archive|Search|Menu|About us|Follow us|Advertisement|Tags"


class _Maker:
    """Makes pages; a private mark in each text says whether it is content."""

    def __init__(self, seed: int):
        self.rnd = random.Random(seed)

    def pick(self, *kinds):
        return self.rnd.choice(kinds)

    def words(self, low: int, high: int) -> str:
        return " ".join("".join(self.rnd.choice("aeioustrnl") for _ in range(self.rnd.randint(2, 9))) + self.pick("", "", "", "", ",") for _ in range(self.rnd.randint(low, high)))

    def sentence(self, high: int = 40) -> str:
        return self.words(1, high).strip(",").capitalize() + self.pick(".", ".", ".", "!", "?", "")

    def paragraph(self) -> str:
        return " ".join(self.sentence() for _ in range(self.rnd.randint(1, 4)))

    def content_block(self) -> str:
        kind = self.rnd.random()
        if kind < 0.6:
            return f"<p>\x01{self.paragraph()}</p>"
        if kind < 0.66:
            return f"<p>\x01<b>{self.paragraph()}<br>"
        if kind < 0.72:
            return f"<{self.pick('h2', 'h3', 'h4')}>\x01{self.words(1, 7)}</h2>"
        if kind < 0.79:
            return "<ul>" + "".join(f"<li>\x01{self.words(1, 12)}</li>" for _ in range(self.rnd.randint(1, 5))) + "</ul>"
        if kind < 0.84:
            return f"<blockquote>\x01{self.paragraph()}</blockquote>"
        if kind < 0.88:
            return f"<figure><img src=x><figcaption>\x01{self.sentence(12)}</figcaption></figure>"
        if kind < 0.92:
            return "<table>" + "".join("<tr>" + "".join(f"<td>\x01{self.words(1, 3)}</td>" for _ in range(3)) + "</tr>" for _ in range(self.rnd.randint(1, 4))) + "</table>"
        if kind < 0.96:
            return f"<p>\x01{self.sentence()} <a href=/x>{self.words(1, 5)}</a> {self.sentence()}</p>"
        return f"<pre>\x01{self.paragraph()}</pre>"

    def attributes(self, part: str) -> str:
        mark = self.pick(*PARTS[part].split())
        return self.pick(f' class="{mark}"', f' id="{mark}"', f' class="{mark} x"', f" class='{mark}-{self.pick('box', 'wrap', 'list', 'links')}'")

    def other(self, tag: str, part: str) -> str:
        rnd = self.rnd
        attributes = self.attributes(part) if tag in ("div", "ul", "section") or rnd.random() < 0.6 else ""
        heading = f"<{self.pick('h2', 'h3', 'h4', 'p', 'b')}>\x02{self.pick(*_HEADINGS.split('|'))}</h3>" if rnd.random() < 0.5 else ""

        def item() -> str:
            kind = rnd.random()
            if tag == "ul" or kind < 0.25:
                return f'<li>\x02<a href="/x">{self.words(1, 6)}</a></li>'
            if kind < 0.45:
                return f"<p>\x02{self.sentence()}</p>"
            if kind < 0.6:
                return f"\x02{self.sentence()}<br>"
            if kind < 0.72:
                return f'<a href="/">\x02{self.words(1, 4)}</a>'
            if kind < 0.8:
                return f"\x02&copy; {self.words(1, 9)} &middot; {self.sentence()}<br>"
            if kind < 0.9:
                return f"<div>\x02{self.paragraph()}</div>"
            return f"<label>\x02{self.words(1, 3)}</label><input><button>\x02{self.words(1, 2)}</button>" if part == "form" else f"<h3>\x02{self.words(1, 6)}</h3>"

        return f"<{tag}{attributes}>{heading}" + "".join(item() for _ in range(rnd.randint(1, 6))) + f"</{tag}>"

    def article(self, nested: bool) -> str:
        rnd = self.rnd
        out = [f"<h1>\x01{self.words(1, 9)}</h1>"] if rnd.random() < 0.85 else []
        out += [self.content_block() for _ in range(rnd.randint(1, 12))]
        for _ in range(rnd.randint(1, 4) if nested else 0):
            out.insert(rnd.randint(0, len(out)), self.other(*self.pick(*_OTHER)))
        return "".join(out)

    def page(self) -> str:
        rnd = self.rnd
        core, wrap = self.article(rnd.random() < 0.5), rnd.random()
        before = "".join(self.other(*self.pick(*_OTHER)) for _ in range(rnd.randint(0, 3)))
        after = "".join(self.other(*self.pick(*_OTHER)) for _ in range(rnd.randint(0, 3)))
        if wrap < 0.4:
            core = f"<article{self.pick('', '', self.attributes('content'))}>{core}</article>"
        elif wrap < 0.5:
            core = f"<main>{core}</main>"
        elif wrap < 0.75:
            core = f"<{self.pick('div', 'div', 'section')}{self.attributes('content')}>{core}</div>"
        elif wrap < 0.85:
            core = f"<div>{core}</div>"
        if rnd.random() < 0.2:  # the page is laid out by a table
            left, right = (self.other(*self.pick(("ul", "nav"), ("div", "side"), ("div", "nav"), ("div", "ad"))) for _ in range(2))
            core = f"<table><tr><td colspan=2>{before}</td></tr><tr><td>{left}</td><td>{core}</td>{self.pick('', f'<td>{right}</td>')}</tr></table>"
            before = ""
        elif rnd.random() < 0.3:
            core = f'<div class="{self.pick("wrapper", "container", "row", "page")}">{core}{self.other("div", "side")}</div>'
        return f"<html><head><title>x</title></head><body>{before}{core}{after}</body></html>"


def labelled_pages(count: int = 500, seed: int = 11) -> list[tuple[list[Block], list[int]]]:
    """Made pages of many layouts with the label of each leaf block."""
    maker, pages = _Maker(seed), []
    for _ in range(count):
        labels, kept, last = [], [], 0
        for b in leaf_blocks(maker.page()):
            last = 1 if "\x01" in b.text else 0 if "\x02" in b.text else last
            text = b.text.replace("\x01", "").replace("\x02", "").strip()
            if text:
                labels.append(last)
                kept.append(Block(b.path, text, b.links))
        pages.append((kept, labels))
    return pages


def main_text(page: str | None, field: Field) -> str:
    blocks = leaf_blocks(page or "")
    return " ".join(b.text for b, y in zip(blocks, field.viterbi(blocks)) if y)


def extract_main(pages: DataFrame, labelled: list[tuple[list[Block], list[int]]] | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    bounded_batches(pages.sparkSession)
    field = train(labelled if labelled is not None else labelled_pages())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                texts = [main_text(x.as_py(), field) for x in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[id_col, url_col, "text", "n_chars"]
                )

    kinds = dict(pages.dtypes)
    return pages.select(id_col, url_col, html_col).mapInArrow(run, f"`{id_col}` {kinds[id_col]}, `{url_col}` string, text string, n_chars long")
