"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of the DOM.

A page is parsed into a tree of open elements; text between the borders of block elements is a leaf block. A block's
features are its ancestors' tags, the words of their classes and ids, what its text looks like (length, share of
link text, closing punctuation, marks of boilerplate), and how the prose of the page is spread: whether the block lies
in the smallest element that holds most of it, how much its own parent holds, and what stands before and after. The
field scores each block's features per label and each pair of neighbouring labels; it is trained by maximum likelihood
on labelled pages and decoded by Viterbi.

Labelled pages come from ``labelled_pages``: seeded random pages in many layouts, with and without telling tags and
names, whose blocks are labelled as they are made. Pages of one's own, as (html, labels of the blocks), can be passed
to ``train`` instead or as well. A fitted field is two small tables (``field_rows``, ``field_from``), which can be
stored once and read wherever pages are extracted.
"""

from __future__ import annotations

import functools
import random
import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import bound_batches, text_of

PAGES = 1800
EPOCHS = 14
RATE = 0.3
#: Pages whose slopes are added up before the weights move.
BATCH = 12
DECAY = 1e-4
SEED = 23

# How HTML groups its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style title template".split())
#: Elements without blocks of their own whose text may be content or not; the field is told of them.
EMBEDDED = frozenset("noscript svg math iframe object".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol option p "
    "pre search section select summary table tbody td textarea tfoot th thead tr ul".split()
)
#: An opening tag ends open elements of these kinds, if nothing of the third stands between.
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
#: A paragraph ends where any of these opens.
ENDS_PARAGRAPH = BLOCK - frozenset(["button", "label", "option", "select", "textarea", "caption", "td", "th", "tr"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words that mark boilerplate in any layout.
MARKS = frozenset(
    "cookie cookies copyright subscribe newsletter advertisement sponsored login register reply comments share "
    "search menu privacy rights reserved anzeige werbung publicidad publicité impressum datenschutz".split()
)

_NAME = re.compile(r"[a-z0-9]+")
_HUMP = re.compile(r"([a-z0-9])([A-Z])")
_TITLE_END = re.compile(r"</title\s*>", re.I)


@dataclass
class Block:
    text: str
    linked: int  # characters of link text
    tags: list[str]  # ancestors, outermost first
    names: list[list[str]]  # words of each ancestor's class, id and role
    path: tuple[int, ...] = ()  # numbers of the open block elements, outermost first


class BlockParser(HTMLParser):
    """Leaf blocks of a page. Character references are decoded; white space inside a block becomes one space."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, list[str]]] = []
        self.path: list[int] = []
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = self.skipping = self.links = self.heading = self.elements = 0

    def _flush(self):
        text = " ".join("".join(self.parts).split())
        if text:
            tags = [t for t, _ in self.open]
            named = [n for _, n in self.open if n]
            self.blocks.append(Block(text, min(self.linked, len(text)), tags, named, tuple(self.path)))
        self.parts.clear()
        self.linked = 0

    def _pop(self, depth: int):
        for tag, _ in self.open[depth:]:
            self.skipping -= tag in SKIPPED
            self.links -= tag == "a"
            self.heading -= tag in ("head", "title")
        ended = sum(tag in BLOCK for tag, _ in self.open[depth:])
        if ended:
            self._flush()
            del self.path[-ended:]
        del self.open[depth:]

    def _end_open(self, kinds, limits):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] in kinds:
                return self._pop(depth)
            if self.open[depth][0] in limits:
                return None

    def _title_ends(self) -> bool:
        """Whether the title that opens here has an end tag: then all up to it is its text."""
        line, column = self.getpos()
        at = 0
        for _ in range(line - 1):
            at = self.rawdata.find("\n", at) + 1
        return bool(_TITLE_END.search(self.rawdata, at + column))

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag == "hr":
                self._flush()
            elif not self.skipping:
                self.parts.append(" ")
            return
        if tag in ENDS_PARAGRAPH:
            self._end_open(("p",), ("button", "td", "th", "table", "caption"))
        if tag in CLOSES:
            self._end_open(*CLOSES[tag])
        if tag in BLOCK:
            if self.heading:  # the end tags of head and title were left out
                self._pop(next(d for d, (t, _) in enumerate(self.open) if t in ("head", "title")))
            self._flush()
        elif tag == "title" and all(t != "svg" for t, _ in self.open):
            if not self.get_starttag_text().endswith("/>") and self._title_ends():
                self.set_cdata_mode("title")
        names = _NAME.findall(tag) if "-" in tag else []  # elements of one's own have telling names
        for key, value in attrs:
            if value and key in ("class", "id", "role", "itemprop"):
                names += _NAME.findall(_HUMP.sub(r"\1 \2", value).lower())
            elif key == "hidden" or key == "style" and value and "display:none" in value.replace(" ", "").lower():
                names.append("hidden")
        self.open.append((tag, names))
        if tag in BLOCK:
            self.elements += 1
            self.path.append(self.elements)
        self.skipping += tag in SKIPPED
        self.links += tag == "a"
        self.heading += tag in ("head", "title")

    def handle_endtag(self, tag):
        if tag == "br":
            self.parts.append(" ")
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                return self._pop(depth)
        if tag == "p":
            self._flush()

    def handle_data(self, data):
        if not self.skipping:
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())

    def finish(self) -> list[Block]:
        self.close()
        self._flush()
        return self.blocks


def blocks_of(html: str) -> list[Block]:
    parser = BlockParser()
    parser.feed(html)
    return parser.finish()


#: A block of so many words, few of them in links, is prose.
PROSE_WORDS = 8
#: The share of a page's prose that its main element holds.
MAIN_SHARE = 0.6


def _look(block: Block) -> set[str]:
    """Features of the block by itself: ancestors, their names, and the look of the text."""
    out = {"always"}
    inner = [t for t in block.tags if t in BLOCK]
    out.update(f"in:{t}" for t in inner if t not in ("html", "body"))
    out.update(f"in:{t}" for t in EMBEDDED.intersection(block.tags))
    out.add(f"own:{inner[-1] if inner else 'none'}")
    for names in block.names:
        out.update(f"name:{n}" for n in names)
        out.update(f"name:{n.rstrip('s')}*" for n in names)
    if block.names:
        out.update(f"near:{n.rstrip('s')}*" for n in block.names[-1])
    n = len(block.text)
    words = block.text.lower().split()
    share = block.linked / n
    out.add(f"chars:{min(n.bit_length(), 9)}")
    out.add(f"words:{min(len(words).bit_length(), 7)}")
    out.add("links:" + ("none" if not block.linked else "few" if share < 0.3 else "many" if share < 0.8 else "all"))
    out.add("ends:" + ("mark" if block.text[-1] in ".!?:;\"')" else "bare"))
    marks = sum(w.strip(".,:;!?()") in MARKS for w in words)
    if "©" in block.text:
        out.add("marks:sign")
    if marks:
        out.add("marks:" + ("dense" if len(words) <= 4 * marks else "some" if len(words) <= 12 * marks else "thin"))
    return out


def _is_prose(block: Block) -> bool:
    return block.text.count(" ") >= PROSE_WORDS - 1 and block.linked < 0.3 * len(block.text)


def features(blocks: list[Block]) -> list[set[str]]:
    """Per block: how it looks, and how it stands to the prose of the page."""
    rows = [_look(b) for b in blocks]
    prose = [len(b.text) if _is_prose(b) else 0 for b in blocks]
    whole = sum(prose)
    held: dict[int, int] = {}  # characters of prose, of all text and of links per element
    chars: dict[int, int] = {}
    linked: dict[int, int] = {}
    for b, p in zip(blocks, prose, strict=True):
        for element in b.path:
            held[element] = held.get(element, 0) + p
            chars[element] = chars.get(element, 0) + len(b.text)
            linked[element] = linked.get(element, 0) + b.linked
    # elements are numbered from outside to inside, so the last one that holds enough is the smallest
    main = max((e for e, p in held.items() if whole and p >= MAIN_SHARE * whole), default=0)
    kinds = [
        "prose" if p else "links" if b.linked * 5 >= 4 * len(b.text) else "short" for b, p in zip(blocks, prose, strict=True)
    ]
    first = next((i for i, k in enumerate(kinds) if k == "prose"), len(blocks))
    last = next((i for i in range(len(blocks) - 1, -1, -1) if kinds[i] == "prose"), -1)
    heads = [any(t in HEADINGS for t in b.tags[-2:]) for b in blocks]
    for i, (b, row) in enumerate(zip(blocks, rows, strict=True)):
        inside = "none" if not whole else "free" if not main else "in" if main in b.path else "out"
        parent = b.path[-2] if len(b.path) > 1 else b.path[0] if b.path else 0
        share = held.get(parent, 0) / whole if whole else 0
        holds = "most" if share >= 0.5 else "some" if share >= 0.1 else "little" if share else "none"
        links = linked.get(parent, 0) / max(chars.get(parent, 1), 1)
        row.add(f"main:{inside}")
        row.add(f"main:{inside}:{kinds[i]}")
        row.add(f"parent:{holds}")
        row.add("parentlinks:" + ("none" if not links else "few" if links < 0.3 else "many"))
        row.add(f"kind:{kinds[i]}:{inside}:{holds}")
        row.add(f"before:{kinds[i - 1] if i else 'start'}")
        row.add(f"after:{kinds[i + 1] if i + 1 < len(blocks) else 'end'}")
        row.add("at:" + ("ahead" if i < first else "behind" if i > last else "amid"))
        row.add(f"blocks:{min(len(blocks), 3)}:{kinds[i]}")
        if heads[i]:
            row.add(f"head:{kinds[i + 1] if i + 1 < len(blocks) else 'end'}:{inside}")
        if i == 0:
            row.add("place:first")
        if i == len(blocks) - 1:
            row.add("place:last")
    return rows


@dataclass
class Field:
    """Weights of a trained field: per feature the scores of labels 0 (boilerplate) and 1 (main text), and of pairs."""

    weights: dict[str, tuple[float, float]]
    pairs: list[list[float]] = field(default_factory=lambda: [[0.0, 0.0], [0.0, 0.0]])

    def decode(self, blocks: list[Block]) -> list[int]:
        """The best sequence of labels, by Viterbi."""
        (p00, p01), (p10, p11) = self.pairs
        best0 = best1 = 0.0
        back: list[tuple[int, int]] = []
        get = self.weights.get
        for i, row in enumerate(features(blocks)):
            s0 = s1 = 0.0
            for f in row:
                w = get(f)
                if w:
                    s0 += w[0]
                    s1 += w[1]
            if i == 0:
                best0, best1 = s0, s1
                continue
            from0, from1 = (best0 + p00, best1 + p10), (best0 + p01, best1 + p11)
            back.append((int(from0[1] > from0[0]), int(from1[1] > from1[0])))
            best0, best1 = max(from0) + s0, max(from1) + s1
        if not blocks:
            return []
        label = int(best1 > best0)
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return labels[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def marginals(scores: np.ndarray, pairs: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over pages of ``sizes`` blocks, padded to one length: scores (pages, blocks, 2).

    Returns probabilities of labels (pages, blocks, 2), expected numbers of pairs (pages, 2, 2), and the log partitions.
    Values of padded places mean nothing.
    """
    pages, n, _ = scores.shape
    ahead, behind = np.zeros((pages, n, 2)), np.zeros((pages, n, 2))
    ahead[:, 0] = scores[:, 0]
    for i in range(1, n):
        ahead[:, i] = scores[:, i] + _log_sum(ahead[:, i - 1, :, None] + pairs, 1)
    for i in range(n - 2, -1, -1):
        there = _log_sum(pairs + (scores[:, i + 1] + behind[:, i + 1])[:, None, :], 2)
        behind[:, i] = np.where((i + 1 < sizes)[:, None], there, 0.0)
    whole = _log_sum(ahead[np.arange(pages), sizes - 1], 1)
    joint = ahead[:, :-1, :, None] + pairs + (scores[:, 1:] + behind[:, 1:])[:, :, None, :] - whole[:, None, None, None]
    inside = np.arange(n - 1)[None, :] < (sizes - 1)[:, None]
    joint = np.where(inside[:, :, None, None], np.exp(np.where(inside[:, :, None, None], joint, 0.0)), 0.0)
    labels = ahead + behind - whole[:, None, None]
    real = np.arange(n)[None, :, None] < sizes[:, None, None]
    return np.exp(np.where(real, labels, 0.0)), joint.sum(axis=1), whole


def train(
    pages: list[tuple[str, list[int]]], epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED, batch: int = BATCH
) -> Field:
    """Maximum likelihood with a quadratic penalty, by Adagrad, some pages of like length at a time."""
    names: dict[str, int] = {}
    data = []
    for html, labels in pages:
        blocks = blocks_of(html)
        if len(blocks) != len(labels):
            raise ValueError(f"{len(labels)} labels for {len(blocks)} blocks")
        if blocks:
            rows = [sorted(r) for r in features(blocks)]
            flat = np.array([names.setdefault(f, len(names)) for r in rows for f in r])
            data.append((flat, np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.array(labels)))
    rng = np.random.default_rng(seed)
    weights, pairs = np.zeros((len(names), 2)), np.zeros((2, 2))
    seen_w, seen_p = np.full(weights.shape, 1e-6), np.full((2, 2), 1e-6)
    by_length = sorted(range(len(data)), key=lambda k: (len(data[k][2]), k))
    groups = [[data[k] for k in by_length[i : i + batch]] for i in range(0, len(by_length), batch)]
    for _ in range(epochs):
        for g in rng.permutation(len(groups)):
            slope, joint = _slope(groups[g], weights, pairs)
            used = np.flatnonzero(slope.any(axis=1))
            slope = slope[used] + DECAY * weights[used]
            seen_w[used] += slope**2
            weights[used] -= rate * slope / np.sqrt(seen_w[used])
            seen_p += joint**2
            pairs -= rate * joint / np.sqrt(seen_p)
    found = {name: (float(weights[i, 0]), float(weights[i, 1])) for name, i in names.items()}
    return Field(found, pairs.tolist())


def _slope(group: list, weights: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slope of the negative log likelihood of some pages, by weights and by pairs, per page."""
    sizes = np.array([len(y) for _, _, y in group])
    n = int(sizes.max())
    flat = np.concatenate([f for f, _, _ in group])
    owner = np.concatenate([o + p * n for p, (_, o, _) in enumerate(group)])
    total = len(group) * n
    scores = np.stack([np.bincount(owner, weights[flat, c], total) for c in (0, 1)], axis=1)
    labels, joint, _ = marginals(scores.reshape(len(group), n, 2), pairs, sizes)
    joint = joint.sum(axis=0)
    for p, (_, _, y) in enumerate(group):
        labels[p, np.arange(len(y)), y] -= 1
        np.add.at(joint, (y[:-1], y[1:]), -1)
    off = labels.reshape(total, 2)[owner]
    slope = np.stack([np.bincount(flat, off[:, c], len(weights)) for c in (0, 1)], axis=1)
    return slope / len(group), joint / len(group)


FIELD_ROWS = "kind string, name string, boilerplate double, main double"


def field_rows(spark, model: Field) -> DataFrame:
    """A fitted field as a table: one row a feature, and one a label with the scores of the labels after it."""
    rows = [("feature", name, *w) for name, w in model.weights.items()]
    rows += [("pair", str(label), *scores) for label, scores in enumerate(model.pairs)]
    return spark.createDataFrame(rows, FIELD_ROWS)


def field_from(rows: DataFrame) -> Field:
    """The field of such a table, which is as small as the features of the training pages are few."""
    found = rows.collect()
    pairs = sorted((r.name, [r.boilerplate, r.main]) for r in found if r.kind == "pair")
    return Field({r.name: (r.boilerplate, r.main) for r in found if r.kind == "feature"}, [p for _, p in pairs])


# Names that layouts give to their parts, in the languages of the tables.
_MENUS = (
    "nav menu navbar navigation breadcrumbs main-menu topnav site-nav pagination toc menue menu-principal "
    "hauptmenu"
).split()
_SIDES = (
    "sidebar side widget related recommended popular-posts right-column aside trending secondary rail "
    "seitenleiste rechts barre-laterale lateral"
).split()
_ADVERTS = (
    "ad ads advert advertisement banner sponsored promo ad-slot adbox promotion anzeige werbung publicite "
    "pub publicidad anuncio"
).split()
_NOTICES = "cookie cookie-notice notice gdpr consent alert popup disclaimer newsletter paywall".split()
_COMMENTS = (
    "comments comment comment-list reader-comments replies discussion responses disqus kommentare "
    "commentaires comentarios"
).split()
_FOOTERS = "footer site-footer bottom copyright legal credits page-footer fuss pied pie impressum".split()
_HEADERS = "header site-header masthead top topbar branding logo page-header kopf entete cabecera".split()
_FORMS = ["search", "login", "subscribe", "signup", "contact-form", "search-form", "register"]
_SHARES = "share social share-buttons tags meta byline-tools toolbar teilen partager compartir".split()
_BODIES = "content post article entry-content article-body main-content story text post-body page".split()


class _Maker:
    """Writes one labelled page: html in parts, and a label for each block of text."""

    def __init__(self, rng: random.Random):
        self.rng, self.parts, self.labels = rng, [], []
        self.pick = rng.choice

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def some(self, least: int, most: int) -> range:
        return range(self.rng.randint(least, most))

    def words(self, least: int, most: int) -> str:
        made = ["".join(self.rng.choices("aeiounrstlmdéäñ", k=self.rng.randint(2, 8))) for _ in self.some(least, most)]
        text = " ".join(made).capitalize()
        return text + self.pick([".", ".", ".", "!", "", "?"]) if most > 6 else text

    def block(self, tag: str, text: str, label: int, attrs: str = ""):
        if label and self.chance(0.1):
            text = f"<b>{text}</b>" if self.chance(0.5) else f'{text} <a href="/x">{self.words(1, 3)}</a> {self.words(3, 9)}'
        self.parts.append(f"<{tag}{attrs}>{text}" + ("" if tag in ("p", "li") and self.chance(0.1) else f"</{tag}>"))
        self.labels.append(label)

    def linked(self, title: str) -> str:
        """A title, which may be a link to its own page."""
        return f'<a href="/x">{title}</a>' if self.chance(0.12) else title

    def named(self, names: list[str]) -> str:
        return f' {self.pick(["class", "class", "id"])}="{self.pick(names)}"'

    def wrapped(self, tag: str, attrs: str, fill):
        self.parts.append(f"<{tag}{attrs}>")
        fill()
        self.parts.append(f"</{tag}>")

    def marked(self, text: str, least: int, most: int) -> str:
        """With words that mark boilerplate elsewhere, one in so many words."""
        words = text.split()
        for _ in range(max(1, len(words) // self.rng.randint(least, most))):
            words.insert(self.rng.randint(0, len(words)), self.pick(sorted(MARKS)))
        return " ".join(words)

    def prose(self, label: int, least: int, most: int, tag: str = "p"):
        for _ in self.some(least, most):
            text = self.words(3, 60)
            if self.chance(0.04):  # long prose may hold such words; a long notice holds more of them, at any place
                text = " ".join([text, *(self.words(45, 60) for _ in range(2))])
            if label and text.count(" ") > 8 and self.chance(0.2):
                text = self.marked(text, 10, 40)
            elif label and self.chance(0.03):  # a line on rights inside the text
                text = self.marked(self.words(1, 6), 2, 4)
            elif not label and self.chance(0.3):
                text = self.marked(text, 4, 10)
            self.block(tag, text, label)

    def links(self, n: int):
        def items():
            for _ in range(n):
                self.block("li", f'<a href="/{self.words(1, 1)}">{self.words(1, 3)}</a>', 0)

        self.wrapped("ul", "", items)

    def menu(self):
        tag = self.pick(["nav", "nav", "div", "ul"])
        if tag == "ul":
            self.wrapped("div", self.named(_MENUS), lambda: self.links(4))
        else:
            attrs = "" if tag == "nav" and self.chance(0.7) else self.named(_MENUS)
            self.wrapped(tag, attrs, lambda: self.links(self.rng.randint(2, 7)))

    def boxed(self, tags: list[str], plain: str | None, names: list[str], text):
        """A part with its own tag, or a div with a telling name; its text directly inside or in paragraphs."""
        tag = self.pick(tags)
        attrs = "" if tag == plain and self.chance(0.7) else self.named(names)
        if self.chance(0.5):
            self.block(tag if tag != "p" else "div", text(), 0, attrs)
        else:
            inner = lambda: [self.block(self.pick(["p", "div", "p", "h3", "p"]), text(), 0) for _ in self.some(1, 3)]
            self.wrapped(tag, attrs, inner)

    def embedded(self, label: int):
        """Content for readers without scripts or plug-ins, or a formula; outside the article a notice or an advert."""
        tag = self.pick(["noscript", "noscript", "object", "iframe"])
        kind = self.rng.random()
        if label and kind < 0.3:
            formula = f"<math><mi>{self.words(1, 1)}</mi><mo>=</mo><mn>{self.rng.randint(1, 99)}</mn></math>"
            self.block("p", f"{self.words(2, 20)} {formula} {self.words(2, 20)}", 1)
        elif label and kind < 0.4:
            self.block("div", f"<math><mi>{self.words(1, 2)}</mi><mo>=</mo><mn>{self.rng.randint(1, 99)}</mn></math>", 1)
        elif label and kind < 0.5:
            self.block("figure", f"<svg><title>x</title><text>{self.words(2, 9)}</text></svg>", 1)
        else:
            attrs = "" if label else self.pick(["", self.named(_ADVERTS), self.named(_NOTICES)])
            self.wrapped(tag, attrs, lambda: self.prose(label, 1, 2, self.pick(["p", "p", "div"])))

    def advert(self):
        self.boxed(["div", "div", "aside", "section"], None, _ADVERTS, lambda: self.words(2, 30))

    def side(self):
        if self.chance(0.5):
            inner = lambda: (self.block("h3", self.words(1, 4), 0), self.links(4))
            self.wrapped(self.pick(["aside", "div"]), self.named(_SIDES), inner)
        else:
            self.boxed(["aside", "div"], "aside", _SIDES, lambda: self.words(3, 40))

    def notice(self):
        self.boxed(["div", "section"], None, _NOTICES, lambda: self.words(3, 40) + self.pick(["", " cookies", " Subscribe"]))

    def header(self):
        tag = self.pick(["header", "header", "div"])
        attrs = "" if tag == "header" and self.chance(0.6) else self.named(_HEADERS)

        def fill():
            self.block(self.pick(["div", "h1", "p"]), self.words(1, 8), 0)
            if self.chance(0.4):
                self.menu()

        self.wrapped(tag, attrs, fill)

    def footer(self):
        text = lambda: self.pick(["&copy; 2024 ", "", "Copyright ", "&copy; www.example.com &middot; "]) + self.words(2, 30)
        self.boxed(["footer", "footer", "footer", "div"], "footer", _FOOTERS, text)

    def form(self):
        def fill():
            self.block("label", self.words(1, 5), 0)
            self.block("p", self.words(2, 25), 0)
            self.block("button", self.words(1, 2), 0)

        self.wrapped("form", "" if self.chance(0.5) else self.named(_FORMS), fill)

    def shares(self):
        self.boxed(["div"], None, _SHARES, lambda: self.words(1, 6))

    def comments(self):
        def fill():
            if self.chance(0.7):
                attrs = self.pick(["", "", ' class="comments-title"', ' class="comments-heading"', ' class="title"'])
                self.block(self.pick(["h2", "h3"]), self.words(1, 5), 0, attrs)
            for _ in self.some(1, 4):
                tag = self.pick(["div", "li", "article", "p"])
                if tag in ("div", "article") and self.chance(0.6):
                    self.wrapped(tag, self.named(["comment", "reply", "comment-body"]), lambda: self.prose(0, 1, 2))
                else:
                    self.block(tag, self.words(3, 60), 0)

        self.wrapped(self.pick(["div", "section", "ol"]), self.named(_COMMENTS), fill)

    def table(self):
        """Figures inside the text."""

        def row(kind: str):
            self.wrapped("tr", "", lambda: [self.block(kind, self.words(1, 3), 1) for _ in range(columns)])

        columns = self.rng.randint(2, 3)
        self.wrapped("table", "", lambda: [row("th" if i == 0 else "td") for i in self.some(2, 4)])

    def short(self):
        """Hardly any text: a title and a line."""
        self.block(self.pick(["h1", "h1", "h2"]), self.words(1, 9), 1)
        for _ in self.some(0, 3):
            text = self.words(1, 9)
            self.block("p", self.pick(["{}", "{}", "<b>{}<br></b>", "<b>{}", "{}<br>"]).format(text), 1)

    def article(self):
        tag = self.pick(["article", "article", "article", "main", "div", "section", "body"])
        named = tag in ("div", "section") or self.chance(0.3)

        def fill():
            if self.chance(0.12) and tag != "body":
                self.short()
                return
            if self.chance(0.8):
                title = lambda: self.block(self.pick(["h1", "h1", "h2", "h3"]), self.linked(self.words(2, 14)), 1)
                self.wrapped("header", "", title) if self.chance(0.1) else title()
            wrap = self.chance(0.25)
            if wrap:
                self.parts.append(f"<div{self.named(_BODIES)}>")
            for _ in self.some(1, 4):
                self.prose(1, 1, 4)
                kind = self.rng.random()
                if kind < 0.12:
                    self.block(self.pick(["h2", "h3"]), self.words(1, 8), 1)
                elif kind < 0.2:
                    points = lambda: [self.block("li", self.words(2, 20), 1) for _ in range(3)]
                    self.wrapped(self.pick(["ul", "ol"]), "", points)
                elif kind < 0.26:
                    self.block(self.pick(["blockquote", "pre", "div", "td"]), self.words(4, 40), 1)
                elif kind < 0.34:
                    self.advert()
                elif kind < 0.38:
                    self.side()
                elif kind < 0.42:
                    self.notice()
                elif kind < 0.45:
                    self.form()
                elif kind < 0.57:
                    self.embedded(1)
                elif kind < 0.63:
                    self.table()
            if wrap:
                self.parts.append("</div>")
            if self.chance(0.12):
                self.shares()
            if self.chance(0.12):
                self.comments()
            if self.chance(0.05):
                self.wrapped("footer", "", lambda: self.block("p", self.words(2, 12), 0))

        if tag == "body":
            fill()  # the text stands in the page without a part of its own
        else:
            self.wrapped(tag, self.named(_BODIES) if named else "", fill)

    def page(self) -> tuple[str, list[int]]:
        """In most pages tags or names tell the parts; in the others they tell little or nothing."""
        kind = self.pick([self.told] * 6 + [self.bare, self.soup, self.soup, self.table_page, self.encyclopedia])
        kind()
        return "".join(self.parts), self.labels

    def told(self):
        head = f"<title>{self.words(2, 8)}</title><script>var t='</p>';</script>"
        ends = self.pick(["</head><body>", "</head><body>", "</head><body>", "<body>", ""])
        self.parts.append(f"<!DOCTYPE html><html><head>{head}{ends}")
        wrap = self.chance(0.3)
        if wrap:
            self.parts.append(f'<div class="{self.pick(["wrapper", "container", "page", "site"])}">')
        before = [(self.header, 0.45), (self.menu, 0.7), (self.advert, 0.35), (self.notice, 0.2), (self.form, 0.15)]
        after = [(self.comments, 0.3), (self.side, 0.35), (self.advert, 0.25), (self.shares, 0.1), (self.notice, 0.15)]
        after += [(lambda: self.embedded(0), 0.1), (self.form, 0.15), (self.menu, 0.15), (self.footer, 0.8)]
        for part, p in [*before, (self.side, 0.15), (lambda: self.embedded(0), 0.2)]:
            if self.chance(p):
                part()
        if self.chance(0.97):
            self.article()
        for part, p in after:
            if self.chance(p):
                part()
        if wrap:
            self.parts.append("</div>")
        if self.chance(0.9):
            self.parts.append("</body></html>")

    def link_line(self):
        """A few links in one line: the way on from a page without a menu."""
        links = self.pick([" | ", " ", " - ", " &middot; "]).join(f'<a href="/x">{self.words(1, 2)}</a>' for _ in self.some(1, 5))
        tag = self.pick(["p", "center", "div", "", "", "td"])
        self.parts.append(f"<{tag}>{links}</{tag}>" if tag else links)
        self.labels.append(0)
        if not tag:
            self.parts.append(self.pick(["<hr>", "<p>", "<hr><p>"]))

    def credit(self):
        text = self.pick(["&copy; 1999 ", "Copyright ", "&copy; "]) + self.words(1, 6) + self.pick(["", " All rights reserved."])
        tag = self.pick(["p", "div", "center", "address"])
        self.block(tag, self.pick([text, f"<small>{text}</small>"]), 0)

    def bare(self):
        """Text in the page itself, with hardly any tags, or none at all."""
        self.parts.append(self.pick(["", "<html><body>", f"<title>{self.words(1, 5)}</title><body>", "<html><head></head><body>"]))
        if self.chance(0.3):
            text = " ".join(self.words(3, 50) for _ in self.some(1, 8))
            self.parts.append(self.pick(["{}", "<b>{}</b>", "<pre>{}</pre>", "{}<br><br>" + self.words(9, 40)]).format(text))
            self.labels.append(1)
            return
        if self.chance(0.3):
            self.link_line()
            self.parts.append("<hr>")
        if self.chance(0.6):
            self.block(self.pick(["h1", "h2", "center", "h3"]), self.words(1, 9), 1)
        tag = self.pick(["p", "p", "p", "div", "li", "td"])
        for _ in self.some(1, 3):
            self.prose(1, 1, 5, tag)
            if self.chance(0.2):
                self.block(self.pick(["h2", "h3", "h4"]), self.words(1, 6), 1)
                self.prose(1, 1, 2, tag)
            if self.chance(0.15):
                points = lambda: [self.block("li", self.words(2, 20), 1) for _ in range(3)]
                self.wrapped(self.pick(["ul", "ol"]), "", points)
        if self.chance(0.6):
            self.parts.append(self.pick(["<hr>", "</p><hr>", "<p>"]))
            self.link_line()
        if self.chance(0.3):
            self.credit()

    def unnamed(self) -> str:
        """No names, or names that say nothing."""
        token = "".join(self.rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=6))
        return self.pick(["", "", f' class="css-{token}"', f' class="sc-{token} x"', f' id="{token}"', ' class="row"', ' class="box inner"'])

    def container(self) -> str:
        """A name made of a word for the main part or the page and a word for a part."""
        words = "main primary central page single post story entry blog wiki doc markdown rich text body article news content".split()
        parts = "col column area wrap wrapper inner container body text section block region output".split()
        glue = self.pick(["-", "_", "", "__"])
        second = self.pick(parts)
        return f' {self.pick(["class", "id"])}="{self.pick(words)}{glue}{second.capitalize() if not glue else second}"'

    def soup(self):
        """Divs, with names that say nothing, or only of the main part."""
        names = self.pick([self.unnamed, self.unnamed, self.container])
        self.parts.append(f"<!DOCTYPE html><html><head><title>{self.words(2, 8)}</title></head><body><div{self.unnamed()}>")
        some_links = lambda: [self.block("div", f'<a href="/x">{self.words(1, 3)}</a>', 0, self.unnamed()) for _ in self.some(2, 6)]
        if self.chance(0.5):
            self.block("div", self.words(1, 5), 0, self.unnamed())
        if self.chance(0.7):
            self.wrapped("div", self.unnamed(), lambda: self.links(5) if self.chance(0.4) else some_links())
        if self.chance(0.25):
            self.notice()

        def fill():
            if self.chance(0.8):
                self.block(self.pick(["h1", "h2", "h3", "div"]), self.linked(self.words(2, 12)), 1)
            for _ in self.some(1, 3):
                self.prose(1, 1, 4, self.pick(["p", "p", "p", "div"]))
                if self.chance(0.25):
                    self.block(self.pick(["h2", "h3"]), self.words(1, 8), 1)
                    self.prose(1, 1, 2)
                if self.chance(0.15):
                    points = lambda: [self.block("li", self.words(2, 20), 1) for _ in range(3)]
                    self.wrapped(self.pick(["ul", "ol"]), "", points)
                if self.chance(0.1):
                    self.table()
                if self.chance(0.1):
                    self.advert()
            if self.chance(0.15):
                self.shares()

        self.wrapped("div", names(), lambda: self.wrapped("div", self.unnamed(), fill) if self.chance(0.4) else fill())
        if self.chance(0.25):
            self.comments()
        if self.chance(0.45):
            heading = lambda: (self.block(self.pick(["h3", "h4", "div"]), self.words(1, 4), 0), self.links(4))
            self.wrapped("div", self.unnamed(), heading if self.chance(0.6) else some_links)
        if self.chance(0.6):
            self.credit() if self.chance(0.5) else self.wrapped("div", self.unnamed(), some_links)
        self.parts.append("</div></body></html>")

    def table_page(self):
        """Menu and text in the cells of one table."""
        self.parts.append(f"<html><head><title>{self.words(1, 5)}</title></head><body><table{self.unnamed()}>")
        if self.chance(0.6):
            self.wrapped("tr", "", lambda: self.block("td", self.words(1, 6), 0, ' colspan="2"'))

        def menu():
            for _ in self.some(3, 7):
                self.parts.append(f'<p><a href="/x">{self.words(1, 3)}</a></p>')
                self.labels.append(0)

        def text():
            if self.chance(0.7):
                self.block(self.pick(["h1", "h2", "p"]), self.words(2, 9), 1)
            self.prose(1, 1, 7)
            if self.chance(0.2):
                self.table()
                self.prose(1, 1, 2)

        cells = [menu, text] if self.chance(0.7) else [text, menu]
        self.wrapped("tr", "", lambda: [self.wrapped("td", self.unnamed(), c) for c in cells])
        if self.chance(0.5):
            self.wrapped("tr", "", lambda: self.block("td", "&copy; " + self.words(2, 9), 0, ' colspan="2"'))
        self.parts.append("</table></body></html>")

    def encyclopedia(self):
        """A title, a line of the site below it, a box of contents, sections, notes, and boxes of links after them."""
        self.parts.append(f"<!DOCTYPE html><html><head><title>{self.words(1, 5)}</title></head><body>")
        if self.chance(0.5):
            self.menu()
        self.parts.append(f"<div{self.container()}>")
        self.block("h1", self.words(1, 5), 1, self.pick(["", ' id="firstHeading"', ' class="title"']))
        if self.chance(0.6):
            self.block("div", self.words(3, 8), 0, self.pick([' id="siteSub"', ' class="tagline"', ' class="subtitle noprint"', ' class="site-sub"']))
        inner = self.chance(0.6)
        if inner:
            self.parts.append(f"<div{self.container()}>")
        self.prose(1, 1, 3)

        def contents():
            self.block(self.pick(["h2", "div", "p", "h3", "span"][:4]), self.pick(["Contents", self.words(1, 2)]), 0)
            self.links(self.rng.randint(3, 8))

        if self.chance(0.7):
            self.wrapped(self.pick(["div", "div", "nav", "section"]), self.pick([' class="toc"', ' id="toc"', ' id="contents"', self.unnamed()]), contents)
        for _ in self.some(1, 4):
            edit = self.pick(["", "", ' <span>[<a href="/e">edit</a>]</span>'])
            self.parts.append(f"<h2>{self.words(1, 4)}{edit}</h2>")
            self.labels.append(1)
            self.prose(1, 1, 4)
            if self.chance(0.25):
                points = lambda: [self.block("li", f'{self.words(2, 9)} <a href="/x">{self.words(1, 3)}</a> {self.words(3, 9)}', 1) for _ in range(3)]
                self.wrapped(self.pick(["ul", "ol"]), "", points)
        if inner:
            self.parts.append("</div>")
        if self.chance(0.5):
            self.wrapped("div", self.pick([' class="navbox"', ' id="catlinks"', ' class="categories"', self.unnamed()]), lambda: self.links(5))
        self.parts.append("</div>")
        if self.chance(0.6):
            self.footer()
        self.parts.append("</body></html>")


def labelled_pages(n: int = PAGES, seed: int = SEED) -> list[tuple[str, list[int]]]:
    """Random pages and the labels of their leaf blocks."""
    rng = random.Random(seed)
    return [_Maker(rng).page() for _ in range(n)]


@functools.cache
def default_field() -> Field:
    """The field that is trained on ``labelled_pages``; trained once in a process."""
    return train(labelled_pages())


def main_text(model: Field, html: str) -> str:
    """Blocks that the field takes for main text, in page order, joined by an empty line."""
    blocks = blocks_of(html)
    return "\n\n".join(b.text for b, label in zip(blocks, model.decode(blocks)) if label)


def extract(
    pages: DataFrame, model: Field | None = None, html: str = "html", page_id: str = "page_id", url: str = "url"
) -> DataFrame:
    """Per row: page_id, url, text and n_chars (code points). Null or empty pages have an empty text; null and
    repeated ids get a row each."""
    bound_batches(pages.sparkSession)
    trained = model or default_field()

    @F.pandas_udf("string")
    def texts(htmls: pd.Series) -> pd.Series:
        return pd.Series([main_text(trained, h) for h in htmls], dtype=object)

    out = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), texts.asNondeterministic()(text_of(html)).alias("text")
    )
    return out.withColumn("n_chars", F.length("text").cast("long"))
