"""Main text of web pages by a linear-chain conditional random field.

A page becomes a sequence of leaf blocks: runs of text that no block-level tag
interrupts, with their ancestors. The field labels each block as main text or
not, from ancestor tags, words in ancestors' class, id and role, and the form
of the text; neighbouring labels depend on each other. It is trained by
stochastic gradient on labelled pages and decoded by Viterbi.

Labelled pages come from a bounded sample of the table: pages that mark their
article (``article``, ``main``) are labelled by that, others by the names of
their parts and the lengths of their blocks; the blocks are also set anew into layouts of other kinds (containers told only by class, comments
inside the article, sidebars, forms, notices), whose labels are then known.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import hashed_sample, ship, texts_of

TRAIN_PAGES = 300
#: Longer pages are not trained on (they are extracted like all others).
TRAIN_CHARS = 100_000
#: Pages with tags nested deeper are not trained on either.
TRAIN_DEPTH = 300
FEATURES = 1 << 16
EPOCHS = 6
RATE, DECAY = 0.3, 1e-6

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd "
                    "label mark q rp rt ruby s samp small span strike strong sub sup time tt u "
                    "var wbr".split())
_UNSEEN = frozenset("script style noscript template svg math iframe object canvas select option "
                    "button textarea title head audio video noframes noembed".split())
#: Start tags that may stand in a head; any other ends it.
_IN_HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style "
                     "template title".split())
#: Start tags that end an open paragraph.
_ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure "
                    "footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table "
                    "ul".split())
_SIBLINGS = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}),
             "dd": ("dt dd", {"dl"}), "tr": ("tr td th", {"table"}),
             "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"})}


class _Blocks(HTMLParser):
    """Leaf blocks of a page, in time that does not grow with their depth.

    ``blocks`` holds a text, its context (see ``nodes``), its two innermost tags
    and the characters inside links. A context is a number: ``nodes`` gives the
    context around it and the ancestor features that it adds, so that nested
    tags are neither copied nor hashed for each block. With ``depth``, ``whole``
    also gets each block's ancestors (outermost first, as tag and words of
    class, id and role), unless they are more than that: then ``deep`` is set.
    """

    #: Elements whose content is text up to their own end tag.
    CDATA_CONTENT_ELEMENTS = ("script", "style", "textarea", "title", "noscript", "iframe",
                              "noframes", "noembed")

    def __init__(self, depth: float = 0):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, tuple[str, ...], int]] = []
        self.places: dict[str, list[int]] = {}    # of each open tag, in the stack
        self.held: dict[str, int] = {}            # ancestor features now open
        self.nodes: list[tuple[int, list[int]]] = [(0, [])]
        self.unseen = self.links = self.linked = 0
        self.loose = False                        # a button without an end tag is open
        self.text: list[str] = []
        self.blocks: list[tuple[str, int, tuple[str, ...], int]] = []
        self.depth, self.deep = depth, False
        self.whole: list[tuple[str, tuple, int]] = []

    def flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                self.blocks.append((text, self.stack[-1][2] if self.stack else 0,
                                    tuple(t for t, _, _ in self.stack[-2:]), self.linked))
                self.deep |= len(self.stack) > self.depth
                if not self.deep:
                    self.whole.append((text, tuple((t, w) for t, w, _ in self.stack),
                                       self.linked))
            self.text, self.linked = [], 0

    def _push(self, tag: str, words: tuple[str, ...]) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        node, new = self.stack[-1][2] if self.stack else 0, []
        for f in (f"t:{tag}", *[f"w:{w}" for w in words]):
            n = self.held.get(f, 0)
            self.held[f] = n + 1
            if not n:
                new.append(_number(f))
        if new:
            self.nodes.append((node, new))
            node = len(self.nodes) - 1
        self.stack.append((tag, words, node))
        self.unseen += tag in _UNSEEN
        self.links += tag == "a"

    def _pop(self, at: int) -> None:
        if any(tag not in _INLINE for tag, _, _ in self.stack[at:]):
            self.flush()
        for tag, words, _ in self.stack[at:]:
            self.places[tag].pop()
            for f in (f"t:{tag}", *[f"w:{w}" for w in words]):
                self.held[f] -= 1
            self.unseen -= tag in _UNSEEN
            self.links -= tag == "a"
            self.loose &= tag != "button"
        del self.stack[at:]

    def _last(self, tags) -> int:
        """Place of the innermost open one of the tags; -1 if none is open."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def _close(self, tags: tuple, within) -> None:
        at = self._last(tags)
        if at < 0 or at <= self._last(within):
            return
        # what an unseen element holds ends nothing outside of it
        if not self.unseen or at > self._last(_UNSEEN - set(tags)):
            self._pop(at)

    def parse_starttag(self, i: int) -> int:
        """A tag that the page's end cuts off is none."""
        self.begin = i
        end = super().parse_starttag(i)
        return end if end >= 0 else len(self.rawdata)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.loose and (tag == "button" or tag in _ENDS_P or tag in _SIBLINGS):
            self._pop(self._last(("button",)))
        if tag in _ENDS_P:
            self._close(("p",), {"article", "main", "div", "section", "td", "button", "body"})
        elif tag in _SIBLINGS:
            names, within = _SIBLINGS[tag]
            self._close(tuple(names.split()), within)
        if tag == "body" or self.places.get("head") and tag not in _IN_HEAD:
            if self.unseen == len(self.places.get("head", ())):
                self._close(("head",), set())
        if tag == "br":
            self.text.append(" ")
        elif tag not in _INLINE:
            self.flush()
        if tag in _VOID:
            return
        words = tuple(re.findall(r"[a-z]+", " ".join(
            v for k, v in attrs if v and k in ("class", "id", "role")).lower())) if attrs else ()
        if attrs and any(k == "hidden" or k == "aria-hidden" and v == "true" for k, v in attrs):
            words += ("hidden",)
        self._push(tag, words)
        if tag == "button":
            # without an end tag before the next button, blocks after it are not in it
            end = _BUTTON.search(self.rawdata, self.begin + 1)
            self.loose = not end or not end[1]

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and self.stack and self.stack[-1][0] == tag:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self.places.get(tag):
            self._pop(self.places[tag][-1])
        elif tag not in _INLINE:
            self.flush()

    def parse_comment(self, i: int, report: bool = True) -> int:
        """A comment ends at ``-->`` or ``--!>``, at once if ``>`` or ``->``
        follow its start, and else at the page's end."""
        end = _COMMENT_END.match(self.rawdata, i + 4) or _COMMENT_END.search(
            self.rawdata, i + 4)
        return end.end() if end else len(self.rawdata)

    def parse_html_declaration(self, i: int) -> int:
        """A marked section other than CDATA is a comment up to its ``>``; a
        declaration without an end goes on to the page's end."""
        marked = self.rawdata.startswith("<![", i)
        if not marked or self.rawdata.startswith("<![CDATA[", i):
            end = super().parse_html_declaration(i)
            if end >= 0 or not marked:
                return end if end >= 0 else len(self.rawdata)
        end = self.parse_bogus_comment(i)
        return end if end >= 0 else len(self.rawdata)

    def handle_data(self, data: str) -> None:
        if self.unseen and self.stack[-1][0] == "head" and data.strip():
            self._pop(len(self.stack) - 1)
        if not self.unseen:
            self.text.append(data)
            if self.links:
                self.linked += len(data)


_BUTTON = re.compile(r"<(/?)button(?=[\s/>])", re.I)
_COMMENT_END = re.compile(r"(?<=<!--)-?>|--!?>")


def _parsed(html: str, depth: float = 0) -> _Blocks:
    parser = _Blocks(depth)
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser


def leaf_blocks(html: str) -> list[tuple[str, tuple, int]]:
    """Each leaf block's text, ancestors and characters inside links."""
    return _parsed(html, float("inf")).whole


def _bin(n: int) -> int:
    return min(n.bit_length(), 8)


def features(blocks: list[tuple[str, tuple, int]]) -> list[list[int]]:
    """Feature numbers (hashed) of each block of a page."""
    out = []
    for i, (text, ancestors, linked) in enumerate(blocks):
        own = [f"t:{tag}" for tag, _ in ancestors] + [
            f"w:{w}" for _, words in ancestors for w in words]
        own += _form(text, [t for t, _ in ancestors[-2:]], linked, i, len(blocks))
        out.append([_number(f) for f in dict.fromkeys(own)])
    return out


def _form(text: str, near: Sequence[str], linked: int, i: int, n: int) -> list[str]:
    """Features of block ``i`` of ``n`` that are not its ancestors'."""
    own = ["p:" + "/".join(near), f"own:{near[-1] if near else ''}",
           f"words:{_bin(text.count(' ') + 1)}", f"link:{min(4, 4 * linked // max(len(text), 1))}",
           f"end:{text[-1] if text[-1] in '.!?:,;|' else ''}",
           f"at:{min(i, 3)}", f"left:{min(n - 1 - i, 3)}", "bias"]
    if "©" in text or "copyright" in text.lower():
        own.append("copyright")
    return own


_NUMBERS: dict[str, int] = {}


def _number(feature: str) -> int:
    import zlib

    n = _NUMBERS.get(feature)
    if n is None:
        if len(_NUMBERS) > 200_000:
            _NUMBERS.clear()
        n = _NUMBERS[feature] = zlib.crc32(feature.encode()) % FEATURES
    return n


class Field:
    """Linear-chain field over two labels: 0 other, 1 main text."""

    def __init__(self):
        self.state = np.zeros((FEATURES, 2))
        self.step = np.zeros((2, 2))
        self.first = np.zeros(2)

    def scores(self, page: list[list[int]]) -> np.ndarray:
        flat = np.fromiter(chain.from_iterable(page), np.int64)
        return np.add.reduceat(self.state[flat], np.cumsum([0] + [len(b) for b in page[:-1]]))

    def fit(self, pages: list[tuple[list[list[int]], list[int]]], epochs: int = EPOCHS,
            seed: int = 1) -> Field:
        """Gradient steps on the pages' log-likelihood, with steps that shrink
        for weights that have moved (AdaGrad)."""
        order = random.Random(seed)
        seen = [np.full_like(w, 1e-2) for w in (self.state, self.step, self.first)]
        pages = [p for p in pages if p[0]]
        for _ in range(epochs):
            order.shuffle(pages)
            for page, labels in pages:
                s = self.scores(page)
                node, edge = self._marginals(s)
                n = len(page)
                diff = -node
                diff[np.arange(n), labels] += 1
                flat = np.fromiter(chain.from_iterable(page), np.int64)
                rows, at = np.unique(flat, return_inverse=True)
                grad = np.zeros((len(rows), 2))
                np.add.at(grad, at, np.repeat(diff, [len(b) for b in page], axis=0))
                grad -= DECAY * self.state[rows]
                seen[0][rows] += grad ** 2
                self.state[rows] += RATE * grad / np.sqrt(seen[0][rows])
                pairs = -edge
                np.add.at(pairs, (labels[:-1], labels[1:]), 1)
                for w, g, k in ((self.step, pairs, 1), (self.first, diff[0], 2)):
                    seen[k] += g ** 2
                    w += RATE * g / np.sqrt(seen[k])
        return self

    def _marginals(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(s)
        ahead, back = np.zeros((n, 2)), np.zeros((n, 2))
        ahead[0] = s[0] + self.first
        for i in range(1, n):
            ahead[i] = s[i] + np.logaddexp(ahead[i - 1, 0] + self.step[0],
                                           ahead[i - 1, 1] + self.step[1])
        for i in range(n - 2, -1, -1):
            to = s[i + 1] + back[i + 1]
            back[i] = np.logaddexp(self.step[:, 0] + to[0], self.step[:, 1] + to[1])
        total = np.logaddexp(ahead[-1, 0], ahead[-1, 1])
        node = np.exp(ahead + back - total)
        edge = np.exp(ahead[:-1, :, None] + self.step + (s[1:] + back[1:])[:, None, :]
                      - total).sum(axis=0)
        return node, edge

    def decode(self, page: list[list[int]]) -> list[int]:
        """The most probable labels (Viterbi), ties to 0."""
        return self.best(self.scores(page).tolist()) if page else []

    def page_scores(self, page: _Blocks) -> list[list[float]]:
        """``scores`` of a parsed page's blocks: what ancestors add is summed
        once for each context, from the outermost in."""
        def sums(lists: list[list[int]]) -> np.ndarray:
            flat = np.fromiter(chain.from_iterable(lists), np.int64)
            total = np.vstack([np.zeros((1, 2)), np.cumsum(self.state[flat], axis=0)])
            ends = np.cumsum([len(x) for x in lists])
            return total[ends] - total[ends - [len(x) for x in lists]]

        context = sums([new for _, new in page.nodes]).tolist()
        for i, (around, _) in enumerate(page.nodes):
            if i:
                context[i][0] += context[around][0]
                context[i][1] += context[around][1]
        n = len(page.blocks)
        own = sums([[_number(f) for f in _form(text, near, linked, i, n)]
                    for i, (text, _, near, linked) in enumerate(page.blocks)])
        return (own + np.array([context[node] for _, node, _, _ in page.blocks])).tolist()

    def best(self, s: list[list[float]]) -> list[int]:
        """The most probable labels of a chain of blocks with these scores."""
        (a, b), (c, d) = self.step.tolist()
        x, y = s[0][0] + self.first[0], s[0][1] + self.first[1]
        came = []
        for p, q in s[1:]:
            came.append((0 if x + a >= y + c else 1, 0 if x + b >= y + d else 1))
            x, y = max(x + a, y + c) + p, max(x + b, y + d) + q
        label = 0 if x >= y else 1
        out = [label]
        for step in reversed(came):
            label = step[label]
            out.append(label)
        return out[::-1]


# ---------------------------------------------------------- labelled pages
_OUTSIDE = frozenset("nav header footer aside form".split())
#: Words in class, id or role that tell parts apart, for labels and layouts.
_PARTS = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topnav toc pagination",
    "header": "header masthead banner topbar site-title branding",
    "footer": "footer colophon copyright site-info bottom legal",
    "aside": "sidebar aside widget related rail more-stories recommended popular",
    "ad": "ad ads advert advertisement sponsored promo adsense banner-ad",
    "notice": "notice cookie cookies consent alert gdpr popup modal message newsletter-bar",
    "form": "form search search-form newsletter subscribe signup login",
    "comment": "comment comments comment-list respond discussion replies disqus reader-comments",
    "share": "share social sharing follow tags meta",
}
_MAIN = "content post entry article story body text main post-content entry-content article-body"
_NOT_MAIN = frozenset(w for v in _PARTS.values() for x in v.split() for w in x.split("-")) - {
    "text", "body", "message", "meta", "more", "site", "title", "info", "bottom", "top", "list",
    "bar", "stories", "reader", "tags", "form"}


def own_labels(blocks: list[tuple[str, tuple, int]]) -> list[int] | None:
    """Labels from a page's own marking of its article; None without one."""
    marked = [next((i for i, (t, w) in enumerate(a) if t in ("article", "main") or "main" in w),
                   None) for _, a, _ in blocks]
    if not any(m is not None for m in marked):
        return None
    return [int(m is not None and not any(t in _OUTSIDE or set(w) & _NOT_MAIN
                                          for t, w in a[m:]))
            for (_, a, _), m in zip(blocks, marked)]


def likely_labels(blocks: list[tuple[str, tuple, int]]) -> list[int]:
    """Labels for a page that does not mark its article: longer blocks that are
    not links, outside of parts with telling names, and what shares their
    container."""
    def container(ancestors: tuple) -> tuple:
        last = max((i for i, (t, _) in enumerate(ancestors)
                    if t in ("div", "section", "td", "article", "main", "body")), default=-1)
        return ancestors[:last + 1]

    may = [not any(t in _OUTSIDE or set(w) & _NOT_MAIN for t, w in a) and 2 * linked < len(text)
           for text, a, linked in blocks]
    long = {container(a) for (text, a, _), ok in zip(blocks, may)
            if ok and text.count(" ") >= 12}
    return [int(ok and container(a) in long) for (_, a, _), ok in zip(blocks, may)]


def layout(main: list[tuple[str, tuple, int]], other: list[tuple[str, tuple, int]],
           r: random.Random) -> tuple[list[tuple[str, tuple, int]], list[int]]:
    """A labelled page of another kind, from blocks of a sampled one."""
    page: list[tuple[str, tuple, int]] = []
    labels: list[int] = []
    root = [("html", ()), ("body", ())] + [("div", (r.choice(["page", "wrapper", "site", "main",
                                                             "container", "root"]),))] * r.randint(0, 2)
    # a container of main text, told by its tag or by its class only
    place = r.choice([[("article", ())], [("main", ())], [("main", ()), ("article", ())],
                      [("div", tuple(r.choice(_MAIN.split()).split("-")))],
                      [("section", tuple(r.choice(_MAIN.split()).split("-")))],
                      [("article", tuple(r.choice(_MAIN.split()).split("-")))],
                      [("div", ("main",)), ("div", ())], [("div", ("main",)), ("article", ())]])
    shorts = [b for b in other] or [("Home", (), 4)]

    def part(kind: str, inside: list) -> None:
        tag = r.choice({"nav": ["nav", "ul", "div"], "header": ["header", "div"],
                        "footer": ["footer", "div"], "aside": ["aside", "div", "section"],
                        "form": ["form", "form", "div"],
                        "comment": ["section", "div", "ol"]}.get(kind, ["div", "section", "p"]))
        named = tag in ("div", "ul", "section", "p", "ol") or r.random() < 0.6
        words = tuple(r.choice(_PARTS[kind].split()).split("-")) if named else ()
        for _ in range(r.randint(1, 6 if kind in ("nav", "comment", "aside") else 3)):
            long = kind == "comment" or r.random() < 0.25
            text, _, _ = r.choice(main if long and main else shorts)
            if not long:
                text = " ".join(text.split()[:r.randint(1, 12)])
            link = kind in ("nav", "share") or r.random() < 0.2
            leaf = {"nav": [("li", ())], "comment": [r.choice([("p", ()), ("li", ()), ("div", ())])]
                    }.get(kind, r.choice([[("p", ())], [], [("div", ())], [("li", ())]]))
            if kind == "header" and r.random() < 0.5:
                leaf = [("h1", ())] if r.random() < 0.5 else [("div", ("title",))]
            if kind in ("aside", "comment") and r.random() < 0.2:
                leaf, text = [("h3", ())], " ".join(text.split()[:3])
            page.append((text, tuple(inside + [(tag, words)] + leaf
                                     + ([("a", ())] if link else [])), len(text) * link))
            labels.append(0)

    bare = r.random() < 0.1                    # a page of main text only
    for kind in ("notice", "header", "nav", "ad", "aside"):
        if not bare and r.random() < 0.55:
            part(kind, root)
    story = main[:1] if r.random() < 0.1 else main
    mid = r.randint(1, len(story)) if story else 0
    for i, (text, ancestors, linked) in enumerate(story):
        own = [ancestors[-1]] if ancestors and ancestors[-1][0] not in ("article", "main", "div") \
            else [("p", ())]
        if r.random() < 0.05:
            own = [("ul", ()), ("li", ())] if r.random() < 0.5 else [("blockquote", ()), ("p", ())]
        if r.random() < 0.15:                  # a heading before it
            cut = " ".join(text.split()[:r.randint(1, 8)]).rstrip(".,")
            page.append((cut, tuple(root + place + [(r.choice(["h1", "h2", "h3"]), ())]), 0))
            labels.append(1)
        if r.random() < 0.1:                   # short, long, or without a full stop
            text = r.choice([" ".join(text.split()[:r.randint(1, 9)]), " ".join([text] * 40),
                             text.rstrip(".")]) or text
        page.append((text, tuple(root + place + own), linked))
        labels.append(1)
        if not bare and i + 1 == mid and r.random() < 0.5:
            part(r.choice(["ad", "share", "form", "notice", "aside"]), root + place)
    for kind in ("share", "comment"):
        if not bare and r.random() < 0.4:
            part(kind, root + place if r.random() < 0.5 else root)
    for kind in ("aside", "ad", "form", "comment", "footer", "notice"):
        if not bare and r.random() < 0.45:
            part(kind, root)
    return page, labels


def train(pages: DataFrame, train_pages: int = TRAIN_PAGES, seed: int = 11) -> Field:
    """The field, from the ``train_pages`` pages with the smallest hashes of their ids."""
    usable = pages.select("page_id", F.col("html").cast("string").alias("html")).where(
        F.length("html").between(1, TRAIN_CHARS))
    sample = [r["html"] for r in
              hashed_sample(usable, "page_id", train_pages, usable.count()).collect()]
    return Field().fit(labelled(sample, seed))


def labelled(sample: list[str], seed: int = 11) -> list[tuple[list[list[int]], list[int]]]:
    """Labelled pages from sampled ones, and new layouts of their blocks. If no
    page of the sample has a main text, layouts of stock blocks stand for them."""
    r = random.Random(seed)
    out = []
    for html in sample:
        page = _parsed(html, TRAIN_DEPTH)
        if page.deep:
            continue
        blocks = page.whole
        own = own_labels(blocks) or likely_labels(blocks)
        if not any(own):
            continue
        out.append((features(blocks), own))
        main = [b for b, y in zip(blocks, own) if y]
        other = [b for b, y in zip(blocks, own) if not y]
        for _ in range(3):
            page, labels = layout(main, other, r)
            out.append((features(page), labels))
    for _ in range(0 if out else STOCK_LAYOUTS):
        page, labels = layout([(t, (("p", ()),), 0) for t in r.sample(_STOCK, len(_STOCK))],
                              [], r)
        out.append((features(page), labels))
    return out


#: Layouts trained on where no sampled page has a main text, and their blocks.
STOCK_LAYOUTS = 150
_STOCK = ("The river rose after a week of rain, and the lower fields were under water by Friday.",
          "She said that the survey would be repeated in spring. Nobody had asked for it before.",
          "A second report, published last month, comes to the same result with other data.",
          "Prices fell for the third year in a row.",
          "How the two methods compare is shown below; both need about an hour for each sample.")


def main_text(html: str, field: Field) -> str:
    page = _parsed(html)
    if not page.blocks:
        return ""
    return " ".join(b[0] for b, y in zip(page.blocks, field.best(field.page_scores(page))) if y)


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    Null and empty pages, and pages without main text, have the empty text. Odd
    declarations are comments; an open comment, declaration or tag goes on to the
    page's end; an open head ends at the first thing not its own, an open button
    at the next block; nothing in an unseen element ends what is around it.
    Repeated rows are extracted each; other columns are ignored; an empty
    input gives no rows.
    """
    ship(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(field or train(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = shared.value
        for batch in batches:
            found = [main_text(t.decode(), trained) for t in texts_of(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()),
                 pa.array([len(t) for t in found], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                        F.col("html").cast("string")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
