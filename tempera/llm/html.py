"""The main text of web pages, by scores that paragraphs pass up the tree of elements.

A page is read tag by tag into a tree: raw text elements, comments and void elements as in HTML, a block start ends an open
paragraph, an end tag closes what is open inside its element, and whatever is open at the end ends there. Elements that
are never part of an article go with all they hold: menus, footers, asides, forms, scripts, styles, embedded and hidden
things, headers outside an article, and elements whose class, id or role names a menu, sidebar, notice, advert, share bar,
comment section and the like. A name that only says what its element has beside the text, as ``has-sidebar`` does, is not
one, and neither is one of the page's body or of an element that holds the article itself.

The text between two block borders is a paragraph. Its points, for its length and commas, go to its element, half of
them to the parent, a quarter to the next, and so on; what an element gets is discounted by the share of its text that
is in links. The best element is the container, or else the ``article``, ``main`` or element named as one that it stands in.
With few links, siblings of the container and of what it is in are kept if they have a fifth of its score, are
paragraphs of some length or headings before it; beside an article or main part only a title is. Of what is kept no
paragraph is dropped, however short.

Character references are decoded, white space inside a paragraph is one space, and paragraphs are joined by line feeds.
A NULL or empty page, and one without text, has the empty text. Each row is judged by itself, repeated rows alike; the work
grows with the length of a page, whatever its nesting. Other columns are carried, and may have any name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempera.llm.common import col, lean, slices

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre search section "
    "select summary table tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What the start of an element ends, if it is open within the elements named second.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "body": ({"head"}, set()),
}
# What no article consists of.
NEVER = frozenset(
    "nav footer aside form button select datalist menu dialog script style noscript template iframe object embed svg canvas "
    "audio video head title textarea xmp noembed noframes search map".split()
)
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
NEVER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot banner sponsor sponsors sponsored promo "
    "promos promotion outbrain taboola sidebar sidebars aside nav navbar navigation menu menus breadcrumb breadcrumbs pagination "
    "pager paginator footer header masthead topbar toolbar comment comments commentlist commentform disqus reply replies respond "
    "notice notices cookie cookies consent gdpr alert popup modal overlay lightbox toast newsletter subscribe subscription signup "
    "login signin share sharing social related recommended recommendations teaser teasers skip".split()
)
OWN_WORDS = frozenset("article post entry story content text main".split())
BESIDE = frozenset("with has no without is not show hide js".split())
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

TAG = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*+(?:>|\Z)|/(?=[^A-Za-z])[^>]*+(?:>|\Z)"
    r"|(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)"
    r"(?P<rest>(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)?+)*+)(?:>|\Z))",
    re.DOTALL,
)
ATTRIBUTE = re.compile(
    r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s>\"'][^\s>]*+)))?", re.DOTALL
)
NAMING = re.compile(r"class|id|role|hidden|style", re.IGNORECASE)
DEEPEST = 512  # elements deeper than this become siblings, as in browsers
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
COMMAS = re.compile("[,，、،]")
LEAST = 25  # characters from which a paragraph counts fully
SIBLING = 0.2  # of the best score
FEW_LINKS = 0.25


class Page:
    """The elements of a page, in the order of their start, and its paragraphs."""

    def __init__(self, html: str):
        self.tags, self.parents, self.marked = ["#"], [-1], [False]
        self.named_main, self.own_name = [False], [False]
        #: Pieces of text: element, whether in a link, text; a piece without text is the border of a block.
        self.pieces: list[tuple[int, bool, str]] = []
        self._open, self._count = [0], Counter()
        self._read(html)

    def _read(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            found = TAG.search(html, at)
            self._text(html[at : found.start()] if found else html[at:])
            if not found:
                return
            at = found.end()
            name = found["name"]
            if not name:
                continue
            name = name.lower()
            if found["end"]:
                self._close(name)
            else:
                self._start(name, found["rest"])
                if name in RAW:
                    closing = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(html, at)
                    at = closing.start() if closing else end
                elif name == "plaintext":
                    self._text(html[at:])
                    return

    def _text(self, text: str) -> None:
        if text:
            self.pieces.append((self._open[-1], self._count["a"] > 0, unescape(text)))

    def _border(self) -> None:
        if self.pieces and self.pieces[-1][2]:
            self.pieces.append((self._open[-1], False, ""))

    def _start(self, name: str, rest: str) -> None:
        if name == "br":
            self._text(" ")
            return
        if name in BLOCKS:
            self._border()
            if name not in ("option", "optgroup"):
                self._end_open({"p"}, {"td", "th", "table", "button", "caption", "object"})
        if name in HEADINGS and self.tags[self._open[-1]] in HEADINGS:
            self._pop(len(self._open) - 1)
        if name in ENDS:
            self._end_open(*ENDS[name])
        if name == "a":
            self._end_open({"a"}, {"td", "th", "table"}, inline=True)
        if name in VOID:
            return
        if len(self._open) > DEEPEST:
            self._pop(DEEPEST)
        attributes = self._attributes(rest) if NAMING.search(rest) else {}
        self.tags.append(name)
        self.parents.append(self._open[-1])
        self.marked.append(never(name, attributes))
        self.named_main.append(name == "main" or attributes.get("role", "").strip().lower() == "main")
        self.own_name.append(any(OWN_WORDS.intersection(said) for said in names(attributes)))
        self._open.append(len(self.tags) - 1)
        self._count[name] += 1

    @staticmethod
    def _attributes(rest: str) -> dict[str, str]:
        found: dict[str, str] = {}
        for name, *values in ATTRIBUTE.findall(rest):
            found.setdefault(name.lower(), unescape("".join(values)))
        return found

    def _end_open(self, names: set[str], within: set[str], inline: bool = False) -> None:
        """Close the outermost open element of ``names`` that is not beyond one of ``within``."""
        last = None
        if not any(self._count[n] for n in names):
            return
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self.tags[self._open[depth]]
            if tag in names:
                last = depth
                if len(names) == 1:
                    break
            elif tag in within or (inline and tag in BLOCKS):
                break
        if last is not None:
            self._pop(last)

    def _close(self, name: str) -> None:
        block = name in BLOCKS
        if block:
            self._border()
        if not self._count[name] and name not in HEADINGS:
            return
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self.tags[self._open[depth]]
            if tag == name or (name in HEADINGS and tag in HEADINGS):
                self._pop(depth)
                return
            if not block and tag in BLOCKS or tag in ("table", "td", "th") and name not in TABLES:
                return

    def _pop(self, depth: int) -> None:
        for element in self._open[depth:]:
            self._count[self.tags[element]] -= 1
            if self.tags[element] in BLOCKS:
                self._border()
        del self._open[depth:]


TABLES = frozenset("table tbody thead tfoot tr td th body html article main section div form".split())


def never(name: str, attributes: dict[str, str]) -> bool:
    """Whether an element is by its own words no part of an article."""
    if name in NEVER:
        return True
    if name in ("html", "body", "main"):
        return False
    if "hidden" in attributes or UNSEEN.search(attributes.get("style", "")):
        return True
    if attributes.get("aria-hidden", "").strip().lower() == "true":
        return True
    if set(attributes.get("role", "").lower().split()) & NEVER_ROLES:
        return True
    for said in names(attributes):
        found = NEVER_WORDS.intersection(said)
        if name in HEADINGS or name == "header" or said[0] in OWN_WORDS:
            found -= {"header", "banner", "masthead"}
        if found and said[0] not in BESIDE:
            return True
    return "hidden" in attributes.get("class", "").split()


def names(attributes: dict[str, str]) -> list[list[str]]:
    """The words of every class name and of the id."""
    each = f"{attributes.get('class', '')} {attributes.get('id', '')}".split() if attributes else []
    return [said for one in each if (said := [w.lower() for w in WORD.findall(one)])]


def text_of_page(html: str) -> str:
    """The main text of a page; see the module."""
    if "<" not in html:
        return " ".join(unescape(html).split())
    page = Page(html)
    text = _chosen(page, _dropped(page, named=True))
    return text or _chosen(page, _dropped(page, named=False))


def _dropped(page: Page, named: bool) -> list[bool]:
    """Elements that are no part of an article, by their own words (if ``named``) or those of an element they are in.

    An element that holds an unmarked ``article`` or ``main`` is not dropped for its names, and a form not even
    for its tag; nor is, on a page without these, a form that holds most of the text.
    """
    n = len(page.tags)
    holds, inside, junk, prose = [False] * n, [False] * n, [False] * n, [0] * n
    for i in range(1, n):
        inside[i] = inside[page.parents[i]] or page.tags[i] == "article" or page.named_main[i]
        junk[i] = junk[page.parents[i]] or page.marked[i] and page.tags[i] != "form"
    for of, _, text in page.pieces:
        if not junk[of] and (page.tags[of] == "p" or page.tags[page.parents[of]] == "p"):
            prose[of] += len(text)
    for i in range(n - 1, 0, -1):
        up = page.parents[i]
        prose[up] += prose[i]
        holds[i] = holds[i] or not page.marked[i] and (page.tags[i] == "article" or page.named_main[i])
        holds[up] = holds[up] or holds[i] and not (page.marked[i] and page.tags[i] in NEVER - {"form"})
    out = [False] * n
    for i in range(1, n):
        tag = page.tags[i]
        drop = page.marked[i] and not holds[i] and (named or tag in NEVER)
        if tag == "form" and not holds[0] and 2 * prose[i] > prose[0]:
            drop = False
        out[i] = out[page.parents[i]] or drop or page.marked[i] and tag in NEVER - {"form"}
        out[i] = out[i] or tag == "header" and not inside[i] and not holds[i]
    return out


def _paragraphs(page: Page, dropped: list[bool]) -> list[tuple[int, str, int]]:
    """Element, text and characters in links of every paragraph that is not dropped, in order."""
    out, texts, links, element = [], [], 0, -1
    # A piece with no text is a border.
    for of, linked, text in [*page.pieces, (0, False, "")]:
        if not text:
            joined = " ".join("".join(texts).split())
            if joined:
                out.append((element, joined, min(links, len(joined))))
            texts, links, element = [], 0, -1
        elif not dropped[of]:
            if element < 0 and not text.isspace():
                element = _block_of(page, of)
            texts.append(text)
            links += len(text.strip()) if linked else 0
    return out


def _block_of(page: Page, element: int) -> int:
    while element and page.tags[element] not in BLOCKS:
        element = page.parents[element]
    return element


def _chosen(page: Page, dropped: list[bool]) -> str:
    paragraphs = _paragraphs(page, dropped)
    if not paragraphs:
        return ""
    n = len(page.tags)
    score, length, linked = [0.0] * n, [0] * n, [0] * n
    for of, text, links in paragraphs:
        points = len(text) / 100 if len(text) < LEAST else 1 + len(COMMAS.findall(text)) + min(len(text) / 100, 3)
        # A paragraph element hands its points on; it is no container itself.
        own = page.parents[of] if page.tags[of] in PARAGRAPHS and of else of
        score[max(own, 0)] += points
        length[of] += len(text)
        linked[of] += links
    for i in range(n - 1, 0, -1):  # children come after their parents
        up = page.parents[i]
        score[up] += score[i] / 2
        length[up] += length[i]
        linked[up] += linked[i]
    density = [k / max(m, 1) for k, m in zip(linked, length, strict=True)]
    score = [s * (1 - d) for s, d in zip(score, density, strict=True)]
    best = max((i for i in range(n) if length[i] and page.tags[i] not in LINES), key=lambda i: (score[i], -i), default=0)
    kept = _kept(page, _grown(page, best), score, length, density)
    menus = _menus(page, length, density)
    return "\n".join(text for of, text, _ in paragraphs if kept[of] and not menus[of])


#: Elements that hand the points of their own text to their parent, and those that are never a container.
LINES = HEADINGS | {"p", "pre", "dt", "figcaption", "caption", "summary"}
PARAGRAPHS = LINES | {"li", "dd", "td", "th", "blockquote"}


def _grown(page: Page, best: int) -> int:
    """The article, main part or element named as one that the best element is or stands in."""
    chain = [best]
    while chain[-1] > 0:
        chain.append(page.parents[chain[-1]])
    for outer in (
        [i for i in chain if page.tags[i] == "article"][-1:],
        [i for i in chain if page.named_main[i]][-1:],
        [i for i in chain if page.own_name[i] and page.tags[i] not in ("body", "html")][:1],
    ):
        if outer:
            return outer[0]
    return best


def _kept(page: Page, container: int, score: list[float], length: list[int], density: list[float]) -> list[bool]:
    """The container and what it holds, and the siblings of it, and of what it is in, that are text as well."""
    n = len(page.tags)
    kept, least = [False] * n, max(SIBLING * score[container], 1e-9)
    kept[container] = True
    titled = _holds_title(page, container)
    of, alone = container, page.tags[container] == "article" or page.named_main[container]
    beside: dict[int, int] = {}
    while of > 0 and page.tags[of] not in ("body", "html"):
        beside[page.parents[of]] = of
        of = page.parents[of]
    for i in range(1, n):
        of = beside.get(page.parents[i])
        if of is not None and i != of and length[i] and density[i] <= FEW_LINKS:
            if page.tags[i] == "h1":
                kept[i] = i < of and not titled
            elif not alone and page.tags[i] in HEADINGS:
                kept[i] = i < of
            elif not alone:
                kept[i] = score[i] >= least or page.tags[i] in PARAGRAPHS and length[i] >= LEAST
        kept[i] = kept[i] or kept[page.parents[i]]
    return kept


def _holds_title(page: Page, container: int) -> bool:
    inside = [False] * len(page.tags)
    inside[container] = True
    for i in range(container + 1, len(page.tags)):
        inside[i] = inside[page.parents[i]]
        if inside[i] and page.tags[i] == "h1":
            return True
    return False


def _menus(page: Page, length: list[int], density: list[float]) -> list[bool]:
    """Lists outside an article that hold nothing but links."""
    n = len(page.tags)
    out, inside = [False] * n, [False] * n
    for i in range(1, n):
        up, tag = page.parents[i], page.tags[i]
        inside[i] = inside[up] or tag == "article"
        out[i] = out[up] or (tag in ("ul", "ol", "dl") and not inside[i] and length[i] > 0 and density[i] > 0.9)
    return out


def extract(pages: DataFrame, html: str = "html", carry: list[str] | None = None) -> DataFrame:
    """``row``, the carried columns (all but the page by default), and the main ``text`` of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "html"):
            texts = pa.array([text_of_page(h) for h in b.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("row"), texts], names=["row", "text"])

    columns = [c for c in pages.columns if c != html] if carry is None else carry
    source = pages.select(F.struct(*[col(c) for c in columns]).alias("row"), F.coalesce(col(html), F.lit("")).alias("html"))
    return lean(source).mapInArrow(run, f"row {source.schema['row'].dataType.simpleString()}, text string")
