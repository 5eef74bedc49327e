"""Main text of web pages by tree scoring.

A page is read once by a tag pattern into a flat tree (parents before children).
Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are cut by element, role and class. A class, an id or a form cuts no subtree that
holds the article: its one article or main element, or most of the page's unlinked text
(for names that say plainly what they are, nearly all of it; for reader comments, only
the element counts). Inside an article element a name whose last word is none of the cut
words ("share-price") cuts nothing between other text unless most of it is links; paragraphs are
cut by plain names only. Every block with text of its own
passes points for its length and its commas, discounted by the share of link text,
to the container around it, half of them to the next, and less further up. The container
with the most points after its own link discount is kept, with those siblings that
score like text; of it all blocks stay, whatever their length. Without an article or main
element the same holds for every level above: headings, lists and sections of little
link text stay that stand next to what is kept, in an unbroken run; after it, those
that are text blocks, sections of the same make, or end like a sentence.

Defined cases: null, empty or textless pages give an empty text; unclosed and
stray tags are repaired as browsers do it for paragraphs, list items and table
cells; an unclosed comment, script or style ends the page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: element names of HTML, and words that name what is no article
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "html body main article section div p pre blockquote ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "h1 h2 h3 h4 h5 h6 header footer nav aside form fieldset figure figcaption address details summary hr center "
    "dialog menu search hgroup".split()
)
CUT_TAGS = frozenset(
    "head script style title noscript template iframe nav footer aside form button select option textarea input svg math "
    "canvas object embed audio video dialog menu search fieldset label".split()
)
CUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist status tooltip".split()
)
CUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored sponsors promo promos promotion "
    "promoted nav navbar navigation navigator menu menus breadcrumb breadcrumbs pager pagination sidebar sidebars sidenav aside "
    "rail widget widgets footer foot colophon copyright masthead topbar banner banners cookie cookies consent gdpr notice notices "
    "notification notifications alert alerts popup popups modal overlay newsletter subscribe subscription signup login signin paywall "
    "comment comments commentlist commentary disqus respond replies reply share sharing social related recommended recommendations "
    "recirculation trending outbrain taboola skip search searchbox hidden".split()
)
CUT_HEADER_WORDS = frozenset("header head toolbar".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond replies reply".split())
#: Words before and after a cut word that tell of a layout or a state, not of what the element is.
LAYOUT_BEFORE = frozenset("has no with without".split())
LAYOUT_AFTER = frozenset("open closed enabled disabled on off xs sm md lg xl mobile phone tablet desktop print".split())
#: Words that leave a cut word what it is ("comment-list", "sidebar-inner").
PART_WORDS = frozenset(
    "list lists area section sections box block blocks container wrapper wrap inner outer content body item items text title "
    "bar group holder panel links posts articles stories".split()
)
#: Further words that say where or how an element stands, not what it is ("ad-slot", "newsletter-top").
PLACE_WORDS = frozenset(
    "slot unit card cards button buttons form thread dialog space placement label icon icons module component region zone count "
    "counts tools cta prompt message strip tray wrap header top left right bottom mid middle center inline main side native frame "
    "row col column feed stream".split()
)
#: Cuts that may hold the article: forms, and names in classes and ids by how plain they are.
FORM_TAGS = frozenset("form fieldset".split())
HARD, WEAK, LOOSE, PLAIN, COMMENT = 1, 2, 3, 4, 5
#: Elements that a class never cuts.
KEEP_TAGS = frozenset("html body article main".split())
CLOSES = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
    "thead": frozenset(["tr", "td", "th", "thead", "tbody"]),
    "tbody": frozenset(["tr", "td", "th", "thead", "tbody"]),
}
#: Elements that can hold an article; points go to the nearest of them.
CONTAINERS = frozenset("#root html body main article section div td center fieldset details".split())
#: Blocks of running text.
TEXT_TAGS = frozenset("p pre blockquote ul ol dl table h1 h2 h3 h4 h5 h6 figure".split())
#: Elements out of which an implied end never reaches.
FENCES = frozenset("ul ol dl table html body article section div main aside nav header footer form blockquote".split())

# no alternative scans the same text twice: quoted values and open tags may run to the page's end
_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|))*+)(>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW}
_COMMAS = re.compile(r"[,،、，﹐]")
_STOP = re.compile(r"[.!?。！？][\"'”’)]*$")


class Page:
    """The flat tree of one page: for each node its tag, parent, names and cut; texts in page order."""

    def __init__(self, html: str):
        self.tag, self.parent, self.names = ["#root"], [0], [""]
        #: what cuts the node itself, 0 for nothing; HARD is passed on to all below
        self.cut = [0]
        #: article and main elements whose own names say that they are something else
        self.misnamed: set[int] = set()
        #: (node, text) in page order; text None marks a border between blocks
        self.flow: list[tuple[int, str | None]] = []
        self._open = [0]
        self._count: dict[str, int] = {}
        self._read(html)

    def _read(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            m = _TOKEN.search(html, at)
            if m is None:
                self._text(html[at:])
                return
            if m.start() > at:
                self._text(html[at : m.start()])
            at = m.end()
            if not m[4]:  # a comment, a declaration, or a tag that the page's end cuts off
                continue
            name = m[2].lower()
            if m[1]:
                self._end(name)
            else:
                self._start(name, m[3])
                if name in RAW:
                    end = _RAW_END[name].search(html, at)
                    at = end.end() if end else size
                    self._end(name)

    def _text(self, text: str) -> None:
        if self.cut[self._open[-1]] != HARD:
            self.flow.append((self._open[-1], unescape(text) if "&" in text else text))

    def _start(self, name: str, attributes: str) -> None:
        if name in BLOCK and self._count.get("p"):
            self._close_upto(("p",), FENCES)
        if name in CLOSES and any(map(self._count.get, CLOSES[name])):
            self._close_all(CLOSES[name])
        top = self._open[-1]
        if name == "br":
            self.flow.append((top, " "))
        if name in VOID:
            if name == "hr":
                self.flow.append((top, None))
            return
        node = len(self.tag)
        self.tag.append(name)
        self.parent.append(top)
        self.names.append("")
        self.cut.append(HARD if self.cut[top] == HARD else self._cut_by(name, attributes, node))
        self._open.append(node)
        self._count[name] = self._count.get(name, 0) + 1
        if name in BLOCK:
            self.flow.append((node, None))

    def _end(self, name: str) -> None:
        if name == "p" and not self._count.get("p"):
            return
        if self._count.get(name):
            self._close_upto((name,), frozenset() if name in FENCES else FENCES - {name})

    def _pop(self) -> None:
        node = self._open.pop()
        self._count[self.tag[node]] -= 1
        if self.tag[node] in BLOCK:
            self.flow.append((self._open[-1], None))

    def _close_upto(self, names: tuple[str, ...], fences: frozenset) -> None:
        """Closes the nearest open element of ``names`` and all in it, unless a fence stands between."""
        for k in range(len(self._open) - 1, 0, -1):
            name = self.tag[self._open[k]]
            if name in names:
                while len(self._open) > k:
                    self._pop()
                return
            if name in fences:
                return

    def _close_all(self, names: frozenset) -> None:
        while True:
            before = len(self._open)
            self._close_upto(tuple(names), FENCES)
            if len(self._open) == before:
                return

    def _cut_by(self, name: str, attributes: str, node: int) -> int:
        if name in CUT_TAGS and name not in FORM_TAGS:
            return HARD
        found = LOOSE if name in FORM_TAGS else 0
        in_article = bool(self._count.get("article"))
        if name == "header" and not in_article:
            return HARD
        if not attributes or attributes.isspace():
            return found
        for m in _ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                return HARD
            if key == "role" and (roles := CUT_ROLES.intersection(value.lower().split())):
                if roles != {"form"}:
                    return HARD
                found = max(found, LOOSE)
            if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return HARD
            if key in ("class", "id"):
                if key == "class":
                    self.names[node] = value
                for token in value.split():
                    kind, sure = _named(token, in_article)
                    if name == "p":
                        found = max(found, kind if sure and kind >= PLAIN else 0)
                    elif name not in KEEP_TAGS:
                        found = max(found, kind)
                    elif kind:
                        self.misnamed.add(node)
        return found


def _named(token: str, in_article: bool) -> tuple[int, bool]:
    """What one name of a class or id cuts by, 0 if it is no cut; and whether it says what the element is."""
    words = [w.lower() for w in _WORD.findall(token)]
    cut = [w in CUT_WORDS or (w in CUT_HEADER_WORDS and not in_article) for w in words]
    of_layout = [
        (k > 0 and words[k - 1] in LAYOUT_BEFORE) or (k + 1 < len(words) and words[k + 1] in LAYOUT_AFTER) for k in range(len(words))
    ]
    found = [w for w, c, no in zip(words, cut, of_layout) if c and not no]
    if not found:
        return 0, False
    plain = all(c or w in CUT_HEADER_WORDS or w in PART_WORDS for w, c in zip(words, cut))
    # the last word that names more than a part is what the element is
    noun = next((c for w, c in reversed(list(zip(words, cut))) if c or not (w in PART_WORDS or w in PLACE_WORDS)), False)
    if in_article and not plain and not noun:
        return WEAK, False
    if COMMENT_WORDS.intersection(found):
        return COMMENT, plain or noun
    return (PLAIN if plain else LOOSE), plain or noun


def _keep_weak(page: Page, soft: list[int], linked: list[bool]) -> None:
    """Undoes weak cuts that are mostly unlinked and stand between free text of their article."""
    tag, parent = page.tag, page.parent
    n = len(tag)
    article, under = [0] * n, [False] * n
    for i in range(1, n):
        article[i] = i if tag[i] == "article" else article[parent[i]]
        under[i] = bool(soft[i]) or under[parent[i]]
    every, unlinked, place = [0] * n, [0] * n, [len(page.flow)] * n
    span: dict[int, tuple[int, int]] = {}
    for at, (node, text) in enumerate(page.flow):
        k = sum(map(len, text.split())) if text is not None else 0
        if k:
            every[node] += k
            place[node] = min(place[node], at)
            if not linked[node]:
                unlinked[node] += k
                if not under[node]:
                    span[article[node]] = (span.get(article[node], (at, at))[0], at)
    for i in range(n - 1, 0, -1):
        every[parent[i]] += every[i]
        unlinked[parent[i]] += unlinked[i]
        place[parent[i]] = min(place[parent[i]], place[i])
    for i in range(1, n):
        if soft[i] == WEAK and 2 * unlinked[i] > every[i]:
            first, last = span.get(article[i], (-1, n + len(page.flow)))
            if first < place[i] < last:
                soft[i] = 0


def _gone(page: Page) -> list[bool]:
    """For each node whether it is cut, once those cuts are undone that hold the article."""
    tag, parent, cut = page.tag, page.parent, page.cut
    n = len(tag)
    # HARD is passed on while the page is read; everything else only counts for what is below
    soft = [c if c > HARD else 0 for c in cut]
    if not any(soft):
        return [c == HARD for c in cut]
    linked, in_comment, under = [False] * n, [False] * n, [False] * n
    for i in range(1, n):
        linked[i] = tag[i] == "a" or linked[parent[i]]
    if WEAK in soft:
        _keep_weak(page, soft, linked)
    for i in range(1, n):
        in_comment[i] = soft[i] == COMMENT or in_comment[parent[i]]
        under[i] = bool(soft[i]) or under[parent[i]]
    #: unlinked text, all of it and without comments, of each subtree
    every, size = [0] * n, [0] * n
    outside = 0
    for node, text in page.flow:
        if text is not None and not linked[node]:
            k = sum(map(len, text.split()))
            every[node] += k
            if not in_comment[node]:
                size[node] += k
            if not under[node]:
                outside += k
    for i in range(n - 1, 0, -1):
        every[parent[i]] += every[i]
        size[parent[i]] += size[i]
    articles = [i for i in range(1, n) if tag[i] in ("article", "main") and cut[i] != HARD and i not in page.misnamed and every[i]]
    if articles and all(under[i] for i in articles):
        # an article that is cut as a whole: the longest one, if it is more than what is not cut
        top = max(articles, key=lambda i: every[i])
        if every[top] > outside:
            while top:
                soft[top] = 0
                top = parent[top]
    total = size[0]
    for i in range(1, n):
        if (soft[i] in (WEAK, LOOSE) and 2 * size[i] > total) or (soft[i] == PLAIN and 10 * size[i] > 9 * total):
            soft[i] = 0
    gone = [False] * n
    for i in range(1, n):
        gone[i] = cut[i] == HARD or bool(soft[i]) or gone[parent[i]]
    return gone


def _add_neighbours(page: Page, best: int, score, own, all_size, density, last_text, chosen: set[int]) -> None:
    """Adds to ``chosen``, level by level above ``best``, what belongs to the same text."""
    tag, parent = page.tag, page.parent
    children: dict[int, list[int]] = {}
    ends_in = [bool(t and _STOP.search(t)) for t in last_text]
    for i in range(len(tag) - 1, 0, -1):
        children.setdefault(parent[i], []).append(i)
        # the last text of a subtree stands in its last block with text
        if all_size[i] and not last_text[parent[i]]:
            last_text[parent[i]], ends_in[parent[i]] = last_text[i], ends_in[i]
    enough = 0.2 * score[best]
    at = best
    while at:
        up = parent[at]
        row = [i for i in reversed(children[up]) if all_size[i] or i == at]
        middle = row.index(at)
        like = [density[i] < 0.25 for i in row]
        take = {middle} | {k for k, i in enumerate(row) if score[i] + own[i] >= enough and density[i] < 0.5}
        make = (tag[at], page.names[at])
        take |= {k for k, i in enumerate(row) if like[k] and page.names[i] and (tag[i], page.names[i]) == make}
        # all that reads as text between two that stay, before the first, and after the last
        first, last = min(take), max(take)
        take |= {k for k in range(first, last) if like[k]}
        while first and like[first - 1]:
            first -= 1
            take.add(first)
        while last + 1 < len(row) and like[last + 1] and (tag[row[last + 1]] in TEXT_TAGS or ends_in[row[last + 1]]):
            last += 1
            take.add(last)
        chosen.update(row[k] for k in take if row[k] != at)
        at = up


def main_text(html: str) -> str:
    """The article of one page, its blocks joined by line feeds."""
    page = Page(html)
    tag, parent = page.tag, page.parent
    n = len(tag)
    gone = _gone(page)
    page.flow = [(node, text) for node, text in page.flow if text is None or not gone[node]]
    # the block each node's text belongs to, and whether it stands in a link
    block, linked = [0] * n, [False] * n
    for i in range(1, n):
        block[i] = i if tag[i] in BLOCK else block[parent[i]]
        linked[i] = tag[i] == "a" or linked[parent[i]]
    # the nearest container above each node
    holder = [0] * n
    for i in range(1, n):
        up = parent[i]
        holder[i] = up if tag[up] in CONTAINERS else holder[up]
    size, links, commas = [0] * n, [0] * n, [0] * n
    last_text = [""] * n
    for node, text in page.flow:
        if text is not None and (text := " ".join(text.split())):
            b = block[node]
            size[b] += len(text)
            commas[b] += len(_COMMAS.findall(text))
            last_text[b] = text
            if linked[node]:
                links[b] += len(text)
    points = [0.0] * n
    loose: set[int] = set()
    all_size, all_links = size[:], links[:]
    for i in range(n - 1, 0, -1):
        all_size[parent[i]] += all_size[i]
        all_links[parent[i]] += all_links[i]
    own = [0.0] * n
    for i in range(1, n):
        if size[i]:
            own[i] = (1 + commas[i] + min(size[i] / 100, 3)) * (1 - links[i] / size[i])
            node = i
            for share in (1, 2, 6, 12, 24):
                if node == 0:
                    break
                node = holder[node]
                points[node] += own[i] / share
    density = [all_links[i] / all_size[i] if all_size[i] else 0.0 for i in range(n)]
    score = [points[i] * (1 - density[i]) for i in range(n)]
    # among equals the last one, which is the deeper or the later
    best = max(range(n), key=lambda i: (score[i], i))
    if best == 0 or score[best] <= 0:
        chosen = {0}
    else:
        node = best
        while node and tag[node] not in ("article", "main"):
            node = parent[node]
        best = node or best
        chosen = {best}
        if node:
            enough = max(10.0, 0.2 * score[best])
            for i in range(1, n):
                if parent[i] == parent[best] and i != best:
                    text_like = tag[i] == "p" and (
                        (all_size[i] > 80 and density[i] < 0.25)
                        or (0 < all_size[i] <= 80 and not all_links[i] and _STOP.search(last_text[i]))
                    )
                    if score[i] + own[i] >= enough or text_like:
                        chosen.add(i)
        elif best:
            _add_neighbours(page, best, score, own, all_size, density, last_text, chosen)
            # text that stands between the blocks of a level that is kept in part
            up = best
            while up:
                up = parent[up]
                if 4 * links[up] < size[up]:
                    loose.add(up)
    kept = [False] * n
    for i in range(n):
        kept[i] = i in chosen or (i > 0 and kept[parent[i]])
    blocks: list[str] = []
    open_: list[str] = []
    for node, text in page.flow:
        if text is None:
            if open_:
                blocks.append(" ".join("".join(open_).split()))
                open_ = []
        elif kept[node] or block[node] in loose:
            open_.append(text)
    if open_:
        blocks.append(" ".join("".join(open_).split()))
    return "\n".join(b for b in blocks if b)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) if h else "" for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
