"""Main text of web pages by tag-path ratios.

Each block of a page lies at the end of a root-to-leaf path of tags. Over all blocks of a path, the
mean length of its text outside links and its mean number of punctuation marks are two ratios: long,
punctuated blocks are prose, short bare ones are menus. Both are smoothed (a path also gets a part of
what lies in the containers around it), fused by their product, and a path is content when its score
reaches a share of the best one. What tags, classes and roles say comes in as a prior: elements that
are furniture by their tag or role (menus, forms, asides and the like) are left out, paths through
elements that only their class or id names so score a small part, and paths in an article or main element
score more, the more of the page's text such elements hold. So a body that is badly named is found where
nothing else on the page comes near its ratios.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthspan.llm.shared import slices

# A path is content from this share of the best score on.
SHARE = 0.03
# What a path gets of the ratios of the container around it, and again of that one's container.
PART = 0.5
# By how much an article or main element that holds all text raises its paths' scores.
PRIOR = 16.0

# What is left of the score of a path through an element whose class or id names furniture: such a path is
# content only if its ratios are ten times those of the best path without.
NAMED = SHARE / 10

# Names in HTML, and words that sites use for parts that are not the article.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_FURNITURE = frozenset(
    "head nav footer aside form button select option datalist fieldset legend label dialog menu "
    "script style noscript template textarea title iframe object svg canvas audio video map "
    "noembed noframes".split()
)
_FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar "
    "toolbar tablist tooltip status".split()
)
_FURNITURE_WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising advertorial adsense sponsor sponsored "
    "sponsors promo promos promotion promoted banner banners sidebar sidebars aside rail nav navbar "
    "navigation menu menus submenu breadcrumb breadcrumbs crumbs footer foot header masthead topbar "
    "toolbar comment comments commentlist respond reply replies discussion disqus cookie cookies consent "
    "gdpr notice notices notification alert alerts popup modal overlay lightbox newsletter subscribe "
    "subscription signup login signin register search searchbox share sharing social follow related "
    "recommended recommendations recommendation teaser teasers widget widgets pagination pager paging "
    "tags tagcloud skip skiplink copyright legal disclaimer survey poll form captcha hidden".split()
)
# Lists and tables are one with the container that they stand in.
_PARTS_OF = frozenset("ul ol li dl dt dd table thead tbody tfoot tr td th".split())
_CONTAINERS = frozenset(("html", "body"))
# Words that may follow a furniture word in its token (sidebar-left, comments-wrapper); other words make it a
# topic or a state (follow-the-money, menu-open).
_PLACES = frozenset(
    "left right top bottom upper lower inner outer main primary secondary wide first second wrapper wrap "
    "container box block area section panel list item items group row col column bar inline form text title "
    "content body link links buttons button module unit slot zone".split()
)
# Articles that are not the page's own; other words on article and main tell topics.
_ARTICLES = frozenset(("main", "article"))
_CARD_WORDS = frozenset(
    "ad ads advert adverts advertisement advertorial sponsor sponsored promo promoted comment comments "
    "commentlist reply replies related recommended recommendation recommendations teaser teasers".split()
)
# Words that begin a token that tells a topic or a setting (tag-reply, no-comments, has-sidebar).
_SETTINGS = frozenset("tag tags category topic has no with without is".split())
# An opening tag of the first kind ends an open element of the second kind in its container.
_ENDS = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "tbody": ("thead", "tbody", "tr", "td", "th"),
    "option": ("option",),
}
_SCOPES = frozenset(
    "html body article section main div table td th ul ol dl blockquote aside header footer nav form".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*+(?:\"[^\"]*\"[^>\"']*+|'[^']*'[^>\"']*+)*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z]+")
_HUMP = re.compile(r"([a-z])([A-Z])")
_MARKS = re.compile(r"[.,;:!?…。，、！？]")


def main_text(page: str) -> str:
    """The article of a page: blocks in page order, two line breaks between them."""
    found = list(_blocks(page))
    if not found:
        return ""
    content = _content(found)
    return "\n\n".join(text for path, text, _ in found if path in content)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page's main text, from its whole html.

    A null or empty page, and one without an article, has an empty text. Broken markup is read as
    far as it goes. Repeated rows and rows without a page_id each give a row; an empty table gives
    none; other columns are ignored.
    """
    chosen = pages.select(
        F.col(f"`{id_col}`").alias("page_id"),
        F.col(f"`{url_col}`").alias("url"),
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"),
    )
    kinds = [chosen.schema[c].dataType.simpleString() for c in ("page_id", "url")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(page) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    return chosen.mapInArrow(work, "page_id {}, url {}, text string, n_chars long".format(*kinds))


def _content(found: list[tuple]) -> set[tuple]:
    """The paths whose smoothed and fused ratios reach the threshold."""
    sums: dict[tuple, list[float]] = defaultdict(lambda: [0.0, 0.0, 0, 0])
    for path, text, linked in found:
        held = sums[path]
        held[0] += len(text) - linked
        held[1] += len(_MARKS.findall(text))
        held[2] += 1
        held[3] += len(text)
    named = {path: _named(path) for path in sums}
    inside = {p for p in sums if any(name in _ARTICLES for name, _ in p)}
    plain = [p for p in sums if not named[p]]
    held_inside, unlinked = sum(sums[p][0] for p in plain if p in inside), sum(sums[p][0] for p in plain)
    prior = 1 + (PRIOR - 1) * held_inside / unlinked if unlinked else 1.0
    ratios = {p: (held[0] / held[2], held[1] / held[2]) for p, held in sums.items()}
    around: dict[tuple, list[float]] = defaultdict(lambda: [0.0, 0.0])
    for path, (length, marks) in ratios.items():
        # What stands in a named element says nothing of the containers around that element.
        for depth in range(max(1, named[path]), len(path)):
            if path[depth - 1][0] not in ("html", "body"):
                around[path[:depth]][0] += length
                around[path[:depth]][1] += marks
    scores = {}
    for path, (length, marks) in ratios.items():
        part = 1.0
        for depth in range(len(path) - 1, 0, -1):
            if path[depth][0] not in _PARTS_OF:
                part *= PART
            if path[:depth] in around:
                length += part * around[path[:depth]][0]
                marks += part * around[path[:depth]][1]
        scores[path] = length * (1 + marks) * sums[path][0] / sums[path][3]
        if named[path]:
            scores[path] *= NAMED
        elif path in inside:
            scores[path] *= prior
    best = max(scores.values(), default=0.0)
    content = {p for p, score in scores.items() if score >= SHARE * best}
    # Of named elements only the one that holds most of the unlinked text can be the body.
    texts: dict[tuple, float] = defaultdict(float)
    for path in content:
        if named[path]:
            texts[path[: named[path]]] += sums[path][0]
    body = max(texts, key=texts.get, default=None)
    content = {p for p in content if not named[p] or p[: named[p]] == body}
    # Headings stand beside the text that they belong to, whatever their own ratios.
    parents = {p[:-1] for p in content}
    return content | {p for p in sums if p and p[-1][0] in _HEADINGS and p[:-1] in parents}


_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))


def _named(path: tuple) -> int:
    """Down to which element of a path the first one lies whose class or id names furniture; 0 if there is none."""
    return next((depth for depth, (_, mark) in enumerate(path, 1) if mark), 0)


def _blocks(page: str) -> Iterator[tuple]:
    """Path, text and length of linked text of each block with text in it.

    A path is a tuple of (tag, the words of a class or id that name furniture) without inline elements. What lies in
    elements that are furniture by tag, role or style is left out.
    """
    stack: list[str] = []
    path: tuple = ()
    paths: list[tuple] = []
    links = 0
    parts: list[str] = []
    linked: list[str] = []

    def block() -> Iterator[tuple]:
        nonlocal parts, linked
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        if text and not any(mark is None for _, mark in path):
            yield path, text, len(" ".join(html.unescape("".join(linked)).split()))
        parts, linked = [], []

    def close_to(size: int) -> None:
        nonlocal path, links
        while len(stack) > size:
            links -= stack.pop() == "a"
            path = paths.pop()

    position, end = 0, len(page)
    while position < end:
        token = _TOKEN.search(page, position) if page.find(">", position) >= 0 else None
        text = page[position : token.start() if token else end]
        if text:
            parts.append(text)
            if links:
                linked.append(text)
        if not token:
            break
        position = token.end()
        closing, name, rest = token.group(1, 2, 3) if token[2] else token.group(4, 5, 6)
        if name is None:
            continue
        name = name.lower()
        inline = name in _INLINE
        if name == "br":
            parts.append("\n")
            continue
        if not inline:
            yield from block()
        if closing:
            size = _opened(stack, name)
            if size is not None:
                close_to(size)
            continue
        if name in _RAW:
            found = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, position)
            position = found.end() if found else end
            continue
        if name in _VOID or rest.endswith("/") and name not in _SCOPES:
            continue
        if not inline:
            size = _ended(stack, name)
            if size is not None:
                close_to(size)
        stack.append(name)
        paths.append(path)
        links += name == "a"
        if not inline:
            path = (*path, (name, _furniture(name, rest, stack)))
    yield from block()


def _opened(stack: list[str], name: str) -> int | None:
    """Where the innermost open element of that name is; inline ones don't reach out of a block."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i] == name:
            return i
        if name in _INLINE and stack[i] not in _INLINE:
            return None
    return None


def _ended(stack: list[str], name: str) -> int | None:
    """Down to which open element a new one ends what came before it."""
    ends = _ENDS.get(name, ())
    least = None
    for i in range(len(stack) - 1, -1, -1):
        held = stack[i]
        if held == "p" or held in ends:
            least = i
        elif held in _SCOPES and held not in ends:
            break
    return least


def _furniture(name: str, rest: str, stack: list[str]) -> str | None:
    """None for an element that is furniture by its tag, role or style, else the first token of its class or id that
    names furniture, or nothing."""
    if name in _FURNITURE or name == "header" and "article" not in stack:
        return None
    if name in _CONTAINERS or name == "header" or not rest or rest.isspace():
        return ""
    words, mark = _CARD_WORDS if name in _ARTICLES else _FURNITURE_WORDS, ""
    for key, *values in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), "".join(values)
        if key in ("class", "id"):
            for token in value.split():
                parts = _WORD.findall(_HUMP.sub(r"\1-\2", token).lower())
                if not mark and _names(parts, words):
                    mark = "-".join(parts)
        if key == "role" and value.strip().lower() in _FURNITURE_ROLES:
            return None
        if key == "hidden" or key == "style" and "display:none" in value.lower().replace(" ", ""):
            return None
    return mark


def _names(parts: list[str], words: frozenset) -> bool:
    """Whether a token names furniture: by its last word (reader-comments), or by one that only words for a place
    follow (sidebar-left). Tokens for topics, settings and states don't."""
    if not parts or parts[0] in _SETTINGS:
        return False
    while len(parts) > 1 and parts[-1] in _PLACES and parts[-1] not in words:
        parts = parts[:-1]
    return parts[-1] in words
