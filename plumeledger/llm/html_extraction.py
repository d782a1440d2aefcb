"""Main text of web pages by tag-path ratios.

A page is read as a sequence of text blocks, each with its root-to-leaf path of block tags.
Per path, the length of the text and the number of punctuation marks are summed over its
blocks and divided by their number; both ratios are smoothed along the page, multiplied, and
compared with their spread. Paths above that threshold carry prose. Their blocks are the main
text, in page order, and with them all other blocks of their article or main elements or,
where those do not hold half of the prose, of the smallest element that holds all that prose.
If that is the whole body, the ratios alone decide: beside the paths above the threshold only
headings that lead to a block of the main text stay, and items of lists and tables between
two such blocks that are not made of links.

Left out are elements that are never content or hidden, and elements marked as something else
by a class, id or role (menus, headers, footers, sidebars, notices, adverts, comments of
readers), see ``_drop_marked``: a mark counts only where the prose of the page is somewhere
else. A header inside an article is the article's own and stays.

Each page is handled by itself in one pass, so nothing is shuffled and a task holds one batch
of pages. Defined results: a null, empty or textless page has the empty text; broken and
cut-off markup is read as far as it goes; repeated rows are handled one by one; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose text is never content, and those whose text is not markup at all.
_NEVER = set(
    "head title nav header footer aside form button select textarea input label fieldset script style "
    "noscript template iframe object svg math canvas audio video dialog menu".split()
)
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that neither begin nor end a block.
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr img br label".split()
)
#: What an opening tag closes when it is still open, up to the nearest holder.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_ARTICLE = {"article", "main"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_HOLDS_NO_BLOCK = {"p"} | _HEADINGS
_ITEMS = {"li", "dt", "dd", "td", "th", "pre", "blockquote", "figcaption", "caption"}
_WHOLE_PAGE = {"", "html", "body"}
_KEEPS_CLASS = {"html", "body"} | _ARTICLE | _HEADINGS
_MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|adsense|banners?|promos?|promotions?|sponsor(?:s|ed)?|"
    r"sidebars?|menus?|nav|navbar|navigation|breadcrumbs?|footers?|headers?|masthead|comments?|replies|"
    r"disqus|cookies?|consent|gdpr|notices?|alerts?|newsletter|subscribe|signup|login|related|recommended|"
    r"share|sharing|social|popup|modal|overlay|widgets?|toolbar|pagination|pager|copyright|legal|skip)(?:$|[\s_-])"
)
#: Parts of names that say that the element lacks or surrounds something: no-sidebar, has-comments.
_ABOUT_ANOTHER = re.compile(r"(?:^|(?<=[\s_-]))(?:no|non|not|without|with|has|have|hide|hides)[_-]\S*")
#: Whole names that nothing but an advert has.
_ADVERT = re.compile(r"(?:^|\s)(?:ads?|adverts?|advertisements?|adsense|adsbygoogle|sponsored)(?:$|\s)")
_MARKED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu"}

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)"
    # A quote opens a value only behind an equals sign.
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))|[^>])*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…。、，！？؟،।]")


def _hidden(attributes: str) -> bool:
    """Whether the tag says that the element is not shown."""
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or (key == "style" and re.search(r"display\s*:\s*none", value)):
            return True
    return False


def _marked(name: str, attributes: str) -> bool:
    """Whether the tag says that the element is not content."""
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id") and name not in _KEEPS_CLASS and _MARKED.search(_ABOUT_ANOTHER.sub(" ", value)):
            return True
        if (key == "role" and value in _MARKED_ROLES) or (key == "aria-hidden" and value == "true"):
            return True
    return False


def _advert(attributes: str) -> bool:
    """Whether a class or id of the tag is an advert's."""
    found = _ATTRIBUTE.findall(attributes)
    return any(key.lower() in ("class", "id") and _ADVERT.search(value.strip("\"'").lower()) for key, value in found)


class _Element:
    """A marked element or an article: the nearest of either kind around it, and its depth in marks."""

    __slots__ = ("advert", "article", "depth", "holds_article", "mark")

    def __init__(self, mark: _Element | None, article: _Element | None, advert: bool = False) -> None:
        self.mark, self.article, self.advert, self.holds_article = mark, article, advert, False
        self.depth = mark.depth + 1 if mark else 1


class _Path:
    """A root-to-leaf path of tags; equal paths are one object, so that none is ever copied."""

    __slots__ = ("article", "children", "tag")

    def __init__(self, tag: str, parent: _Path | None) -> None:
        self.tag, self.children = tag, {}
        #: The path down to the outermost article or main element, if there is one.
        self.article: _Path | None = (parent and parent.article) or (self if tag in _ARTICLE else None)

    def child(self, tag: str) -> _Path:
        if tag not in self.children:
            self.children[tag] = _Path(tag, self)
        return self.children[tag]


class _Open:
    """An open element: what holds for text inside it, and the blocks that it holds."""

    __slots__ = ("article", "first", "last", "mark", "parent", "path", "wanted")

    def __init__(
        self, path: _Path, parent: _Open | None, wanted: bool, mark: _Element | None, article: _Element | None, first: int
    ) -> None:
        self.path, self.parent, self.wanted, self.mark, self.article = path, parent, wanted, mark, article
        self.first, self.last = first, -1


class _Block:
    __slots__ = ("article", "holder", "linked", "mark", "number", "path", "text", "wanted")

    def __init__(self, holder: _Open, text: str, linked: int, number: int) -> None:
        self.holder, self.text, self.linked, self.number = holder, text, linked, number
        self.path, self.wanted, self.mark, self.article = holder.path, holder.wanted, holder.mark, holder.article


def blocks(page: str) -> list[_Block]:
    """Text blocks of a page in order: path, text with single blanks, characters in links."""
    found: list[_Block] = []
    # Open elements; inline ones are not kept. How many of each tag are open.
    stack = [_Open(_Path("", None), None, True, None, None, 0)]
    n_open: dict[str, int] = {}
    parts: list[str] = []
    linked, links = 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if text:
            found.append(_Block(stack[-1], text, min(linked, len(text)), len(found)))
        linked = 0

    def close() -> str:
        done = stack.pop()
        done.last = len(found)
        n_open[done.path.tag] -= 1
        return done.path.tag

    at, n = 0, len(page)
    while at < n:
        token = _TOKEN.search(page, at)
        text = page[at : token.start()] if token else page[at:]
        if text:
            parts.append(text)
            linked += len(text) * (links > 0)
        if token is None:
            break
        at = token.end()
        name = token["name"]
        if name is None:
            continue
        name = name.lower()
        if token["close"]:
            if name == "a":
                links = max(0, links - 1)
            elif name not in _INLINE and n_open.get(name):
                flush()
                while close() != name:
                    pass
                links = 0
            continue
        attributes = token["attributes"]
        if name in _RAW and not attributes.endswith("/"):
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])|\Z", re.I).search(page, at)
            at = end.end()
            if end[0]:
                stop = page.find(">", at)
                at = n if stop < 0 else stop + 1
            continue
        if name == "br":
            parts.append(" ")
        if name == "a":
            links += 1
        if name in _INLINE:
            continue
        flush()
        links = 0
        if name in _VOID:
            continue
        if name in _CLOSES and any(n_open.get(tag) for tag in _CLOSES[name][0]):
            closed, holders = _CLOSES[name]
            depth = len(stack)
            while depth > 1 and stack[depth - 1].path.tag not in holders:
                depth -= 1
            inner = [k for k in range(depth, len(stack)) if stack[k].path.tag in closed]
            while inner and len(stack) > inner[0]:
                close()
        while stack[-1].path.tag in _HOLDS_NO_BLOCK:
            close()
        around = stack[-1]
        wanted, mark, article = around.wanted, around.mark, around.article
        never = name in _NEVER and not (name == "header" and article)
        wanted = wanted and not never and not _hidden(attributes)
        if wanted and _marked(name, attributes):
            mark = _Element(mark, article, _advert(attributes))
        if name in _ARTICLE:
            article = _Element(mark, article)
            outer = mark if wanted else None
            while outer and not outer.holds_article:
                outer.holds_article = True
                outer = outer.mark
        stack.append(_Open(around.path.child(name), around, wanted, mark, article, len(found)))
        n_open[name] = n_open.get(name, 0) + 1
    flush()
    for element in stack:
        element.last = len(found)
    return found


def _smoothed(values: list[float]) -> list[float]:
    """A Gaussian window of five blocks over a sequence."""
    window = ((-2, 0.06), (-1, 0.24), (0, 0.4), (1, 0.24), (2, 0.06))
    out = []
    for i in range(len(values)):
        inside = [(values[i + k], w) for k, w in window if 0 <= i + k < len(values)]
        out.append(sum(v * w for v, w in inside) / sum(w for _, w in inside))
    return out


def prose_paths(found: list[_Block]) -> dict[_Path, float]:
    """Paths whose fused ratio passes the threshold, with the characters of their blocks."""
    chars: dict[_Path, int] = {}
    marks: dict[_Path, int] = {}
    count: dict[_Path, int] = {}
    for b in found:
        chars[b.path] = chars.get(b.path, 0) + len(b.text) - b.linked
        marks[b.path] = marks.get(b.path, 0) + len(_PUNCTUATION.findall(b.text))
        count[b.path] = count.get(b.path, 0) + 1
    by_text = _smoothed([chars[b.path] / count[b.path] for b in found])
    by_mark = _smoothed([marks[b.path] / count[b.path] for b in found])
    # The share of its last tag in the page's text keeps a single block from passing by its
    # neighbours alone.
    of_tag: dict[str, int] = {}
    for path, size in chars.items():
        of_tag[path.tag] = of_tag.get(path.tag, 0) + size
    whole = sum(of_tag.values()) or 1
    share = [of_tag[b.path.tag] / whole for b in found]
    fused = [x * y * z for x, y, z in zip(by_text, by_mark, share, strict=True)]
    if not any(fused):
        fused = by_text
    mean = sum(fused) / len(fused)
    spread = (sum((x - mean) ** 2 for x in fused) / len(fused)) ** 0.5
    total: dict[_Path, float] = {}
    for b, x in zip(found, fused, strict=True):
        total[b.path] = total.get(b.path, 0.0) + x
    passing = {p: chars[p] for p, x in total.items() if x / count[p] >= min(spread, mean) and chars[p] > 0}
    return passing or {p: c for p, c in chars.items() if c == max(chars.values())}


def _drop_marked(found: list[_Block]) -> list[_Block]:
    """The blocks without those of marked elements that do not hold the page's prose.

    Outer elements are judged first. An advert without an article or main element goes. Any
    other element is kept if it holds such an element or more than half of the page's prose.
    Beside an article with text outside of marks, a marked element that neither holds nor lies
    in an article goes, whatever its length; beside one with prose, so do comments and teasers
    in articles of their own, unless they lie in that same article. If neither prose nor an
    article is left, marks other than those of adverts do not count.
    """
    if all(b.mark is None for b in found):
        return found
    levels: dict[int, dict[_Element, None]] = {}
    for mark in {b.mark: None for b in found}:
        while mark and mark not in levels.setdefault(mark.depth, {}):
            levels[mark.depth][mark] = None
            mark = mark.mark
    adverts: set[_Element | None] = set()
    for depth in sorted(levels):
        adverts |= {m for m in levels[depth] if m.mark in adverts or (m.advert and not m.holds_article)}
    found = [b for b in found if b.mark not in adverts]
    if all(b.mark is None for b in found):
        return found
    chosen = prose_paths(found)
    of_mark: dict[_Element | None, list[_Block]] = {}
    prose: dict[_Element | None, int] = {}
    for b in found:
        of_mark.setdefault(b.mark, []).append(b)
        prose[b.mark] = prose.get(b.mark, 0) + (len(b.text) - b.linked) * (b.path in chosen)
    for depth in sorted(levels, reverse=True):
        for mark in levels[depth]:
            if mark.mark:
                prose[mark.mark] = prose.get(mark.mark, 0) + prose.get(mark, 0)
    total = sum(chosen.values())
    kept: set[_Element | None] = {None}
    fresh: set[_Element | None] = {None}
    articles: set[_Element | None] = set()
    any_article = False
    for depth in sorted(levels):
        for b in (b for mark in fresh for b in of_mark.get(mark, ()) if b.article):
            any_article = True
            if b.path in chosen and b.path.tag not in _HEADINGS:
                articles.add(b.article)
        fresh = set()
        for mark in levels[depth]:
            if mark.mark not in kept or mark in adverts or (articles and mark.article not in articles):
                continue
            if mark.holds_article or (2 * prose.get(mark, 0) > total and (mark.article or not any_article)):
                fresh.add(mark)
        kept |= fresh
    left = [b for b in found if b.mark in kept]
    return left if any(b.article or b.path in chosen for b in left) else found


def _smallest_holder(found: list[_Block]) -> _Open:
    """The smallest element that holds all of some blocks."""
    low, high = found[0].number, found[-1].number
    holder = found[0].holder
    while not holder.first <= low <= high < holder.last:
        holder = holder.parent
    # The element of one block holds nothing that could stand beside it.
    return holder.parent if holder.parent and holder.last - holder.first == 1 else holder


def main_text(page: str | None) -> str:
    """The main text of one page, blocks joined by a line break."""
    every = blocks(page or "")
    found = _drop_marked([b for b in every if b.wanted])
    if not found:
        return ""
    chosen = prose_paths(found)
    in_articles = sum(c for p, c in chosen.items() if p.article)
    prose = [b for b in found if b.path in chosen]
    if 2 * in_articles >= sum(chosen.values()):
        articles = {p.article for p in chosen if p.article}
        kept = [b for b in found if b.path in chosen or (b.path.article and b.path.article in articles)]
    else:
        holder = _smallest_holder(prose)
        if holder.path.tag in _WHOLE_PAGE:
            kept = _by_ratio(found, chosen)
        else:
            kept = [b for b in found if holder.first <= b.number < holder.last]
    return "\n".join(b.text for b in kept)


def _by_ratio(found: list[_Block], chosen: dict[_Path, float]) -> list[_Block]:
    """Blocks of the chosen paths, the headings that lead to them, and items between them."""
    places = [i for i, b in enumerate(found) if b.path in chosen]
    kept = []
    leads = False  # whether the next block that is no heading is kept
    for i in range(len(found) - 1, -1, -1):
        b = found[i]
        inside = places[0] < i < places[-1]
        if b.path.tag in _HEADINGS:
            stays = b.path in chosen or leads
        else:
            item = inside and b.path.tag in _ITEMS and 10 * b.linked < 8 * len(b.text)
            stays = leads = b.path in chosen or item
        if stays:
            kept.append(b)
    return kept[::-1]


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; ``n_chars`` counts code points."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return rows.mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint")
