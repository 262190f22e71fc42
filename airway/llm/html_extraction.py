"""Main text of web pages: site templates and page furniture removed.

Element subtrees of whole pages are hashed and counted per host and per section of its paths; a
subtree that recurs on many pages of either is part of the site's template and deleted. What a
page says about itself narrows the rest: its article, tags and roles of menus, footers and
forms, and containers named for such a part.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airway.llm.batches import as_bytes, map_batches
from airway.llm.linking import BROADCAST_ROWS
from airway.sources.staging import Work, session_work

# A subtree belongs to the template of a group of pages (a host, or a section of its paths)
# if it is on this many different pages of it, and on this share of them: a higher one
# inside what the page marks as its article.
TEMPLATE_PAGES, TEMPLATE_SHARE, TEMPLATE_SHARE_IN_ARTICLE = 8, 0.1, 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|hidden|style|aria-hidden)(?![\w-])(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = {t: re.compile(rf"</{t}\s*>?", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "xmp")}
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
_CLOSES_P = _BLOCK - {"body", "caption", "dd", "dt", "head", "html", "legend", "li", "option", "tbody", "td", "tfoot", "th", "thead", "tr"}
# An opening tag ends open elements of these tags, up to the nearest of the second ones.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_DROPPED = frozenset(
    "nav footer aside form button select input textarea iframe svg canvas object embed menu dialog head title script style "
    "noscript template audio video label fieldset xmp".split()
)
_DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
# A name is the noun a class ends in: "site-footer", "related-posts" and "ad slot-2" name furniture,
# "related-work", "notice-period" and "with-sidebar" do not.
_COMMENT_NAMES = frozenset("comment comments commentlist disqus replies reply respond responses discussion".split())
_ADVERT_NAMES = frozenset("ad ads advert adverts advertisement advertising promo promotion sponsor sponsored".split())
_DROPPED_NAMES = _COMMENT_NAMES | _ADVERT_NAMES | frozenset(
    "banner breadcrumb breadcrumbs consent cookie cookies footer gdpr header "
    "login masthead menu modal nav navbar navigation newsletter notice notification pager pagination paywall popup "
    "recommended related share sharing sidebar signup skip social subscribe subscription toolbar "
    "widget".split()
)
_PLACES = frozenset(
    "area articles bar block bottom box button buttons container form group icons inner item items left link links list main "
    "outer panel posts primary right row secondary section slot stories text top unit wrap wrapper".split()
)
_STATES = frozenset("has is no non not with without".split())
# Elements that a name may make furniture: never headings, paragraphs or words. An id counts on the
# second ones only, for sections are given ids made from their headings.
_CONTAINERS = frozenset("article aside center details div dl figure ol section table ul".split())
_ID_CONTAINERS = frozenset("aside div ol table ul".split())
# Of these, what no closing tag ends before the page does is not trusted to be furniture.
_BOUNDED = frozenset("nav aside form menu dialog fieldset label select button".split())
# Blocks that are a menu if most of their text is links.
_LISTS = frozenset("ul ol div p table section".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def noun_of(token: str) -> str:
    """The last part of a class name that is more than a place; empty for names of states."""
    parts = _NAME.findall(_CAMEL.sub(" ", token).lower())
    if _STATES.intersection(parts):
        return ""
    while len(parts) > 1 and parts[-1] in _PLACES:
        parts.pop()
    return parts[-1] if parts else ""


class Element:
    __slots__ = ("tag", "names", "role", "hidden", "open", "parent", "parts", "mark", "size", "linked")

    def __init__(self, tag: str, parent: Element | None, raw: str = ""):
        self.tag, self.parent, self.parts, self.mark, self.size, self.linked = tag, parent, [], 0, 0, 0
        self.names, self.role, self.hidden, self.open = frozenset(), "", False, True
        if raw and not raw.isspace():
            for m in _ATTRIBUTE.finditer(raw):
                key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if key in ("class", "id"):
                    if tag in (_CONTAINERS if key == "class" else _ID_CONTAINERS):
                        self.names |= {noun_of(token) for token in html.unescape(value).split()}
                    elif key == "id" and tag in _CONTAINERS:
                        self.names |= {noun_of(value)} & {"comment", "comments", "disqus", "replies"}
                elif key == "role":
                    self.role = value.strip().lower()
                elif key == "itemprop":
                    self.role = "main" if value.strip().lower() == "articlebody" else self.role
                elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                    self.hidden = True
                elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    self.hidden = True

    def within(self) -> Iterator[Element]:
        """This element and all below it, in page order."""
        stack = [self]
        while stack:
            here = stack.pop()
            yield here
            stack.extend(x for x in reversed(here.parts) if not isinstance(x, str))


def parse(page: str) -> Element:
    """The page's elements. Unclosed and misplaced tags are taken as browsers would, roughly."""
    root = here = Element("html", None)
    at, token = 0, _TOKEN.search(page)
    while token:
        if token.start() > at:
            here.parts.append(html.unescape(page[at : token.start()]))
        at = token.end()
        close, tag, raw = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
        if token[0].startswith("<![CDATA["):
            here.parts.append(token[0][9:].removesuffix("]]>"))
        elif tag:
            tag = tag.lower()
            if close:
                up = here
                while up is not None and up.tag != tag:
                    up = up.parent
                if up is not None and up.parent is not None:
                    if tag not in ("body", "html"):  # what the element holds ends with it
                        inner = here
                        while inner is not up:
                            inner.open, inner = False, inner.parent
                        up.open = False
                    here = up.parent
                elif tag == "br":
                    here.parts.append(" ")
            elif tag == "br":
                here.parts.append(" ")
            else:
                ends, fence = _ENDS.get(tag, (None, None))
                if ends is None and tag in _CLOSES_P:
                    ends, fence = {"p"}, {"td", "th", "table", "button", "object"}
                if ends:
                    up, last = here, None
                    while up is not None and up.tag not in fence:
                        if up.tag in ends:
                            last = up
                            if tag != "tr":
                                break
                        up = up.parent
                    if last is not None and last.parent is not None:
                        here = last.parent
                made = Element(tag, here, raw)
                here.parts.append(made)
                if tag in _RAW:
                    end = _RAW[tag].search(page, at)
                    at = end.end() if end else len(page)
                elif tag not in _VOID and not (raw or "").endswith("/"):
                    here = made
        token = _TOKEN.search(page, at)
    if at < len(page):
        here.parts.append(html.unescape(page[at:]))
    return root


def measure(root: Element) -> None:
    """Set on every element the characters of text in it, and how many of them are links."""
    for e in reversed(list(root.within())):
        e.size = e.linked = 0
        for x in e.parts:
            if isinstance(x, str):
                e.size += 0 if x.isspace() else len(x)
            elif not x.hidden:
                e.size += x.size
                e.linked += x.size if x.tag == "a" else x.linked


def _is_article(e: Element) -> bool:
    named = e.names & (_COMMENT_NAMES | _ADVERT_NAMES)
    return not named and (e.tag in ("article", "main") or e.role in ("main", "article"))


def _furniture(e: Element, in_article: bool, holds_article: bool, holds_title: bool) -> bool:
    """Whether an element's tag, role or names say that it is not part of the article."""
    if e.hidden or e.tag in _DROPPED or e.role in _DROPPED_ROLES:
        endless = e.open and (e.tag in _BOUNDED or e.role in _DROPPED_ROLES) and not e.hidden
        return not holds_article and not endless and not (e.tag == "form" and holds_title)
    if e.tag == "header":
        return not in_article and not holds_article
    found = e.names & _DROPPED_NAMES
    # A wrapper named for one of its parts holds the title of the page.
    if not found or holds_article or holds_title or e.open or _is_article(e):
        return False
    return not (found <= {"header", "banner", "notice"} and in_article and any(x.tag in _HEADINGS for x in e.within()))


def _titled(root: Element) -> set[int]:
    """The elements, by their ``id()``, that hold every ``h1`` of the page."""
    order = list(root.within())
    whole = sum(e.tag == "h1" for e in order)
    held: dict[int, int] = {}
    for e in reversed(order):
        held[id(e)] = sum((x.tag == "h1") + held[id(x)] for x in e.parts if not isinstance(x, str))
    return {e for e, n in held.items() if n == whole} if whole else set()


def main_elements(root: Element) -> tuple[list[Element], bool]:
    """What holds the main text, furniture removed, and whether the page marks it."""
    holds: set[int] = set()
    for e in root.within():
        if _is_article(e) and not e.hidden:
            up = e.parent
            while up is not None and id(up) not in holds:
                holds.add(id(up))
                up = up.parent
    titled = _titled(root)
    measure(root)
    marked: list[Element] = []

    def clean(e: Element, in_article: bool, below_article: bool) -> None:
        stack = [(e, in_article)]
        while stack:
            here, inside = stack.pop()
            kept = []
            for x in here.parts:
                if isinstance(x, str):
                    kept.append(x)
                elif here.tag == "nav" and x.tag in ("a", "ul", "ol"):  # a nav that is not trusted still has its menu
                    continue
                elif not _furniture(x, inside, id(x) in holds, id(x) in titled):
                    first = not inside and _is_article(x)
                    if first:
                        marked.append(x)
                    kept.append(x)
                    stack.append((x, inside or first))
            here.parts = kept

    clean(root, False, False)
    measure(root)
    if marked:
        mains = [e for e in marked if e.tag == "main" or e.role == "main"]
        for m in mains:  # an article inside <main> that holds most of it is the article
            inner = [x for x in m.within() if x is not m and _is_article(x)]
            if inner and 2 * sum(x.size for x in inner) > m.size:
                marked[marked.index(m) : marked.index(m) + 1] = inner
        order = {id(e): i for i, e in enumerate(root.within())}
        unique = {id(e): e for e in marked}
        outer = [e for e in unique.values() if not any(id(u) in unique for u in _above(e))]
        return sorted(outer, key=lambda e: order[id(e)]), True
    for e in list(root.within()):
        e.parts = [
            x for x in e.parts if isinstance(x, str) or x.tag not in _LISTS or 10 * x.linked <= 6 * x.size
        ]
    return [root], False


def _above(e: Element) -> Iterator[Element]:
    while e.parent is not None:
        e = e.parent
        yield e


def mark_subtrees(root: Element) -> set[tuple[int, bool]]:
    """Hash every element of the page by its tag, text and children; returns the hashes of the
    blocks that hold text (words inside a sentence are no template), and whether each is
    inside an article."""
    found = set()
    order = list(root.within())
    inside: dict[int, bool] = {}
    for e in order:
        inside[id(e)] = e.parent is not None and (inside[id(e.parent)] or _is_article(e.parent))
    texts: dict[int, bool] = {}
    for e in reversed(order):
        digest, some = xxhash.xxh64(e.tag), False
        for x in e.parts:
            if isinstance(x, str):
                words = " ".join(x.split())
                some = some or bool(words)
                digest.update(f"\0{words}")
            else:
                some = some or texts[id(x)]
                digest.update(x.mark.to_bytes(8, "big"))
        e.mark, texts[id(e)] = digest.intdigest(), some
        if some and e is not root and e.tag in _BLOCK:
            found.add((e.mark - (1 << 64) if e.mark >> 63 else e.mark, inside[id(e)]))
    return found


def blocks(top: Element, deleted: frozenset[int] | set[int] = frozenset()) -> list[str]:
    """Texts of the blocks below ``top`` in page order, white space made single spaces;
    subtrees with deleted marks are left out."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = " ".join("".join(held).split())
        if text:
            out.append(text)
        held.clear()

    stack: list = [top]
    while stack:
        here = stack.pop()
        if here is None:
            flush()
        elif isinstance(here, str):
            held.append(here)
        elif here is top or not deleted or (here.mark - (1 << 64) if here.mark >> 63 else here.mark) not in deleted:
            if here.tag in _BLOCK:
                flush()
                stack.append(None)
            stack.extend(reversed(here.parts))
        elif here.tag in _BLOCK:
            flush()
    flush()
    return out


def host_of(url: str) -> Column:
    """The host of a URL, lower-cased; empty where there is none."""
    found = F.regexp_extract(F.lower(F.trim(F.col(url))), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.coalesce(found, F.lit(""))


def folders_of(url: str) -> Column:
    """The folders of a URL's path, the first of them ""; what follows the last slash is the page."""
    path = F.regexp_extract(F.trim(F.col(url)), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)", 1)
    return F.split(F.coalesce(F.regexp_extract(path, r"^(.*)/", 1), F.lit("")), "/")


def areas_of(host: str, folders: str) -> Column:
    """A hash for each group that a page is compared in: its host, and every section of
    the host's paths that it is in."""
    depths = F.sequence(F.lit(1), F.size(folders))
    return F.transform(depths, lambda n: F.xxhash64(F.col(host), F.array_join(F.slice(F.col(folders), F.lit(1), n), "/")))


def _decoded(raw: bytes | None) -> str:
    return (raw or b"").decode("utf-8", "replace")


def template_subtrees(pages: DataFrame, work: Work) -> DataFrame:
    """``key, marks`` of the pages (``key, host, areas, html``) that hold template subtrees
    of any of their areas; staged. Subtrees of the whole page are counted, those inside an
    article by themselves. A subtree counts once for every different main text it occurs
    with, so copies of a page make nothing a template. Pages without a host are not compared."""

    def start():
        def run(columns):
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for key, areas, raw in zip(*columns, strict=True):
                root = parse(_decoded(raw))
                found = mark_subtrees(root)
                tops, marked = main_elements(root)
                text = "\n".join(b for t in tops for b in blocks(t))
                sign = xxhash.xxh64_intdigest(text) >> 1
                for mark, inside in [(0, False), *found]:
                    for column, value in zip(out, (key, areas, mark, inside, marked, sign), strict=True):
                        column.append(value)
            return list(out)

        return run

    rows = pages.where("host <> ''").select("key", "areas", "html")
    schema = "key string, areas array<long>, mark long, inside boolean, marked boolean, sign long"
    found = work.stage(map_batches(rows, start, schema), "subtrees")
    placed = found.withColumn("area", F.explode("areas"))
    once = placed.select("area", "mark", "inside", "sign").distinct().groupBy("area", "mark", "inside").agg(F.count("*").alias("n"))
    sizes = once.where("mark = 0").select("area", F.col("n").alias("pages")).where(F.col("pages") >= TEMPLATE_PAGES)
    share = F.when(F.col("inside"), TEMPLATE_SHARE_IN_ARTICLE).otherwise(TEMPLATE_SHARE)
    many = F.col("n") >= share * F.col("pages")
    template = once.where(f"mark <> 0 AND n >= {TEMPLATE_PAGES}").join(sizes, "area").where(many).select("area", "mark", "inside")
    # Of a page that marks its article only that is read.
    hits = placed.where("inside = marked").join(work.stage(template, "template"), ["area", "mark", "inside"])
    return work.stage(hits.groupBy("key").agg(F.collect_set("mark").alias("marks")), "hits")


def extract_main_text(
    pages: DataFrame,
    id_column: str = "page_id",
    url: str = "url",
    page: str = "html",
    work: Work | None = None,
) -> DataFrame:
    """One row per input row: ``id, url, text, n_chars``; runs jobs.

    ``text`` joins the blocks of the main text by line breaks, character references
    decoded and white space inside a block made one space; empty for null and empty
    pages and where nothing is left. Where a page marks its article (or main part), only
    that is read. A page of template alone has no text. Names count on containers only, and
    not where an element holds the article or the page's title. Pages of any length are read
    whole, an empty table gives no rows. Repeated rows and rows without id or URL give a row
    each, copies of a page the same text; other columns are not read."""
    work = work or session_work(pages.sparkSession)
    rows = pages.select(F.col(id_column).alias("id"), F.col(url).alias("url"), host_of(url).alias("host"), as_bytes(page, "html"))
    rows = rows.withColumn("folders", folders_of("url")).withColumn("areas", areas_of("host", "folders"))
    # Template subtrees depend on areas and page alone, so these name the page.
    place = F.concat_ws("/", "host", F.array_join("folders", "/")).cast("binary")
    rows = rows.withColumn("key", F.md5(F.concat(place, F.lit(b"\n"), F.coalesce("html", F.lit(b"")))))
    hits = template_subtrees(rows, work)
    known = F.broadcast(hits) if hits.count() <= BROADCAST_ROWS else hits
    joined = rows.join(known, "key", "left").select("id", "url", "html", "marks")

    def start():
        def run(columns):
            texts = []
            for raw, marks in zip(columns[2], columns[3], strict=True):
                root = parse(_decoded(raw))
                if marks:
                    mark_subtrees(root)
                deleted = frozenset(marks or ())
                texts.append("\n".join(b for t in main_elements(root)[0] for b in blocks(t, deleted)))
            return columns[0], columns[1], texts, [len(t) for t in texts]

        return run

    return map_batches(joined, start, "id long, url string, text string, n_chars long")
