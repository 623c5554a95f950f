"""HTML extraction with site template removal.

Pass one hashes the block element subtrees of every page and Spark counts, per host, the different pages that have each: pages
of the same text count once. Subtrees on many pages of their host are the site's template, if they are built as one: most of their
text in links, or paragraphs in a container. Headings, quotations, lists, tables and paragraphs that recur are an article's as well,
so they go only where nothing but template stands before or after them, and never from an article. Pass two reads each page again,
deletes those subtrees and what its markup names as no article (menus, headers, footers, adverts, forms, comments), and joins the
blocks that are left. Where a page marks its article (``article``, ``main``), it is that part, unless most text stands elsewhere.

The counts are keyed by (host, subtree, page's text), then by (host, subtree) after a map-side sum, so a host with a third of
all pages is spread over many tasks. Python only parses: one page at a time, in steps in proportion to its length.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from hashlib import blake2b
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocklake.llm.common import stored, table

#: A subtree is template if it is on at least so many different pages of its host, whatever the host's size: outside article
#: and main elements, and within them. Within them, pages whose article begins alike are one page, so that near copies of a story
#: do not make its parts template.
MIN_PAGES, MIN_INSIDE = 4, 10
#: Up to so many template subtrees (8 bytes each, and their host), of hosts or of pages, are sent to all tasks; more meet pages by a shuffle.
MOST_SENT = 200_000

BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript template iframe svg math canvas object video audio".split())
CONTAINER = set("div section aside fieldset center".split())
#: Elements whose text is as good as an article's own, unless most of it is links.
OWN_PARTS = set("h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure details".split())
SUBHEADING = set("h2 h3 h4 h5 h6".split())
#: Where a template may take an element away: nowhere, at the end of a page, at its beginning or end, anywhere.
NOWHERE, END, EDGE, ANYWHERE = range(4)
#: Elements and roles that are never article text.
NO_TEXT = set("nav footer aside button dialog menu head label select".split())
NO_ROLE = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
#: Words of class names and ids of what surrounds an article: whatever its size, or unless it holds most of the page's text.
SURE = set(
    "ad ads advert adverts advertisement advertisements advertising adsbygoogle adsense adbox adslot adunit nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar sidenav topnav subnav footer "
    "masthead comment comments commentlist commenters disqus respond replies cookie cookies cookiebar cookiebanner gdpr consent".split()
)
PERHAPS = set(
    "banner sponsor sponsored promo promotion notice alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations widget toolbar "
    "pagination pager skip header topbar drawer crumbs copyright colophon notification announcement reply discussion advertorial".split()
)
#: Words that may stand beside them in a name; any other word makes it the name of something else.
BESIDE = set(
    "site page main top bottom left right upper lower side inner outer global primary secondary list items item box block wrapper wrap container section area region row col column link links button buttons "
    "bar panel slot unit form text title body head icon icons posts articles stories news more google js widgets inline mobile desktop sticky fixed media".split()
)
#: Words of an article's own parts: beside a word of SURE only. An article's header is article.
OWN = set("article entry post content story".split())
TEASER = set("card teaser preview related promo sponsored".split())
#: An opening tag of the second kind closes one of the first that is open, up to the third.
CLOSED_BY = {"li": ({"li"}, {"ul", "ol", "menu"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"})}
#: What an element's markup says of it.
STAYS, GOES_UNLESS_MOST, GOES = 0, 1, 2

_NEXT = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)|<[!?][^>]*>", re.S)
_REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


def _named(name: str) -> int:
    """What one class name or id says: each of its words must be known, and one of them name what surrounds an article."""
    parts = [x for x in re.split(r"[-_0-9]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if x]
    known = set(parts)
    if parts and parts[-1] == "header" and known & OWN:
        return STAYS
    if known & SURE and known <= SURE | PERHAPS | BESIDE | OWN:
        return GOES
    return GOES_UNLESS_MOST if known & PERHAPS and known <= PERHAPS | BESIDE else STAYS


def _verdict(tag: str, attributes: str, inside: bool) -> int:
    """What the markup of an element says of it; ``inside``: it stands in an article or main element."""
    if tag in NO_TEXT or tag == "header" and not inside:
        return GOES
    said = GOES_UNLESS_MOST if tag == "form" else STAYS
    if not attributes or tag in ("html", "body", "main"):
        return said
    got = {k.lower(): a or b or c or "" for k, a, b, c in _ATTRIBUTE.findall(attributes)}
    if got.get("role", "").lower() in NO_ROLE or "hidden" in got or got.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", got.get("style", "")):
        return GOES
    names = [*got.get("class", "").split(), got.get("id", "")]
    if tag == "article":
        if any(_named(n) == GOES and {"comment", "reply", "ad"} & set(re.split(r"[-_]+", n.lower())) for n in names):
            return GOES
        return max(said, GOES_UNLESS_MOST if any(n.lower() in TEASER for n in names) else STAYS)
    return max(said, *map(_named, names))


def _digest(parts: Iterable[str]) -> int:
    return int.from_bytes(blake2b("\x00".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


class Element(NamedTuple):
    """An element whose fate is open: blocks ``first`` to ``last`` (excluded), hash of tags and texts, verdict, where a template may be it."""

    first: int
    last: int
    subtree: int
    said: int
    where: int


class Page(NamedTuple):
    blocks: list[str]
    inside: list[bool]  # in an article or main element
    elements: list[Element]


class _Open:
    __slots__ = ("first", "holds", "inside", "links", "own", "parts", "said", "size", "skipped", "subheadings", "tag")

    def __init__(self, tag: str, skipped: bool, inside: bool, first: int, parts: list[str], said: int):
        self.tag, self.skipped, self.inside, self.first, self.parts, self.said, self.holds = tag, skipped, inside, first, parts, said, False
        self.size = self.links = self.own = self.subheadings = 0  # characters in it, and those in such elements, itself included


def _where(tag: str, inside: bool, size: int, links: int, own: int, subheadings: int) -> int:
    """Where a template may be an element of ``size`` characters, of which so many stand in links, own parts, headings below the first."""
    if 2 * links >= size or tag in CONTAINER and own < size:
        return ANYWHERE
    if inside:
        return NOWHERE
    return END if subheadings == size else EDGE


def parse(page: str) -> Page:
    """Blocks of text in page order, without elements that are never article text, and the elements around them.

    Repairs what browsers repair: paragraphs and items that are not closed, end tags of elements that are not open.
    """
    blocks: list[str] = []
    inside: list[bool] = []
    elements: list[Element] = []
    current: list[str] = []
    stack = [_Open("", False, False, 0, [], STAYS)]
    depth: dict[str, list[int]] = {}  # where in the stack elements of a tag are open
    block_at = [0]  # where in the stack block elements are open

    def flush() -> None:
        if current:
            text = " ".join("".join(current).split())
            current.clear()
            if text and not stack[-1].skipped:
                blocks.append(text)
                inside.append(stack[-1].inside)

    def close() -> None:
        top = stack[-1]
        if top.tag in BLOCK:
            flush()
            block_at.pop()
        stack.pop()
        depth[top.tag].pop()
        up = stack[-1]
        if top.tag == "a":
            top.links = top.size
        if top.tag in OWN_PARTS:
            top.own = top.size
        if top.tag in SUBHEADING:
            top.subheadings = top.size
        up.size, up.links, up.own, up.subheadings = up.size + top.size, up.links + top.links, up.own + top.own, up.subheadings + top.subheadings
        marked = top.tag in ("article", "main") and not top.skipped
        up.holds |= top.holds or marked and top.said == STAYS
        if top.tag in BLOCK and not top.skipped:
            subtree = _digest(top.parts)
            up.parts.append(f"<{subtree}>")
            if len(blocks) > top.first:
                whole = top.holds or marked or top.tag in ("html", "body")
                where = NOWHERE if whole else _where(top.tag, top.inside, top.size, top.links, top.own, top.subheadings)
                if where or top.said:
                    elements.append(Element(top.first, len(blocks), ~subtree if top.inside else subtree, top.said, where))

    def close_to(k: int) -> None:
        while len(stack) > k:
            close()

    def text(piece: str) -> None:
        if not stack[-1].skipped:
            piece = entities.unescape(piece) if "&" in piece else piece
            current.append(piece)
            piece = " ".join(piece.split())
            if piece:
                stack[-1].parts.append(piece)
                stack[-1].size += len(piece)

    innermost = lambda tags: max((depth[t][-1] for t in tags if depth.get(t)), default=-1)
    at, size, quoted = 0, len(page), True
    while at < size:
        m = _NEXT.search(page, at)
        if not m:
            text(page[at:])
            break
        end, rest = m.end(), ""
        if m[2]:
            found = _REST.match(page, end) if quoted else None
            quoted &= bool(found)  # quotes that do not pair up to the end of the page mean nothing
            end = found.end() if found else page.find(">", m.end()) + 1
            if not end:  # no tag ends any more
                text(page[at:])
                break
            rest = page[m.end() : end - 1]
        if m.start() > at:
            text(page[at : m.start()])
        at = end
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if depth.get(tag):
                close_to(depth[tag][-1])
            elif tag == "p":
                flush()
            continue
        alone = rest.endswith("/")
        if tag in RAW:
            over = None if alone else re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = over.end() if over else at if alone else size
            continue
        if tag == "br":
            current.append(" ")
        if tag in BLOCK:
            flush()
            if tag not in VOID and stack[block_at[-1]].tag == "p":  # a paragraph ends where a block begins
                close_to(block_at[-1])
        if tag in VOID or alone and tag not in BLOCK:
            continue
        if tag in CLOSED_BY:
            ends, scope = CLOSED_BY[tag]
            k, limit = innermost(ends), innermost(scope)
            while k > limit:
                close_to(k)
                k = innermost(ends)
        up = stack[-1]
        said = STAYS if up.skipped else _verdict(tag, rest, up.inside)
        if tag not in BLOCK and said != GOES:
            said = STAYS
        if said == GOES and tag in BLOCK:
            flush()
        here = up.inside or tag in ("article", "main") and said == STAYS
        depth.setdefault(tag, []).append(len(stack))
        if tag in BLOCK:
            block_at.append(len(stack))
            stack.append(_Open(tag, up.skipped or said == GOES, here, len(blocks), [tag], said))
        else:  # inline elements add to the block they stand in
            stack.append(_Open(tag, up.skipped or said == GOES, here, len(blocks), up.parts, STAYS))
    close_to(1)
    flush()
    return Page(blocks, inside, elements)


def main_text(page: Page, template: set[int] | frozenset[int] = frozenset()) -> str:
    """The blocks that neither the template nor the markup takes away, joined by empty lines."""
    n = len(page.blocks)
    upto = [0, *accumulate(map(len, page.blocks))]
    cover = [0] * (n + 1)
    begins: dict[int, int] = {}
    ends: dict[int, int] = {}
    for e in page.elements:
        recurs = e.where and e.subtree in template
        if recurs and e.where == ANYWHERE or e.said == GOES_UNLESS_MOST and 2 * (upto[e.last] - upto[e.first]) <= upto[n]:
            cover[e.first] += 1
            cover[e.last] -= 1
        elif recurs:
            ends[e.last] = min(e.first, ends.get(e.last, n))
            if e.where == EDGE:
                begins[e.first] = max(e.last, begins.get(e.first, 0))
    gone = [over > 0 for over in accumulate(cover)]
    first, last = 0, n
    while first < n and (gone[first] or first in begins):
        first = first + 1 if gone[first] else begins[first]
    while last > first and (gone[last - 1] or last in ends):
        last = last - 1 if gone[last - 1] else ends[last]
    left = [k for k in range(first, last) if not gone[k]]
    marked = [k for k in left if page.inside[k]]
    mass = lambda ks: sum(len(page.blocks[k]) for k in ks)
    # a teaser marked as article beside an unmarked story is not the article
    if marked and 4 * mass(marked) >= mass(left):
        left = marked
    return "\n\n".join(page.blocks[k] for k in left)


def candidates(page: Page) -> set[tuple[int, int, bool]]:
    """``subtree, of, inside``: what may be template, with a hash of what the page is, as far as that subtree is concerned."""
    content = _digest(page.blocks)
    # the article's first block, and where the first ends that does not start there
    lead = next((k for k, x in enumerate(page.inside) if x), 0)
    out = set()
    for e in page.elements:
        if e.where:
            if page.inside[e.first]:
                k = lead if not e.first <= lead < e.last else e.last
                out.add((e.subtree, _digest(page.blocks[k : k + 1]), True))
            else:
                out.add((e.subtree, content, False))
    return out


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [list(candidates(parse(page))) for page in batch["html"].to_pylist()]
        row = pa.array([k for k, each in enumerate(found) for _ in each], pa.int64())
        columns = [pa.array([x[i] for each in found for x in each], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.bool_()))]
        yield pa.RecordBatch.from_arrays([batch["host"].take(row), batch["page"].take(row), *columns], ["host", "page", "subtree", "of", "inside"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(parse(page), set(template or ())) for page, template in zip(batch["html"].to_pylist(), batch["template"].to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_inside: int = MIN_INSIDE) -> DataFrame:
    """``page_id, url, text``: a row for each row ``page_id, url, html``; repeated rows stay, other columns are left out.

    ``page_id`` may be of any type. ``text`` is empty for a null or empty page. Pages without a host in their url (null too) count
    as one host. Pages of one host that have the same text are one page to the counts, however often they are repeated.
    """
    host = F.lower(F.coalesce(F.regexp_extract(F.coalesce("url", F.lit("")), _HOST, 1), F.lit("")))
    rows = pages.select("page_id", "url", host.alias("host"), F.coalesce("html", F.lit("")).alias("html")).withColumn("page", F.xxhash64("html"))
    found = stored(rows.select("host", "page", "html").mapInArrow(_subtrees, "host string, page long, subtree long, of long, inside boolean").distinct(), "subtrees")
    # one subtree has other numbers inside and outside of articles
    counts = found.select("host", "subtree", "of", "inside").distinct().groupBy("host", "subtree", "inside").agg(F.count("*").alias("n"))
    template = stored(counts.where(F.col("n") >= F.when(F.col("inside"), min_inside).otherwise(min_pages)).select("host", "subtree"), "template")
    small = F.broadcast if template.count() <= MOST_SENT else (lambda df: df)
    # a page only meets what it has itself: a host may have many template subtrees
    met = found.select("host", "page", "subtree").distinct().join(small(template), ["host", "subtree"])
    of_page = stored(met.groupBy("host", "page").agg(F.collect_list("subtree").alias("template")), "page-template")
    if (of_page.agg(F.sum(F.size("template"))).first()[0] or 0) <= MOST_SENT:
        of_page = F.broadcast(of_page)
    schema = T.StructType([rows.schema["page_id"], T.StructField("url", T.StringType()), T.StructField("text", T.StringType())])
    return rows.join(of_page, ["host", "page"], "left").select("page_id", "url", "html", "template").mapInArrow(_texts, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).withColumn("n_chars", F.length("text").cast("long"))


QUERIES = {"op9_html_extraction": query}
SQL: dict[str, str] = {}
