"""Operator 6, main text of HTML pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass decides a block, on every page, by these rules in turn:

* hidden: it stands in an element that shows nothing or is never text (menu, form, footer, button and the like);
* links: too many of its characters are links, or it is short and has any;
* names: it stands in an element whose class or id consists of words for boilerplate, unless the blocks that this
  leaves hold no text: then such names are ignored on that page;
* density: a long block dense in stop words is text.

The rest is undecided. In the second pass an undecided block takes the label of its nearest decided neighbours on its
side of the border of the article (or main element); where they differ, the nearer one counts, and at equal distance only
a long block counts as text; a heading goes with what follows it. Where its side has none decided, a block inside the
article is text and one outside it is not; on a page without article in which nothing is text, undecided blocks stay.

Each page is judged alone: one scan, no shuffle. Parsing is a single pass over tags, linear in the page, and
takes malformed markup as it comes: an end tag closes the nearest open element of its name or is ignored, an
unclosed one ends with its parent, an unclosed comment or script runs to the end.

Defined results: null or empty html gives an empty text; pages without any block likewise; a very long page is one page
like any other; repeated rows repeat; an empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapweave.llm.shared import blocks, record

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)>", re.DOTALL)
_ATTRIBUTE = re.compile(r"([A-Za-z_:][A-Za-z0-9_.:-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([A-Za-z_:][A-Za-z0-9_.:-]*)")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

RAW = frozenset("script style noscript template iframe svg canvas object audio video math textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLE = frozenset(("article", "main"))
#: Elements that end an open element of the second set.
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements whose missing end tag would hide an article that follows.
UNCLOSED = frozenset("head header nav".split())
BOILER_TAGS = frozenset("nav footer aside form button select menu dialog head search".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
#: Words for boilerplate in class and id; a name counts if all its words are these or the plain ones that follow.
BOILER_WORDS = frozenset("ad ads adv advert adverts advertisement advertisements adsense advertising banner banners breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr menu modal nav navbar navigation newsletter notice notices notification pager pagination paywall popup promo promotion promotions recommended related replies reply share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser teasers toolbar widget widgets".split())
PLAIN_WORDS = frozenset("area bar block bottom box btn button buttons center column container content count counter div form group header icon icons inner item items left link links list main mini outer panel right row section site side slot small sticky sub text title top unit wrap wrapper page global primary secondary thread tree user email mobile desktop close open".split())
#: And these only outside the article.
HEADER_WORDS = frozenset("header masthead topbar".split())

#: Common function words of the four languages.
STOP_WORDS = frozenset(
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there would their we him been has when who will no more if out so up "
    "de la le et les des en un du une que est pour qui dans par sur plus pas au avec ce il sont ou mais se aux son cette ne elle nous leur entre être "
    "der die das und ist nicht ein eine zu den von mit sich auf für im dem auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über so zum war haben nur oder aber vor zur bis mehr durch man sein "
    "el los y en que las del se por con no una su para al lo como más pero sus le ya o este sí porque esta son cuando muy sin sobre también me hasta hay donde quien desde todo nos durante todos uno les ni contra otros ese eso".split()
)


@dataclass(frozen=True)
class Rules:
    max_link_density: float = 0.33
    short: int = 70
    long: int = 200
    stop_words: float = 0.28


@dataclass
class Block:
    text: str
    link_chars: int
    heading: bool
    inside: bool  # of the article
    mark: str = ""  # "hidden", "named" or ""


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        name = (m[1] or m[5]).lower()
        out.setdefault(name, next((g for g in (m[2], m[3], m[4]) if g is not None), ""))
    return out


def _named(value: str, words: frozenset[str]) -> bool:
    """Whether one of the names in a class or id attribute consists of such words and plain ones."""
    for name in value.split():
        parts = [m.lower() for m in _TOKEN.findall(name)]
        if any(p in words for p in parts) and all(p in words or p in PLAIN_WORDS or p.isdigit() for p in parts):
            return True
    return False


@dataclass(frozen=True)
class Place:
    """Where the content of an element stands."""

    inside: bool = False
    mark: str = ""
    cause: str = ""  # the outermost element that marks it


def _place(tag: str, raw: str, parent: Place) -> Place:
    attrs = _attributes(raw) if raw and "=" in raw or "hidden" in raw else {}
    name = attrs.get("class", "") + " " + attrs.get("id", "")
    inside = parent.inside or tag == "main" or (tag == "article" and parent.mark != "hidden" and not _named(name, BOILER_WORDS))
    mark = parent.mark
    if mark != "hidden":
        shown = not ("hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", ""), re.IGNORECASE))
        if not shown or tag in BOILER_TAGS or (tag == "header" and not inside) or attrs.get("role", "").lower() in BOILER_ROLES:
            mark = "hidden"
        elif tag not in ("body", "html") and (_named(name, BOILER_WORDS) or (not inside and _named(name, HEADER_WORDS))):
            mark = "named"
    return parent if (inside, mark) == (parent.inside, parent.mark) else Place(inside, mark, parent.cause or (tag if mark else ""))


def blocks_of(page: str) -> list[Block]:
    out: list[Block] = []
    open_tags: list[tuple[str, Place]] = [("", Place())]
    depths: dict[str, list[int]] = {}  # where the open elements of each name are
    block_depths: list[int] = []
    text: list[str] = []
    links, link_depth, heading = 0, 0, False

    def close() -> None:
        nonlocal links, text
        joined = " ".join("".join(text).split())
        if joined:
            out.append(Block(joined, links, heading, open_tags[-1][1].inside, open_tags[-1][1].mark))
        text, links = [], 0

    def add(piece: str) -> None:
        nonlocal links
        if piece:
            piece = html.unescape(piece) if "&" in piece else piece
            text.append(piece)
            if link_depth:
                links += len(" ".join(piece.split()))

    def pop(depth: int) -> None:
        nonlocal link_depth
        for name, _ in open_tags[depth:]:
            link_depth -= name == "a"
            depths[name].pop()
        del open_tags[depth:]
        while block_depths and block_depths[-1] >= depth:
            block_depths.pop()

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if m[3] is None:
            if m[1]:
                add(m[1])
            continue
        closing, tag = bool(m[2]), m[3].lower()
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCK or (tag in RAW and tag == "title"):
            close()
        if closing:
            if depths.get(tag):
                pop(depths[tag][-1])
                if tag in HEADINGS:
                    heading = False
            continue
        if tag in RAW and not m[4].rstrip().endswith("/"):
            stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*>|</{tag}>", re.IGNORECASE).search(page, at)
            at = stop.end() if stop else end
            continue
        if tag in VOID or m[4].rstrip().endswith("/"):
            continue
        if tag in BLOCK:
            above = open_tags[block_depths[-1]][0] if block_depths else ""
            if (tag == "p" or tag in HEADINGS) and (above == "p" or above in HEADINGS) or above in IMPLIED.get(tag, ()):
                pop(block_depths[-1])
            heading = tag in HEADINGS
        parent = open_tags[-1][1]
        if tag == "body" or (tag in ARTICLE and parent.mark == "hidden" and parent.cause in UNCLOSED):
            parent = Place()  # what came before was left open
        depths.setdefault(tag, []).append(len(open_tags))
        if tag in BLOCK:
            block_depths.append(len(open_tags))
        open_tags.append((tag, _place(tag, m[4], parent)))
        link_depth += tag == "a"
    close()
    return out


def first_pass(page: list[Block], rules: Rules = Rules(), names: bool = True) -> list[tuple[bool | None, str]]:
    """The label of each block, None if undecided, and the rule that gave it."""
    out: list[tuple[bool | None, str]] = []
    for b in page:
        words = b.text.lower().split()
        if b.mark == "hidden":
            out.append((False, "hidden"))
        elif b.link_chars > rules.max_link_density * len(b.text) or (len(b.text) < rules.short and b.link_chars and not b.inside):
            out.append((False, "links"))
        elif (b.mark == "named" and names) or (b.text.startswith("©") and not b.inside):
            out.append((False, "names"))
        elif len(b.text) >= rules.long and not b.heading and sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) >= rules.stop_words * len(words):
            out.append((True, "density"))
        else:
            out.append((None, ""))
    if names and any(b.mark == "named" for b in page) and not any(x for x, _ in out) and not any(x is None and (b.inside or not any(c.inside for c in page)) for (x, _), b in zip(out, page, strict=True)):
        return first_pass(page, rules, False)
    return out


def second_pass(page: list[Block], decided: list[bool | None], rules: Rules = Rules()) -> list[bool]:
    """Labels of all blocks: undecided ones from their neighbours on the same side of the article's border."""
    out: list[bool] = [bool(x) for x in decided]
    article = any(b.inside for b in page)
    for side in (True, False):
        here = [k for k, b in enumerate(page) if b.inside == side]
        before: list[int] = []
        for n, k in enumerate(here):
            before.append(n if decided[k] is not None else before[-1] if n else -1)
        after = [len(here)] * len(here)
        for n in range(len(here) - 1, -1, -1):
            after[n] = n if decided[here[n]] is not None else after[n + 1] if n + 1 < len(here) else len(here)
        text = any(decided[k] for k in here)
        for n, k in enumerate(here):
            if decided[k] is not None:
                continue
            left = decided[here[before[n]]] if before[n] >= 0 else None
            right = decided[here[after[n]]] if after[n] < len(here) else None
            if side and not text:
                out[k] = True
            elif not text:
                out[k] = not article
            elif page[k].heading:
                out[k] = bool(right if right is not None else side)
            elif left is None or right is None or left == right:
                out[k] = bool(right if left is None else left)
            elif n - before[n] != after[n] - n:
                out[k] = bool(left if n - before[n] < after[n] - n else right)
            else:
                out[k] = side or len(page[k].text) >= rules.short
    return out


def labels(page: list[Block], rules: Rules = Rules()) -> list[bool]:
    """Whether each block is main text."""
    return second_pass(page, [x for x, _ in first_pass(page, rules)], rules)


def extract(page: str | None, rules: Rules = Rules()) -> str:
    found = blocks_of(page or "")
    return "\n".join(b.text for b, main in zip(found, labels(found, rules), strict=True) if main)


ROWS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract_pages(pages: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """page_id, url, main text and its length of each page."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "html"):
            texts = [extract(x, rules) for x in b.column("html").to_pylist()]
            yield record(ROWS, {"page_id": b.column("page_id"), "url": b.column("url"), "text": texts, "n_chars": list(map(len, texts))})

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
