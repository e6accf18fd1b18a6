"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags.  The first pass decides
blocks on their own: what stands in a menu, header, footer, sidebar, notice,
advert, form or comment area (by element, role, class or id) is boilerplate,
as is a block that is mostly links; a block with enough stop words is text;
a long one with hardly any is boilerplate.  Short blocks, and those between
the stop-word thresholds, stay open.  In the second pass each open block
takes the label of the nearest decided neighbour, first among neighbours that
share more of its containers (areas have no say outside themselves; without
any such neighbour a block is text).  Where a page has an ``article`` or ``main``
with text in it, blocks outside are boilerplate.

Pages are independent: no shuffle, one page at a time in memory.

Defined cases: null and empty html give the empty text; so does a page
without text blocks; repeated ids and rows are done row by row; an empty
table gives an empty result; other columns pass through ``extract`` whatever
their names.  Broken markup (unclosed or crossing tags, unclosed comments and
scripts, text outside ``body``) never fails: an end tag closes the nearest
open element of its name, an unclosed comment or script runs to the end, an
unclosed tag to the next one.
A ``br`` is white space, two in a row end the block.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from portrait.llm.common import slices, table, trimmed

# Frequent function words of the languages that pages come in.
STOP_WORDS = frozenset((
    "the of and to in is that it for was on are with as at be this by from or an not have he his which you but had they "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat "
    "le la les de des et en un une du est pour que qui dans sur par plus pas au avec il elle ce se ne "
    "el los las del y a por con para su lo como más pero sus una no al o si sin sobre este "
).split())

# Elements and names.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINER = BLOCK - frozenset("p hr h1 h2 h3 h4 h5 h6 dt dd".split())
BOILERPLATE = frozenset("aside button datalist dialog footer form head header iframe math menu nav noscript object select svg template textarea title".split())
RAW = frozenset("script style".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
AREAS = frozenset(
    "ad ads adv advert advertisement adverts advertising banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright "
    "disqus footer form header login masthead menu menus modal nav navbar navigation newsletter notice notices notification pagination pager popup promo "
    "related recommended reply replies respond search share sharing sidebar signup social sponsor sponsored subscribe subscription teaser toolbar widget widgets".split())
#: Areas that may be part of an article: its own header.
OWN = frozenset("header masthead byline".split())

SHORT, LONG = 70, 200  # code points of a block
STOP_LOW, STOP_HIGH = 0.10, 0.25  # stop words among words
LINKS = 0.33  # share of a block's text inside links
UNCLOSED = ("nav", "header", "footer", "head")

# Every alternative stops at the next "<" (but a comment, which ends once), so
# the time is in proportion to the page however broken it is.
TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/<>]*+)((?:"[^"<]*+"|'[^'<]*+'|[^<>"'])*+)>"""
    r"""|<(/?)([A-Za-z][^\s/<>]*+)([^<>]*+)(?:>|(?=<)|\Z)|<[!?/][^<>]*+(?:>|(?=<)|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([A-Za-z-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
WORD = re.compile(r"[^\W\d_]+")
RAW_END = {name: re.compile(rf"</{name}\s*>|\Z", re.I) for name in RAW}


@dataclass
class Block:
    """Text between block-level tags.  ``low``: how many containers stayed open
    from where the block before began to where this one does, so the least of
    the blocks on the way is the number of containers that two blocks share."""

    low: int
    boilerplate: bool
    article: bool
    runs: list[str] = field(default_factory=list)
    text: str = ""
    linked: int = 0
    label: int = 0  # 1 text, -1 boilerplate, 0 open


def is_area(name: str, attributes: str, in_article: bool) -> bool:
    """Whether this element holds boilerplate whatever it says."""
    if name in BOILERPLATE and not (in_article and name == "header"):
        return True
    if "=" not in attributes and "hidden" not in attributes:
        return False
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values)
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if key == "role" and value.lower() in ROLES:
            return True
        if key in ("class", "id") and name not in ("body", "html"):
            names = set(NAME.findall(CAMEL.sub(" ", value).lower())) & AREAS
            if names - OWN if in_article else names:
                return True
    return False


def page_blocks(html: str) -> list[Block]:
    """The blocks with text of a page, in order."""
    out: list[Block] = []
    open_: list[tuple[str, bool, bool]] = []  # name, boilerplate, article
    named: Counter = Counter()  # open elements by name
    links = breaks = lowest = 0
    block = Block(0, False, False)

    def close() -> str:
        """Close the innermost open container."""
        nonlocal lowest
        name = open_.pop()[0]
        lowest = min(lowest, len(open_))
        return name

    def end() -> None:
        nonlocal block, lowest
        block.text = " ".join("".join(block.runs).split())
        if block.text:
            out.append(block)
            since = lowest
        else:  # a block without text is none: the next one follows the one before it
            since = min(block.low, lowest)
        _, boilerplate, article = open_[-1] if open_ else ("", False, False)
        block, lowest = Block(since, boilerplate, article), len(open_)

    def say(raw: str) -> None:
        nonlocal breaks
        if raw:
            run = unescape(raw)
            if not run.isspace():
                breaks = 0
            block.runs.append(run)
            if links:
                block.linked += sum(map(len, run.split()))

    at = 0
    while m := TAG.search(html, at):
        say(html[at:m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        if not closing:
            if name in RAW:
                at = RAW_END[name].search(html, at).end()
                continue
            if name == "br":
                breaks += 1
                block.runs.append(" ")
                if breaks > 1:
                    end()
                continue
            if name == "a":
                links = 1  # links do not nest: a second one closes the first
                continue
            inside = open_[-1] if open_ else ("", False, False)
            area = is_area(name, attributes, inside[2])
            if name in ("article", "main") and not area:
                while any(named[x] for x in UNCLOSED):  # these were never closed
                    named[close()] -= 1
                inside = open_[-1] if open_ else ("", False, False)
            if name == "body":
                while named["head"]:
                    named[close()] -= 1
                inside = open_[-1] if open_ else ("", False, False)
            if name not in BLOCK and not area:
                if name in ("img", "input", "wbr"):
                    block.runs.append("" if name == "wbr" else " ")
                continue
            links = links if name not in CONTAINER else 0
            if name in VOID:
                end()
                continue
            if name in CONTAINER or area:
                named[name] += 1
                open_.append((name, inside[1] or area, inside[2] or name in ("article", "main")))
            end()
        elif name == "a":
            links = 0
        elif named[name]:
            while (last := close()) != name:
                named[last] -= 1
            named[name] -= 1
            end()
        elif name in BLOCK:
            end()
    say(html[at:])
    end()
    return out


def first_pass(block: Block) -> int:
    """1 text, -1 boilerplate, 0 open."""
    size = sum(map(len, block.text.split()))
    if block.boilerplate or block.linked > LINKS * size:
        return -1
    words = WORD.findall(block.text.lower())
    stop = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
    if len(block.text) < SHORT:
        return 0 if not block.linked or block.article else -1
    if stop >= STOP_HIGH or block.article and stop >= STOP_LOW:
        return 1
    if stop < STOP_LOW and len(block.text) > LONG and not block.article:
        return -1
    return 0


def shared(blocks: list[Block], decided: list[int]) -> tuple[list[int], list[int]]:
    """For every block the containers that it shares with the nearest decided
    block before it and behind it (0 where there is none)."""
    n = len(blocks)
    before, behind, known = [0] * n, [0] * n, set(decided)
    for i in range(1, n):
        before[i] = blocks[i].low if i - 1 in known else min(before[i - 1], blocks[i].low)
    for i in range(n - 2, -1, -1):
        behind[i] = blocks[i + 1].low if i + 1 in known else min(behind[i + 1], blocks[i + 1].low)
    return before, behind


def label(blocks: list[Block]) -> None:
    """Both passes: every block gets 1 or -1."""
    for b in blocks:
        b.label = first_pass(b)
    if any(b.article and b.label >= 0 for b in blocks):
        for b in blocks:
            if not b.article:
                b.label = -1
    decided = [i for i, b in enumerate(blocks) if b.label]
    first = [b.label for b in blocks]
    before, behind = shared(blocks, decided)
    for i, b in enumerate(blocks):
        if first[i]:
            continue
        at = bisect_left(decided, i)
        near = []
        for j in decided[max(0, at - 1):at + 1]:
            other = blocks[j]
            # an area says nothing about what stands beside it, nor does the page about its article
            if not other.boilerplate and not (b.article and not other.article):
                near.append((-(before if j < i else behind)[i], abs(i - j), -first[j]))
        b.label = -min(near)[2] if near else 1


def main_text(html: str | None) -> str:
    blocks = page_blocks(html or "")
    label(blocks)
    return "\n".join(b.text for b in blocks if b.label > 0)


def extract(pages: DataFrame, carry: list[str], html_col: str = "html") -> DataFrame:
    """``row`` (a struct of the ``carry`` columns) and the page's text."""
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{html_col}`").alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html = batch.column(1).to_pylist()
            for s, e in slices(html):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s, e - s), pa.array(map(main_text, html[s:e]), pa.string())], names=["row", "text"])

    return rows.mapInArrow(trimmed(run), StructType().add("row", rows.schema["row"].dataType).add("text", "string"))


def op5_htmltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(table(spark, sf_dir, "pages"), ["page_id", "url"])
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))
