"""Main text of HTML pages by two-pass block rules."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from panelflow.config import ENGLISH_STOP_WORDS, SPANISH_STOP_WORDS
from panelflow.llm.tokens import slices

# Block rules: share of stop words and of characters in links, and words in a block.
STOP_SHARE, LINK_SHARE, LONG_WORDS = 0.15, 0.4, 10

FRENCH_AND_GERMAN = """
le la les un une des du de et en est que qui dans pour par sur pas au aux ce cette il elle ne se plus avec son sa ses
der die das und ist nicht ein eine einen dem den des zu zum zur von mit sich auf für als auch es an werden aus er hat dass sie nach bei um am
""".split()
STOP_WORDS = frozenset([*ENGLISH_STOP_WORDS, *SPANISH_STOP_WORDS, *FRENCH_AND_GERMAN])

# Elements whose content is no text of the page, and those that surround other things than its main text.
SILENT = frozenset("script style noscript template title svg math iframe object canvas audio video select textarea button datalist".split())
ASIDE = frozenset("nav footer aside form dialog menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
MAIN = frozenset(["article", "main"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words of class, id and role that name parts around the main text; comments also hide articles inside them.
HINT = re.compile(
    r"(?<![a-z])(?:ads?|advert\w*|banner\w*|sponsor\w*|promo\w*|menu\w*|nav|navbar|navigation|sidebars?|footer|masthead|cookies?|consent|notices?|"
    r"notification\w*|alert\w*|popup\w*|modal\w*|newsletter\w*|subscri\w*|signup|login|share|sharing|social\w*|related|recommended|breadcrumbs?|"
    r"pagination|pager|widget\w*|toolbar|search|complementary|contentinfo|disclaimer|paywall)(?![a-z])"
)
COMMENTS = re.compile(r"(?<![a-z])(?:comments?|comment[-_]?\w*|respond|replies|reply|disqus\w*|discussion)(?![a-z])")
ATTRIBUTE = re.compile(r"""([a-z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none")


@dataclass
class Block:
    """``around`` marks places outside the main text, ``main`` the article that holds the block."""

    text: str
    linked: int
    heading: bool
    around: bool
    main: int
    label: str = ""


@dataclass
class _Reader:
    """Collects a page's blocks; ``open`` holds (tag, around, main, comments) of open elements."""

    blocks: list[Block] = field(default_factory=list)
    open: list[tuple[str, bool, int, bool]] = field(default_factory=list)
    count: Counter = field(default_factory=Counter)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    in_link: int = 0
    heading: bool = False
    mains: int = 0

    def text(self, raw: str) -> None:
        text = unescape(raw) if "&" in raw else raw
        self.parts.append(text)
        if self.in_link:
            self.linked += len(text.strip())

    def end_block(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                _, around, main, _ = self.open[-1] if self.open else ("", False, 0, False)
                self.blocks.append(Block(text, self.linked, self.heading, around, main))
        self.parts, self.linked, self.heading = [], 0, False

    def start(self, tag: str, attributes: str) -> None:
        if tag == "a":
            self.in_link += 1
        elif tag == "br":
            self.parts.append(" ")
        if tag not in BLOCKS:
            return
        self.end_block()
        self.heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6")
        if tag in VOID:
            return
        _, around, main, comments = self.open[-1] if self.open else ("", False, 0, False)
        attributes = attributes.lower()
        named = " ".join(a or b or c for key, a, b, c in ATTRIBUTE.findall(attributes) if key in ("class", "id", "role")) if attributes else ""
        comments = comments or bool(named and COMMENTS.search(named))
        if tag in MAIN and not comments:
            if not main:
                self.mains += 1
                main = self.mains
            around = False  # an article ends what was left open around it
        if comments or tag in ASIDE or tag == "header" and not main or named and HINT.search(named) and tag not in ("html", "body", "main"):
            around = True
        if attributes and HIDDEN.search(attributes):
            around = True
        if tag == "p" and self.open and self.open[-1][0] == "p":
            self.pop()
        self.open.append((tag, around, main, comments))
        self.count[tag] += 1

    def pop(self) -> None:
        self.count[self.open.pop()[0]] -= 1

    def end(self, tag: str) -> None:
        if tag == "a":
            self.in_link = max(0, self.in_link - 1)
        if tag in BLOCKS and tag not in VOID:
            self.end_block()
            if self.count[tag]:
                while self.open[-1][0] != tag:
                    self.pop()
                self.pop()


def _tag_end(html: str, at: int, quotes: dict[str, int]) -> int:
    """Index of the ``>`` that ends the tag at ``at``, outside quoted values; -1 if there is none."""
    while True:
        end = html.find(">", at)
        if end < 0:
            return -1
        quote = min((q for q in (html.find('"', at, end), html.find("'", at, end)) if q >= 0), default=-1)
        if quote < 0:
            return end
        mark = html[quote]
        if quote >= quotes.get(mark, len(html)):  # known to be never closed
            return end
        close = html.find(mark, quote + 1)
        if close < 0:
            quotes[mark] = quote
            return end
        if close > end and html.find("<", end, close) >= 0:  # a stray quote, not a value with ">"
            return end
        at = close + 1


NAME = re.compile(r"[a-zA-Z][^\s/>]*")


def read_blocks(html: str) -> list[Block]:
    """Blocks of a page in order.  Linear in the page's length."""
    reader, at, n, quotes, silent = _Reader(), 0, len(html), {}, set()
    while at < n:
        open_at = html.find("<", at)
        if open_at < 0:
            reader.text(html[at:])
            break
        if open_at > at:
            reader.text(html[at:open_at])
        if html.startswith("<!--", open_at):
            end = html.find("-->", open_at + 4)
            at = n if end < 0 else end + 3
            continue
        closing = html.startswith("/", open_at + 1)
        name = NAME.match(html, open_at + 1 + closing)
        if not name:
            if html.startswith(("!", "?", "/"), open_at + 1):
                end = html.find(">", open_at)
                at = n if end < 0 else end + 1
            else:
                reader.text("<")
                at = open_at + 1
            continue
        end = _tag_end(html, name.end(), quotes)
        if end < 0:
            break  # a tag cut off at the page's end
        tag = name.group().lower()
        at = end + 1
        if closing:
            reader.end(tag)
        elif tag in SILENT:
            if tag not in silent:
                close = re.compile(f"</{tag}(?![a-z0-9])", re.I).search(html, at)
                if close:
                    at = close.start()
                else:
                    silent.add(tag)
                    if tag in ("script", "style"):
                        break
        else:
            reader.start(tag, html[name.end() : end])
    reader.end_block()
    return reader.blocks


def _first_label(block: Block, any_main: bool) -> str:
    """Pass one: ``good``, ``bad`` or, for a short block that could be either, ``short``."""
    if block.around or any_main and not block.main:
        return "bad"
    if block.linked > LINK_SHARE * len(block.text):
        return "bad"
    words = block.text.lower().split()
    if len(words) < LONG_WORDS:
        return "short"
    stops = sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words)
    return "good" if stops >= STOP_SHARE * len(words) or block.main else "bad"


def label_blocks(blocks: list[Block]) -> list[Block]:
    """Pass two: short blocks take the label of the nearest decided neighbour.

    If both sides are as near, a heading follows what comes after it and other blocks are good
    if either side is.  Inside an article only its own blocks are neighbours.  Where nothing
    is decided, blocks of an article are good and others bad.
    """
    any_main = any(b.main and not b.around for b in blocks)
    for b in blocks:
        b.label = _first_label(b, any_main)
    sides = []
    for order in (range(len(blocks)), range(len(blocks) - 1, -1, -1)):
        nearest, found = {}, {}
        for i in order:
            b = blocks[i]
            if b.label == "short":
                found[i] = nearest.get(b.main)
            elif not (b.main and b.around):
                nearest[b.main] = i
        sides.append(found)
    for i, before in sides[0].items():
        after = sides[1][i]
        b = blocks[i]
        if before is None and after is None:
            b.label = "good!" if b.main else "bad!"
        elif before is None or after is not None and (after - i < i - before or after - i == i - before and (b.heading or blocks[after].label == "good")):
            b.label = blocks[after].label + "!"
        else:
            b.label = blocks[before].label + "!"
    for b in blocks:
        b.label = b.label.rstrip("!")
    return blocks


def main_text(html: str | None) -> tuple[str, int, int]:
    """Text, blocks kept and blocks dropped."""
    blocks = label_blocks(read_blocks(html or ""))
    kept = [b.text for b in blocks if b.label == "good"]
    return "\n\n".join(kept), len(kept), len(blocks) - len(kept)


def extract_main_text(df: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``df`` with the main text in place of the HTML, and ``n_blocks``, ``n_dropped``.

    The page is cut into blocks at block elements; character references are decoded and white
    space becomes one space.  Blocks in navigation, footers, forms, comments and the like and
    blocks mostly of links are bad, long blocks with enough stop words or inside an article
    good, and short ones inherit their label (``label_blocks``).  Good blocks are joined in
    page order by an empty line.  A null or empty page and one without main text give an
    empty text.  Rows stay as they are otherwise; columns of the output names are replaced.
    """
    names = [c for c in df.columns if c not in (html, out, "n_blocks", "n_dropped")]
    inner = df.select(F.col(f"`{html}`").cast("string").alias("_html"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)])

    def run(batches):
        for batch in batches:
            pages = batch.column(0).to_pylist()
            for s in slices(pages):
                found = [main_text(p) for p in pages[s]]
                text, kept, dropped = zip(*found)
                rest = batch.slice(s.start, s.stop - s.start).columns[1:]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(text, pa.string()), pa.array(kept, pa.int32()), pa.array(dropped, pa.int32())],
                    names=[*(f"c{k}" for k in range(len(names))), "_text", "_kept", "_dropped"],
                )

    kept = [StructField(f"c{k}", inner.schema[f"c{k}"].dataType) for k in range(len(names))]
    schema = StructType([*kept, *_parse_datatype_string("_text string, _kept int, _dropped int").fields])
    return inner.mapInArrow(run, schema).select(
        *[F.col(f"c{k}").alias(c) for k, c in enumerate(names)],
        F.col("_text").alias(out),
        F.col("_kept").alias("n_blocks"),
        F.col("_dropped").alias("n_dropped"),
    )
