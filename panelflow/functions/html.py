"""HTML to text by an expression chain, right on regular markup; ``markup`` reads any other page.

Text rules: subtrees of page furniture are dropped, text nodes are joined by one space,
lines and double-space separated chunks are trimmed and re-joined by one space.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Elements whose whole subtree is dropped ...
DROPPED_TAGS = ["script", "style", "nav", "footer", "header", "aside", "form"]
# ... and elements whose strings a plain text extraction does not return either.
HIDDEN_TAGS = ["template", "rt", "rp"]
# Elements that never have content.
VOID_TAGS = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem",
    "meta", "param", "source", "track", "wbr", "basefont", "bgsound", "command", "frame",
    "image", "isindex", "nextid", "spacer",
}
# Entities decoded natively; any other one makes the page irregular.
ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "copy": "©", "reg": "®",
    "trade": "™", "middot": "·", "bull": "•", "hellip": "…", "ndash": "–", "mdash": "—",
    "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "laquo": "«", "raquo": "»",
    "euro": "€", "pound": "£", "cent": "¢", "deg": "°", "times": "×",
}

GAP = "\u0001"  # stands for a boundary between text nodes
END = "\u0002"  # appended to the page; vanishes if an unclosed subtree swallows the rest

SUBTREE_TAGS = DROPPED_TAGS + HIDDEN_TAGS
_ANY_SUBTREE_TAG = "|".join(SUBTREE_TAGS)
_RAW_TEXT_TAGS = ["script", "style"]  # their content is no markup
_ATTRS = r"(?:[\s/](?:[^<>]*[^<>/])?)?"  # does not match a self-closed tag


def _elements(tags: list[str]) -> str:
    """Elements from start tag to end tag.  Every alternative finds an end (at worst that
    of the page), so a run of unclosed start tags costs one pass, not one pass each."""
    return "|".join(rf"<{t}{_ATTRS}>.*?(?:</{t}\s*>|\z)" for t in tags)


# Comments, scripts and declarations go first: they may hold anything that looks like a tag.
LEXICAL = rf"(?is)<!--.*?(?:-->|\z)|{_elements(_RAW_TEXT_TAGS)}|<[!?][^<>]*>"
SUBTREES = "(?is)" + _elements([t for t in SUBTREE_TAGS if t not in _RAW_TEXT_TAGS])
TAG = r"</?[a-zA-Z][^<>]*>"
LINE_BREAK = r"[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
SPACE = (
    r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def strip(col: Column) -> Column:
    """Trim Unicode white space on both ends in linear time."""
    return F.regexp_replace(col, rf"^{SPACE}++|(?<!{SPACE}){SPACE}++\z", "")


def join_chunks(text: Column) -> Column:
    chunks = F.transform(F.split(text, rf"{LINE_BREAK}|  "), strip)
    return F.array_join(F.filter(chunks, lambda c: c != ""), " ")


def without_scripts(html: Column) -> Column:
    return F.regexp_replace(F.concat(html, F.lit(END)), LEXICAL, GAP)


def without_subtrees(lexed: Column) -> Column:
    return F.regexp_replace(lexed, SUBTREES, GAP)


def without_tags(stripped: Column) -> Column:
    return F.regexp_replace(stripped, TAG, GAP)


def native_text(untagged: Column) -> Column:
    """Finish the native chain: gaps to spaces, entities, chunks."""
    text = F.regexp_replace(untagged, f"{GAP}+", GAP)
    # A text node of nothing but white space separates chunks like a line break.
    text = F.regexp_replace(text, f"{GAP}[ \t\n\f\r]+(?={GAP})", "\n")
    text = F.regexp_replace(text, f"[{GAP}{END}]", " ")
    for name, char in ENTITIES.items():
        text = F.replace(text, F.lit(f"&{name};"), F.lit(char))
    text = F.replace(text, F.lit("&#39;"), F.lit("'"))
    text = F.replace(text, F.lit("&amp;"), F.lit("&"))
    return join_chunks(text)


def _badly_nested(tags: Column) -> Column:
    """Whether the tags of a dropped element leave it early or open it again.

    An end tag without its start tag inside the element would close something around it.
    """

    def places(tag: Column) -> Column:
        return F.filter(
            F.transform(tags, lambda t, i: F.when(t == tag, i)), lambda i: i.isNotNull()
        )

    def leaves(name: Column) -> Column:
        pairs = F.zip_with(
            places(F.concat(F.lit("<"), name)),
            places(F.concat(F.lit("</"), name)),
            lambda start, end: end.isNotNull() & (start.isNull() | (start > end)),
        )
        return F.exists(pairs, lambda early: early)

    ends = F.filter(tags, lambda t: F.startswith(t, F.lit("</")))
    names = F.array_distinct(F.transform(ends, lambda t: F.substring(t, F.lit(3), F.length(t))))
    return (F.size(F.filter(tags, lambda t: t == F.get(tags, 0))) > 1) | F.exists(names, leaves)


def is_irregular(html: Column, lexed: Column, stripped: Column, untagged: Column) -> Column:
    """True where regular expressions cannot be trusted with the markup.

    Nested, unclosed or self-closed dropped subtrees, end tags that cross their border, a
    quoted ``>``, markup left over after the tag pass, entities outside the native map.
    """
    known = "|".join([*ENTITIES, "amp", "#39"])
    elements = F.regexp_extract_all(lexed, F.lit(SUBTREES), F.lit(0))
    tags = F.transform(
        elements, lambda e: F.regexp_extract_all(e, F.lit(r"</?[a-zA-Z][^\s/<>]*"), F.lit(0))
    )
    return (
        F.contains(html, F.lit(GAP))
        | F.contains(html, F.lit(END))
        | ~F.endswith(stripped, F.lit(END))
        | stripped.rlike(rf"(?i)</?(?:{_ANY_SUBTREE_TAG})[\s/>]")
        | untagged.rlike(rf"<[/!?a-zA-Z]|>|&(?!(?:{known});)[a-zA-Z#]")
        | F.exists(tags, _badly_nested)
    )
