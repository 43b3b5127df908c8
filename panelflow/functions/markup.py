"""Visible text of badly nested HTML: a scan of tags with the open elements as running state.

A page is cut at every tag, comment, declaration and character reference by one expression.  The
tags that can open or close something are folded in page order: the open elements are kept as
a path, and an end tag closes everything down to the nearest open element of its name.  Stretches
in which no dropped element is open are noted as ranges of parts, and the page is put
together from those ranges.  All of it happens inside one row of one task.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, functions as F

from panelflow.functions.html import SUBTREE_TAGS, VOID_TAGS, join_chunks

# Noncharacters that separate parts, fields of a part and text nodes; pages cannot hold them in earnest.
CUT, FIELD, NODE = "\ufdd0", "\ufdd1", "\ufdd2"

_NAME = r"[a-zA-Z][^\t\n\r\f />\x00]*+"
# After a name: attributes with values in either quotes, or bare up to white space or ">".
_ATTRIBUTES = r"""(?:(?:\s|/(?!>))*+(?<=['"\s/])[^\s/>][^\s/=>]*+(?:\s*=+\s*(?:'[^']*'|"[^"]*"|(?!['"])[^>\s]*+)\s*)?)*+(?:\s|/(?!>))*+"""
_BLANK = r"[\t\n\r\f />\x00]"
# Whatever is not text, with a group for every kind that matters: 2 start tag, 3 its closing
# slash, 4 end tag, 5 CDATA text, 6 a broken start tag (text), 7 number and 8 name of a reference.
TOKEN = (
    r"<!--.*?--\s*>"
    rf"|(?i:<(script|style)(?={_BLANK})){_ATTRIBUTES}>(?:.*?</\s*(?i:\1)\s*>|.*)"
    rf"|<({_NAME}){_ATTRIBUTES}(/?)>"
    r"|</\s*([a-zA-Z][^\t\n\r\f />\x00]*+)[^>]*+>"
    r"|<!\[CDATA\[(.*?)\]\s*\]\s*>"
    r"|</>|</[^>]*+>|<[!?][^>]*+>"
    rf"|(<{_NAME}{_ATTRIBUTES}(?:(?=[a-zA-Z=/])[^>]*+>)?)"
    r"|&(?:#([0-9]+|[xX][0-9a-fA-F]+)|([a-zA-Z][-.a-zA-Z0-9]*+));?"
)


def _text(value: str) -> str:
    """A SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _names(values: list[str]) -> str:
    return ", ".join(map(_text, values))


def _let(name: str, value: str, use: str) -> str:
    """``use`` with ``name`` standing for ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {use})[0]"


def _behind(page: str, mark: str, old: str, new: str) -> str:
    """``old`` becomes ``new`` behind the last ``mark``, where a search for ``mark`` would read to the end each time."""
    tail = f"substring_index({page}, {_text(mark)}, -1)"
    return f"concat(left({page}, length({page}) - length({tail})), replace({tail}, {_text(old)}, {_text(new)}))"


def _parts(html: str) -> str:
    """Text and tokens in turn; a token is its groups joined by ``FIELD``."""
    groups = FIELD.join(f"${g}" for g in range(2, 9))
    page = f"translate({html}, {_text(CUT + FIELD + NODE)}, {_text(chr(0xFFFD) * 3)})"
    # What cannot end is text, or a plain declaration in the case of CDATA.
    page = _let("p", page, _behind("p", "-->", "<!--", "&lt;!--"))
    page = _let("p", page, _behind("p", "]]>", "<![CDATA[", "<![cdata["))
    page = _let("p", page, _behind("p", ">", "<", "&lt;"))
    return f"split(regexp_replace({page}, {_text('(?s)(?=[<&])(?:' + TOKEN + ')')}, {_text(CUT + groups + CUT)}), {_text(CUT)})"


# Fields of a token ``f``.
TAG, SLASH, END, CDATA, BROKEN, NUMBER, ENTITY = (f"f[{i}]" for i in range(7))

# A code point ``c`` as text; Windows-1252 below 256, U+FFFD where there is no character.
_UPPER = [bytes([b]).decode("cp1252", "replace") for b in range(128, 160)]
_CHARACTER = (
    f"CASE WHEN c IS NULL OR c > 1114111 OR c BETWEEN 55296 AND 57343 OR c BETWEEN {ord(CUT)} AND {ord(NODE)} THEN '�' "
    f"WHEN c BETWEEN 128 AND 159 THEN array({_names(_UPPER)})[cast(c - 128 AS int)] "
    "ELSE decode(unhex(lpad(hex(c), 8, '0')), 'UTF-32') END"
)
# More than nine digits are beyond the last code point, and leading zeros say nothing.
_CODE = (
    f"CASE WHEN lower(left({NUMBER}, 1)) = 'x' THEN "
    + _let("d", f"regexp_replace(substring({NUMBER}, 2), '^0+(?=.)', '')", "if(length(d) < 10, cast(conv(d, 16, 10) AS bigint), NULL)")
    + " ELSE "
    + _let("d", f"regexp_replace({NUMBER}, '^0+(?=.)', '')", "if(length(d) < 10, cast(d AS bigint), NULL)")
    + " END"
)


def _entities() -> str:
    """All named references; the optimizer folds this into one constant map."""
    table = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
    keys, values = (f"split({_text(FIELD.join(v))}, {_text(FIELD)})" for v in (table.keys(), table.values()))
    return f"map_from_arrays({keys}, {values})"


def _rendered() -> str:
    """The text of a token ``f``; an unknown reference stays without its semicolon."""
    return (
        f"CASE WHEN {BROKEN} <> '' THEN {BROKEN} "
        f"WHEN {NUMBER} <> '' THEN {_let('c', _CODE, _CHARACTER)} "
        f"WHEN {ENTITY} <> '' THEN coalesce(try_element_at({_entities()}, {ENTITY}), concat('&', {ENTITY})) "
        f"ELSE concat('{NODE}', {CDATA}, '{NODE}') END"
    )


def _events(parts: str) -> str:
    """Start and end tags that can matter, with their places among the parts.

    An element that is never closed matters only if dropped, an end tag only if it can close something.
    """
    opens = f"({TAG} <> '' AND {SLASH} = '' AND lower({TAG}) NOT IN ({_names(sorted(VOID_TAGS))}))"
    found = f"if({opens} OR {END} <> '', struct(i AS i, lower(concat({TAG}, {END})) AS name, {opens} AS opens), NULL)"
    tags = f"filter(transform({parts}, (t, i) -> if(i % 2 = 1, {_let('f', f'split(t, {_text(FIELD)})', found)}, NULL)), e -> e IS NOT NULL)"
    opened, closed = (f"array_distinct(transform(filter(tags, e -> {which}), e -> e.name))" for which in ("e.opens", "NOT e.opens"))
    wanted = f"if(e.opens, e.name IN ({_names(SUBTREE_TAGS)}) OR array_contains(n.closed, e.name), array_contains(n.opened, e.name))"
    useful = _let("n", f"struct({opened} AS opened, {closed} AS closed)", f"filter(tags, e -> {wanted})")
    return _let("tags", tags, useful)


def _visible(parts: str) -> str:
    """Ranges ``(first, size)`` of parts inside no dropped element.

    State: ``path``, the open elements; ``hidden``, the bytes of the path around the outermost
    dropped one, or -1; ``first``, where the current range began; the ranges so far.
    """
    start = "struct('' AS path, -1 AS hidden, 0 AS first, cast(array() AS array<struct<first:int,size:int>>) AS ranges)"

    def state(path: str, hidden: str, first: str, ranges: str) -> str:
        return f"struct({path} AS path, {hidden} AS hidden, {first} AS first, {ranges} AS ranges)"

    def seen(end: str) -> str:
        return f"concat(s.ranges, array(struct(s.first AS first, {end} - s.first AS size)))"

    key = "concat('/', e.name, '/')"
    hides = f"e.name IN ({_names(SUBTREE_TAGS)}) AND s.hidden < 0"
    opened = state(f"concat(s.path, {key})", f"if({hides}, octet_length(s.path), s.hidden)", "s.first", f"if({hides}, {seen('e.i')}, s.ranges)")
    shows = "s.hidden >= 0 AND octet_length(path) <= s.hidden"
    closed = state("path", f"if({shows}, -1, s.hidden)", f"if({shows}, e.i + 1, s.first)", "s.ranges")
    left = f"substring(cast(s.path AS binary), 1, octet_length(s.path) - octet_length(tail) - octet_length({key}))"
    path = f"if(octet_length(tail) < octet_length(s.path), cast({left} AS string), s.path)"
    ended = _let("tail", f"substring_index(s.path, {key}, -1)", _let("path", path, closed))
    rest = f"if(s.hidden < 0, {seen(f'size({parts})')}, s.ranges)"
    return f"aggregate({_events(parts)}, {start}, (s, e) -> if(e.opens, {opened}, {ended}), s -> {rest})"


def visible_text(html: str) -> Column:
    """Text of column ``html`` outside dropped elements; null gives null.

    Text nodes are joined by one space, then lines and double-space separated chunks are trimmed and
    re-joined by one space.  The noncharacters U+FDD0 to U+FDD2 come out as U+FFFD.
    """
    # Text and tokens alternate; a range that begins with a token has an odd first place.
    part = f"if((i + r.first) % 2 = 0, t, {_let('f', f'split(t, {_text(FIELD)})', _rendered())})"
    piece = f"array_join(transform(slice(parts, r.first + 1, r.size), (t, i) -> {part}), '')"
    nodes = _let("parts", _parts(f"`{html}`"), f"array_join(transform({_visible('parts')}, r -> {piece}), '{NODE}')")
    # A text node of nothing but white space separates chunks like a line break.
    text = f"regexp_replace(regexp_replace({nodes}, '{NODE}+', '{NODE}'), '{NODE}[ \\\\t\\\\n\\\\f\\\\r]+(?={NODE})', '\\n')"
    return F.when(F.col(f"`{html}`").isNotNull(), join_chunks(F.expr(f"replace({text}, '{NODE}', ' ')")))
