"""HTML handling with native regular expressions (no DOM, no UDF).

Order matters and mirrors what a tree parser sees as text: comments first,
then ``script``/``style`` bodies (their strings may hold ``"</p>"``; an unclosed
one runs to the end), then every tag becomes a separator, then entities are
decoded in one pass, then Unicode white space is collapsed.  A tag ends at the
first ``>`` outside quoted attribute values.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements dropped before measuring competitor pages.
BOILERPLATE_TAGS = ("nav", "footer", "aside", "header")

# The rest of a tag up to its ">": quoted values first, any characters where
# the quotes do not pair up.
_REST = r"""(?:[^>"']*+(?:"[^"]*"[^>"']*+|'[^']*'[^>"']*+)*+>|[^>]*>)"""
_COMMENT_RE = r"(?s)<!--.*?(?:-->|\z)"
_TAG_RE = r"(?s)<[/!?a-zA-Z]" + _REST
_BOILERPLATE_RE = rf"(?is)</?(?:{'|'.join(BOILERPLATE_TAGS)})\b" + _REST
_ENTITY_RE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"

# Groups: 1 level, 2 attributes, 3 inner HTML.
HEADING_RE = r"""(?is)<h([1-6])\b([^>"']*+(?:"[^"]*"[^>"']*+|'[^']*'[^>"']*+)*+|[^>]*)>(.*?)</h\1\s*>"""

# What is no markup though it may look like it: comments, and elements whose
# content is raw text.  Each is hidden behind one private-use character and put
# back afterwards; such a character in the input hides itself.
COMMENT_MARK, RAW_MARK = "\ue000", "\ue001"
_RAW_RE = rf"<(script|style|textarea|title)\b{_REST}.*?(?:</\1\s*>|\z)"
_HIDDEN_RE = rf"(?is)<!--.*?(?:-->|\z)|{_RAW_RE}|[{COMMENT_MARK}{RAW_MARK}]"
_MAY_HIDE_RE = rf"(?i)<(?:!--|script|style|textarea|title)|[{COMMENT_MARK}{RAW_MARK}]"
# A heading element as a whole, any other tag, or a hidden raw element.
_TOKEN_RE = rf"(?is)<h([1-6])\b{_REST}.*?</h\1\s*>|<[/!?a-z]{_REST}|{RAW_MARK}"
# Elements without content; elements that end an open paragraph;
# elements that end an open one of their own name.
VOID_TAGS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
BLOCK_TAGS = ("address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure",
              "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre",
              "section", "table", "ul")
REPEATED_TAGS = ("li", "dt", "dd", "tr", "td", "th", "option")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_boilerplate(html: Column | str) -> Column:
    """Remove nav/footer/aside/header elements with their content, however
    deeply they are nested.  The text is cut at their tags once; a piece stays
    if no such element is open before it (a stray closing tag opens nothing)."""
    def kept(cut: Column) -> Column:
        depths = F.aggregate(
            cut["tags"], F.array(F.lit(0)),
            lambda d, t: F.array_append(d, F.when(t.startswith("</"), F.greatest(F.element_at(d, -1) - 1, F.lit(0)))
                                        .otherwise(F.element_at(d, -1) + 1)))
        return F.transform(F.array(depths), lambda d: F.array_join(F.transform(
            cut["pieces"], lambda p, i: F.when(F.get(d, i) == 0, p).otherwise("")), ""))[0]

    text = _c(html)
    cut = F.struct(F.split(text, _BOILERPLATE_RE, -1).alias("pieces"),
                   F.regexp_extract_all(text, F.lit(_BOILERPLATE_RE), 0).alias("tags"))
    return F.when(text.isNotNull(), F.transform(F.array(cut), kept)[0])


def _entity(name: Column) -> Column:
    """The character of an entity name (without ``&`` and ``;``), or the entity
    as written if there is none.  A no-break space reads as a space."""
    code = F.when(name.startswith("#x") | name.startswith("#X"), F.conv(F.substr(name, F.lit(3)), 16, 10)) \
        .when(name.startswith("#"), F.substr(name, F.lit(2))).cast("int")
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    numeric = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    named = F.create_map(*[F.lit(x) for n, c in name2codepoint.items() for x in (n, chr(c))],
                         F.lit("apos"), F.lit("'"))
    char = F.coalesce(numeric, F.element_at(named, name), F.concat(F.lit("&"), name, F.lit(";")))
    return F.when(char == "\u00a0", " ").otherwise(char)


def decode_entities(text: Column | str) -> Column:
    """Named and numeric entities, each decoded once (``&amp;lt;`` gives the
    text ``&lt;``)."""
    def joined(cut: Column) -> Column:
        return F.array_join(F.transform(
            cut["pieces"], lambda p, i: F.concat(p, F.coalesce(F.get(cut["chars"], i), F.lit("")))), "")

    text = _c(text)
    cut = F.struct(F.split(text, _ENTITY_RE, -1).alias("pieces"), F.transform(
        F.regexp_extract_all(text, F.lit(_ENTITY_RE), 1), _entity).alias("chars"))
    return F.when(F.contains(text, F.lit("&")), F.transform(F.array(cut), joined)[0]).otherwise(text)


def html_to_text(html: Column | str) -> Column:
    """Visible text, pieces separated by one space, trimmed."""
    out = F.regexp_replace(_c(html), _COMMENT_RE, " ")
    for tag in ("script", "style"):
        out = F.regexp_replace(out, rf"(?is)<{tag}\b{_REST}.*?(?:</{tag}\s*>|\z)", " ")
    out = F.regexp_replace(out, _TAG_RE, " ")
    out = decode_entities(out)
    out = F.regexp_replace(out, r"(?U)\s+", " ")
    return F.trim(out)


def word_count(text: Column | str) -> Column:
    """Number of whitespace-separated words."""
    return F.size(F.filter(F.split(_c(text), r"(?U)\s+"), lambda w: w != "")).cast("int")


def plain_word_count(text: Column | str) -> Column:
    """:func:`word_count` of a text of :func:`html_to_text` (in any case), whose
    words are one space apart."""
    t = _c(text)
    return F.when(t == "", 0).when(t.isNotNull(), F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1) \
        .otherwise(F.size(F.lit(None).cast("array<string>"))).cast("int")


def hide_raw(html: Column | str) -> Column:
    """The text with each comment and each raw-text element as one character."""
    text = _c(html)
    out = F.regexp_replace(text, rf"(?s)<!--.*?(?:-->|\z)|{COMMENT_MARK}", COMMENT_MARK)
    out = F.regexp_replace(out, rf"(?is){_RAW_RE}|{RAW_MARK}", RAW_MARK)
    return F.when(text.rlike(_MAY_HIDE_RE), out).otherwise(text)


def hidden_parts(html: Column | str) -> Column:
    """What :func:`hide_raw` hid, in order."""
    return F.when(_c(html).rlike(_MAY_HIDE_RE), F.regexp_extract_all(_c(html), F.lit(_HIDDEN_RE), 0)).otherwise(
        F.array().cast("array<string>"))


def show_raw(text: Column, parts: Column) -> Column:
    """Put hidden parts back; ``text`` has the marks of the first parts."""
    pieces = F.split(text, f"[{COMMENT_MARK}{RAW_MARK}]", -1)
    return F.when(F.size(parts) == 0, text).otherwise(F.transform(F.array(F.struct(
        pieces.alias("p"), parts.alias("h"))), lambda s: F.array_join(F.transform(
            s["p"], lambda p, i: F.when(i < F.size(s["p"]) - 1, F.concat(p, F.get(s["h"], i))).otherwise(p)), ""))[0])


def _tokens(hidden: Column) -> Column:
    """Tags of a text without raw parts, ``array<struct<kind, name, before,
    length>>``: kind 0 other, 1 opening, 2 closing, 3 a heading element as a
    whole, 4 an element without children; ``before`` is the length of the text
    that precedes the token."""
    def token(t: Column, piece: Column) -> Column:
        name = F.lower(F.regexp_extract(t, r"^</?([a-zA-Z][a-zA-Z0-9:-]*)", 1))
        kind = (F.when(t == RAW_MARK, 4).when(name == "", 0).when(t.rlike(r"(?is)^<h[1-6]\b.*</h[1-6]\s*>$"), 3)
                .when(t.startswith("</"), 2).when(name.isin(*VOID_TAGS), 4).otherwise(1))
        return F.struct(kind.alias("kind"), name.alias("name"), F.length(piece).alias("before"), F.length(t).alias("length"))

    cut = F.struct(F.regexp_extract_all(hidden, F.lit(_TOKEN_RE), 0).alias("t"), F.split(hidden, _TOKEN_RE, -1).alias("p"))
    return F.transform(F.array(cut), lambda c: F.transform(c["t"], lambda t, i: token(t, F.get(c["p"], i))))[0]


def _left_open(names: Column, t: Column) -> Column:
    """How many of the open elements a token leaves open: a closing tag ends its
    element and all inside it (a stray one ends nothing); a block ends an open
    paragraph, a list item an open item."""
    top = F.get(names, F.size(names) - 1)
    at = F.array_position(F.reverse(names), t["name"])
    implied = F.coalesce(((top == "p") & t["name"].isin(*BLOCK_TAGS)) | ((top == t["name"]) & t["name"].isin(*REPEATED_TAGS)),
                         F.lit(False))
    return (F.when((t["kind"] == 2) & (at > 0), F.size(names) - at)
            .when(t["kind"].isin(1, 3, 4) & implied, F.size(names) - 1).otherwise(F.size(names))).cast("int")


def _opened(s: Column, t: Column, keep: Column) -> tuple[Column, Column]:
    """Names and ids (token numbers, from 1) of the elements open after ``t``."""
    names, ids = F.slice(s["names"], 1, keep), F.slice(s["ids"], 1, keep)
    return (F.when(t["kind"] == 1, F.array_append(names, t["name"])).otherwise(names),
            F.when(t["kind"] == 1, F.array_append(ids, s["i"])).otherwise(ids))


def heading_containers(hidden: Column) -> Column:
    """Per heading, in document order, the element that holds it:
    ``array<struct<id, path>>`` with the token number of that element (0: none)
    and the names of the open elements.  One fold over the tags; its state is
    the stack of open elements, and it grows by a place at each heading."""
    none = F.array().cast("array<int>")
    start = F.struct(F.array().cast("array<string>").alias("names"), none.alias("ids"), F.lit(1).alias("i"),
                     F.array().cast("array<struct<id:int,path:string>>").alias("out"))

    def step(s: Column, t: Column) -> Column:
        keep = _left_open(s["names"], t)
        names, ids = _opened(s, t, keep)
        here = F.struct(F.coalesce(F.get(s["ids"], keep - 1), F.lit(0)).alias("id"),
                        F.array_join(F.slice(s["names"], 1, keep), "/").alias("path"))
        return F.struct(names.alias("names"), ids.alias("ids"), (s["i"] + 1).alias("i"),
                        F.when(t["kind"] == 3, F.array_append(s["out"], here)).otherwise(s["out"]).alias("out"))

    return F.aggregate(_tokens(hidden), start, step, lambda s: s["out"])


def section_end(hidden: Column, heading: Column, container: Column) -> Column:
    """Characters up to the end of the last element beside heading number
    ``heading`` (from 1) in its container, an id of :func:`heading_containers`:
    where a section ends that no further heading ends."""
    none = F.array().cast("array<int>")
    start = F.struct(F.array().cast("array<string>").alias("names"), none.alias("ids"), F.lit(1).alias("i"),
                     F.lit(0).alias("pos"), F.lit(0).alias("n"), F.lit(0).alias("last"), F.lit(False).alias("over"))

    def step(s: Column, t: Column) -> Column:
        keep = _left_open(s["names"], t)
        names, ids = _opened(s, t, keep)
        begin = s["pos"] + t["before"]
        end = begin + t["length"]
        n = s["n"] + F.when(t["kind"] == 3, 1).otherwise(0)
        inside = (container == 0) | F.array_contains(F.slice(s["ids"], 1, keep), container)
        beside = F.coalesce(F.get(s["ids"], F.size(s["ids"]) - 1), F.lit(0)) == container  # no child is open before it
        # a child ends here: closed by its tag, a heading or a void element as a whole, or because another begins
        child = F.coalesce(F.get(s["ids"], keep - 1), F.lit(0)) == container
        ended = F.when(child & t["kind"].isin(2, 3, 4) & ((t["kind"] != 2) | (keep < F.size(s["ids"]))), end) \
            .when(child & (t["kind"] == 1) & (keep < F.size(s["ids"])), begin)
        live = ~s["over"] & (n >= heading)
        last = F.when(live & inside, F.coalesce(ended, s["last"])).when(live & ~inside & ~beside, begin).otherwise(s["last"])
        return F.struct(names.alias("names"), ids.alias("ids"), (s["i"] + 1).alias("i"), end.alias("pos"), n.alias("n"),
                        last.alias("last"), (s["over"] | (live & ~inside)).alias("over"))

    def finish(s: Column) -> Column:
        open_child = ~s["over"] & (F.coalesce(F.get(s["ids"], F.size(s["ids"]) - 1), F.lit(0)) != container)
        return F.when(open_child, F.length(hidden)).otherwise(s["last"])

    return F.aggregate(_tokens(hidden), start, step, finish)


def heading_inner_text(inner: Column | str, sep: str = "") -> Column:
    """Text of a heading's inner HTML.  Each text piece is trimmed and the
    pieces are joined with ``sep`` -- by default nothing, so
    ``Foo <b>bar</b>`` gives ``Foobar``."""
    text = _c(inner)
    out = F.regexp_replace(text, _COMMENT_RE + f"|[{COMMENT_MARK}{RAW_MARK}]", "")
    out = F.regexp_replace(out, rf"(?s)\s*<[/!?a-zA-Z]{_REST}\s*", sep)
    return F.when(text.rlike(f"[<&{COMMENT_MARK}{RAW_MARK}]"), F.trim(decode_entities(out))).otherwise(F.trim(text))


def heading_levels(html: Column | str, hidden: bool = False) -> Column:
    """Levels of all headings in document order, ``array<int>``; what looks like
    one in a comment or a script is none (``hidden``: the text comes from
    :func:`hide_raw`)."""
    return F.transform(F.regexp_extract_all(_c(html) if hidden else hide_raw(html), F.lit(HEADING_RE), 1),
                       lambda x: x.cast("int"))


def heading_texts(html: Column | str, sep: str = "", hidden: bool = False) -> Column:
    """Texts of all headings in document order, ``array<string>``."""
    return F.transform(F.regexp_extract_all(_c(html) if hidden else hide_raw(html), F.lit(HEADING_RE), 3),
                       lambda x: heading_inner_text(x, sep))


def tag_texts(html: Column | str, tag: str, sep: str = "", hidden: bool = False) -> Column:
    """Texts of every ``<tag>`` element (e.g. ``h2``) in document order."""
    pat = rf"(?is)<{tag}\b{_REST}(.*?)</{tag}\s*>"
    return F.transform(F.regexp_extract_all(_c(html) if hidden else hide_raw(html), F.lit(pat), 1),
                       lambda x: heading_inner_text(x, sep))


def escape_text(text: Column | str) -> Column:
    """Escape ``&``, ``<`` and ``>`` (``&`` first)."""
    out = F.replace(_c(text), F.lit("&"), F.lit("&amp;"))
    out = F.replace(out, F.lit("<"), F.lit("&lt;"))
    return F.replace(out, F.lit(">"), F.lit("&gt;"))
