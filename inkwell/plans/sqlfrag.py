"""DuckDB expression fragments used by the oracle strings."""

from __future__ import annotations

INT_RE = r"[+-]?[0-9]+"
FLOAT_RE = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def parse_int(x: str) -> str:
    s = strip(x)
    return (f"(CASE WHEN regexp_full_match(coalesce({s}, ''), '{INT_RE}') "
            f"THEN CAST({s} AS BIGINT) ELSE CAST(0 AS BIGINT) END)")


def parse_float(x: str) -> str:
    s = strip(x)
    return (f"(CASE WHEN regexp_full_match(coalesce({s}, ''), '{FLOAT_RE}') "
            f"THEN CAST({s} AS DOUBLE) ELSE 0.0 END)")


def lines(x: str) -> str:
    return (f"list_filter(regexp_split_to_array({x}, '\\r\\n|\\n|\\r'), "
            f"lambda l: NOT regexp_full_match(l, '\\s*'))")


# --- HTML: written for RE2 and lists, with its own tag and entity lists ---
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "),
             ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))


def decode_entities(x: str) -> str:
    out = x
    for ent, ch in _ENTITIES:
        out = f"replace({out}, '{ent}', '{ch.replace(chr(39), chr(39) * 2)}')"
    return out


def strip_boilerplate(x: str) -> str:
    """Pieces between boilerplate tags whose count of open elements is 0: the
    prefix sum of +1/-1, reflected at 0."""
    tag = "(?is)</?(?:nav|footer|aside|header)\\b[^>]*>"
    steps = f"list_transform(regexp_extract_all({x}, '{tag}'), lambda t: CASE WHEN starts_with(t, '</') THEN -1 ELSE 1 END)"
    return (f"list_aggregate(list_transform(range(1, len(regexp_extract_all({x}, '{tag}')) + 2), lambda i: "
            f"CASE WHEN coalesce(list_sum(({steps})[1:i - 1]), 0) - least(0, coalesce(list_min(list_transform(range(1, i), "
            f"lambda j: list_sum(({steps})[1:j]))), 0)) = 0 THEN regexp_split_to_array({x}, '{tag}')[i] ELSE '' END), "
            f"'string_agg', '')")


def html_to_text(x: str) -> str:
    out = f"regexp_replace({x}, '(?s)<!--.*?-->', ' ', 'g')"
    for tag in ("script", "style"):
        out = f"regexp_replace({out}, '(?is)<{tag}\\b[^>]*>.*?</{tag}\\s*>', ' ', 'g')"
    out = f"regexp_replace({out}, '(?s)<[^>]*>', ' ', 'g')"
    out = decode_entities(out)
    out = f"regexp_replace({out}, '\\s+', ' ', 'g')"
    return f"trim({out})"


def word_count(x: str) -> str:
    return f"CAST(len(list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> '')) AS INTEGER)"


def inner_text(x: str) -> str:
    out = f"regexp_replace({x}, '(?s)<!--.*?-->', '', 'g')"
    out = f"regexp_replace({out}, '(?s)\\s*<[^>]*>\\s*', '', 'g')"
    return f"trim({decode_entities(out)})"


def tag_texts(x: str, tag: str) -> str:
    return (f"list_transform(regexp_extract_all({x}, '(?is)<{tag}\\b[^>]*>(.*?)</{tag}\\s*>', 1), "
            f"lambda t: {inner_text('t')})")
