"""Text column expressions (JVM regex, no Python UDFs).

Whitespace follows Python's ``str.isspace`` set, spelled out so that the Java
regex engine and an RE2 oracle agree (RE2's ``\\s`` is ASCII-only).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from workpulse.params import NUDGE_DEFAULT_FIRST_NAME, REMINDER_DEFAULT_FIRST_NAME, UNASSIGNED

# Python str.isspace() characters as one regex class.
WS = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NON_WS = WS.replace("[", "[^", 1)
# The same characters, to trim by.
WS_CHARS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

# Entity decoding order and the image pattern.
HTML_ENTITIES = (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"))
IMG_SRC_PATTERN = r"""(?i)<img[^>]+src=["']([^"']+)["']"""
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``: remove leading/trailing Python whitespace."""
    return F.btrim(_c(c).cast("string"), F.lit(WS_CHARS))


def strip_html(c) -> Column:
    """HTML comment body to plain text (X1). NULL/empty -> ''.

    A text without tags, entities, breaks, tabs and runs of spaces only loses its ends, as every other step leaves it.
    """
    text = F.coalesce(_c(c), F.lit(""))
    marked = text.contains("<") | text.contains("&") | text.contains("\n") | text.contains("\t") | text.contains("  ")
    return F.when(marked, _strip_marked(text)).otherwise(py_strip(text))


def _strip_marked(t: Column) -> Column:
    t = F.regexp_replace(t, rf"(?i)</(div|p|li|br){WS}*>", "\n")
    t = F.regexp_replace(t, rf"(?i)<br{WS}*/?>", "\n")
    t = F.regexp_replace(t, r"<[^>]+>", "")
    for src, dst in HTML_ENTITIES:
        t = F.replace(t, F.lit(src), F.lit(dst))
    t = F.regexp_replace(t, r"[ \t]+", " ")
    t = F.regexp_replace(t, rf"\n{WS}*\n+", "\n")
    return py_strip(t)


def image_urls(c) -> Column:
    """``src`` of every ``<img>`` tag, in document order (X2). NULL -> []."""
    text = F.coalesce(_c(c), F.lit(""))
    return F.when(text.contains("<"), F.regexp_extract_all(text, F.lit(IMG_SRC_PATTERN), 1)).otherwise(F.array().cast("array<string>"))


def clean_text(c) -> Column:
    """strip + lower."""
    return F.lower(py_strip(c))


def tokens(c) -> Column:
    """Vectoriser default tokens: lower-case runs of >= 2 word characters."""
    return F.regexp_extract_all(F.lower(F.coalesce(_c(c), F.lit(""))), F.lit(TOKEN_PATTERN), 0)


def is_blank(c) -> Column:
    """NULL, empty or whitespace only."""
    return F.coalesce(py_strip(c) == F.lit(""), F.lit(True))


def nullif_empty(c) -> Column:
    """'' -> NULL."""
    return F.nullif(_c(c), F.lit(""))


def pipe_join(arr) -> Column:
    """Pipe-join an array; empty result -> NULL."""
    return F.nullif(F.array_join(_c(arr), "|"), F.lit(""))


_ASSIGNEE_SCHEMA = "displayName string, uniqueName string"


def parse_assignee(raw) -> Column:
    """Landed assignee (NULL, JSON object text or plain name) -> struct(display_name, email)."""
    r = _c(raw)
    trimmed = py_strip(r)
    obj = F.from_json(r, _ASSIGNEE_SCHEMA)
    is_obj = trimmed.startswith("{") & trimmed.endswith("}")
    empty_obj = trimmed.rlike(rf"\A\{{{WS}*\}}\z")
    falsy = r.isNull() | (r == F.lit("")) | (is_obj & empty_obj)
    return (
        F.when(falsy, F.struct(F.lit(UNASSIGNED).alias("display_name"), F.lit("").alias("email")))
        .when(is_obj, F.struct(F.coalesce(obj["displayName"], F.lit("")).alias("display_name"),
                               F.coalesce(obj["uniqueName"], F.lit("")).alias("email")))
        .otherwise(F.struct(r.alias("display_name"), F.lit("").alias("email")))
    )


def first_token(c) -> Column:
    """First whitespace-separated token, '' when none."""
    return F.regexp_extract(F.coalesce(_c(c), F.lit("")), rf"\A{WS}*({NON_WS}+)", 1)


def nudge_first_name(display_name) -> Column:
    """First token, empty -> 'Developer'."""
    t = first_token(display_name)
    return F.when(t == "", F.lit(NUDGE_DEFAULT_FIRST_NAME)).otherwise(t)


def reminder_first_name(display_name) -> Column:
    """First token, empty or 'Unassigned' -> 'there'."""
    d = _c(display_name)
    t = first_token(d)
    return F.when((t == "") | (F.coalesce(d, F.lit("")) == F.lit(UNASSIGNED)), F.lit(REMINDER_DEFAULT_FIRST_NAME)).otherwise(t)
