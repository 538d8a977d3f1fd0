"""Text functions as Column expressions; all but the exact entity decoder and URL check stay in the JVM."""

from __future__ import annotations

import html
import string
import unicodedata
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType

#: Entities that the built-in decoder knows, the ampersand last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))
LINK = r"[\[]([^\]]+)[\]][(]([^)]+)[)]"
BARE_URL = r"(?U)https?://\S+"
TRIMMED_TAIL = r"[)\].,;:!?]+$"
#: The rewrites of Markdown, in order: (pattern, replacement).
MARKDOWN = (
    (r"(?s)```.*?```", " "),
    (r"`[^`]+`", " "),
    (r"[!][\[][^\]]*[\]][(][^)]*[)]", " "),
    (r"[\[]([^\]]*)[\]][(][^)]*[)]", "$1"),
    (r"(?mdU)^>+\s?", " "),
    (r"(?mdU)^#{1,6}\s*", " "),
    (r"(?mdU)^(?:\d+[.]\s+|\s*[*+-]\s+)", " "),
)
REDACTIONS = (
    (r"[%+._0-9a-zA-Z-]+@[.0-9a-zA-Z-]+", "[redacted_email]"),
    (r"(?U)\b\d\d\d-\d\d-\d{4}\b", "[redacted_ssn]"),
    (r"(?U)\b\d{10}\b", "[redacted_phone]"),
)


def whitespace(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def strip_ends(c: Column) -> Column:
    """Without white space at the ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def strip_markdown(c: Column) -> Column:
    for pattern, to in MARKDOWN:
        c = F.regexp_replace(c, pattern, to)
    return c


@F.arrow_udf(StringType())
def unescape(texts: pa.Array) -> pa.Array:
    """Every HTML entity decoded, by batches."""
    return pa.array([t if t is None or "&" not in t else html.unescape(t) for t in texts.to_pylist()], pa.string())


def strip_html(c: Column, exact: bool = False) -> Column:
    """Tags as blanks, then entities decoded: the common six in the JVM, or all of them with ``exact``."""
    c = F.regexp_replace(c, "<[^>]+>", " ")
    if exact:
        return unescape(c)
    for entity, char in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


@F.arrow_udf(BooleanType())
def valid_url(urls: pa.Array) -> pa.Array:
    """Whether the standard URL splitter takes it; false for null and ''."""

    def ok(u: str | None) -> bool:
        try:
            return bool(u) and urlsplit(u) is not None
        except ValueError:
            return False

    return pa.array([ok(u) for u in urls.to_pylist()], pa.bool_())


def split_url(c: Column) -> Column:
    """struct<scheme, authority, path, query, fragment>, or null where there is no URL."""
    part = lambda k: F.regexp_extract(c, r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$", k)
    whole = F.struct(*[part(k).alias(n) for k, n in enumerate(("scheme", "authority", "path", "query", "fragment"), 1)])
    square = part(2)
    bad = (F.length(F.regexp_replace(square, r"[^\[]", "")) != F.length(F.regexp_replace(square, r"[^\]]", "")))
    return F.when(c.isNull() | (c == "") | bad, F.lit(None)).otherwise(whole)


def splittable(u: Column) -> Column:
    """Whether a URL can be split: the brackets of its authority match (checked in the JVM; ``valid_url`` is exact)."""
    host = F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    return (u != "") & (F.contains(host, F.lit("[")) == F.contains(host, F.lit("]")))


def urls(c: Column) -> Column:
    """Targets of Markdown links, then bare URLs outside of them; what can't be split is left out."""
    rest = F.regexp_replace(c, LINK, " ")
    found = F.concat(F.regexp_extract_all(c, F.lit(LINK), F.lit(2)), F.regexp_extract_all(rest, F.lit(BARE_URL), F.lit(0)))
    return F.filter(found, splittable)


def without_urls(c: Column) -> Column:
    """Links, with their labels, and bare URLs as blanks."""
    return F.regexp_replace(F.regexp_replace(c, LINK, " "), BARE_URL, " ")


def clean_urls(c: Column) -> Column:
    """URLs of a text in lower case without closing punctuation; empty ones stay only if the trimming made them so."""
    return F.transform(urls(c), lambda u: whitespace(F.regexp_replace(F.lower(u), TRIMMED_TAIL, "")))


def domain(c: Column) -> Column:
    """What stands between // and the path, with port and user; null if the brackets of an address don't match."""
    found = F.regexp_extract(c, r"^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)", 1)
    opened, closed = F.instr(found, "[") > 0, F.instr(found, "]") > 0
    return F.when(opened != closed, F.lit(None)).otherwise(found)


def without_crosspost(c: Column) -> Column:
    return F.regexp_replace(c, r"(?iU)cross\s*(?:posted|post)\s{1,}from\s{1,}r/\w+", " ")


def without_mentions(c: Column) -> Column:
    return F.regexp_replace(c, "/?u/[_0-9a-zA-Z-]+", " ")


def _new_emoji() -> str:
    """Symbols (So) that Python's tables have, as character class; Java's may be older."""
    spans, start = [], None
    for k in range(0x1F000, 0x1FC00):
        so = unicodedata.category(chr(k)) == "So"
        if so and start is None:
            start = k
        if not so and start is not None:
            spans.append(f"\\x{{{start:x}}}-\\x{{{k - 1:x}}}")
            start = None
    return "".join(spans)


def without_emoji(c: Column) -> Column:
    return F.regexp_replace(c, r"[\p{So}" + _new_emoji() + "]", "")


def tokens(c: Column) -> Column:
    """Runs of a-z and 0-9; the text must be in lower case."""
    return F.filter(F.split(c, "[^a-z0-9]+"), lambda t: t != "")


def words(norm: Column) -> Column:
    """The tokens of a normalised text, which has one blank between them."""
    return F.filter(F.split(norm, " "), lambda t: t != "")


def char_grams(c: Column, n: int = 5) -> Column:
    """All n characters in a row, or the whole text if it is shorter; linear in its length."""
    return F.when(F.length(c) < n, F.array(c)).otherwise(F.regexp_extract_all(c, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)))


#: The 37 characters of normalised texts by number; five of them fit 32 bits.
_DIGIT = np.zeros(256, np.int32)
_DIGIT[list((string.ascii_lowercase + string.digits + " ").encode())] = np.arange(37)


def gram_codes(norms: pa.Array) -> Iterator[np.ndarray]:
    """The distinct 5-grams of each normalised text as ascending numbers; the gram of a shorter text has a negative one."""
    for lo in range(0, len(norms), 256):
        texts = norms.slice(lo, 256).to_pylist()
        c = _DIGIT[np.frombuffer("".join(texts).encode("ascii"), np.uint8)]
        g = c[: max(0, len(c) - 4)].copy()
        for k in range(1, 5):
            g *= 37
            g += c[k : len(c) - 4 + k]
        at = 0
        for text in texts:
            n = len(text)
            if n < 5:
                yield np.array([-1 - sum((int(d) + 1) * 38**k for k, d in enumerate(c[at : at + n]))], np.int32)
            else:
                s = np.sort(g[at : at + n - 4])
                yield s[np.r_[True, s[1:] != s[:-1]]]
            at += n


@F.arrow_udf(LongType())
def gram_counts(norms: pa.Array) -> pa.Array:
    """The number of distinct 5-grams of each normalised text."""
    return pa.array([len(g) for g in gram_codes(norms)], pa.int64())


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays as sets; 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def blend(token: Column, char: Column) -> Column:
    return F.lit(0.7) * token + F.lit(0.3) * char


def similarity(a: Column, b: Column) -> Column:
    """0.7 of the token and 0.3 of the 5-gram similarity of two normalised texts."""
    return blend(jaccard(tokens(a), tokens(b)), jaccard(char_grams(a), char_grams(b)))


def normalise(c: Column, exact: bool = False, keep_labels: bool = False) -> Column:
    """The canonical form that duplicates are compared in. With ``keep_labels`` the labels of links stay."""
    c = strip_html(without_mentions(without_crosspost(F.lower(c))), exact)
    if keep_labels:
        c = F.regexp_replace(c, r"(?<!!)" + LINK, "$1")
    c = without_emoji(strip_markdown(without_urls(c)))
    return F.trim(F.regexp_replace(c, "[^a-z0-9]+", " "))


def post_text(title: Column, body: Column) -> Column:
    """Title and body with a blank line between, without white space at the ends; nulls count as empty."""
    return strip_ends(F.concat(F.coalesce(title, F.lit("")), F.lit("\n\n"), F.coalesce(body, F.lit(""))))


def redact(c: Column) -> Column:
    for pattern, to in REDACTIONS:
        c = F.regexp_replace(c, pattern, to)
    return c
