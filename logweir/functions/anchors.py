"""Links in the source of pages: anchors, character references, relative addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Named references that addresses need.
_NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " "}

# What holds no anchors although it may look so.
_NO_MARKUP = r"(?is)<!--.*?-->|<(script|style|template|textarea)\b.*?</\1\s*>"
# A tag ends at the first `>` that is not within quotes.
_REST = r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>"""
_ANCHOR = rf"(?is)<a\s{_REST}"
_BASE = rf"(?is)<base\s{_REST}"
# The first `href`, but not within the value of another attribute.
_HREF = r"""(?is)^<\w+(?:\s*+(?!href\s*=)[^\s=>]++(?:\s*=\s*(?:"[^"]*+"|'[^']*+'|[^\s>"']++))?)*+\s*+href\s*=\s*(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++))"""

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
_REFERENCE = r"&#[xX][0-9a-fA-F]{1,6};?|&#[0-9]{1,7};?|&[A-Za-z]+;|[^&]+|&"


def _character(number: Column) -> Column:
    """The character of a code point; what is none stands for nothing."""
    legal = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    return F.when(legal, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise(F.lit("�"))


def decoded(text: Column) -> Column:
    """Text with its character references decoded; names that are not known stay."""

    def piece(part: Column) -> Column:
        digits = F.regexp_extract(part, r"^&#[xX]?([0-9a-fA-F]+)", 1)
        base = F.when(part.rlike("^&#[xX]"), 16).otherwise(10)
        number = F.when(base == 16, F.conv(digits, 16, 10)).otherwise(digits).cast("bigint")
        named = [F.when(part == f"&{name};", F.lit(value)) for name, value in _NAMED.items()]
        return F.when(part.rlike("^&#"), _character(number)).otherwise(F.coalesce(*named, part))

    pieces = F.regexp_extract_all(text, F.lit(_REFERENCE), 0)
    return F.when(text.contains("&"), F.array_join(F.transform(pieces, piece), "")).otherwise(text)


def markup(html: Column) -> Column:
    """Source of a page without comments, scripts and the like."""
    return F.regexp_replace(html, _NO_MARKUP, " ")


def _href(tag: Column) -> Column:
    """`href` of a tag as it stands there, null if it has none."""
    # One search: the three ways to write a value are three groups, and a mark tells `""` from no match.
    found = F.regexp_replace(tag, rf"{_HREF}.*", "=$1$2$3")
    return F.when(found.startswith("="), F.substr(found, F.lit(2)))


def _clean(href: Column) -> Column:
    return F.trim(decoded(href), F.lit(" \t\r\n\f"))


def hrefs(source: Column) -> Column:
    """Addresses of the anchors in a page's :func:`markup`, in their order."""
    found = F.transform(F.regexp_extract_all(source, F.lit(_ANCHOR), 0), _href)
    return F.transform(F.filter(found, lambda x: x.isNotNull()), _clean)


def base_href(source: Column) -> Column:
    """Address in the `base` tag in a page's :func:`markup`, null without one."""
    tags = F.regexp_extract_all(source, F.lit(_BASE), 0)
    return F.get(F.transform(F.transform(F.slice(tags, 1, 1), _href), _clean), F.lit(0))


def _without_dots(path: Column) -> Column:
    """A path that begins with `/` without `.` and `..`."""
    parts = F.split(path, "/")

    def step(done: Column, part: Column) -> Column:
        shorter = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))
        return F.when(part == "..", shorter).when(part == ".", done).otherwise(F.concat(done, F.array(part)))

    rest = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    kept = F.aggregate(rest, F.array(F.lit("")), step)
    last = F.element_at(parts, -1)
    ended = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    joined = F.array_join(ended, "/")
    return F.when(joined == "", F.lit("/")).otherwise(joined)


def absolute(link: Column, base: Column) -> Column:
    """A link in full, by the address of the page it stands on (RFC 3986, section 5)."""
    scheme = F.regexp_extract(base, _SCHEME, 0)
    site = F.regexp_extract(base, rf"{_SCHEME}(?://[^/?#]*)?", 0)
    rest = F.substr(base, F.length(site) + 1)
    path = F.regexp_extract(rest, r"^[^?#]*", 0)
    query = F.regexp_extract(rest, r"^[^?#]*(\?[^#]*)?", 1)
    own = F.regexp_extract(link, r"^[^?#]*", 0)
    tail = F.substr(link, F.length(own) + 1)
    folder = F.concat(F.lit("/"), F.regexp_extract(path, r"^/?(.*/)?[^/]*$", 1))
    return (
        F.when(link.rlike(_SCHEME), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when((own == "") & link.startswith("?"), F.concat(site, path, tail))
        .when(own == "", F.concat(site, path, query, tail))
        .when(link.startswith("/"), F.concat(site, _without_dots(own), tail))
        .otherwise(F.concat(site, _without_dots(F.concat(folder, own)), tail))
    )
