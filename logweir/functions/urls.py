"""URL normalisation and wildcard block lists."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default block list. `*` stands for any text, every other
# character for itself.
DEFAULT_BLOCKED_URLS: tuple[str, ...] = (
    # images
    "*.png", "*.png?*", "*.jpg", "*.jpg?*", "*.jpeg", "*.jpeg?*",
    "*.gif", "*.gif?*", "*.webp", "*.webp?*",
    # videos
    "*.mp4", "*.mp4?*", "*.webm", "*.webm?*",
    # styles, icons, fonts
    "*.css", "*.css?*", "*.svg", "*.svg?*", "*.ico", "*.ico?*",
    "*.woff", "*.woff?*", "*.woff2", "*.woff2?*",
    # analytics and tracking
    "https://www.google.com/xjs/_/js/*",
    "https://www.gstatic.com/og/_/js/*",
    "https://www.google.com/gen_204*",
    "https://www.googleadservices.com/",
    "https://www.googletagmanager.com",
    "https://www.google-analytics.com",
    "*/gtm.js?*",
    # third-party services
    "https://www.youtube.com",
    "https://maps.googleapis.com",
    "https://cdn.shopify.com",
    "https://*.cloudfront.net/*.js",
    "https://static.cloudflareinsights.com",
    "https://connect.facebook.net/*",
    "https://www.facebook.com",
    "https://static.zdassets.com",
    "https://d.oracleinfinity.io",
    "https://bat.bing.com/",
    "https://i8.amplience.net/i/jpl/*",
    "https://*.monetate.net",
    "https://*.criteo.com/*",
    "https://analytics.tiktok.com",
    "https://assets.gorgias.chat",
    "https://sdk.postscript.io",
    "https://script.hotjar.com",
    "https://cdn.judge.me",
    "https://cdn.jsdelivr.net",
    "https://consent.cookiebot.co",
    "https://static.klaviyo.com",
    "https://www.clarity.ms",
    # scripts among static files
    "*/static/*.js",
)

# Schemes whose address part starts with `//`, and schemes whose
# last path segment may carry `;parameters`, as in Python's `urllib.parse`.
_WITH_HOST = (
    "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms", "https",
    "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu", "rsync", "svn", "svn+ssh",
    "sftp", "nfs", "git", "git+ssh", "ws", "wss", "itms-services",
)
_WITH_PARAMETERS = (
    "", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp", "rtsps",
    "rtspu", "sip", "sips", "mms", "sftp", "tel",
)

_SCHEME = r"(?:[A-Za-z][A-Za-z0-9+.\-]*:)"
_HOST = r"(?://[^/?#]*+)"
_HOST_SCHEME = f"(?i:{'|'.join(map(re.escape, _WITH_HOST))})"
# Start of a URL that may carry parameters: a scheme of the list, or none.
_PARAMETER_START = (
    f"(?:(?i:{'|'.join(map(re.escape, filter(None, _WITH_PARAMETERS)))}):|(?!{_SCHEME})){_HOST}?+"
)

# Each step is one pass over the text: (what, pattern, replacement).
_STEPS = (
    ("blanks in front, tabs, line breaks", r"^[\x00-\x20]+|[\t\r\n]", ""),
    ("bare # at the end", r"(?s)^([^#]*)#\z", "$1"),
    ("bare ?", r"(?s)^([^?#]*)\?(#.*)?\z", "$1$2"),
    (
        "bare ; at the end of the path",
        rf"(?s)^({_PARAMETER_START}(?:[^?#]*/)?[^/;?#]*);([?#].*)?\z",
        "$1$2",
    ),
    ("no path", rf"(?s)^({_SCHEME}?{_HOST}?+)([?#].*)?\z", "$1/$2"),
    ("parameters, no path", rf"(?s)^({_PARAMETER_START})(;[^/?#]*(?:[?#].*)?)\z", "$1/$2"),
    ("// of a scheme with hosts", rf"(?s)^({_HOST_SCHEME}:)(/(?!/).*)\z", "$1//$2"),
    (
        "// without a host elsewhere",
        rf"(?s)^((?!{_HOST_SCHEME}:){_SCHEME}?)//(/(?!/).*)\z",
        "$1$2",
    ),
)


def _like(pattern: str) -> str:
    for special in ("\\", "%", "_"):
        pattern = pattern.replace(special, "\\" + special)
    return pattern.replace("*", "%")


def is_blocked(
    url: Column, patterns: Iterable[str] = DEFAULT_BLOCKED_URLS, match: str = "part"
) -> Column:
    """Does any wildcard pattern fit the URL? False for a null URL.

    ``match="part"`` finds the pattern anywhere in the URL, ``match="whole"``
    compares with the whole URL. Each pattern becomes a LIKE, which Catalyst turns
    into a prefix, suffix or substring test where it can, so this is one map
    step with neither join nor regex.
    """
    if match not in ("whole", "part"):
        raise ValueError(f"match must be whole or part, not {match!r}")
    around = "%" if match == "part" else ""
    tests = [url.like(around + _like(pattern) + around) for pattern in patterns]
    if not tests:
        return F.lit(False)
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def normalize_url(url: Column) -> Column:
    """Give a URL without a path the path `/`; null or empty gives null.

    Other parts stay as they are, but for what any parse and rebuild changes:
    the scheme in lower case, no bare `;`, `?` or `#` at the end of a part,
    no blanks in front and no tabs or line breaks.
    """
    text = url
    for _, pattern, replacement in _STEPS:
        text = F.regexp_replace(text, pattern, replacement)
    scheme = F.regexp_extract(text, f"^{_SCHEME}", 0)
    rebuilt = F.concat(F.lower(scheme), F.substr(text, F.length(scheme) + 1))
    return F.when(F.length(url) > 0, rebuilt)
