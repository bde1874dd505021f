"""Regular expressions shared by the Spark expressions and the DuckDB oracle.

Every pattern here is written so that Java regex (Spark) and RE2 (DuckDB) read
it the same way: no look-around, no back-references, explicit white-space
classes (the two engines disagree on what ``\\s`` holds).
"""

WS = r"[ \t\n\r\f\x0B]"

# Blocks whose content is not page text and holds no links.
SCRIPT_STYLE_COMMENT = r"(?is)<script[^>]*>.*?</script[^>]*>|<style[^>]*>.*?</style[^>]*>|<!--.*?-->"
TAG = r"<[^>]*>"
WS_RUN = WS + "+"
EDGE_WS = "^" + WS + "+|" + WS + "+$"

TITLE = r"(?is)<title[^>]*>(.*?)</title[^>]*>"
META_TAG = r"(?is)<meta[ \t\n\r\f][^>]*>"
# Attribute value: double-quoted, single-quoted or bare.
_VAL = r"""("[^"]*"|'[^']*'|[^ \t\n\r\f"'>]+)"""
QUOTES = r"""^["']|["']$"""


def attr(name: str) -> str:
    """Value of attribute `name` inside one tag's text (group 1, quotes kept)."""
    return r"(?is)[ \t\n\r\f]" + name + r"[ \t\n\r\f]*=[ \t\n\r\f]*" + _VAL


A_LINK_HREF = r"(?is)<(?:a|link)[ \t\n\r\f](?:[^>]*?[ \t\n\r\f])?href[ \t\n\r\f]*=[ \t\n\r\f]*" + _VAL
REF_SRC = (r"(?is)<[a-z][a-z0-9]*[ \t\n\r\f](?:[^>]*?[ \t\n\r\f])?(?:src|background|lowsrc)"
           r"[ \t\n\r\f]*=[ \t\n\r\f]*" + _VAL)
LINK_TAG = r"(?is)<link[ \t\n\r\f][^>]*>"
HEAD = r"(?is)<head(?:[ \t\n\r\f][^>]*)?>(.*?)</head[ \t\n\r\f]*>"
BASE_TAG = r"(?is)<base[ \t\n\r\f][^>]*>"

# Analyzer: maximal runs of letters and digits (applied to lower-cased text).
TOKEN = r"[\p{L}\p{N}]+"

# URL anatomy. An absolute URL is scheme "://" authority rest.
ABS_URL = r"^[A-Za-z][A-Za-z0-9+.-]*:"
URL_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*)://"
URL_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
URL_USERINFO = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)"
URL_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
URL_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
URL_AFTER_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(.*)$"
URL_PATH_QUERY = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)"
URL_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"
# Well-formed absolute URI: scheme, host, optional port, then characters that
# are allowed unescaped (non-ASCII allowed, as IRIs), '%' only before two hex
# digits. Anything else is malformed and is dropped, never fatal. Two plain
# tests, shape and no bad '%': a repeated group would recurse for each character.
WELL_FORMED_URL = (r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^ \t\n\r\f/?#@<>\"]*@)?[A-Za-z0-9._~-]+(?::[0-9]+)?"
                   r"(?:[/?#][^ \t\n\r\f<>\"{}|\\^`]*)?$")
BAD_PERCENT = r"^[^/?#]*//[^/?#]*[/?#].*%(?:[^0-9A-Fa-f]|$|[0-9A-Fa-f](?:[^0-9A-Fa-f]|$))"

# Numeric character references.
NUM_ENTITY = r"&#[0-9]+;|&#[xX][0-9a-fA-F]+;"

# The named entities decoded in links (see SURVEY B6), in the
# order they are applied; "&amp;" comes last so "&amp;lt;" stays "&lt;".
NAMED_ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&nbsp;", "\u00a0"),
    ("&copy;", "\u00a9"),
    ("&middot;", "\u00b7"),
    ("&amp;", "&"),
]

# Characters escaped by the query syntax escaper.
QUERY_SYNTAX_CHARS = "\\+-!():^[]\"{}~*?|&"

# Fixed value: the default URL exclusion pattern of the sample configuration.
DEFAULT_EXCLUDE = r"(\.jpg|\.css|\.js|\.gif|\.jpeg|\.png|\.ico)"

# A region rule that removes <a ... rel="...nofollow..."> tags and
# one that drops everything after a robots-nofollow meta (sample config).
NOFOLLOW_A_START = r'<a[^><]+?rel="[^"><"]*nofollow[^"><"]*?"'
NOFOLLOW_A_END = ">"
NOFOLLOW_META_START = r'<meta name="robots" content="[^"><"]*nofollow[^"><"]*?"'
NOFOLLOW_META_END = "</html>"

_REGEX_SPECIAL = set("\\.^$*+?{}[]|()")


def quote_literal(s: str) -> str:
    """Escape `s` so it matches literally in Java regex and RE2 alike."""
    return "".join("\\" + c if c in _REGEX_SPECIAL else c for c in s)
