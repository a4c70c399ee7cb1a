"""Text helpers: Unicode trim, blank-to-null, control-character cleaning, url domain,
script payload extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode White_Space: ASCII blanks, NEL and every separator (Z*) code point, so that
# U+00A0 in "12,00<nbsp>€" is trimmed like a space. The same class is valid in Java
# regex and in RE2, which keeps the SQL oracle on identical rules.
WHITESPACE_CLASS = r"[\t\n\x0B\f\r \x{85}\p{Z}]"
_EDGE_WS = rf"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The same set as WHITESPACE_CLASS, listed: ASCII blanks, NEL, and the Unicode
# separators (Zs, Zl, Zp).
WHITESPACE_CHARS = ("\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
                    + "\u2028\u2029\u202f\u205f\u3000")


def unicode_trim(c) -> Column:
    """TRIM with Unicode whitespace (Spark's ``trim`` strips the ASCII space only).
    A character-set trim from both ends: no regex, one scan per side."""
    return F.btrim(_col(c), F.lit(WHITESPACE_CHARS))


def nullif_blank(c) -> Column:
    """NULLIF(TRIM(x), '')."""
    return F.nullif(unicode_trim(c), F.lit(""))


# Characters below U+0020 other than CR and LF (those become spaces instead).
_CONTROL_CHARS = "".join(chr(c) for c in range(32) if c not in (10, 13))


def clean_string(c) -> Column:
    """Newline and CR become a space, other characters below U+0020 are dropped, then
    the result is trimmed. Null stays null. Character mapping (``translate``) in one scan,
    so whole documents stay cheap, and only for texts that hold such a character: most
    fields of a record do not."""
    s = _col(c)
    return unicode_trim(F.when(s.rlike(r"[\x00-\x1F]"), F.translate(s, "\r\n" + _CONTROL_CHARS, "  ")).otherwise(s))


# Fixed value: the shop-domain pattern of the event model (scheme, optional www., host).
URL_DOMAIN_PATTERN = r"https?://(?:www\.)?([^/]+)"


def url_domain(c) -> Column:
    """REGEXP_EXTRACT(url, 'https?://(?:www\\.)?([^/]+)'); no match gives null."""
    return F.nullif(F.regexp_extract(_col(c), URL_DOMAIN_PATTERN, 1), F.lit(""))


# Fixed value: product data sits in a page script as ``var react_data = {...};``.
# Lazy and dot-all: the match ends at the first "};".
SCRIPT_PAYLOAD_PATTERN = r"(?s)var\s+react_data\s*=\s*(\{.*?\});"


def extract_script_payload(html, pattern: str = SCRIPT_PAYLOAD_PATTERN, group: int = 1) -> Column:
    """Text of the first match of ``pattern`` in the page, or null when absent."""
    return F.nullif(F.regexp_extract(_col(html), pattern, group), F.lit(""))
