"""Text cleaning and text-list expressions (built-in functions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Characters each board's texts are cleaned of.
CONTROL_CHARS = {
    "marriott": "\t\xa0\n\r",
    "paypal": "\r\n\t\xa0\u202f",
    "quest": "\xa0\n\r",
    "monster_sg": "\n",
    "careerjet": "\n",
    "mckesson": "\n",
}
NBSP = "\xa0"
CRLF = "\r\n"


def char_class(chars: str) -> str:
    """A pattern for runs of the characters."""
    return "[" + "".join(f"\\x{{{ord(c):x}}}" for c in chars) + "]+"


def without_chars(text: Column, chars: str) -> Column:
    """Delete every occurrence of each character, in one pass."""
    return F.regexp_replace(text, char_class(chars), "")


def without_crlf(text: Column) -> Column:
    """Delete CR LF pairs; a lone CR or LF stays."""
    return F.replace(text, F.lit(CRLF), F.lit(""))


def stripped(text: Column) -> Column:
    """Trim all Unicode white space; trim() alone takes only U+0020."""
    return F.btrim(text, F.lit(WHITESPACE))


def clean(text: Column, board: str) -> Column:
    return stripped(without_chars(text, CONTROL_CHARS[board]))


def non_empty(text: Column) -> Column:
    """The trimmed text, null when nothing is left."""
    return F.nullif(stripped(text), F.lit(""))


def sentinel_to_null(text: Column, sentinel: str = "Not Specified") -> Column:
    return F.nullif(text, F.lit(sentinel))


def has_word(text: Column, word: str) -> Column:
    """Case-insensitive keyword test."""
    return F.contains(F.lower(text), F.lit(word))


def integer_after_colon(text: Column) -> Column:
    """`Job Id: 42` to 42; a part that is not a number gives null."""
    return stripped(F.split_part(text, F.lit(":"), F.lit(2))).try_cast("bigint")


def last_count(text: Column) -> Column:
    """The last space-separated token as a number, thousands commas allowed."""
    last = F.split_part(stripped(text), F.lit(" "), F.lit(-1))
    return F.replace(last, F.lit(","), F.lit("")).try_cast("bigint")


def label_title(label: Column) -> Column:
    """Everything before the last space; a label without a space is all title."""
    label = stripped(label)
    return F.when(F.contains(label, F.lit(" ")), F.regexp_extract(label, "(?s)^(.*) [^ ]*$", 1)).otherwise(label)


def label_id(label: Column) -> Column:
    """What follows the last space; null when there is none."""
    label = stripped(label)
    return F.when(F.contains(label, F.lit(" ")), F.nullif(F.split_part(label, F.lit(" "), F.lit(-1)), F.lit("")))


def title_before(title: Column, location: Column) -> Column:
    """Text in front of the location, hyphens removed; the whole title if there is none."""
    head = F.when(location.isNull() | (location == ""), title).otherwise(F.split_part(title, location, F.lit(1)))
    return F.replace(head, F.lit("-"), F.lit(""))


def without_ends(text: Column) -> Column:
    """Drop the first and the last character."""
    return F.substring(text, F.lit(2), F.greatest(F.length(text) - 2, F.lit(0)))


def icon_text(markup: Column) -> Column:
    """Text after the first inline icon of a list item, one span unwrapped."""
    tail = F.split_part(markup, F.lit("</svg>"), F.lit(2))
    text = stripped(F.split_part(tail, F.lit("</li"), F.lit(1)))
    inner = F.split_part(F.split_part(text, F.lit("span>"), F.lit(2)), F.lit("</"), F.lit(1))
    return F.when(F.contains(text, F.lit("<span>")), stripped(inner)).otherwise(text)


def without_tags(text: Column) -> Column:
    """Text that itself holds escaped markup: tags and comments removed."""
    return F.regexp_replace(text, r"(?s)<!--.*?-->|</?[A-Za-z][^<>]*>", "")
