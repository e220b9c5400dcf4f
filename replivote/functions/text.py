"""Text normalisation as Spark columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Python's str.strip and \s treat as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same characters as a class without ``(?U)``, which would ask for the type of every character of a text.
_UNEVEN = r"\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACES = rf"[ {_UNEVEN}]++"
# Runs that are not one plain blank already, so ordinary text needs no replacing.
_UNEVEN_SPACES = rf"[{_UNEVEN}][ {_UNEVEN}]*+| [ {_UNEVEN}]++"
# Characters among which are all those of _UNEVEN. Few texts have any; single letters and one range are quickly looked for.
_PERHAPS_UNEVEN = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680-\u3000]"
# From the first to the last letter or digit; only the two ends are looked at closely.
_CORE = r"(?s)^[^\p{L}\p{N}]*+(.*[\p{L}\p{N}])"
# What stands before the first and behind the last of them, for the ends of a longer text.
_ALNUM, _BEFORE, _BEHIND = r"[\p{L}\p{N}]", r"(?s)^([^\p{L}\p{N}]*+)", r"(?s)^.*[\p{L}\p{N}](.*)$"
_END = 64  # bytes of an end; a letter cut in two there reads as U+FFFD, which is neither a letter nor white space
_SPOKEN = rf"[^ {_UNEVEN}\ufffd]"
# Between two parts of a list: a run without letters and digits that holds a comma or semicolon, looked for at its start only.
_BETWEEN = r"(?<![^\p{L}\p{N}])[^\p{L}\p{N},;]*+[,;][^\p{L}\p{N}]*+"
# The same where every such run begins with its comma or semicolon, which is quickly looked for; and what tells that one does not.
_BETWEEN_EVEN = r"[,;][^\p{L}\p{N}]*+"
_LATE_COMMA = r"[,;](?<=[^\p{L}\p{N},;][,;])"


def strip(text: Column) -> Column:
    """Trim Unicode white space from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def is_blank(text: Column) -> Column:
    """True for null and for white-space-only text; where the start says that it is not, the rest is not read."""
    start = F.substring(text.cast("binary"), 1, _END).cast("string")
    return text.isNull() | F.when(F.rlike(start, F.lit(_SPOKEN)), False).otherwise(strip(text) == "")


def clean_response(text: Column) -> Column:
    """Trim, then turn every CR and every LF into one space each."""
    return F.translate(strip(text), "\r\n", "  ")


def _collapse(text: Column) -> Column:
    """Turn every run of white space into one blank."""
    uneven = F.contains(text, F.lit("  ")) | F.rlike(text, F.lit(_PERHAPS_UNEVEN))
    return F.when(uneven, F.regexp_replace(text, _UNEVEN_SPACES, " ")).otherwise(text)


def _core(text: Column) -> Column:
    """From the first to the last letter or digit, empty without any; of a long text that has them near its ends, cut as bytes."""
    raw, size = text.cast("binary"), F.octet_length(text)
    start, end = (F.substring(raw, at, _END).cast("string") for at in (1, -_END))
    near = (size > 4 * _END) & F.rlike(start, F.lit(_ALNUM)) & F.rlike(end, F.lit(_ALNUM))
    before, behind = (F.octet_length(F.regexp_extract(x, p, 1)) for x, p in ((start, _BEFORE), (end, _BEHIND)))
    inner = F.substring(raw, before + 1, size - before - behind).cast("string")
    return F.when(near, inner).otherwise(F.regexp_extract(text, _CORE, 1))


def _bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value worked out once, however often it is named."""
    return F.transform(F.array(value), then)[0]


def normalize(text: Column) -> Column:
    """Lower-case, drop outer non-alphanumerics, collapse inner white space."""
    # the ends go first: white space there would send the whole text through the replacing
    return _bound(_bound(F.lower(text), _core), _collapse)


def normalize_light(text: Column) -> Column:
    """Lower-case, trim, collapse inner white space; punctuation stays."""
    return F.lower(strip(_collapse(text)))


def split_set(text: Column) -> Column:
    """Distinct normalised parts of a comma or semicolon list, in first-seen order."""
    # the whole list is normalised at once: neither white space nor the form of a letter reaches beyond its part

    def parts(whole: Column) -> Column:
        return F.when(F.rlike(whole, F.lit(_LATE_COMMA)), F.split(whole, _BETWEEN)).otherwise(F.split(whole, _BETWEEN_EVEN))

    bound = F.transform(F.array(normalize(text)), parts)[0]
    return F.array_distinct(F.filter(bound, lambda p: p != ""))


def tokenize(text: Column) -> Column:
    """Lower-cased words; white space at an end yields an empty word there."""
    return F.split(F.lower(text), _SPACES)
