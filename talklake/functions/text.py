"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- fixed values: patterns that decide the results ---------------------------------
# Unicode white space and U+001C..U+001F, as the inside of a character class. Written
# out because the regex dialects disagree on what \s holds.
SPACE = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
TAG = r"<[^>]+>"
NOTE = r"\[[^\]\n]*\]"
URL = r"https?://"
SLUG_LENGTH = 50
# -------------------------------------------------------------------------------------


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+\z", "")


def squeeze(text: Column) -> Column:
    """Runs of whitespace become one blank; none is left at the ends."""
    return F.trim(F.regexp_replace(text, rf"[{SPACE}]+", " "))


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, TAG, "")


def strip_notes(text: Column) -> Column:
    """Remove ``[Music]``-like notes; a note never spans a line break."""
    return F.regexp_replace(text, NOTE, "")


def clean_segment(text: Column) -> Column:
    """One caption segment without tags, notes and outer whitespace."""
    return strip(strip_notes(strip_tags(text)))


def keyword_text(text: Column) -> Column:
    """Lower case, no URLs, letters a-z only, single blanks."""
    no_urls = F.regexp_replace(F.lower(text), rf"{URL}[^{SPACE}]+", "")
    return F.trim(F.regexp_replace(no_urls, "[^a-z]+", " "))


def slug(text: Column) -> Column:
    """Cut to 50 characters after stripping, so a slug may end in ``-``."""
    kept = F.regexp_replace(F.lower(text), rf"[^a-z0-9{SPACE}\-]", "")
    dashed = F.regexp_replace(kept, rf"[{SPACE}\-]+", "-")
    return F.substring(F.regexp_replace(dashed, r"^-|-\z", ""), 1, SLUG_LENGTH)


def is_blank(text: Column) -> Column:
    """Nothing but whitespace."""
    return ~F.regexp_like(text, F.lit(rf"[^{SPACE}]"))


def has_words(text: Column, least: int) -> Column:
    """At least ``least`` whitespace-separated words; reads no further than needed."""
    return F.regexp_like(
        text, F.lit(rf"^[{SPACE}]*(?:[^{SPACE}]+[{SPACE}]+){{{least - 1}}}[^{SPACE}]")
    )
