"""Tokens, word pairs and stop words."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, functions as F

from talklake.functions.arrays import let, neighbours
from talklake.functions.stop_words import ENGLISH
from talklake.functions.text import SPACE, URL, keyword_text

# --- fixed values: words that say nothing about a talk's topic ----------------------
DOMAIN_STOP_WORDS = (
    "like", "know", "thing", "think", "going", "right", "really",
    "just", "actually", "basically", "okay", "yeah", "well",
    "gonna", "wanna", "gotta", "let", "say", "said", "see",
    "look", "way", "lot", "kind", "stuff", "make", "got",
    "come", "want", "need", "use", "used", "using",
)
# -------------------------------------------------------------------------------------


def english_stop_words() -> tuple[str, ...]:
    """Spark ML's English stop words."""
    return tuple(ENGLISH.split())


def words(text: Column) -> Column:
    """Words of two or more letters, in order."""
    return F.filter(F.split(keyword_text(text), " "), lambda w: F.length(w) >= 2)


def content_words(text: Column, stop_words: Iterable[str] | None = None) -> Column:
    """``words`` without stop words."""
    listed = english_stop_words() if stop_words is None else stop_words
    # A token is made of two or more letters, so no other entry can match one.
    stop = [w for w in listed if re.fullmatch("[a-z]{2,}", w)]
    if not stop:
        return words(text)
    return F.filter(
        F.split(keyword_text(text), " "), lambda w: (F.length(w) >= 2) & ~w.isin(stop)
    )


def words_of_sentences(stop_words: Iterable[str] | None = None) -> Callable[[str], list[list[str]]]:
    """A function for workers: the ``content_words`` of each sentence of a text that is in lower case.

    Sentences end at ``.`` or a line break; blank ones do not count.
    """
    space = re.sub(r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), SPACE)
    url, seen, word = re.compile(f"{URL}[^{space}]+"), re.compile(f"[^{space}]"), re.compile("[a-z]+")
    stop = frozenset(english_stop_words() if stop_words is None else stop_words)

    def of(lower: str) -> list[list[str]]:
        sentences = (s for s in re.split("[.\n]", lower) if seen.search(s))
        return [[w for w in word.findall(url.sub("", s) if "://" in s else s) if len(w) > 1 and w not in stop] for s in sentences]

    return of


def with_pairs(tokens: Column) -> Column:
    """The words followed by the pairs of adjacent words (stop words already gone)."""
    return let(
        tokens, lambda t: F.concat(t, neighbours(t, lambda a, b: F.concat_ws(" ", a, b)))
    )


def is_stop_phrase(term: Column, stop_words: Iterable[str] = DOMAIN_STOP_WORDS) -> Column:
    """True when every word of the term is a domain stop word."""
    stop = list(stop_words)
    return F.forall(F.split(term, " "), lambda w: w.isin(stop))
