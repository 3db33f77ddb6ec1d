"""Topics of one text, computed inside its row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from talklake.functions.arrays import let, runs
from talklake.functions.terms import (
    DOMAIN_STOP_WORDS,
    content_words,
    is_stop_phrase,
    with_pairs,
)
from talklake.functions.text import has_words

# --- fixed values --------------------------------------------------------------------
MIN_WORDS = 10
TOP_K = 10
CANDIDATES_PER_TOPIC = 3
# -------------------------------------------------------------------------------------

TERMS = "array<struct<term:string,tf:int,score:double>>"


def ranked_terms(
    text: Column,
    top_k: int = TOP_K,
    stop_words: Iterable[str] | None = None,
    domain_stop_words: Iterable[str] = DOMAIN_STOP_WORDS,
) -> Column:
    """The best terms of a text, best first, as ``struct(term, tf, score)``.

    The ``3 * top_k`` most frequent words and word pairs are kept (equal counts in
    alphabetical order), weighted by term frequency over the L2 norm of the kept ones;
    terms made only of domain stop words are then dropped and the best ``top_k`` stay.
    Texts of fewer than ten words have no terms.
    """

    def score(kept: Column) -> Column:
        norm = F.sqrt(
            F.aggregate(kept, F.lit(0.0), lambda s, t: s + t["least"].cast("double") * t["least"])
        )
        scored = let(
            norm,
            lambda n: F.transform(
                kept,
                lambda t: F.struct(
                    t["term"].alias("term"), (-t["least"]).alias("tf"), (-t["least"] / n).alias("score")
                ),
            ),
        )
        return F.slice(
            F.filter(scored, lambda t: ~is_stop_phrase(t["term"], domain_stop_words)), 1, top_k
        )

    counts = F.transform(
        runs(F.sort_array(with_pairs(content_words(text, stop_words)))),
        lambda r: F.struct((-r["n"]).alias("least"), r["item"].alias("term")),
    )
    kept = F.slice(F.sort_array(counts), 1, top_k * CANDIDATES_PER_TOPIC)
    return F.when(has_words(text, MIN_WORDS), let(kept, score)).otherwise(F.array().cast(TERMS))
