"""The search job: text to vector to ranked hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from talklake.operators import vectors
from talklake.operators.embed import embed
from talklake.operators.vectors import TOP_K
from talklake.session import staged


def search(
    store: DataFrame,
    texts: DataFrame,
    embedder,
    k: int = TOP_K,
    where: Column | None = None,
    planes: vectors.SignPlanes | None = None,
) -> DataFrame:
    """The ``k`` nearest stored videos of each ``(query_id, text)``.

    ``where`` limits the search to a part of the store by its payload columns. With ``planes``, only videos
    that share a key with a query are scored; keys kept with the store must be of the same planes.
    Texts are embedded once.
    """
    queries = embed(texts.select("query_id", "text"), embedder, "text").drop("text")
    part = store if where is None else store.where(where)
    scored = part.select("video_id", "embedding", *(["keys"] if "keys" in part.columns else []))
    if planes is None:
        return vectors.hits(vectors.top_k(scored, queries, k), part)
    asked = staged(planes.with_keys(queries), "queries")
    if "keys" not in scored.columns:
        scored = staged(planes.with_keys(scored), "keys")
    return vectors.hits(vectors.near_top_k(scored, asked, k), part)
