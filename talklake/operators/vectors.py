"""Cosine top-k search.

Queries are the small side, the corpus the big one. The queries are written once to the scratch folder; each
task reads them from there, a bounded block at a time, against a bounded block of its own rows, and passes on its
best ``k`` per query. So the corpus is read once and never joined or shuffled, whatever the number of queries, and
nothing passes through the driver.

For approximate search, vectors get keys: the sides of fixed planes they lie on, table by table. Only rows that
share a key with a query are scored; both sides meet by an equality join on the key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from talklake.functions.times import iso_text
from talklake.session import scratch_path

TOP_K = 5
#: Rows of the corpus and of the queries that are scored against each other at once.
ROW_BLOCK, QUERY_BLOCK = 16_384, 1_024
# Scores closer than this are equal, and equal scores are ordered by id: the order in
# which numpy adds products must not decide.
SCORE_DIGITS = 12


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays as an expression, in double; 0 for a zero vector."""
    dot = lambda x, y: F.aggregate(
        F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v
    )
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms).otherwise(0.0)


def _carried(kind: T.DataType) -> T.DataType:
    """Ids travel through Python as 64-bit numbers or as strings."""
    return T.LongType() if isinstance(kind, T.IntegralType) else T.StringType()


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int):
    """The first ``k`` per query by score, then id."""
    order = np.lexsort((ids, -scores, query))
    query, ids, scores = query[order], ids[order], scores[order]
    first = np.searchsorted(query, query, side="left")
    keep = np.arange(len(query)) - first < k
    return query[keep], ids[keep], scores[keep]


def _by_size(column: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Places and unit vectors of the rows of each vector size; null and empty vectors are left out."""
    sizes = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    found = {}
    for size in np.unique(sizes[sizes > 0]):
        places = np.flatnonzero(sizes == size)
        flat = column.take(pa.array(places)).flatten().to_numpy(zero_copy_only=False)
        found[int(size)] = places, _unit(flat.reshape(-1, size).astype(np.float64))
    return found


def _query_blocks(path: str) -> Iterator[pa.RecordBatch]:
    """The written queries, a bounded block at a time."""
    files, folder = fs.FileSystem.from_uri(path)
    for info in sorted(files.get_file_info(fs.FileSelector(folder)), key=lambda i: i.path):
        if info.path.endswith(".parquet"):
            with files.open_input_file(info.path) as source:
                yield from pq.ParquetFile(source).iter_batches(QUERY_BLOCK)


def _block_best(rows: pa.RecordBatch, path: str, k: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The best ``k`` of a block of rows for each query that has vectors of its size."""
    own = _by_size(rows.column(1))
    for block in _query_blocks(path) if own else ():
        for size, (query_places, queries) in _by_size(block.column(1)).items():
            if size not in own:
                continue
            places, vectors = own[size]
            scores = np.round(vectors @ queries.T, SCORE_DIGITS)
            wanted = np.ones(scores.shape, bool)
            if len(places) > k:
                wanted = scores >= np.partition(scores, len(places) - k, axis=0)[len(places) - k]
            row, col = np.nonzero(wanted)
            ids = np.asarray(rows.column(0).take(pa.array(places[row])).to_pylist())
            col, ids, kept = _best(col, ids, scores[row, col], k)
            asked = block.column(0).take(pa.array(query_places[col]))
            yield pa.RecordBatch.from_arrays([asked, pa.array(ids.tolist(), rows.schema.field(0).type), pa.array(kept)], names=names)


def top_k(corpus: DataFrame, queries: DataFrame, k: int = TOP_K, id_col: str = "video_id") -> DataFrame:
    """``(query_id, rank, <id_col>, score)``: the ``k`` nearest rows of each query.

    ``corpus`` has ``id_col`` and ``embedding``, ``queries`` has ``query_id`` and ``embedding``. Filter the
    corpus beforehand to search a part of it. A query is scored against the rows whose vectors have its size;
    where there are none, and for a null vector, it has no hits. Equal scores are ordered by id.
    """
    types = {"query_id": queries.schema["query_id"].dataType, id_col: corpus.schema[id_col].dataType}
    schema = T.StructType(
        [T.StructField(name, _carried(kind)) for name, kind in types.items()]
        + [T.StructField("score", T.DoubleType())]
    )
    path = scratch_path(corpus.sparkSession, "queries")
    asked = queries.where(F.col("embedding").isNotNull())
    asked.select(F.col("query_id").cast(schema["query_id"].dataType), "embedding").write.parquet(path)
    names = schema.fieldNames()

    def local_best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            waiting.append(batch)
            n += batch.num_rows
            if n >= ROW_BLOCK:
                yield from scored(waiting)
                waiting, n = [], 0
        if n:
            yield from scored(waiting)

    def scored(waiting: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(waiting).combine_chunks().to_batches()
        for part in rows:
            yield from _block_best(part, path, k, names)

    rows = corpus.select(F.col(id_col).cast(schema[id_col].dataType).alias(id_col), "embedding")
    return _ranked(rows.mapInArrow(local_best, schema), k, id_col, types)


def _ranked(found: DataFrame, k: int, id_col: str, types: dict[str, T.DataType]) -> DataFrame:
    # The first ``k`` per query are cut out before the shuffle as well as after it.
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), id_col))
    return (
        found.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select(
            F.col("query_id").cast(types["query_id"]).alias("query_id"),
            "rank",
            F.col(id_col).cast(types[id_col]).alias(id_col),
            "score",
        )
    )


def nearest(corpus: DataFrame, vector: list[float], k: int = TOP_K, id_col: str = "video_id") -> DataFrame:
    """The ``k`` nearest rows of one vector, with all their columns and ``score``."""
    query = F.array(*[F.lit(float(x)) for x in vector])
    return (
        corpus.where(F.size("embedding") == len(vector))
        .withColumn("score", F.round(cosine(F.col("embedding"), query), SCORE_DIGITS))
        .orderBy(F.desc("score"), id_col)
        .limit(k)
    )


@dataclass(frozen=True)
class SignPlanes:
    """``tables`` times ``bits`` planes through the origin.

    Part ``i`` of a plane's normal is ``x / 2**31 - 1`` of the first eight hexadecimal digits ``x`` of
    ``md5("table:bit:i")``, so the keys are the same wherever they are computed. More bits make smaller
    buckets, more tables find more of the neighbours.
    """

    tables: int = 16
    bits: int = 8

    def normals(self, size: int) -> np.ndarray:
        number = lambda t, b, i: int(hashlib.md5(f"{t}:{b}:{i}".encode()).hexdigest()[:8], 16) / 2**31 - 1
        return np.array([[number(t, b, i) for i in range(size)] for t in range(self.tables) for b in range(self.bits)])

    def with_keys(self, rows: DataFrame) -> DataFrame:
        """Add ``keys``, one number per table; none for a null vector. Keep it with the store."""
        schema = T.StructType([*rows.schema.fields, T.StructField("keys", T.ArrayType(T.LongType()))])
        place = rows.columns.index("embedding")
        tables, bits, normals = self.tables, self.bits, self.normals

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known: dict[int, np.ndarray] = {}
            for batch in batches:
                keys: list[list[int] | None] = [None] * batch.num_rows
                for size, (places, vectors) in _by_size(batch.column(place)).items():
                    if size not in known:
                        known[size] = normals(size)
                    sides = (vectors @ known[size].T > 0).reshape(-1, tables, bits)
                    numbers = sides @ (1 << np.arange(bits)) + (np.arange(tables) << bits)
                    for at, own in zip(places, numbers.tolist()):
                        keys[at] = own
                columns = [*batch.columns, pa.array(keys, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

        return rows.mapInArrow(run, schema)


def sharing_keys(corpus: DataFrame, queries: DataFrame, id_col: str = "video_id") -> DataFrame:
    """``(query_id, <id_col>)`` of the pairs with a common key; both sides have ``keys``.

    An equality join: AQE splits the rows of a large bucket, and ids alone are shuffled.
    """
    rows = corpus.select(id_col, F.explode("keys").alias("key"))
    asked = queries.select("query_id", F.explode("keys").alias("key"))
    return rows.join(asked, "key").select("query_id", id_col).distinct()


def near_top_k(corpus: DataFrame, queries: DataFrame, k: int = TOP_K, id_col: str = "video_id") -> DataFrame:
    """As ``top_k``, over the rows that share a key with the query; their scores are exact."""
    types = {"query_id": queries.schema["query_id"].dataType, id_col: corpus.schema[id_col].dataType}
    pairs = sharing_keys(corpus, queries, id_col)
    vectors = pairs.join(corpus.select(id_col, "embedding"), id_col).join(
        queries.select("query_id", F.col("embedding").alias("asked")), "query_id"
    )
    same = vectors.where(F.size("embedding") == F.size("asked"))
    score = F.round(cosine(F.col("embedding"), F.col("asked")), SCORE_DIGITS)
    return _ranked(same.select("query_id", id_col, score.alias("score")), k, id_col, types)


def hits(ranked: DataFrame, store: DataFrame, id_col: str = "video_id") -> DataFrame:
    """Ranked ids with the payload fields a search shows."""
    payload = store.select(
        id_col,
        "title",
        "channel",
        iso_text(F.col("published_date")).alias("published_date"),
        "url",
        F.coalesce("topics", F.array().cast("array<string>")).alias("topics"),
    )
    return ranked.join(payload, id_col).select(
        "query_id", "rank", id_col, "title", "channel", "published_date", "url", "topics", "score"
    )
