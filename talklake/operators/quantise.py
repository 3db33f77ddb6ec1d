"""Inverted lists: a coarse quantiser, product codes, and searches that look at some lists alone.

A quantiser is fitted on a bounded sample: spherical k-means gives the centres, and the differences between unit vectors
and their centres are coded part by part, one byte each. Every row is assigned to its nearest centre and coded. A
search asks the lists whose centres are nearest, scores their rows by the codes (the query itself is not coded), and
scores the best of those exactly.

The exact search uses the same lists with the triangle inequality: no row of a list is nearer to a query than
the angle to the centre less the list's radius. Lists that cannot reach the query's k-th score are skipped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F, types as T

from talklake.operators.vectors import SCORE_DIGITS, TOP_K, _best, _by_size, _carried, _ranked
from talklake.session import scratch_path, staged

#: Rows the quantiser is fitted on, at most; they come to the driver.
SAMPLE = 20_000
#: Most lists. Their centres, with the codebooks, travel to every task.
MAX_LISTS = 4_096
ROUNDS = 12
CODES = 256
#: Rows and queries that are scored against each other at once.
ROW_BLOCK, QUERY_BLOCK = 8_192, 256
#: Rows of a block that are scored exactly for each query, as a multiple of ``k``.
RERANK = 20
#: Added to angles where rounding could otherwise hide a row.
SLACK = 1e-6
MODEL = "size int, lists int, parts int, centres binary, books binary"


def _k_means(rows: np.ndarray, k: int, dice: np.random.Generator, spherical: bool) -> np.ndarray:
    """Centres of ``rows``; an empty one is moved to the row that is worst off."""
    centres = rows[np.sort(dice.choice(len(rows), k, replace=False))].copy()
    for _ in range(ROUNDS):
        own, off = _nearest(rows, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, rows)
        counts = np.bincount(own, minlength=k)
        worst = iter(np.argsort(-off, kind="stable"))
        for empty in np.flatnonzero(counts == 0):
            place = next(worst)
            sums[empty], counts[empty] = rows[place], 1
        centres = sums / counts[:, None]
        if spherical:
            norms = np.linalg.norm(centres, axis=1, keepdims=True)
            centres = np.divide(centres, norms, out=np.zeros_like(centres), where=norms > 0)
    return centres


def _nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row and the squared distance to it, in blocks."""
    own, off = np.zeros(len(rows), np.int64), np.zeros(len(rows))
    half = (centres * centres).sum(axis=1) / 2
    for start in range(0, len(rows), ROW_BLOCK):
        part = rows[start : start + ROW_BLOCK]
        score = part @ centres.T - half
        best = score.argmax(axis=1)
        own[start : start + len(part)] = best
        off[start : start + len(part)] = (part * part).sum(axis=1) - 2 * score[np.arange(len(part)), best]
    return own, np.maximum(off, 0)


@dataclass(frozen=True)
class Quantiser:
    """``centres``: unit vectors, one per list; ``books``: per part of a vector, the values its byte stands for."""

    centres: np.ndarray
    books: np.ndarray

    @property
    def size(self) -> int:
        return self.centres.shape[1]

    @property
    def lists(self) -> int:
        return len(self.centres)

    @classmethod
    def fit(cls, rows: DataFrame, size: int, lists: int | None = None, parts: int = 8, id_col: str = "video_id", seed: int = 7) -> Quantiser | None:
        """Fit on at most ``SAMPLE`` rows, those with the least hashes of their ids; None if no row has a vector.

        ``lists`` is about the square root of the number of rows unless given, ``MAX_LISTS`` at most. ``parts``
        must divide ``size``. Vectors of another size and zero vectors are left out.
        """
        if size % parts:
            raise ValueError(f"{parts} parts do not divide {size}")
        fits = rows.where(F.size("embedding") == size)
        drawn = fits.select("embedding", F.xxhash64(F.col(id_col).cast("string")).alias("at"))
        table = drawn.orderBy("at", F.col("embedding")).limit(SAMPLE).toArrow()
        found = _by_size(table.column("embedding").combine_chunks()).get(size) if table.num_rows else None
        unit = found[1][np.linalg.norm(found[1], axis=1) > 0] if found else np.zeros((0, size))
        if not len(unit):
            return None
        wanted = lists or int(np.sqrt(fits.count()))
        dice = np.random.default_rng(seed)
        centres = _k_means(unit, max(1, min(wanted, MAX_LISTS, len(unit))), dice, spherical=True)
        rest = unit - centres[_nearest(unit, centres)[0]]
        width = size // parts
        books = np.zeros((parts, CODES, width))
        for part in range(parts):
            own = rest[:, part * width : (part + 1) * width]
            k = min(CODES, len(own))
            books[part, :k] = _k_means(own, k, dice, spherical=False)
            books[part, k:] = books[part, 0]
        # Kept as floats so that a stored quantiser is the same as a fitted one.
        return cls(centres.astype(np.float32).astype(float), books.astype(np.float32).astype(float))

    def row(self) -> tuple:
        as_bytes = (x.astype("<f4").tobytes() for x in (self.centres, self.books))
        return (self.size, self.lists, len(self.books), *as_bytes)

    @classmethod
    def from_row(cls, size: int, lists: int, parts: int, centres: bytes, books: bytes) -> Quantiser:
        read = lambda data, *shape: np.frombuffer(data, "<f4").astype(float).reshape(shape)
        return cls(read(centres, lists, size), read(books, parts, CODES, size // parts))

    def coded(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, angle to its centre, and codes of each unit vector."""
        own, _ = _nearest(unit, self.centres)
        rest = unit - self.centres[own]
        width = self.size // len(self.books)
        codes = [_nearest(rest[:, p * width : (p + 1) * width], book)[0] for p, book in enumerate(self.books)]
        apart = np.linalg.norm(unit - self.centres[own], axis=1)
        # From the chord: exact for small angles, where the arc cosine of a product is not.
        norms = np.linalg.norm(self.centres[own], axis=1)
        angle = np.where(np.abs(norms - 1) < 1e-3, 2 * np.arcsin(np.clip(apart / 2, 0, 1)), np.pi)
        return own, angle, np.stack(codes, axis=1).astype(np.uint8)

    def assign(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``list, angle, codes``; null, zero and differently sized vectors have none."""
        schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL("list int, angle double, codes binary").fields])
        place, model = rows.columns.index("embedding"), self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                number, angle, codes = ([None] * batch.num_rows for _ in range(3))
                places, unit = _by_size(batch.column(place)).get(model.size, ((), None))
                if len(places):
                    filled = np.linalg.norm(unit, axis=1) > 0
                    for at, n, a, c in zip(places[filled], *(x.tolist() for x in model.coded(unit[filled])), strict=True):
                        number[at], angle[at], codes[at] = n, a, bytes(c)
                more = [pa.array(number, pa.int32()), pa.array(angle, pa.float64()), pa.array(codes, pa.binary())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=schema.fieldNames())

        return rows.mapInArrow(run, schema)


def list_sizes(rows: DataFrame, *by: str) -> DataFrame:
    """``list, rows, radius`` of every list, and for each value of the columns ``by``."""
    return rows.where("list IS NOT NULL").groupBy("list", *by).agg(F.count("*").alias("rows"), F.max("angle").alias("radius"))


def _asked(queries: DataFrame, model: Quantiser, choose, more: str) -> DataFrame:
    """Run ``choose(unit vectors, labels)``, which gives per query the lists and values of ``more``, over all queries."""
    kind = _carried(queries.schema["query_id"].dataType)
    fields = T.StructType.fromDDL(f"embedding array<double>, list int, {more}").fields
    schema = T.StructType([T.StructField("query_id", kind), *fields])
    own = queries.select(F.col("query_id").cast(kind), "embedding", *[c for c in ("label", "least") if c in queries.columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, QUERY_BLOCK):
                batch = whole.slice(start, QUERY_BLOCK)
                places, unit = _by_size(batch.column(1)).get(model.size, ((), None))
                if not len(places):
                    continue
                extra = batch.column(2).take(pa.array(places)).to_pylist() if batch.num_columns > 2 else [None] * len(places)
                chosen = choose(unit, extra)
                counts = [len(lists) for lists, _ in chosen]
                at = np.repeat(np.arange(len(places)), counts)
                lists = np.concatenate([x for x, _ in chosen]) if chosen else np.zeros(0)
                values = np.concatenate([x for _, x in chosen]) if chosen else np.zeros(0)
                vectors = pa.ListArray.from_arrays(np.arange(0, at.size * model.size + 1, model.size, dtype=np.int32), unit[at].ravel())
                columns = [batch.column(0).take(pa.array(places[at])), vectors, pa.array(lists.astype(np.int32)), pa.array(values.astype(float))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return own.mapInArrow(run, schema)


def probes(queries: DataFrame, model: Quantiser, sizes: dict, share: float) -> DataFrame:
    """``query_id, embedding, list, near``: the lists each query asks, nearest centres first.

    As many as hold ``share`` of the rows; ``sizes`` has the rows of each list by label, ``None`` for all. For a
    query with a ``label``, only lists with rows of that label count, and rows of that label alone, so a rare label
    is looked for as far away as it takes.
    """
    tables = {label: np.array([own.get(i, 0) for i in range(model.lists)]) for label, own in sizes.items()}

    def choose(unit: np.ndarray, labels: list):
        near = unit @ model.centres.T
        found = []
        for row, label in zip(near, labels, strict=True):
            rows = tables.get(label, np.zeros(model.lists, int))
            order = np.argsort(-row, kind="stable")
            order = order[rows[order] > 0]
            upto = np.cumsum(rows[order])
            enough = int(np.searchsorted(upto, share * rows.sum(), side="left")) + 1
            found.append((order[:enough], row[order[:enough]]))
        return found

    return _asked(queries, model, choose, "near double")


def _write_by_list(asked: DataFrame, label: str) -> str:
    """Write what is asked, one folder per list, so that a task reads only what its rows need."""
    path = scratch_path(asked.sparkSession, label)
    asked.repartition("list").write.partitionBy("list").parquet(path)
    return path


def _questions(path: str, number: int) -> Iterator[pa.RecordBatch]:
    files, folder = fs.FileSystem.from_uri(path)
    selector = fs.FileSelector(f"{folder}/list={number}", allow_not_found=True)
    for info in sorted(files.get_file_info(selector), key=lambda i: i.path):
        if info.path.endswith(".parquet"):
            with files.open_input_file(info.path) as source:
                yield from pq.ParquetFile(source).iter_batches(QUERY_BLOCK)


def _scored(rows: DataFrame, path: str, model: Quantiser, k: int, id_col: str, query_kind: T.DataType, coded: bool) -> DataFrame:
    """Best ``k`` per query of each block of rows of one list: by codes first where ``coded``, then exactly."""
    kind = _carried(rows.schema[id_col].dataType)
    schema = T.StructType([T.StructField("query_id", query_kind), T.StructField(id_col, kind), T.StructField("score", T.DoubleType())])
    width = model.size // len(model.books)

    def block(part: pa.RecordBatch, number: int) -> Iterator[pa.RecordBatch]:
        _, unit = _by_size(part.column(1))[model.size]
        codes = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint8).reshape(len(unit), -1) if coded else None
        for asked in _questions(path, number):
            queries = asked.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, model.size)
            most = RERANK * k
            if coded and len(unit) > most:
                rough = np.zeros((len(unit), len(queries)))
                for p, book in enumerate(model.books):
                    rough += (book @ queries[:, p * width : (p + 1) * width].T)[codes[:, p]]
                kept = np.argpartition(-rough, most, axis=0)[:most]
                col = np.tile(np.arange(len(queries)), (most, 1))
                scores = np.einsum("ijk,jk->ij", unit[kept], queries)
                row, col, scores = kept.ravel(), col.ravel(), scores.ravel()
            else:
                full = unit @ queries.T
                row, col = np.indices(full.shape).reshape(2, -1)
                scores = full.ravel()
                if len(unit) > k:
                    bar = np.partition(np.round(full, SCORE_DIGITS), len(unit) - k, axis=0)[len(unit) - k]
                    near = np.round(scores, SCORE_DIGITS) >= bar[col]
                    row, col, scores = row[near], col[near], scores[near]
            ids = np.asarray(part.column(0).take(pa.array(row)).to_pylist())
            col, ids, scores = _best(col, ids, np.round(scores, SCORE_DIGITS), k)
            yield pa.RecordBatch.from_arrays([asked.column("query_id").take(pa.array(col)), pa.array(ids.tolist(), part.schema.field(0).type), pa.array(scores)], names=schema.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(3).to_numpy(zero_copy_only=False)
            for number in np.unique(numbers):
                part = batch.take(pa.array(np.flatnonzero(numbers == number)))
                for start in range(0, part.num_rows, ROW_BLOCK):
                    yield from block(part.slice(start, ROW_BLOCK), int(number))

    own = rows.where("list IS NOT NULL").select(F.col(id_col).cast(kind).alias(id_col), "embedding", "codes", "list")
    return own.mapInArrow(run, schema)


def _sizes(rows: DataFrame, by: str | None) -> tuple[dict, dict]:
    """Rows by label and list, and radii by list. There are ``MAX_LISTS`` lists at most."""
    radii = {r["list"]: r["radius"] for r in list_sizes(rows).collect()}
    counted = list_sizes(rows, by).select("list", F.col(by).alias("label"), "rows") if by else list_sizes(rows).select("list", F.lit(None).alias("label"), "rows")
    sizes: dict = {}
    for r in counted.collect():
        sizes.setdefault(r["label"], {})[r["list"]] = r["rows"]
    return sizes, radii


def near_lists(
    rows: DataFrame, queries: DataFrame, model: Quantiser, share: float, k: int = TOP_K, id_col: str = "video_id", label: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The ``k`` nearest rows of each query among the lists it asks, and ``query_id, scored, total``.

    ``rows`` are assigned rows (``id_col, embedding, list, angle, codes``), ``queries`` have ``query_id, embedding``. With
    ``label``, a column of ``rows`` with few values, each query names one in its column ``label`` and finds rows of that
    label only. Scores are exact. ``scored`` counts the rows of the asked lists, ``total`` all that the query could find.
    """
    sizes, _ = _sizes(rows, label)
    columns = ["query_id", "embedding"] + ([F.col("label")] if label else [])
    asked = staged(probes(queries.select(*columns), model, sizes, share), "probes")
    types = {"query_id": queries.schema["query_id"].dataType, id_col: rows.schema[id_col].dataType}
    counts = list_sizes(rows, label) if label else list_sizes(rows)
    named = queries.select(F.col("query_id").cast(asked.schema["query_id"].dataType).alias("query_id"), *([F.col("label").alias("_label")] if label else []))
    if label:
        meets = asked.join(named, "query_id").join(counts.withColumnRenamed(label, "_label"), ["list", "_label"])
        totals = named.join(rows.groupBy(F.col(label).alias("_label")).agg(F.count("list").alias("total")), "_label").select("query_id", "total")
        found = [_part(rows.where(F.col(label) == value), asked.join(named.where(F.col("_label") == value), "query_id", "left_semi"), model, k, id_col) for value in sizes]
        best = found[0]
        for other in found[1:]:
            best = best.unionByName(other)
    else:
        meets = asked.join(counts, "list")
        total = sum(sizes.get(None, {}).values())
        totals = named.withColumn("total", F.lit(total).cast("bigint"))
        best = _part(rows, asked, model, k, id_col)
    scored = meets.groupBy("query_id").agg(F.sum("rows").alias("scored")).join(totals, "query_id")
    return _ranked(best, k, id_col, types), scored.select(F.col("query_id").cast(types["query_id"]).alias("query_id"), "scored", "total")


def _part(rows: DataFrame, asked: DataFrame, model: Quantiser, k: int, id_col: str, coded: bool = True) -> DataFrame:
    path = _write_by_list(asked, "questions")
    wanted = asked.select("list").distinct()
    return _scored(rows.join(wanted, "list", "left_semi"), path, model, k, id_col, asked.schema["query_id"].dataType, coded)


def exact_top_k(
    rows: DataFrame, queries: DataFrame, model: Quantiser, k: int = TOP_K, id_col: str = "video_id"
) -> tuple[DataFrame, DataFrame]:
    """The exact ``k`` nearest rows of each query, with lists that cannot hold one of them skipped unread.

    First each query's nearest lists, as many as hold ``k`` rows or more, are scored; the ``k``-th score found is a
    lower bound. A row of a list is not nearer than the angle to the centre less the list's radius, so of the
    others only lists that this bound does not rule out are scored. Returns ranked ids, with exact scores, and
    ``query_id, scored, total``. ``rows`` are assigned rows; rows in no list (null, zero and differently sized
    vectors) are not found. A null or differently sized query has no hits; a zero one scores 0 with every row.
    """
    sizes, radii = _sizes(rows, None)
    counts = np.array([sizes.get(None, {}).get(i, 0) for i in range(model.lists)])
    radius = np.array([radii.get(i, 0.0) for i in range(model.lists)])
    types = {"query_id": queries.schema["query_id"].dataType, id_col: rows.schema[id_col].dataType}
    unit_norm = np.abs(np.linalg.norm(model.centres, axis=1) - 1) < 1e-3

    def ordered(unit: np.ndarray):
        near = unit @ model.centres.T
        apart = np.linalg.norm(unit[:, None, :] - model.centres[None, :, :], axis=2) if unit.size * model.lists < 1 << 24 else np.sqrt(np.maximum(2 - 2 * near, 0))
        angle = 2 * np.arcsin(np.clip(apart / 2, 0, 1))
        # The best score that a row of each list can have.
        best = np.where(unit_norm, np.cos(np.maximum(angle - radius - SLACK, 0)), 1.0)
        return near, np.where(counts > 0, best, -2.0)

    def first_lists(near: np.ndarray) -> np.ndarray:
        order = np.argsort(-near, kind="stable")
        order = order[counts[order] > 0]
        return order[: int(np.searchsorted(np.cumsum(counts[order]), k, side="left")) + 1]

    def first(unit: np.ndarray, _):
        near, _ = ordered(unit)
        return [(lists, row[lists]) for row in near for lists in (first_lists(row),)]

    def rest(unit: np.ndarray, least: list):
        near, best = ordered(unit)
        found = []
        for row, bound, score in zip(near, best, least, strict=True):
            open_ = bound >= (score if score is not None else -2.0) - SLACK
            open_ &= counts > 0
            open_[first_lists(row)] = False
            found.append((np.flatnonzero(open_), bound[open_]))
        return found

    own = queries.select("query_id", "embedding")
    near = staged(_asked(own, model, first, "near double"), "first")
    top = staged(_ranked(_part(rows, near, model, k, id_col, coded=False), k, id_col, {"query_id": near.schema["query_id"].dataType, id_col: types[id_col]}), "top")
    bar = top.where(F.col("rank") == k).select(F.col("query_id"), F.col("score").alias("least"))
    asked_kind = near.schema["query_id"].dataType
    bounded = own.withColumn("query_id", F.col("query_id").cast(asked_kind)).join(bar, "query_id", "left")
    far = staged(_asked(bounded.select("query_id", "embedding", "least"), model, rest, "near double"), "rest")
    more = _part(rows, far, model, k, id_col, coded=False)
    carried = _carried(types[id_col])
    both = top.select("query_id", F.col(id_col).cast(carried).alias(id_col), "score").unionByName(more)
    scored = near.select("query_id", "list").union(far.select("query_id", "list")).join(list_sizes(rows), "list")
    totals = int(counts.sum())
    report = scored.groupBy("query_id").agg(F.sum("rows").alias("scored")).select(
        F.col("query_id").cast(types["query_id"]).alias("query_id"), "scored", F.lit(totals).cast("bigint").alias("total")
    )
    return _ranked(both, k, id_col, types), report
