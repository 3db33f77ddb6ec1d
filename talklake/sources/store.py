"""The transcript store: Parquet files in folders of hashed point ids, written in versions.

``<root>/settings`` holds the vector size and the number of buckets, ``<root>/points`` the rows, each with the id
of the write that brought it. ``<root>/replaced`` names rows that a later write superseded, ``<root>/commits``
the writes that count, each with the largest number it was given. A write adds rows and the names of what they
replace, and counts from the moment its one commit row is there; what a failed write leaves behind is never read.
So nothing is rewritten for an upsert, and readers see all of a write or nothing. ``compact`` rewrites the buckets in which much is superseded.

Point ids are hashes, so buckets are even whatever the videos are. Choose the number of buckets so that one of
them is cheap to rewrite, some gigabytes.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from talklake.functions.ids import bucket, point_id
from talklake.functions.times import batch_name, moment
from talklake.operators.candidates import stored_among, unprocessed
from talklake.operators.quantise import Quantiser
from talklake.schemas import STORE
from talklake.session import staged
from talklake.sources.inverted import InvertedFile

# --- fixed values --------------------------------------------------------------------
TEXT_CAP = 8000  # the default of a parameter
METRIC = "cosine"
# -------------------------------------------------------------------------------------

SETTINGS = "vector_size int, metric string, buckets int"
COMMITS = "write_id string, largest bigint"
REPLACED = "bucket int, point_id bigint, write_id string, by_write string"
#: What names one version of a point.
VERSION = ("bucket", "point_id", "write_id")
#: Buckets with a larger share of superseded rows are rewritten by ``compact``.
STALE_SHARE = 0.3


class Store:
    def __init__(self, spark: SparkSession, root: str, vector_size: int, buckets: int):
        self.spark = spark
        self.root = root
        self.vector_size = vector_size
        self.buckets = buckets

    @classmethod
    def ensure(cls, spark: SparkSession, root: str, vector_size: int = 384, buckets: int = 64) -> Store:
        """Open the store, creating it only if missing; its own settings win."""
        root = root.rstrip("/")
        try:
            found = spark.read.schema(SETTINGS).parquet(f"{root}/settings").first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            found = None
        if found is None:
            rows = spark.createDataFrame([(vector_size, METRIC, buckets)], SETTINGS)
            folder = spark._jvm.org.apache.hadoop.fs.Path(root)
            files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
            for name in ("points", "rejected", "replaced", "commits"):
                files.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}"))
            rows.coalesce(1).write.mode("overwrite").parquet(f"{root}/settings")
            return cls(spark, root, vector_size, buckets)
        return cls(spark, root, found["vector_size"], found["buckets"])

    @property
    def path(self) -> str:
        return f"{self.root}/points"

    def _table(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def _versions(self) -> DataFrame:
        """All rows of committed writes, superseded ones too."""
        return self._table("points", STORE).join(self._table("commits", COMMITS), "write_id", "left_semi")

    def _superseded(self) -> DataFrame:
        """``(bucket, point_id, write_id)`` of the rows that committed writes replaced."""
        commits = self._table("commits", COMMITS).select(F.col("write_id").alias("by_write"))
        return self._table("replaced", REPLACED).join(commits, "by_write", "left_semi").select(*VERSION)

    def read(self) -> DataFrame:
        """The latest row of each point.

        The commits are one row per write and the replaced rows few after a compaction, so both are small sides
        that Catalyst broadcasts; the points are not shuffled.
        """
        return self._versions().join(self._superseded(), list(VERSION), "left_anti").select(*STORE.fieldNames())

    def rejected(self) -> DataFrame:
        """Points of all writes whose vector did not have the store's size."""
        return self._table("rejected", STORE)

    def next_number(self) -> int:
        """The number after the largest that a write was given, so none is given twice, stored or not.

        The commits say it and no point is read, unless a write of an earlier layout left it out.
        """
        commits = self._table("commits", COMMITS)
        known, unknown = commits.agg(F.max("largest"), F.count_if(F.col("largest").isNull())).first()
        if unknown:
            known = max(known or 0, self._versions().agg(F.max("transcript_number")).first()[0] or 0)
        return (known or 0) + 1

    def _checked(self, points: DataFrame, write_id: str, label: str) -> DataFrame:
        """One row per point with a vector of the right size; the others are kept in ``rejected``."""
        rows = last_write(points).withColumns(
            {"write_id": F.lit(write_id), "bucket": bucket(F.col("point_id"), self.buckets)}
        )
        fits = F.coalesce(F.size("embedding") == self.vector_size, F.lit(False))
        checked = staged(rows.select(*STORE.fieldNames(), fits.alias("fits")), label)
        checked.where(~F.col("fits")).drop("fits").write.mode("append").parquet(f"{self.root}/rejected")
        return checked.where("fits").drop("fits")

    def _append(self, points: DataFrame) -> None:
        """Few files per bucket; AQE splits a bucket that is too large for one task. The index gets the rows too."""
        rows = points.hint("rebalance", F.col("bucket"))
        rows.write.mode("append").partitionBy("bucket").parquet(self.path)
        index = InvertedFile(self.spark, self.root)
        if (model := index.model()) is not None:
            index.append(points.withColumn("label", F.col("channel")), model)

    def build_index(self, lists: int | None = None, parts: int = 8) -> bool:
        """Write the store's points into inverted lists; later writes add to them. False if there is no point.

        The channel is the label of filtered searches. Run it while nothing else writes.
        """
        live = self._versions().join(self._superseded(), list(VERSION), "left_anti")
        return InvertedFile(self.spark, self.root).create(live, self.vector_size, lists, parts, F.col("channel"))

    def index_rows(self) -> tuple[DataFrame, Quantiser]:
        """The index's rows of all that ``read`` has a vector for, and its quantiser."""
        index = InvertedFile(self.spark, self.root)
        if (model := index.model()) is None:
            raise ValueError(f"no index in {self.root}")
        return index.rows(self._table("commits", COMMITS), self._superseded()), model

    def _commit(self, write: tuple[str, int]) -> None:
        """From here on the write, given with its largest number, counts."""
        self.spark.createDataFrame([write], COMMITS).coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    def insert_if_absent(self, points: DataFrame) -> None:
        """Append the points that are not stored yet. Running it again adds nothing."""
        write_id = uuid.uuid4().hex
        fresh = self._checked(points, write_id, "insert")
        self._append(unprocessed(fresh, self.read()))
        self._commit((write_id, largest_number(fresh)))

    def upsert(self, points: DataFrame) -> None:
        """Replace points with the same id and add the others, by appending alone.

        Only the ids of the store's buckets that the new points fall into are read.
        """
        write_id = uuid.uuid4().hex
        fresh = self._checked(points, write_id, "upsert")
        known = stored_among(fresh, self.read())
        gone = known.select(*VERSION, F.lit(write_id).alias("by_write"))
        gone.write.mode("append").parquet(f"{self.root}/replaced")
        self._append(fresh)
        self._commit((write_id, largest_number(fresh)))

    def compact(self, stale_share: float = STALE_SHARE) -> int:
        """Rewrite the buckets in which more than ``stale_share`` of the rows is superseded; their number.

        Rows keep their write, so readers find the same rows before and after. The rewritten buckets also
        lose the many small files of many writes. Run it while nothing else writes.
        """
        total = self._versions().groupBy("bucket").agg(F.count("*").alias("n"))
        stale = self._superseded().join(self._versions().select(*VERSION), list(VERSION), "left_semi")
        share = stale.groupBy("bucket").agg(F.count("*").alias("stale")).join(total, "bucket")
        # At most `buckets` numbers, a setting of the store.
        chosen = [r["bucket"] for r in share.where(F.col("stale") > F.col("n") * stale_share).collect()]
        if chosen:
            live = staged(self.read().where(F.col("bucket").isin(chosen)), "compact")
            writer = live.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket")
            writer.option("partitionOverwriteMode", "dynamic").parquet(self.path)
        return len(chosen)


def largest_number(staged_points: DataFrame) -> int:
    """Read from one column of what a write has staged; 0 where no point has a number."""
    return staged_points.agg(F.max("transcript_number")).first()[0] or 0


def points(
    videos: DataFrame,
    as_of: datetime,
    batch_id: str | None = None,
    order: Column | None = None,
    text_cap: int | None = TEXT_CAP,
) -> DataFrame:
    """Store rows of processed videos. The text is capped here, after embedding; ``None`` keeps it whole.

    ``order`` says which of several writes of one video is the later one.
    """
    text = F.col("transcript") if text_cap is None else F.substring("transcript", 1, text_cap)
    rows = videos.select(
        point_id(F.col("video_id")).alias("point_id"),
        F.col("embedding").cast("array<float>").alias("embedding"),
        "video_id",
        "title",
        "channel",
        F.col("published").alias("published_date"),
        "url",
        F.col("duration_seconds").cast("bigint").alias("duration_seconds"),
        text.alias("transcript_text"),
        "topics",
        F.coalesce("metadata_tags", F.array().cast("array<string>")).alias("metadata_tags"),
        F.col("number").cast("bigint").alias("transcript_number"),
        F.lit(batch_id or batch_name(as_of)).alias("batch_id"),
        moment(as_of).alias("indexed_at"),
        *([order.alias("write_order")] if order is not None else []),
    )
    return rows


def last_write(rows: DataFrame, key: str = "point_id", order: str = "write_order") -> DataFrame:
    """One row per key, the latest by ``order``; of equal ones the greatest by number, then by all other columns.

    ``row_number() = 1`` is cut to one row per key before the shuffle, so many writes
    of one key do not meet in one task.
    """
    if order not in rows.columns:
        order = "transcript_number"
    first = [order, *(c for c in ("transcript_number",) if c in rows.columns and c != order)]
    rest = [c for c in rows.columns if c not in (key, *first)]
    turn = F.row_number().over(W.partitionBy(key).orderBy(*(F.desc(c) for c in (*first, *rest))))
    return rows.withColumn("_turn", turn).where("_turn = 1").drop("_turn")
