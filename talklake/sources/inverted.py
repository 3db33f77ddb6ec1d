"""The inverted lists of a store: its points once more, one folder per list, with codes.

``<root>/index/model`` holds the quantiser, ``<root>/index/lists/list=<i>`` the rows. A row names the version of the point it
stands for, so what a store's reader leaves out (failed writes, superseded rows) is left out here by the same two
small tables, and an insert or upsert only adds rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from talklake.operators import quantise
from talklake.operators.quantise import MODEL, Quantiser
from talklake.operators.vectors import TOP_K

ROWS = "bucket int, point_id bigint, write_id string, video_id string, label string, embedding array<float>, angle double, codes binary, list int"
#: Vectors without a direction lie in no list; they are kept in a folder of their own and found by no search.
NOWHERE = -1


class InvertedFile:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = f"{root}/index"

    def model(self) -> Quantiser | None:
        """The stored quantiser; None where there is no index."""
        try:
            found = self.spark.read.schema(MODEL).parquet(f"{self.root}/model").first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return Quantiser.from_row(*(bytes(x) if isinstance(x, bytearray) else x for x in found)) if found else None

    def create(self, points: DataFrame, size: int, lists: int | None = None, parts: int = 8, label: Column | None = None) -> bool:
        """Fit the quantiser on ``points`` and write their lists; False, and no index, if no point has a vector.

        ``label`` is kept with each row for filtered searches; later writes take it from a column of that name.
        The model is written last: lists without one are no index.
        """
        model = Quantiser.fit(points, size, lists, parts)
        if model is None:
            return False
        self.append(points.withColumn("label", label.cast("string")) if label is not None else points, model, "overwrite")
        self.spark.createDataFrame([model.row()], MODEL).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/model")
        return True

    def append(self, points: DataFrame, model: Quantiser, mode: str = "append") -> None:
        """Add the rows of a write; few files per list, and AQE splits a list that is too large for one task."""
        label = F.col("label").cast("string") if "label" in points.columns else F.lit(None).cast("string")
        own = points.select("bucket", "point_id", "write_id", "video_id", label.alias("label"), "embedding")
        rows = model.assign(own).withColumn("list", F.coalesce("list", F.lit(NOWHERE)))
        rows.hint("rebalance", F.col("list")).write.mode(mode).partitionBy("list").parquet(f"{self.root}/lists")

    def rows(self, commits: DataFrame, superseded: DataFrame) -> DataFrame:
        """The rows that count: of committed writes, and not superseded."""
        every = self.spark.read.schema(ROWS).parquet(f"{self.root}/lists").where(F.col("list") != NOWHERE)
        return every.join(commits, "write_id", "left_semi").join(superseded, ["bucket", "point_id", "write_id"], "left_anti")


def search(rows: DataFrame, model: Quantiser, queries: DataFrame, share: float, k: int = TOP_K, label: bool = False) -> tuple[DataFrame, DataFrame]:
    """Approximate top ``k`` over an index: ranked ids and the rows scored; see ``quantise.near_lists``."""
    return quantise.near_lists(rows, queries, model, share, k, label="label" if label else None)
