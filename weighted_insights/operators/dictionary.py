"""Wide vocabularies as tables: sorted categories are numbered, joined and saved without passing through the driver."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import quoted
from ..storage import settle

#: Categories that a part is made for, and the largest number of parts.
BLOCK_ROWS = 1 << 16
MOST_BLOCKS = 20_000


def number_categories(categories: DataFrame) -> DataFrame:
    """``attribute, category, number`` from distinct ``attribute, category``: 0, 1, 2, ... per attribute in the order of the texts.

    Ranges of the sorted categories are parts; a category's number is its place in its part plus the sizes of the parts of
    its attribute before it, of which there are at most ``MOST_BLOCKS``.
    """
    rows = settle(categories.select("attribute", "category"), "categories")
    blocks = min(MOST_BLOCKS, 1 + rows.count() // BLOCK_ROWS)
    ranged = settle(rows.repartitionByRange(blocks, "attribute", "category").withColumn("block", F.spark_partition_id()), "ranges")
    across = Window.partitionBy("attribute").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = ranged.groupBy("attribute", "block").agg(F.count("*").alias("n"))
    before = before.select("attribute", "block", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("attribute", "block").orderBy("category")) - 1
    numbered = ranged.withColumn("place", place).join(before, ["attribute", "block"])
    return numbered.select("attribute", "category", (F.col("before") + F.col("place")).alias("number"))


class _Writer(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        stage = self.instance
        stage.table(self.sparkSession).write.parquet(f"{path.rstrip('/')}/dictionary")


class _Reader(DefaultParamsReader):
    def load(self, path: str):
        return super().load(path)._set(path=f"{path.rstrip('/')}/dictionary")


class DictionaryIndexer(Transformer, HasInputCol, HasOutputCol, MLReadable, MLWritable):
    """Adds the number of a category by a join with its dictionary; unknown ones get the number behind the last.

    The dictionary is a Parquet table; Spark broadcasts it if it is small enough.  A saved stage holds a copy of it.
    """

    path = Param(Params._dummy(), "path", "folder of the dictionary", typeConverter=TypeConverters.toString)
    attribute = Param(Params._dummy(), "attribute", "attribute of the dictionary", typeConverter=TypeConverters.toString)
    size = Param(Params._dummy(), "size", "number of categories", typeConverter=TypeConverters.toInt)

    def __init__(self, path: str = "", attribute: str = "", size: int = 0, inputCol: str = "", outputCol: str = ""):
        super().__init__()
        self._set(path=path, attribute=attribute, size=size, inputCol=inputCol, outputCol=outputCol)

    def table(self, spark) -> DataFrame:
        rows = spark.read.schema("attribute string, category string, number bigint").parquet(self.getOrDefault(self.path))
        return rows.where(F.col("attribute") == self.getOrDefault(self.attribute))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        size, out = self.getOrDefault(self.size), self.getOutputCol()
        known = self.table(dataset.sparkSession).select(F.col("category").alias("_category"), F.col("number").cast("double").alias("_number"))
        joined = dataset.join(known, quoted(self.getInputCol()) == F.col("_category"), "left")
        # Like the stock indexer: the last slot is that of unknown categories.
        kind = {"ml_attr": {"type": "nominal", "name": out, "num_vals": size + 1}}
        return joined.select(*[quoted(c) for c in dataset.columns], F.coalesce("_number", F.lit(float(size))).alias(out, metadata=kind))

    def write(self) -> DefaultParamsWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return _Reader(cls)
