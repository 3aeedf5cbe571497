"""One-hot encoding whose labels stay in a table.

The vocabulary is a stored table of (feature, label, place, rows).  Rows find
their places by joins that hold for any skew and any number of labels, and the
sparse vector is put together from places; neither the driver nor the model
holds a label.  A saved encoder holds a copy of its vocabulary.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.clean import MISSING_GROUP
from tabloom.operators.lookup import left_lookup
from tabloom.operators.prefix import global_rank
from tabloom.scratch import materialize, scratch_path

VOCABULARY = "feature string, label string, place int, n bigint"


def store_vocabulary(words: DataFrame) -> tuple[str, dict[str, int]]:
    """Write the frequent words with their places in label order; the path, and the labels per feature."""
    spark = words.sparkSession
    frequent = materialize(words.where("frequent").select("feature", F.col("category").alias("label"), "n"), "words")
    ranked = global_rank(frequent, [F.col("label").asc()], ["feature"], "rank")
    path = scratch_path(spark, "vocabulary")
    ranked.select("feature", "label", (F.col("rank") - 1).cast("int").alias("place"), "n").write.parquet(path)
    counts = spark.read.schema(VOCABULARY).parquet(path).groupBy("feature").count().collect()  # one row per column
    return path, {row["feature"]: row["count"] for row in counts}


def sparse_vector(size: int, indices: Column, values: Column) -> Column:
    """Vector from arrays of ascending places and their values, on the JVM."""
    fields = F.struct(F.lit(0).alias("type"), F.lit(size).alias("size"), indices.alias("indices"), values.alias("values"))
    schema = T.StructType([T.StructField("v", VectorUDT())])
    return F.from_json(F.to_json(F.struct(fields.alias("v"))), schema)["v"]


class TableEncoder(Transformer, MLWritable, MLReadable):
    """Vector of dense SQL columns, then the one-hot columns of each nominal feature.

    A label without a place takes the shared column where the fit saw rare
    labels, and none elsewhere.  A feature of neither has no column.
    """

    dense = Param(Params._dummy(), "dense", "SQL of the dense columns", TypeConverters.toListString)
    hot = Param(Params._dummy(), "hot", "JSON list of (feature, labels, has rare ones)", TypeConverters.toString)
    path = Param(Params._dummy(), "path", "the stored vocabulary", TypeConverters.toString)
    output = Param(Params._dummy(), "output", "the vector column", TypeConverters.toString)

    @classmethod
    def of(
        cls, dense: Sequence[str], features: Mapping[str, int], has_rare: frozenset[str], path: str, output: str
    ) -> TableEncoder:
        hot = json.dumps([[name, count, name in has_rare] for name, count in features.items()])
        return cls()._set(dense=list(dense), hot=hot, path=path, output=output)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        dense, hot = self.getOrDefault(self.dense), json.loads(self.getOrDefault(self.hot))
        table = dataset.sparkSession.read.schema(VOCABULARY).parquet(self.getOrDefault(self.path))
        rows = dataset.withColumns({f"__dense{i}": F.expr(sql) for i, sql in enumerate(dense)})
        size, places = len(dense), [F.lit(i) for i in range(len(dense))]
        for number, (name, count, rare) in enumerate(hot):
            shared = F.lit(size + count) if rare else F.lit(None).cast("int")
            if count:
                key, place = f"__text{number}", f"__place{number}"
                words = table.where(F.col("feature") == name).select(
                    F.col("label").alias(key), (F.col("place") + size).alias(place), "n"
                )
                text = F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(MISSING_GROUP))
                rows = left_lookup(rows.withColumn(key, text), words, [key], "n")
                places.append(F.coalesce(F.col(place), shared))
            elif rare:
                places.append(shared)
            size += count + rare
        values = [F.col(f"__dense{i}") for i in range(len(dense))] + [F.lit(1.0)] * (len(places) - len(dense))
        entries = F.filter(
            F.array(*[F.struct(p.alias("place"), v.alias("value")) for p, v in zip(places, values, strict=True)]),
            lambda x: x["place"].isNotNull(),
        )
        vector = sparse_vector(size, F.transform(entries, lambda x: x["place"]), F.transform(entries, lambda x: x["value"]))
        return rows.select(*[f"`{name}`" for name in dataset.columns], vector.alias(self.getOrDefault(self.output)))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, instance: TableEncoder):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        DefaultParamsWriter.saveMetadata(self.instance, path, spark)
        words = spark.read.schema(VOCABULARY).parquet(self.instance.getOrDefault(self.instance.path))
        words.write.parquet(f"{path}/vocabulary")


class _Reader(MLReader):
    def load(self, path: str) -> TableEncoder:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        encoder = TableEncoder()
        encoder._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(encoder, metadata)
        return encoder._set(path=f"{path}/vocabulary")
