"""Model versions on shared storage: saved pipelines, aliases and descriptors."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tabloom.contracts import ContractError

VERSION_SCHEMA = (
    "name string, version bigint, model_path string, run_id string, source_sha256 string, study string,"
    " trial bigint, preprocessing string, parameters map<string,string>, test_metrics map<string,double>,"
    " features array<string>, signature string, example array<string>"
)
ALIAS_SCHEMA = "name string, alias string, version bigint, sequence bigint"
DESCRIPTOR_SCHEMA = (
    "schema_version int, model struct<model_uri:string, model_name:string, model_version:string,"
    " model_alias:string, run_id:string, git_commit:string, source_sha256:string, study:string,"
    " trial:string, preprocessing:string, parameters:map<string,string>, test_metrics:map<string,double>>"
)


def _row_json(df: DataFrame):
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})


@dataclass(frozen=True)
class ModelRegistry:
    """Append-only version and alias tables below one folder."""

    spark: SparkSession
    root: str

    def _table(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def versions(self) -> DataFrame:
        return self._table("versions", VERSION_SCHEMA)

    def _single(self, name: str, version: int) -> Row:
        """The entry of a version; none, or a clash of two runs, is an error."""
        rows = self.versions().where((F.col("name") == name) & (F.col("version") == version)).limit(2).collect()
        if len(rows) != 1:
            raise ContractError(f"{name} has no version {version}" if not rows else f"two runs registered version {version} of {name}")
        return rows[0]

    def aliases(self) -> DataFrame:
        """Current version per name and alias: the latest entry wins."""
        entries = self._table("aliases", ALIAS_SCHEMA)
        return entries.groupBy("name", "alias").agg(F.max_by("version", "sequence").alias("version"))

    def register(
        self,
        name: str,
        model: PipelineModel,
        example: DataFrame,
        *,
        features: list[str],
        source_sha256: str | None = None,
        study: str | None = None,
        trial: int | None = None,
        preprocessing: str | None = None,
        parameters: Mapping[str, str] | None = None,
        test_metrics: Mapping[str, float] | None = None,
    ) -> int:
        """Save the pipeline as the next version, with signature and example rows."""
        # A number that two runs took at once is used by neither: both find the clash after they append.
        version = (self._table("versions", VERSION_SCHEMA).where(F.col("name") == name).agg(F.max("version")).first()[0] or 0) + 1
        path = f"{self.root}/models/{name}/version={version}-{uuid.uuid4().hex}"
        model.write().save(path)
        sample = example.select(*features).limit(5)
        rows = [
            (
                name,
                version,
                path,
                uuid.uuid4().hex,
                source_sha256,
                study,
                trial,
                preprocessing,
                dict(parameters or {}),
                {key: float(value) for key, value in (test_metrics or {}).items()},
                features,
                sample.schema.simpleString(),
                [row[0] for row in sample.select(_row_json(sample)).collect()],  # at most 5 rows
            )
        ]
        self.spark.createDataFrame(rows, VERSION_SCHEMA).write.mode("append").parquet(f"{self.root}/versions")
        same = self.versions().where((F.col("name") == name) & (F.col("version") == version))
        if same.count() > 1:
            raise ContractError(f"another run registered version {version} of {name} at the same time; register again")
        return version

    def set_alias(self, name: str, alias: str, version: int) -> None:
        """Point an alias at an existing version; older entries stay."""
        self._single(name, version)
        last = self._table("aliases", ALIAS_SCHEMA).agg(F.max("sequence")).first()[0] or 0
        entry = [(name, alias, version, last + 1)]
        self.spark.createDataFrame(entry, ALIAS_SCHEMA).write.mode("append").parquet(f"{self.root}/aliases")

    def describe(self, name: str, alias: str) -> DataFrame:
        """Lineage, parameters, metrics and features of the model behind an alias."""
        current = self.aliases().where((F.col("name") == name) & (F.col("alias") == alias))
        return self.versions().join(current, ["name", "version"])

    def load(self, name: str, alias: str) -> PipelineModel:
        row = self.describe(name, alias).select("model_path").first()
        if row is None:
            raise ContractError(f"{name} has no model with alias {alias}")
        return PipelineModel.load(row["model_path"])

    def promote(self, name: str, alias: str, version: int, probe: DataFrame) -> None:
        """Flip an alias only after the saved version loads and scores a row.

        The previous version stays on storage, so a failing one changes nothing.
        """
        row = self._single(name, version)
        PipelineModel.load(row["model_path"]).transform(probe.limit(1)).collect()
        self.set_alias(name, alias, version)


def parse_descriptors(df: DataFrame, text: str) -> DataFrame:
    """Typed model descriptors; ``problem`` names what makes one unusable."""
    body = F.from_json(F.col(text), DESCRIPTOR_SCHEMA, {"mode": "PERMISSIVE"})
    parsed = df.withColumn("__body", body).withColumn("__model", F.get_json_object(F.col(text), "$.model"))
    model = F.col("__body.model")
    bad_map = F.lit(False)
    for name, value in (("parameters", model["parameters"]), ("test_metrics", model["test_metrics"])):
        given = F.get_json_object(F.col(text), f"$.model.{name}")
        bad_map = bad_map | (given.isNotNull() & value.isNull())
    problem = (
        F.when(F.col("__body.schema_version").isNull() | (F.col("__body.schema_version") != 1), F.lit("schema_version"))
        .when(F.col("__model").isNull() | ~F.col("__model").startswith("{"), F.lit("model"))
        .when(model["model_uri"].isNull(), F.lit("model_uri"))
        .when(bad_map, F.lit("mapping"))
    )
    empty_text = F.create_map().cast("map<string,string>")
    empty_number = F.create_map().cast("map<string,double>")
    return parsed.select(
        *df.columns,
        problem.alias("problem"),
        model["model_uri"].alias("model_uri"),
        *[
            model[name].alias(name)
            for name in (
                "model_name", "model_version", "model_alias", "run_id", "git_commit", "source_sha256",
                "study", "preprocessing",
            )
        ],
        model["trial"].try_cast("bigint").alias("trial"),
        F.coalesce(model["parameters"], empty_text).alias("parameters"),
        F.coalesce(model["test_metrics"], empty_number).alias("test_metrics"),
    )


def descriptor_text(row) -> str:
    """Descriptor sidecar of a described model as JSON with sorted keys."""
    model = {
        "model_uri": row["model_path"],
        "model_name": row["name"],
        "model_version": str(row["version"]),
        "model_alias": row["alias"],
        "run_id": row["run_id"],
        "source_sha256": row["source_sha256"],
        "study": row["study"],
        "trial": row["trial"],
        "preprocessing": row["preprocessing"],
        "parameters": row["parameters"],
        "test_metrics": row["test_metrics"],
    }
    return json.dumps({"schema_version": 1, "model": model}, indent=2, sort_keys=True) + "\n"
