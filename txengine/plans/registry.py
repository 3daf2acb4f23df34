"""Model registry: named, versioned fitted pipelines (the reference's registry step).

Re-aimed for Spark: a registry is a folder in the shared filesystem holding one saved
``PipelineModel`` per (name, version) and a Parquet table of entries
``(name, version, path, created_at, params, train_rows)``. "Deploy and predict" is a
batch (or streaming, see ``txengine.streaming``) scoring job over a DataFrame; no
service endpoint is started.

Writers may run at the same time. A version belongs to the one writer that creates its claim,
which the file system grants once; deployments are numbered by claims of the same kind, so the
newest is the one with the highest number, whatever the writers' clocks say. A writer that dies
between claim and entry leaves a version that cannot be used; register under the next one.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txengine.session import shared_dir

ENTRY_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("version", T.StringType(), False),
        T.StructField("path", T.StringType(), False),
        T.StructField("created_at", T.TimestampNTZType(), False),
        T.StructField("params", T.StringType(), True),
        T.StructField("train_rows", T.LongType(), True),
    ]
)


DEPLOYMENT_SCHEMA = T.StructType(
    [
        T.StructField("deployment", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("version", T.StringType(), False),
        T.StructField("deployed_at", T.TimestampNTZType(), False),
        T.StructField("number", T.LongType(), False),
    ]
)


def claim(spark: SparkSession, path: str) -> bool:
    """Create ``path`` if nothing is there; true for exactly one of all that try."""
    where = urlparse(path)
    if where.scheme in ("", "file"):
        # local file systems create a folder atomically, Hadoop's local client does not create files so
        local = unquote(where.path)
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            os.mkdir(local)
        except FileExistsError:
            return False
        return True
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        store.create(hadoop, False).close()
    except Exception as e:  # noqa: BLE001  the store's own classes differ; what counts is below
        if store.exists(hadoop):
            return False
        raise e
    return True


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class ModelRegistry:
    def __init__(self, spark: SparkSession, base_path: str | None = None):
        self.spark = spark
        self.base = (base_path or f"{shared_dir(spark).rstrip('/')}/model_registry").rstrip("/")
        self.entries_path = f"{self.base}/_entries"
        self.deployments_path = f"{self.base}/_deployments"

    @classmethod
    def create(cls, spark: SparkSession, base_path: str | None = None) -> "ModelRegistry":
        """Create the registry if it does not exist (an empty entries table)."""
        reg = cls(spark, base_path)
        for path, schema in ((reg.entries_path, ENTRY_SCHEMA), (reg.deployments_path, DEPLOYMENT_SCHEMA)):
            spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/none")
        return reg

    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)

    def _append(self, path: str, schema: T.StructType, row: tuple) -> None:
        """Every row is a folder of its own: jobs that write to one folder at the same time would
        clear each other's unfinished files."""
        self.spark.createDataFrame([row], schema).coalesce(1).write.parquet(f"{path}/{uuid.uuid4().hex}")

    def list_models(self) -> DataFrame:
        return self._read(self.entries_path, ENTRY_SCHEMA)

    def _entry(self, name: str, version: str):
        rows = (
            self.list_models()
            .filter((F.col("name") == name) & (F.col("version") == version))
            .limit(1)
            .collect()
        )
        return rows[0] if rows else None

    def log_model(
        self,
        name: str,
        version: str,
        model: PipelineModel,
        params: dict | None = None,
        train_rows: int | None = None,
    ) -> "ModelRef":
        """Save the model under ``base/name/version`` and append its entry. An existing
        (name, version) is refused: versions are immutable."""
        self.refuse_existing(name, version)
        if not claim(self.spark, f"{self.base}/_claims/models/{name}/{version}"):
            raise ValueError(f"model {name} version {version} is being registered by another writer")
        path = f"{self.base}/{name}/{version}"
        model.write().save(path)
        row = (name, version, path, _now(), json.dumps(params or {}), train_rows)
        self._append(self.entries_path, ENTRY_SCHEMA, row)
        return ModelRef(self, name, version)

    def refuse_existing(self, name: str, version: str) -> None:
        if self._entry(name, version) is not None:
            raise ValueError(f"model {name} version {version} already registered")

    def deploy(self, deployment: str, name: str, version: str) -> None:
        """Make a registered version answer under ``deployment``; deploying another version
        under the same name replaces it. The deployment gets the next free number."""
        self.get(name, version)
        number = self._deployments(deployment).agg(F.coalesce(F.max("number"), F.lit(0))).first()[0] + 1
        while not claim(self.spark, f"{self.base}/_claims/deployments/{deployment}/{number}"):
            number += 1
        row = (deployment, name, version, _now(), number)
        self._append(self.deployments_path, DEPLOYMENT_SCHEMA, row)

    def _deployments(self, deployment: str) -> DataFrame:
        return self._read(self.deployments_path, DEPLOYMENT_SCHEMA).filter(F.col("deployment") == deployment)

    def deployed(self, deployment: str) -> "ModelRef":
        last = self._deployments(deployment).orderBy(F.desc("number")).first()
        if last is None:
            raise KeyError(f"nothing is deployed as {deployment}")
        return ModelRef(self, last["name"], last["version"])

    def predict(self, deployment: str, df: DataFrame) -> DataFrame:
        """Batch scoring with the version deployed under this name."""
        return self.deployed(deployment).predict(df)

    def get(self, name: str, version: str) -> "ModelRef":
        if self._entry(name, version) is None:
            raise KeyError(f"model {name} version {version} not registered")
        return ModelRef(self, name, version)


class ModelRef:
    def __init__(self, registry: ModelRegistry, name: str, version: str):
        self.registry, self.name, self.version = registry, name, version

    @property
    def path(self) -> str:
        return f"{self.registry.base}/{self.name}/{self.version}"

    def load(self) -> PipelineModel:
        return PipelineModel.load(self.path)

    def deploy(self, source_path: str, sink_path: str, schema, **options):
        """Permanent deployment: a streaming job scoring every file that lands in
        ``source_path`` into ``sink_path`` (see ``txengine.streaming.scoring.deploy``)."""
        from txengine.streaming.scoring import deploy

        return deploy(self.registry.spark, self, source_path, sink_path, schema, **options)

    def predict(self, df: DataFrame) -> DataFrame:
        """Batch scoring with the registered model (deploy + predict, as a Spark job)."""
        from txengine.plans.models import _finish

        model = self.load()
        # the pipeline's own column: ``df`` may carry predictions of other models
        suffix = model.stages[-1].getPredictionCol().split("_", 1)[1]
        return _finish(model.transform(df), suffix)
