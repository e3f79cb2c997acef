"""Model registry as append-only tables, and its reconciliation with the live models.

Nothing is updated in place: versions, default pointers and removals are rows with a time, and
readers take the latest. A job that dies half-way leaves earlier rows as they were.

Writers are ordered by a log of numbered entries, of which each can be created only once. A writer
reads the log, refuses what it finds taken, and tries to create the next entry; where another writer
was faster it reads on and tries again. So of two writers of one version one wins and the other is
refused, and neither touches the other's saved model. A version whose writer died stays taken.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.plans.model import TrainedModel

VERSIONS = (
    "model_name string, version string, model_id string, run_id string, algorithm string, task string, "
    "target string, classes array<string>, threshold double, comment string, signature string, "
    "metrics map<string,double>, tags map<string,string>, path string, created_at timestamp"
)
DEFAULTS = "model_name string, version string, set_at timestamp"
REMOVALS = "model_name string, version string, removed_at timestamp"
# Tag names, and what stands for "all versions" in a clean-up list.
APPLICATION_TAG, PROJECT_TAG, MODEL_ID_TAG = "application", "project_key", "model_id"
PARENT_MODEL = "PARENT MODEL"


def default_versions(defaults: DataFrame) -> DataFrame:
    """The version each model's default pointer shows: the latest row wins."""
    return defaults.groupBy("model_name").agg(
        F.max_by("version", F.struct("set_at", "version")).alias("version")
    )


def current_versions(versions: DataFrame, removals: DataFrame) -> DataFrame:
    """Versions that no later removal covers, by themselves or with their whole model."""
    one = removals.groupBy("model_name", "version").agg(F.max("removed_at").alias("removed_at"))
    whole = one.where(F.col("version") == PARENT_MODEL).select("model_name", F.col("removed_at").alias("model_removed"))
    single = one.where(F.col("version") != PARENT_MODEL).withColumnRenamed("removed_at", "version_removed")
    kept = versions.join(whole, "model_name", "left").join(single, ["model_name", "version"], "left")
    alive = F.coalesce(F.col("created_at") > F.col("model_removed"), F.lit(True)) & F.coalesce(
        F.col("created_at") > F.col("version_removed"), F.lit(True)
    )
    return kept.where(alive).select(*versions.columns)


def stale_entries(versions: DataFrame, live: DataFrame, project_key: str) -> DataFrame:
    """Registry entries of a project whose model or version is no longer live: (name, version).

    ``versions`` has model_name, version, tags; ``live`` has model_id and version, the version
    null for a live model without versions. A model that is gone gives one row. Version names
    are compared without regard to letter case. Entries without both tags are not touched.
    """
    tagged = versions.select(
        "model_name",
        "version",
        F.col("tags")[PROJECT_TAG].alias("project"),
        F.col("tags")[MODEL_ID_TAG].alias("model_id"),
    ).where((F.col("project") == project_key) & F.col("model_id").isNotNull())
    live_versions = live.select("model_id", F.upper("version").alias("v")).distinct()
    live_models = live.select("model_id").distinct()
    gone_models = (
        tagged.select("model_name", "model_id").distinct().join(live_models, "model_id", "left_anti")
        .select(F.col("model_name").alias("name"), F.lit(PARENT_MODEL).alias("version"))
    )
    gone_versions = (
        tagged.join(live_models, "model_id", "left_semi")
        .withColumn("v", F.upper("version"))
        .join(live_versions, ["model_id", "v"], "left_anti")
        .select(F.col("model_name").alias("name"), "version")
    )
    return gone_models.unionByName(gone_versions)


class Registry:
    """Model versions below one folder on shared storage."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        for table, schema in (("versions", VERSIONS), ("defaults", DEFAULTS), ("removals", REMOVALS)):
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{table}")
            if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
                self._append(table, [], schema)

    def _read(self, table: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{self.path}/{table}")

    def _append(self, table: str, rows: Sequence[tuple], schema: str) -> None:
        self._add(table, self.spark.createDataFrame(rows, schema).coalesce(1))

    def _add(self, table: str, rows: DataFrame) -> None:
        """Each write has a folder of its own: writers that end at one time don't clear each other's drafts away."""
        rows.write.parquet(f"{self.path}/{table}/{uuid.uuid4().hex}")

    def versions(self) -> DataFrame:
        return current_versions(self._read("versions", VERSIONS), self._read("removals", REMOVALS))

    def defaults(self) -> DataFrame:
        pointers = default_versions(self._read("defaults", DEFAULTS))
        return pointers.join(self.versions().select("model_name", "version"), ["model_name", "version"], "left_semi")

    def register(
        self,
        model: TrainedModel,
        name: str,
        project_key: str,
        version: str,
        run_id: str,
        signature: str,
        metrics: dict[str, float],
        threshold: float = 0.5,
    ) -> str:
        """Save the model, add its version under ``<project>_<name>`` and make that the default."""
        full_name = f"{project_key}_{name}"
        known = self.versions().where(F.col("model_name") == full_name).select("model_id").first()
        model_id = known["model_id"] if known else uuid.uuid4().hex[:8]
        taken = self._read("versions", VERSIONS).where((F.col("model_name") == full_name) & (F.col("version") == version))
        if not taken.isEmpty() or self._taken(full_name, version):
            raise _exists(full_name, version)
        path = f"{self.path}/artifacts/{full_name}/{version}/{uuid.uuid4().hex}"
        model.save(self.spark, path)
        try:
            self._claim(full_name, version, path)
        except ValueError:
            self._delete(path)
            raise
        tags = {APPLICATION_TAG: "tabwright", PROJECT_TAG: project_key, MODEL_ID_TAG: model_id}
        comment = f"Project: {project_key}, Model: {name}"
        classes = [str(c) for c in model.classes]
        now = _now()
        row = (
            full_name, version, model_id, run_id, model.estimator.algorithm, model.task, model.target, classes,
            float(threshold), comment, signature, metrics, tags, path, now,
        )
        self._append("versions", [row], VERSIONS)
        self.set_default(full_name, version)
        return full_name

    # --- the log of writers

    def _file_system(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _entries(self) -> list[str]:
        """Names of the log's entries, in order."""
        folder, files = self._file_system(f"{self.path}/log")
        if not files.exists(folder):
            return []
        return sorted(name for name in (s.getPath().getName() for s in files.listStatus(folder)) if name.isdigit())

    def _entry(self, name: str) -> dict:
        return json.loads("".join(r[0] for r in self.spark.read.text(f"{self.path}/log/{name}").collect()))

    def _taken(self, model_name: str, version: str, read: dict[str, dict] | None = None) -> bool:
        """Whether the log names the version; ``read`` keeps the entries read so far."""
        read = {} if read is None else read
        for name in self._entries():
            if name not in read:
                read[name] = self._entry(name)
        return any(e["model_name"] == model_name and e["version"] == version for e in read.values())

    def _claim(self, model_name: str, version: str, path: str) -> int:
        """Create the log's next entry for the version; returns its number."""
        text = json.dumps({"model_name": model_name, "version": version, "path": path})
        read: dict[str, dict] = {}
        while True:
            if self._taken(model_name, version, read):
                raise _exists(model_name, version)
            number = int(max(read, default="0")) + 1
            if self._create_once(f"{self.path}/log/{number:020d}", text):
                return number

    def _create_once(self, path: str, text: str) -> bool:
        """Create a file with its content in one step; False if it is there already."""
        draft = f"{self.path}/log_drafts/{uuid.uuid4().hex}"
        target, files = self._file_system(path)
        source, _ = self._file_system(draft)
        for folder in (target.getParent(), source.getParent()):
            files.mkdirs(folder)
        stream = files.create(source, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            if files.getScheme() == "file":
                # a local rename would replace the other writer's entry, a link doesn't
                os.link(source.toUri().getPath(), target.toUri().getPath())
            else:
                options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
                context = self.spark._jvm.org.apache.hadoop.fs.FileContext
                context.getFileContext(files.getUri(), self.spark._jsc.hadoopConfiguration()).rename(source, target, options)
            return True
        except FileExistsError:
            return False
        except Py4JJavaError:
            if files.exists(target):
                return False
            raise
        finally:
            files.delete(source, False)

    def _delete(self, path: str) -> None:
        """Remove a folder of this registry, on whatever file system it is."""
        if not path.startswith(f"{self.path}/artifacts/"):
            raise ValueError(f"{path} is no model of the registry at {self.path}")
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def set_default(self, model_name: str, version: str) -> None:
        self._append("defaults", [(model_name, version, _now())], DEFAULTS)

    def find(self, model_name: str, version: str | None = None) -> dict:
        """The row of a version (default: the model's default version)."""
        if version is None:
            pointer = self.defaults().where(F.col("model_name") == model_name).first()
            if pointer is None:
                raise LookupError(f"no default version of model {model_name!r}; was it trained and registered?")
            version = pointer["version"]
        row = (
            self.versions()
            .where((F.col("model_name") == model_name) & (F.col("version") == version))
            .orderBy(F.desc("created_at"))
            .first()
        )
        if row is None:
            raise LookupError(f"no version {version!r} of model {model_name!r}; was it trained and registered?")
        return row.asDict()

    def load(self, model_name: str, version: str | None = None) -> tuple[TrainedModel, dict]:
        row = self.find(model_name, version)
        return TrainedModel.load(self.spark, row["path"]), row

    def cleanup(self, live: DataFrame, project_key: str, perform_deletion: bool = False) -> DataFrame:
        """List entries whose model is gone; with ``perform_deletion`` also remove them and their saved models.

        Removal rows are written first. A job that dies before the files are gone leaves files that
        no version points to; the next removal of the same entries takes them away.
        """
        versions = self.versions()
        stale = stale_entries(versions, live, project_key)
        if not perform_deletion:
            return stale
        removed = stale.select(F.col("name").alias("model_name"), "version", F.lit(_now()).alias("removed_at"))
        batch = f"{self.path}/removal_batches/{uuid.uuid4().hex}"
        # the batch is written first and read back, so the list is the one that was removed
        removed.write.parquet(batch)
        written = self.spark.read.parquet(batch)
        named = written.select("model_name", F.col("version").alias("gone"))
        whole = F.col("gone") == PARENT_MODEL
        # one path per removed version
        paths = versions.join(named, "model_name").where(whole | (F.col("gone") == F.col("version"))).select("path").distinct().collect()
        self._add("removals", written)
        for row in paths:
            self._delete(row["path"])
        return written.select(F.col("model_name").alias("name"), "version")


def _exists(model_name: str, version: str) -> ValueError:
    return ValueError(f"version {version!r} of {model_name!r} exists; versions are never overwritten")


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)
