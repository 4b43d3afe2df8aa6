"""Run ledger (G1-G3, G5, G7, G8): runs recorded in ordinary append-only tables.

Views over one append-only record table (Parquet, partitioned by kind):

* ``runs(run_id, parent_id, name, stage, status, start_ts, end_ts, model_type,
  feature_run_id, split_seed, test_size, version)`` — a run is re-appended when
  it ends; the current state is the row with the highest ``version``;
* ``params(run_id, key, value)``; ``metrics(run_id, key, value, ts, step)``;
* ``artifacts(run_id, path, kind)``.

Each stage of a workflow is its own run with ``parent_id`` set, so a stage tag
is never overwritten, and lookups only consider ``FINISHED`` runs.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import file_system, hadoop_path, input_bytes, local_table

COMPACT_BYTES = 64 << 20  # of record files go to one compacted file
RUNS_SCHEMA = ("run_id string, parent_id string, name string, stage string, status string, "
               "start_ts timestamp, end_ts timestamp, model_type string, feature_run_id string, "
               "split_seed bigint, test_size double, version bigint")
FINISHED, RUNNING, FAILED = "FINISHED", "RUNNING", "FAILED"


def current_runs(runs: DataFrame) -> DataFrame:
    """Latest version of every run (one row per ``run_id``)."""
    if "version" not in runs.columns:
        return runs
    latest = runs.groupBy("run_id").agg(F.max_by(F.struct(*runs.columns), F.col("version")).alias("r"))
    return latest.select("r.*")


def latest_by_stage(runs: DataFrame, stage: str | None = None, status: str | None = FINISHED) -> DataFrame:
    """G1: newest run per stage (ties by run id); only ``status`` runs when given."""
    cur = current_runs(runs)
    if status is not None and "status" in cur.columns:
        cur = cur.where(F.col("status") == status)
    if stage is not None:
        cur = cur.where(F.col("stage") == stage)
    best = cur.groupBy("stage").agg(
        F.max_by(F.struct(*cur.columns), F.struct("start_ts", "run_id")).alias("r"))
    return best.select("r.*")


def get_run(runs: DataFrame, run_id: str) -> DataFrame:
    """One run by id (empty if unknown)."""
    return current_runs(runs).where(F.col("run_id") == run_id)


def lineage(runs: DataFrame) -> DataFrame:
    """Model runs joined to the feature runs they were trained from."""
    cur = current_runs(runs)
    f = cur.select(F.col("run_id").alias("feature_run_id"), F.col("name").alias("feature_run_name"),
                   F.col("start_ts").alias("feature_start_ts"))
    return cur.where(F.col("feature_run_id").isNotNull()).join(f, "feature_run_id", "left")


def workflow_summary(runs: DataFrame) -> DataFrame:
    """``parent_id`` x stage -> newest run id of that stage under the parent."""
    cur = current_runs(runs).where(F.col("parent_id").isNotNull())
    return (cur.groupBy("parent_id").pivot("stage")
            .agg(F.max_by("run_id", F.struct("start_ts", "run_id"))))


def compare_runs(metrics: DataFrame) -> DataFrame:
    """``run_id`` x metric key -> last logged value (by ``ts``, then ``step``)."""
    return (metrics.groupBy("run_id").pivot("key")
            .agg(F.max_by("value", F.struct("ts", "step"))))


RECORD_SCHEMA = ("kind string, run_id string, parent_id string, name string, stage string, status string, "
                 "start_ts timestamp, end_ts timestamp, model_type string, feature_run_id string, "
                 "split_seed bigint, test_size double, version bigint, key string, value string, "
                 "num double, ts timestamp, step bigint, path string")
_RUN_COLS = ["run_id", "parent_id", "name", "stage", "status", "start_ts", "end_ts", "model_type",
             "feature_run_id", "split_seed", "test_size", "version"]


class Ledger:
    """Append-only run records under ``root`` (a shared folder on a cluster).

    One Parquet table partitioned by ``kind`` (run / param / metric / artifact)
    backs the four ledger views.  Params, metrics and artifacts are buffered and
    written with the run's final row, so a run costs two small writes (start and
    end) and a crashed run stays visible as ``RUNNING``.  ``defer=True`` (used by
    a workflow for its stages) keeps everything in memory until ``flush()``.
    """

    def __init__(self, spark: SparkSession, root: str, defer: bool = False):
        self.spark, self.root, self.defer = spark, root, defer
        self._buf: list[tuple] = []
        self._open: dict[str, dict] = {}
        self._known: dict[str, dict] = {}  # latest state of runs written by this instance

    def _path(self, name: str) -> str:
        return os.path.join(self.root, name)

    @staticmethod
    def _record(kind, run_id, **f):
        return (kind, run_id, f.get("parent_id"), f.get("name"), f.get("stage"), f.get("status"),
                f.get("start_ts"), f.get("end_ts"), f.get("model_type"), f.get("feature_run_id"),
                f.get("split_seed"), f.get("test_size"), f.get("version"), f.get("key"), f.get("value"),
                f.get("num"), f.get("ts"), f.get("step"), f.get("path"))

    def flush(self) -> None:
        if not self._buf:
            return
        rows, self._buf = self._buf, []
        (local_table(self.spark, rows, RECORD_SCHEMA).coalesce(1).write.mode("append")
         .partitionBy("kind").parquet(self._path("records")))

    def _records(self, kind: str) -> DataFrame:
        self.flush()
        return self._all().where(F.col("kind") == kind)

    def _all(self) -> DataFrame:
        """All records: the compacted ones of the newest manifest and the files appended since."""
        manifest = self._manifest()
        if manifest is None:
            return self.spark.read.parquet(self._path("records"))
        return self._read(manifest, self._files())

    def _read(self, manifest: dict | None, files: list[str]) -> DataFrame:
        """The manifest's records and those of the files that it does not cover."""
        read = self.spark.read.schema(RECORD_SCHEMA)
        covered = set(manifest["covered"]) if manifest else set()
        new = [self._path(os.path.join("records", f)) for f in files if f not in covered]
        parts = [read.parquet(self._path(manifest["base"]))] if manifest else []
        if new:
            parts.append(self.spark.read.schema(RECORD_SCHEMA).option("basePath", self._path("records")).parquet(*new))
        names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
        out = self.spark.createDataFrame([], RECORD_SCHEMA) if not parts else parts[0].select(names)
        for p in parts[1:]:
            out = out.unionByName(p.select(names))
        return out

    # compaction --------------------------------------------------------------
    def _fs(self):
        return file_system(self.spark, self.root), lambda p: hadoop_path(self.spark, p)

    def _files(self) -> list[str]:
        """Committed record files, relative to the records folder."""
        return sorted(self._listed())

    def _listed(self) -> dict[str, int]:
        """The committed record files, and their bytes."""
        fs, path = self._fs()
        found = fs.globStatus(path(self._path("records/kind=*/part-*.parquet"))) or []
        return {"/".join(str(f.getPath()).rsplit("/", 2)[-2:]): f.getLen() for f in found}

    def _manifest(self) -> dict | None:
        fs, path = self._fs()
        found = sorted(str(f.getPath()) for f in fs.globStatus(path(self._path("manifest-*.json"))) or [])
        if not found:
            return None
        return json.loads("".join(r[0] for r in self.spark.read.text(found[-1], wholetext=True).collect()))

    def compact(self, files: int | None = None) -> None:
        """Rewrite all records as about ``files`` files per kind; views stay the same, also for readers and writers at work.

        By default a file takes ``COMPACT_BYTES`` of the files it replaces, so that no task holds more.  Rows
        go to files by ranges of their run, and within a run of their key and step.

        The records of exactly the files seen now go to a new folder, and a manifest that names the folder
        and those files is put in place by one rename (the newest manifest counts).  Files appended
        meanwhile are not named, so they are read as before.  Old files stay until ``vacuum``.  One
        compaction may run at a time.
        """
        self.flush()
        listed, old = self._listed(), self._manifest()
        seen = sorted(listed)
        if files is None:
            covered = set(old["covered"]) if old else set()
            size = sum(n for f, n in listed.items() if f not in covered)
            size += input_bytes(self.spark, self._path(old["base"])) if old else 0
            files = max(1, -(-size // COMPACT_BYTES))
        base = f"compact-{uuid.uuid4().hex[:12]}"
        records = self._read(old, seen)
        parts = records.repartitionByRange(files, "kind", "run_id", "key", "step") if files > 1 else records.repartition(1)
        parts.sortWithinPartitions("kind", "run_id").write.partitionBy("kind").parquet(self._path(base))
        fs, path = self._fs()
        number = (old["number"] if old else 0) + 1
        part, final = (path(self._path(n)) for n in (f"part-{uuid.uuid4().hex}", f"manifest-{number:08d}.json"))
        out = fs.create(part, True)
        out.write(bytearray(json.dumps({"number": number, "base": base, "covered": seen}).encode()))
        out.close()
        if not fs.rename(part, final):
            raise RuntimeError(f"could not put {final} in place")

    def vacuum(self) -> int:
        """Delete the record files and folders that the newest manifest replaces; no reader of an older one may be at work."""
        manifest = self._manifest()
        if manifest is None:
            return 0
        fs, path = self._fs()
        gone = [path(self._path(os.path.join("records", f))) for f in manifest["covered"]]
        gone += [f.getPath() for f in fs.globStatus(path(self._path("compact-*"))) or []
                 if not str(f.getPath()).endswith(manifest["base"])]
        gone += [f.getPath() for f in fs.globStatus(path(self._path("manifest-*.json"))) or []
                 if not str(f.getPath()).endswith(f"manifest-{manifest['number']:08d}.json")]
        return sum(bool(fs.exists(p) and fs.delete(p, True)) for p in gone)

    # Writers ------------------------------------------------------------
    def start_run(self, stage: str, name: str | None = None, parent_id: str | None = None,
                  **fields) -> str:
        run_id = uuid.uuid4().hex
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        run = {"run_id": run_id, "parent_id": parent_id, "name": name or f"run_{now:%Y%m%d_%H%M%S}",
               "stage": stage, "status": RUNNING, "start_ts": now, "end_ts": None, "version": 0,
               "model_type": fields.get("model_type"), "feature_run_id": fields.get("feature_run_id"),
               "split_seed": fields.get("split_seed"),
               "test_size": float(fields["test_size"]) if fields.get("test_size") is not None else None}
        self._open[run_id] = run
        self._known[run_id] = run
        self._buf.append(self._record("run", **run))
        if not self.defer:
            self.flush()
        return run_id

    def end_run(self, run_id: str, status: str = FINISHED, **fields) -> None:
        run = self._open.pop(run_id, None)
        if run is None:
            r = get_run(self.runs(), run_id).first()
            if r is None:
                raise KeyError(f"unknown run {run_id}")
            run = r.asDict()
        run = {**run, **{k: v for k, v in fields.items() if k in _RUN_COLS}}
        run.update(status=status, end_ts=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
                   version=run["version"] + 1)
        self._known[run_id] = run
        self._buf.append(self._record("run", **run))
        if not self.defer:
            self.flush()

    def run_row(self, run_id: str) -> dict | None:
        """Current state of one run: from this instance's memory, else from the table."""
        if run_id in self._known:
            return dict(self._known[run_id])
        r = get_run(self.runs(), run_id).first()
        return r.asDict() if r is not None else None

    def log_params(self, run_id: str, params: Mapping[str, object]) -> None:
        self._buf += [self._record("param", run_id, key=str(k), value=str(v)) for k, v in params.items()]

    def log_metrics(self, run_id: str, metrics: Mapping[str, float], step: int = 0) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self._buf += [self._record("metric", run_id, key=str(k), num=float(v) if v is not None else None,
                                   ts=now, step=step) for k, v in metrics.items()]

    def log_artifact(self, run_id: str, path: str | None, kind: str, content: str | None = None) -> None:
        """Record an artifact: a file/folder ``path`` (tables, Spark ML models) or, for small
        JSON documents (statistics, coefficients, metrics), the ``content`` inline."""
        self._buf.append(self._record("artifact", run_id, path=path, key=kind, value=content))

    def artifact_text(self, run_id: str, kind: str) -> str | None:
        """Inline content of a small artifact (from this instance's buffer, else the table)."""
        for rec in reversed(self._buf):
            if rec[0] == "artifact" and rec[1] == run_id and rec[13] == kind:
                return rec[14]
        rows = (self.artifacts().where((F.col("run_id") == run_id) & (F.col("kind") == kind))
                .select("content").limit(1).collect())
        return rows[0]["content"] if rows else None

    def param(self, run_id: str, key: str) -> str | None:
        """One parameter of a run (from this instance's buffer, else the table)."""
        for rec in reversed(self._buf):
            if rec[0] == "param" and rec[1] == run_id and rec[13] == key:
                return rec[14]
        rows = (self.params().where((F.col("run_id") == run_id) & (F.col("key") == key))
                .select("value").limit(1).collect())
        return rows[0]["value"] if rows else None

    def artifact_dir(self, run_id: str) -> str:
        return self._path(os.path.join("artifact_store", run_id))

    # views --------------------------------------------------------------------
    def runs(self) -> DataFrame:
        return self._records("run").select(*_RUN_COLS)

    def params(self) -> DataFrame:
        return self._records("param").select("run_id", "key", "value")

    def metrics(self) -> DataFrame:
        return self._records("metric").select("run_id", "key", F.col("num").alias("value"), "ts", "step")

    def artifacts(self) -> DataFrame:
        return self._records("artifact").select("run_id", "path", F.col("key").alias("kind"),
                                                F.col("value").alias("content"))

    def latest_run(self, stage: str):
        """Newest finished run of a stage as a Row, or None (G1)."""
        try:
            return latest_by_stage(self.runs(), stage).first()
        except Exception as e:  # no ledger yet
            if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
                return None
            raise

    def artifact_path(self, run_id: str, kind: str) -> str | None:
        for rec in self._buf:
            if rec[0] == "artifact" and rec[1] == run_id and rec[13] == kind:
                return rec[18]
        rows = (self.artifacts().where((F.col("run_id") == run_id) & (F.col("kind") == kind))
                .select("path").limit(1).collect())
        return rows[0]["path"] if rows else None


__all__ = ["Ledger", "latest_by_stage", "get_run", "lineage", "workflow_summary", "compare_runs",
           "current_runs"]
