"""Run store (S9): a file-based tracking store read into ledger tables, and written.

Layout: ``<root>/<experiment>/<run>/meta.yaml`` (``key: value`` lines),
``params/<key>`` and ``tags/<key>`` (one value per file) and
``metrics/<key>`` (lines ``ts value step``); a key may hold spaces and, as folders, slashes.

Reading is a Python data source: the planner lists the run folders and deals them out,
``RUNS_PER_TASK`` to a partition; a task lists and reads the tiny files of its runs and
yields one row per value or line, with keys as they were written.  So a store of millions
of files is a few thousand tasks, and nothing but folder names passes the driver.  ``root``
must be reachable by pyarrow's file systems from every executor.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import ship_package

# Numeric run status codes of the store format.
STATUS = {"1": "RUNNING", "2": "SCHEDULED", "3": "FINISHED", "4": "FAILED", "5": "KILLED"}
KINDS = {"params": "param", "tags": "tag", "metrics": "metric"}  # folder and kind of row

RUN = re.compile(r"[0-9a-f]{32}")
RUNS_PER_TASK = 200
BATCH = 5_000
SCHEMA = "experiment string, run_id string, kind string, key string, line int, value string"


def file_system(path: str):
    """pyarrow's file system of a path or URI, and the path there."""
    from pyarrow import fs

    if path.startswith("file:"):  # with one slash or three
        path = "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class RunFolders(InputPartition):
    def __init__(self, folders: list[str]):
        super().__init__(folders)
        self.folders = folders


class RunStoreReader(DataSourceReader):
    def __init__(self, options):
        self.root, self.per = options["path"], int(options.get("runspertask", RUNS_PER_TASK))

    def partitions(self):
        from pyarrow.fs import FileSelector, FileType

        fs, root = file_system(self.root)
        folders = []
        for experiment in fs.get_file_info(FileSelector(root)):
            if experiment.type == FileType.Directory:
                folders += [f.path for f in fs.get_file_info(FileSelector(experiment.path))
                            if f.type == FileType.Directory and RUN.fullmatch(f.base_name)]
        folders.sort()
        return [RunFolders(folders[i:i + self.per]) for i in range(0, len(folders), self.per)] or [RunFolders([])]

    def read(self, partition):
        import pyarrow as pa
        from pyarrow.fs import FileSelector, FileType

        fs, _ = file_system(self.root)
        names, rows = [f.split()[0] for f in SCHEMA.split(", ")], []
        types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.string()]

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for folder in partition.folders:
            experiment, run_id = folder.rstrip("/").split("/")[-2:]
            for info in fs.get_file_info(FileSelector(folder, recursive=True)):
                if info.type != FileType.File:
                    continue
                kind, _, key = info.path[len(folder):].strip("/").partition("/")
                if kind == "meta.yaml" and not key:
                    kind, key = "meta", None
                elif kind not in KINDS or not key:
                    continue
                with fs.open_input_stream(info.path) as f:
                    text = f.read().decode("utf-8", "replace")
                lines = [text] if kind in ("params", "tags") else text.splitlines()
                for i, line in enumerate(lines):
                    name, value = key, line
                    if kind == "meta":
                        name, found, value = line.partition(":")
                        if not found:
                            continue
                    elif kind == "metrics" and not line.strip():
                        continue
                    rows.append((experiment, run_id, KINDS.get(kind, kind), name, i, value))
                    if len(rows) >= BATCH:
                        yield batch()
                        rows.clear()
        if rows:
            yield batch()


class RunStore(DataSource):
    @classmethod
    def name(cls):
        return "runstore"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return RunStoreReader(self.options)


def scan(spark: SparkSession, root: str, runs_per_task: int = RUNS_PER_TASK) -> DataFrame:
    """Every value and line of the store: experiment, run_id, kind (meta, param, tag, metric), key, line, value."""
    ship_package(spark)
    spark.dataSource.register(RunStore)
    return spark.read.format("runstore").option("runspertask", runs_per_task).load(root.rstrip("/"))


def read_run_store(spark: SparkSession, root: str, runs_per_task: int = RUNS_PER_TASK) -> dict[str, DataFrame]:
    """Return ``runs``, ``params``, ``metrics`` and ``tags`` tables (ledger shapes)."""
    every = scan(spark, root, runs_per_task)
    params = every.where("kind = 'param'").select("run_id", "key", "value")
    tags = every.where("kind = 'tag'").select("run_id", "key", "value")
    parts = F.split(F.trim("value"), " ")
    metrics = every.where("kind = 'metric'").select(
        "run_id", "key", parts[1].cast("double").alias("value"),
        F.timestamp_millis(parts[0].cast("bigint")).alias("ts"), F.get(parts, F.lit(2)).cast("bigint").alias("step"))

    # one pass over the small values that describe a run
    wanted = {"meta": ["run_name", "status", "start_time", "end_time"], "tag": ["stage", "mlflow.parentRunId"],
              "param": ["model_type", "random_state", "test_size"]}

    def value(kind, key):
        return F.first(F.when((F.col("kind") == kind) & (F.col("key") == key), F.trim("value")), True).alias(key.split(".")[-1])

    wide = every.where("kind <> 'metric'").groupBy("run_id").agg(
        F.max((F.col("kind") == "meta").cast("int")).alias("described"),
        *[value(kind, key) for kind, keys in wanted.items() for key in keys]).where("described = 1")
    status = F.create_map(*[x for k, v in STATUS.items() for x in (F.lit(k), F.lit(v))])
    ms = lambda c: F.when(F.col(c) != "null", F.timestamp_millis(F.col(c).cast("bigint")))
    runs = wide.select(
        "run_id", F.col("parentRunId").alias("parent_id"), F.col("run_name").alias("name"), "stage",
        F.element_at(status, F.col("status")).alias("status"), ms("start_time").alias("start_ts"),
        ms("end_time").alias("end_ts"), "model_type", F.lit(None).cast("string").alias("feature_run_id"),
        F.col("random_state").cast("bigint").alias("split_seed"), F.col("test_size").cast("double").alias("test_size"),
        F.lit(0).cast("bigint").alias("version"))
    return {"runs": runs, "params": params, "metrics": metrics, "tags": tags}


def write_run_store(values: DataFrame, root: str, experiment: str = "0") -> int:
    """Write rows (run_id, kind, key, line, value), as ``scan`` gives them, in the store's layout; the number of files.

    Each file is written whole by one task and appears by a rename, so a task that runs twice leaves one file.
    """
    folder_of = {v: k for k, v in KINDS.items()}
    if values.where(~F.col("run_id").rlike("^[0-9a-f]{32}$")).head(1):
        raise ValueError("run ids of a run store are 32 hexadecimal digits")
    text = F.when(F.col("kind") == "meta", F.concat("key", F.lit(": "), "value")).otherwise(F.col("value"))
    name = F.when(F.col("kind") == "meta", F.lit("meta.yaml")).otherwise(F.col("key"))
    lines = F.array_sort(F.collect_list(F.struct("line", text.alias("text"))))
    files = values.groupBy("run_id", "kind", name.alias("name")).agg(lines.alias("lines"))
    files = files.select("run_id", "kind", "name", F.array_join(F.transform("lines", lambda x: x["text"]), "\n").alias("text"))

    def run(batches):
        import uuid

        import pyarrow as pa

        fs, base = file_system(root)
        for b in batches:
            for run_id, kind, key, body in zip(*(c.to_pylist() for c in b.columns)):
                path = "/".join(p for p in (base.rstrip("/"), experiment, run_id, folder_of.get(kind), key) if p)
                fs.create_dir(os.path.dirname(path), recursive=True)
                # a part file stands beside the run folders, where no reader looks
                part = f"{base.rstrip('/')}/{experiment}/part-{uuid.uuid4().hex}"
                with fs.open_output_stream(part) as f:
                    f.write(body.encode())
                fs.move(part, path)
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])

    return files.mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0
