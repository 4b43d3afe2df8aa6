from __future__ import annotations

import os

from pyspark.sql import functions as F

from sparktab.operators.ledger import Ledger, compare_runs, latest_by_stage
from sparktab.session import local_table
from sparktab.operators import ledger as L


def _append(spark, root, first, n, files):
    """Records of runs as many small files, as separate jobs append them."""
    rows = []
    for i in range(first, first + n):
        rows.append(Ledger._record("run", f"r{i:05d}", stage="training", status="FINISHED", version=1, model_type="gbt"))
        rows.append(Ledger._record("metric", f"r{i:05d}", key="mae", num=float(i), step=0))
    local_table(spark, rows, L.RECORD_SCHEMA).repartition(files).write.mode("append").partitionBy("kind").parquet(
        os.path.join(root, "records"))


def _views(ledger):
    runs = sorted(map(tuple, ledger.runs().select("run_id", "stage", "version").collect()))
    return runs, sorted(map(tuple, compare_runs(ledger.metrics()).collect()))


def test_a_thousand_runs_in_few_files(spark, scratch):
    root = os.path.join(scratch, "ledger")
    _append(spark, root, 0, 1000, 40)
    ledger = Ledger(spark, root)
    before = _views(ledger)
    held = ledger.runs()  # a reader that began before
    ledger.compact()
    assert _views(ledger) == before and len(before[0]) == 1000
    assert held.count() == 1000
    manifest = ledger._manifest()
    files = [f for _, _, fs in os.walk(os.path.join(root, manifest["base"])) for f in fs if f.endswith(".parquet")]
    assert len(files) <= 4
    assert ledger.vacuum() > 0 and _views(ledger) == before and not ledger._files()


def test_appends_during_and_after_compaction(spark, scratch, monkeypatch):
    root = os.path.join(scratch, "ledger")
    _append(spark, root, 0, 20, 3)
    ledger = Ledger(spark, root)
    read = Ledger._read

    def late(self, manifest, files):  # another job appends after the files were listed
        out = read(self, manifest, files)
        if not late.done:
            late.done = True
            _append(spark, root, 20, 5, 2)
        return out

    late.done = False
    monkeypatch.setattr(Ledger, "_read", late)
    ledger.compact()
    monkeypatch.setattr(Ledger, "_read", read)
    assert len(_views(ledger)[0]) == 25
    own = Ledger(spark, root)
    rid = own.start_run("training")
    own.log_metrics(rid, {"mae": 1.0})
    own.end_run(rid)
    assert len(_views(ledger)[0]) == 27  # two versions of the new run
    ledger.compact()
    ledger.vacuum()
    assert len(_views(ledger)[0]) == 27 and ledger._manifest()["number"] == 2
    assert latest_by_stage(ledger.runs(), "training").first()["run_id"] == rid
    assert ledger.run_row("r00003")["status"] == "FINISHED" and ledger.param("r00003", "x") is None


def test_empty_ledger(spark, scratch):
    ledger = Ledger(spark, os.path.join(scratch, "none"))
    assert ledger.latest_run("training") is None and ledger.vacuum() == 0
    ledger.compact()
    assert ledger.runs().count() == 0 and ledger.latest_run("training") is None
    ledger.start_run("training")
    assert Ledger(spark, ledger.root).runs().where(F.col("stage") == "training").count() == 1


def test_compaction_makes_files_of_bounded_size(spark, scratch, monkeypatch):
    """One task held all records of a kind; a run with many records is divided too."""
    monkeypatch.setattr(L, "COMPACT_BYTES", 5_000)
    root = os.path.join(scratch, "ledger")
    rows = [Ledger._record("metric", "hot", key=f"m{i % 7}", num=float(i), step=i) for i in range(4000)]
    rows += [Ledger._record("run", f"r{i:05d}", stage="training", status="FINISHED", version=1) for i in range(1000)]
    local_table(spark, rows, L.RECORD_SCHEMA).repartition(8).write.partitionBy("kind").parquet(os.path.join(root, "records"))
    ledger = Ledger(spark, root)
    before = _views(ledger)
    ledger.compact()
    ledger.vacuum()
    assert _views(ledger) == before
    sizes = [r["count"] for r in ledger._all().groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 5000 and max(sizes) < 2500
