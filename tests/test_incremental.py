"""Runs that take new files only, and states that were left half written."""

import os
import shutil
import time

import pytest

from conftest import rows, write_tree
from logmetrics.operators import entries
from logmetrics.operators import timeline as T
from logmetrics.plans import incremental, jobs
from logmetrics.schemas import APP_TIMELINE
from logmetrics.sources import load_result, read_logs

FIRST = {
    "application_1_0001/container_1_0001_01_000001.log": ["17/03/29 10:00:00 INFO a.A: begin", "17/03/29 10:10:00 ERROR a.A: end"],
    "application_1_0002/container_1_0002_01_000001.log": ["17/03/29 10:05:00 INFO a.A: begin"],
    "application_1_0003/container_1_0003_01_000001.log": [],
    "plain.log": ["17/03/29 09:00:00 INFO a.A: of no application"],
}
SECOND = {
    "application_1_0001/container_1_0001_01_000002.log": ["17/03/29 09:55:00 INFO a.A: earlier"],
    "application_2_0001/container_2_0001_01_000001.log": ["17/03/30 10:00:00 INFO a.A: only"],
}


def full(spark, root):
    return rows(T.app_timeline(entries.parse_entries(read_logs(spark, root), anchored=False)), "application_id")


def kept(spark, ledger):
    return rows(incremental.timeline(spark, ledger), "application_id")


def test_two_batches_equal_a_full_run(spark, tmp_path):
    root, ledger = write_tree(tmp_path / "in", FIRST), str(tmp_path / "ledger")
    assert incremental.timeline(spark, ledger).collect() == []
    assert incremental.take_new_files(spark, root, ledger) == 3  # an empty file is not listed
    assert kept(spark, ledger) == full(spark, root)
    write_tree(tmp_path / "in", SECOND)
    assert incremental.take_new_files(spark, root, ledger) == 2
    assert kept(spark, ledger) == full(spark, root)
    assert incremental.take_new_files(spark, root, ledger) == 0
    assert len(list((tmp_path / "ledger").glob("batch-*"))) == 2


def test_a_file_that_grew_is_taken_again(spark, tmp_path):
    root, ledger = write_tree(tmp_path / "in", FIRST), str(tmp_path / "ledger")
    incremental.take_new_files(spark, root, ledger)
    with open(f"{root}/application_1_0002/container_1_0002_01_000001.log", "a") as f:
        f.write("17/03/29 11:00:00 INFO a.A: more\n")
    assert incremental.take_new_files(spark, root, ledger) == 1
    assert kept(spark, ledger) == full(spark, root)
    state = {r.file_path.rsplit("/", 1)[1]: (r.lines, r.batch) for r in incremental.file_states(spark, ledger).collect()}
    assert state["container_1_0002_01_000001.log"] == (2, 2) and state["plain.log"] == (1, 1)


def test_an_old_file_that_comes_late(spark, tmp_path):
    """Its time of modification lies before that of files already read."""
    root, ledger = write_tree(tmp_path / "in", FIRST), str(tmp_path / "ledger")
    incremental.take_new_files(spark, root, ledger)
    write_tree(tmp_path / "in", SECOND)
    for name in SECOND:
        os.utime(f"{root}/{name}", (time.time() - 86_400, time.time() - 86_400))
    assert incremental.take_new_files(spark, root, ledger) == 2
    assert kept(spark, ledger) == full(spark, root)


def test_a_broken_write_is_passed_over_and_taken_again(spark, tmp_path):
    root, ledger = write_tree(tmp_path / "in", FIRST), str(tmp_path / "ledger")
    incremental.take_new_files(spark, root, ledger)
    before = kept(spark, ledger)
    write_tree(tmp_path / "in", SECOND)
    incremental.take_new_files(spark, root, ledger)
    os.remove(f"{ledger}/batch-000002/_SUCCESS")  # as if the run had ended before its last file was there
    assert kept(spark, ledger) == before
    assert incremental.take_new_files(spark, root, ledger) == 2
    assert kept(spark, ledger) == full(spark, root)
    assert (tmp_path / "ledger" / "batch-000003" / "_SUCCESS").exists()


def test_compacting(spark, tmp_path):
    root, ledger = write_tree(tmp_path / "in", FIRST), str(tmp_path / "ledger")
    incremental.take_new_files(spark, root, ledger)
    write_tree(tmp_path / "in", SECOND)
    incremental.take_new_files(spark, root, ledger)
    incremental.compact(spark, ledger)
    assert [p.name for p in (tmp_path / "ledger").glob("batch-*")] == ["batch-000003"]
    assert kept(spark, ledger) == full(spark, root) and incremental.take_new_files(spark, root, ledger) == 0


def test_only_files_since_the_oldest_new_one_are_opened(spark, tmp_path):
    root = write_tree(tmp_path, FIRST)
    old = f"{root}/plain.log"
    os.utime(old, (1_500_000_000, 1_500_000_000))
    got = {r.file_path.rsplit("/", 1)[1] for r in read_logs(spark, root, modified_after="2017-07-14T02:40:01").select("file_path").distinct().collect()}
    assert "plain.log" not in got and "container_1_0001_01_000001.log" in got
    assert read_logs(spark, root, modified_after="2017-07-14T02:40:00").filter("file_path like '%plain.log'").count() == 1


def test_a_result_without_its_mark_is_refused(spark, tmp_path):
    root, out = write_tree(tmp_path / "in", FIRST), tmp_path / "out"
    jobs.cluster_usage(spark, root, str(out))
    os.remove(out / "timeline" / "_SUCCESS")
    with pytest.raises(FileNotFoundError, match="not whole"):
        load_result(spark, f"{out}/timeline", APP_TIMELINE)
    with pytest.raises(FileNotFoundError):
        jobs.cluster_usage(spark, None, str(out), resume=True)
    assert load_result(spark, f"{out}/timeline", APP_TIMELINE, marked=False).count() == 3
    shutil.rmtree(out / "timeline")
    with pytest.raises(FileNotFoundError):
        load_result(spark, f"{out}/timeline", APP_TIMELINE)
