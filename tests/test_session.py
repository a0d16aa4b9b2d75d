"""Who owns stored intermediates, and how long they live."""

import os
from multiprocessing.pool import ThreadPool

import pytest
from pyspark import inheritable_thread_target

from palate.session import WORKSPACE, checkpoint_root, settle, work_path, workspace


def here(path: str) -> str:
    return path.removeprefix("file:")


def test_a_workspace_deletes_what_was_stored_in_it(spark, tmp_path):
    before = settle(spark.range(5), "before")
    with workspace(spark) as folder:
        inside = settle(spark.range(7), "inside")
        assert os.listdir(here(folder)) and inside.count() == 7
        inside.write.parquet(str(tmp_path / "kept"))
    assert not os.path.exists(here(folder))
    assert before.count() == 5 and spark.read.parquet(str(tmp_path / "kept")).count() == 7
    assert spark.sparkContext.getLocalProperty(WORKSPACE) is None
    assert work_path(spark, "x").startswith(f"{checkpoint_root(spark)}/palate/x-")


def test_workspaces_nest_and_end_on_failure(spark):
    with pytest.raises(RuntimeError), workspace(spark) as outer:
        kept = settle(spark.range(3), "outer")
        with workspace(spark) as inner:
            assert inner.startswith(outer)
            settle(spark.range(3), "inner")
        assert not os.path.exists(here(inner)) and kept.count() == 3
        raise RuntimeError
    assert not os.path.exists(here(outer))
    assert spark.sparkContext.getLocalProperty(WORKSPACE) is None


def test_threads_of_a_job_share_its_workspace(spark):
    with workspace(spark) as folder, ThreadPool(2) as pool:
        paths = pool.map(inheritable_thread_target(spark)(lambda i: work_path(spark, f"t{i}")), range(4))
        assert all(p.startswith(folder) for p in paths)
