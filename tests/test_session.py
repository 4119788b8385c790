from __future__ import annotations

from pathlib import Path
from types import SimpleNamespace

import pytest

from sentinela.session import CODE_LIMIT, scratch_dir, wide_rows, written


def session_at(master):
    """Stands in for a session without a checkpoint folder."""
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: {"spark.master": master}.get(key, default)))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_its_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session_at(master), "x")


def test_threads_of_this_process_share_one_folder():
    first, second = scratch_dir(session_at("local[4]"), "x"), scratch_dir(session_at("local"), "x")
    assert first != second and Path(first).parent == Path(second).parent


def test_scratch_tables_go_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(f"{base}/x-")
    rows = written(spark.range(3), "rows")
    assert rows.count() == 3 and rows.inputFiles()[0].removeprefix("file:").replace("//", "").startswith(base)


def test_the_code_limit_is_put_back(spark):
    before = spark.conf.get(CODE_LIMIT[0])
    spark.conf.set(CODE_LIMIT[0], "65535")
    try:
        with pytest.raises(RuntimeError), wide_rows(spark):
            assert spark.conf.get(CODE_LIMIT[0]) == CODE_LIMIT[1]
            raise RuntimeError
        assert spark.conf.get(CODE_LIMIT[0]) == "65535"
    finally:
        spark.conf.set(CODE_LIMIT[0], before)
