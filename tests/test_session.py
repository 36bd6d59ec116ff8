"""Session helpers: scratch folders come from spark.checkpoint.dir; partition sizing."""

import pytest

from tessera.session import ensure_checkpoint_dir, partition_settings, scratch_path


def test_scratch_paths_live_under_the_session_checkpoint_dir(spark):
    base = spark.sparkContext.getCheckpointDir()
    assert base and ensure_checkpoint_dir(spark) == base      # existing setting kept
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(base.rstrip("/")) and a != b          # fresh folder per call


def test_partition_settings_scale_with_input():
    small = partition_settings(10 * 2**20, total_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"       # 2 x cores floor
    big = partition_settings(10 * 2**40, total_cores=8)         # 10 TiB / 128 MiB
    assert big["spark.sql.shuffle.partitions"] == str(10 * 2**40 // (128 * 2**20))
    huge = partition_settings(100 * 2**40, total_cores=8000)
    assert huge["spark.sql.shuffle.partitions"] == str(100 * 2**40 // (128 * 2**20))


def test_a_cluster_without_a_shared_folder_is_refused():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
