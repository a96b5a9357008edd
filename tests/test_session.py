"""The shared folder comes from the session's configuration."""

from __future__ import annotations

from tillroll.plans.pipeline import default_root
from tillroll.session import ensure_checkpoint_dir


def test_checkpoint_root_is_the_configured_folder(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    root = ensure_checkpoint_dir(spark)
    if configured:
        assert root == configured.rstrip("/")       # stable across applications
    assert spark.sparkContext.getCheckpointDir()
    assert default_root(spark) == f"{root}/tillroll"


def test_scale_conf_sizes_partitions():
    from tillroll.session import scale_conf
    conf = scale_conf(100 * 1024 ** 4, total_cores=8000)          # 100 TB on 1000 x 8 cores
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600    # 256 MB each
    small = scale_conf(10 * 1024 ** 2, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16        # two waves per core
