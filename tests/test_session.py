"""Session helpers: UTC pinning and the shared checkpoint folder."""

import os

from tallyhawk.plans.warehouse import Warehouse
from tallyhawk.session import CLUSTER_CONF, checkpoint_dir


def test_checkpoint_dir_is_the_session_setting(spark):
    assert checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_warehouse_cut_uses_reliable_checkpoints(spark, workdir):
    wh = Warehouse(spark, os.path.join(workdir, "wh"))
    df = spark.range(10).selectExpr("id", "id * 2 AS v")
    cut = wh.cut(df)
    assert cut.count() == 10
    plan = cut._jdf.queryExecution().logical().toString()
    assert "LogicalRDD" in plan  # lineage replaced by the checkpointed data
    assert "spark.checkpoint.dir" not in CLUSTER_CONF  # never hard-coded: the cluster names it
