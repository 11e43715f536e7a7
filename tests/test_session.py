"""Session helpers: checkpoint folder and cluster sizing."""

from candela.session import cluster_settings, ensure_checkpoint_dir


def test_checkpoint_dir_comes_from_the_session(spark):
    before = spark.sparkContext.getCheckpointDir()  # set by the local test session
    assert before and ensure_checkpoint_dir(spark) == before


def test_checkpoint_dir_of_the_user_is_kept(spark, tmp_path):
    before = spark.sparkContext.getCheckpointDir()
    try:
        spark.sparkContext.setCheckpointDir(f"file://{tmp_path}/mine")
        mine = spark.sparkContext.getCheckpointDir()
        assert ensure_checkpoint_dir(spark) == mine and str(tmp_path) in mine
        assert spark.sparkContext.getCheckpointDir() == mine
    finally:
        spark.sparkContext.setCheckpointDir(before)


def test_cluster_settings_scale_with_input():
    small = cluster_settings(10 << 30, executors=2, cores_per_executor=4)
    big = cluster_settings(100e12, executors=1000, cores_per_executor=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16  # two waves of 8
    assert int(small["spark.sql.files.maxPartitionBytes"]) == (10 << 30) // 96
    assert int(big["spark.sql.shuffle.partitions"]) == 18627 and int(big["spark.sql.files.maxPartitionBytes"]) == 1 << 30
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(big["spark.sql.adaptive.autoBroadcastJoinThreshold"]) == 64 << 20
