"""Session helpers: settings only where unset, the shared checkpoint folder."""

from types import SimpleNamespace

import pytest

from splitlens.session import checkpoint_dir, size_for_input

KEYS = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")


@pytest.fixture(autouse=True)
def unset(spark):
    yield
    for k in KEYS:
        spark.conf.unset(k)


def test_size_for_input_respects_explicit_settings(spark):
    spark.conf.set(KEYS[1], "64m")
    got = size_for_input(spark, 100 * (1 << 40))
    # shuffle partitions were set when the session was built, the advisory size just now
    assert got["spark.sql.shuffle.partitions"] == "4" and got[KEYS[1]] == "64m" == spark.conf.get(KEYS[1])
    assert int(got[KEYS[0]]) == 256 << 20 and int(got[KEYS[2]]) == 512 << 20
    assert int(size_for_input(spark, 1 << 40, partition_bytes=128 << 20)[KEYS[0]]) == 128 << 20     # its own value may change


def test_100_tb_gets_its_partitions(spark):
    class Conf(dict):
        def get(self, k, default=None):
            return dict.get(self, k, default)

        def set(self, k, v):
            self[k] = v

    fake = SimpleNamespace(conf=Conf(), sparkContext=SimpleNamespace(applicationId="fake"))
    assert int(size_for_input(fake, 100 * 10 ** 12)["spark.sql.shuffle.partitions"]) == -(-300 * 10 ** 12 // (256 << 20))


def test_checkpoint_dir_is_read_from_the_session(spark):
    assert checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert spark.sparkContext.getCheckpointDir() is not None


@pytest.mark.parametrize("master,allowed", [("local[4]", True), ("local", True), ("local-cluster[2,1,1024]", False), ("yarn", False)])
def test_no_machine_local_folder_on_a_cluster(master, allowed):
    conf = SimpleNamespace(get=lambda k, d=None: d, set=lambda k, v: None)
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
    fake = SimpleNamespace(conf=conf, sparkContext=context)
    if allowed:
        assert checkpoint_dir(fake)
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_dir(fake)
