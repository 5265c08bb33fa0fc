import pytest

from tidylake import session


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class _Context:
    master = "spark://host:7077"

    def getConf(self):
        return _Conf()

    def getCheckpointDir(self):
        return "file:/tmp/one-machine/0b9c"


class _Session:
    conf = _Conf()
    sparkContext = _Context()


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(_Session())


def test_two_sessions_share_the_named_folder():
    class Named(_Session):
        conf = _Conf({"spark.checkpoint.dir": "hdfs://shared/ckpt/"})

    assert {session.checkpoint_root(Named()) for _ in range(2)} == {"hdfs://shared/ckpt"}
