import pytest

from eventmart.config import MartConfig
from eventmart.session import state_root


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Context:
    def __init__(self, master, conf_dir=None, current=None):
        self.master = master
        self._conf = _Conf(conf_dir)
        self._current = current
        self.set_to = None

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self._current

    def setCheckpointDir(self, path):
        self.set_to = path


class _Session:
    def __init__(self, sc):
        self.sparkContext = sc


def test_cluster_without_checkpoint_dir_is_refused():
    with pytest.raises(RuntimeError):
        state_root(_Session(_Context("yarn")))


def test_cluster_uses_configured_shared_folder():
    sc = _Context("yarn", conf_dir="hdfs://nn/checkpoints")
    assert state_root(_Session(sc)) == "hdfs://nn/checkpoints"
    assert sc.set_to == "hdfs://nn/checkpoints"


def test_local_without_setting_gets_private_folder():
    sc = _Context("local[2]")
    root = state_root(_Session(sc))
    assert root and sc.set_to == root


def test_config_from_env(monkeypatch):
    monkeypatch.setenv("EVENTMART_SILVER_DB", "canon")
    monkeypatch.setenv("EVENTMART_GOLD_DB", "")
    cfg = MartConfig.from_env()
    assert cfg.silver_fqn == "canon.events" and cfg.gold_fqn("x") == "gold.x"
    assert cfg.checkpoint_path("/s") == "/s/checkpoints/raw_events"
    assert cfg.schema_store_path("/s/") == "/s/schemas/raw_events"


def test_three_part_names():
    cfg = MartConfig(catalog="lake")
    assert (cfg.bronze_fqn, cfg.silver_fqn, cfg.quarantine_fqn) == (
        "lake.bronze.raw_events", "lake.silver.events", "lake.bronze.quarantine")
    assert cfg.gold_fqn("x") == "lake.gold.x"
