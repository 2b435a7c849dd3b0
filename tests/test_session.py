from __future__ import annotations

import pytest

from tickmacro.session import new_dir, shared_dir


class _Session:
    """Stands in for a session: only its master and settings are asked."""

    def __init__(self, master: str, **conf: str) -> None:
        self.sparkContext = self
        self.master, self.conf = master, conf


def test_the_cluster_names_the_shared_folder():
    session = _Session("yarn", **{"spark.checkpoint.dir": "hdfs:///work/"})
    assert shared_dir(session) == "hdfs:///work"
    assert new_dir(session, "a") != new_dir(session, "a")


def test_without_a_setting_the_warehouse_holds_the_work_folder():
    session = _Session("yarn", **{"spark.sql.warehouse.dir": "hdfs:///wh/"})
    assert shared_dir(session) == "hdfs:///wh/_work"


def test_a_warehouse_of_one_machine_will_do_for_a_local_master_only():
    for base in ("file:/home/me/spark-warehouse", "/home/me/spark-warehouse"):
        conf = {"spark.sql.warehouse.dir": base}
        for master in ("local", "local[8]"):
            assert shared_dir(_Session(master, **conf)) == f"{base}/_work"
        for master in ("yarn", "local-cluster[3,2,1000]", "spark://host:7077"):
            with pytest.raises(ValueError, match="checkpoint"):
                shared_dir(_Session(master, **conf))


def test_the_session_setting_is_read(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
