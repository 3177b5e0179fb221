import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.path.join(ROOT, "tests"), os.environ.get("PYTHONPATH", "")])

from tessellar.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return session("tests", **{"spark.master": "local[4]", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"})


@pytest.fixture(scope="session")
def shared(spark, tmp_path_factory):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return spark.sparkContext.getCheckpointDir()
