import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from busmill.session import session

    out = session("tests", **{"spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    out.sparkContext.setLogLevel("ERROR")
    return out
