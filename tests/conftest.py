import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from concordat.session import session

    s = session("tests", "local[8]", 8, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g", "spark.checkpoint.dir": tempfile.mkdtemp()})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
