import os
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

import pytest  # noqa: E402

from curatrix.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session("local[4]", partitions=4, memory="4g", **{"spark__checkpoint__dir": tmp_path_factory.mktemp("shared").as_uri(), "spark__ui__showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
