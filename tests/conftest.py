import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, (str(ROOT), os.environ.get("PYTHONPATH", ""))))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from factlake.session import local_session

    return local_session("local[8]", "8")
