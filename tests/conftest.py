import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))  # for the workers


@pytest.fixture(scope="session")
def spark():
    from lexloom.plans.base import session

    s = session("tests", cores=4, partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
