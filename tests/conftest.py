from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from regspark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="regspark-test-ckpt-")
    s = build_session(
        "local[*]", app_name="regspark-tests", shuffle_partitions=8,
        extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"},
    )
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture()
def workdir(tmp_path):
    return str(tmp_path)


def write_lines(path: str, lines: list[str], encoding: str = "latin-1") -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as fh:
        for line in lines:
            fh.write(line + "\n")
    return path
