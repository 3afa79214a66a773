"""Tasks carry the package's functions, so executors need not be able to import it."""

from __future__ import annotations

import pickle
import subprocess
import sys

from pyspark import cloudpickle

from tripflow.sources import footers


def test_functions_unpickle_without_the_package(tmp_path):
    shipped = tmp_path / "shipped"
    shipped.write_bytes(cloudpickle.dumps(footers._open))
    code = f"import pickle; print(pickle.load(open({str(shipped)!r}, 'rb')).__name__)"
    run = subprocess.run([sys.executable, "-I", "-c", code], capture_output=True, text=True, cwd=tmp_path)
    assert run.stdout.strip() == "_open", run.stderr
    assert pickle.loads(shipped.read_bytes()) is not footers._open
