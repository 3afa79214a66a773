"""The entry file gives the trip queries whatever else is installed."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent


def test_trip_queries_remain_where_a_library_is_missing():
    code = (
        "import sys; sys.modules['zstandard'] = None\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 80 and not [q for q in e.queries() if q.startswith('op')]\n"
        "assert set(e.oracle_sql()) <= set(e.queries())\n"
    )
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=REPO)
    assert run.returncode == 0, run.stderr
