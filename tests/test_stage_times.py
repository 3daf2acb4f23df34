"""The stage-time reader parses an event log written by a session with event_log_dir."""

import glob
import subprocess
import sys
import tempfile
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from txengine.session import build_session
spark = build_session("local[2]", shuffle_partitions=2, event_log_dir="file://{d}")
spark.range(1000).selectExpr("id % 3 AS k").groupBy("k").count().collect()
spark.stop()
"""


def test_event_log_round_trip():
    d = tempfile.mkdtemp(prefix="evlog-")
    code = SCRIPT.format(root=str(ROOT), d=d)
    subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, timeout=300)
    files = glob.glob(f"{d}/**/events_*", recursive=True) + glob.glob(f"{d}/*local-*")
    files = [f for f in files if Path(f).is_file()]
    assert files
    sys.path.insert(0, str(ROOT / "tests"))
    from stage_times import stages

    st, jobs = stages(files[0])
    assert jobs and st
