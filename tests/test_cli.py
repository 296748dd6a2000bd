import os
import subprocess
import sys

from tests.conftest import write_text
from tests.test_clean import HEADER, ROWS

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(*args):
    env = dict(os.environ, PYTHONPATH=REPO)
    return subprocess.run([sys.executable, "-m", "tempora", "--master", "local[2]", *args], cwd=REPO, env=env,
                          capture_output=True, text=True, timeout=300)


def test_cli_batch_then_read(tmp_path):
    csv = os.path.dirname(write_text(str(tmp_path / "hist" / "a.csv"), HEADER + "\n".join(ROWS) + "\n"))
    base = str(tmp_path / "u")
    out = run("batch", "--input", csv, "--base", base)
    assert out.returncode == 0, out.stderr[-2000:]
    assert '"rows_after": 5' in out.stdout
    rd = run("read", "--base", base, "--since", "1900")
    assert rd.returncode == 0, rd.stderr[-2000:]
    assert "nb_lignes" in rd.stdout and "Dubai" in rd.stdout
