import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent


def names(folder, blocked=()):
    code = f"import sys; sys.modules.update(dict.fromkeys({list(blocked)})); import __spark_entry__ as e; print(*e.queries())"
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)


def test_training_data_files_may_be_absent(tmp_path):
    for name in ("checks", "shelfline"):
        shutil.copytree(REPO / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    found = names(tmp_path).stdout.split()
    assert "sales_kpis" in found and "pipeline" not in found


def test_the_rest_is_collected_without_the_training_data_part(tmp_path):
    for name in ("checks", "shelfline", "tests"):
        shutil.copytree(REPO / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "bench.py"):
        shutil.copy(REPO / name, tmp_path)
    command = [sys.executable, "-B", "-m", "pytest", "--collect-only", "-q", "-p", "no:cacheprovider", "tests"]
    found = subprocess.run(command, cwd=tmp_path, capture_output=True, text=True, timeout=240)
    assert found.returncode == 0, found.stdout[-2000:]
