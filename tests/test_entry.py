import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_training_data_operators(tmp_path):
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{ROOT}/halyard", tmp_path / "halyard", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), set(q) == set(e.oracle_sql()), any(k.startswith('op') for k in q))"
    out = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    n, same, any_op = out.stdout.split()[-3:]
    assert int(n) > 60 and same == "True" and any_op == "False"


def test_library_does_not_import_them():
    for folder, _, names in os.walk(f"{ROOT}/halyard"):
        if "llm" in os.path.relpath(folder, ROOT).split(os.sep):
            continue
        for name in names:
            if name.endswith(".py"):
                with open(f"{folder}/{name}") as f:
                    assert "halyard.llm" not in f.read(), name
