"""entry() in a process that has loaded nothing else, and the library without its optional part."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_in_a_fresh_process():
    code = ("import __spark_entry__ as e; from textloom.session import build_session; "
            "print('ROWS', e.entry(build_session('local[2]', 4)).count())")
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0 and int(run.stdout.split("ROWS")[1]) > 0, run.stderr[-2000:]


def test_queries_without_the_optional_part():
    code = ("import sys; sys.modules['textloom.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
            "import __spark_entry__ as e; print('N', len(e.queries()), len(e.oracle_sql()))")
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0 and int(run.stdout.split()[1]) >= 41, run.stderr[-2000:]
