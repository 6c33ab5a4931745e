"""Running generated code in separate processes: opt-in, scanned before it runs, with limits on time, memory and files.

Code that the safety scan bans never starts. Each run gets a folder of its own under the executor's temporary folder, which
is removed afterwards; results travel in columns only.
"""

from __future__ import annotations

import contextlib
import os
import shutil
import signal
import subprocess
import sys
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions import code
from ..shipping import importable

MEMORY_MB = 512
_ASK = "import sys\nfrom io import StringIO\nfrom solution import solve\nsys.stdin = StringIO(sys.stdin.read())\nsolve()\n"
_TESTS = (
    "import re, traceback\nfrom solution import *\nsource = open('test_solution.py').read()\nscope = {'__file__': 'test_solution.py', '__name__': 'test_solution'}\n"
    "exec(compile(source, 'test_solution.py', 'exec'), scope)\npassed = failed = 0\nfor name in sorted((n for n in scope if n.startswith('test_')), key=lambda n: (len(n), n)):\n"
    "    try:\n        scope[name]()\n        passed += 1\n    except BaseException as e:\n        failed += 1\n        print(f'FAILED test_solution.py::{name} - {type(e).__name__}')\n"
    "print(f'{failed} failed, {passed} passed in 0.00s' if failed else f'{passed} passed in 0.00s')\nraise SystemExit(bool(failed) or not passed)\n"
)


def _limits() -> None:
    import resource

    resource.setrlimit(resource.RLIMIT_AS, (MEMORY_MB << 20, MEMORY_MB << 20))
    resource.setrlimit(resource.RLIMIT_FSIZE, (1 << 20, 1 << 20))
    resource.setrlimit(resource.RLIMIT_CORE, (0, 0))
    os.setsid()  # a group of its own, that can be ended whole


def _run(files: dict[str, str], stdin: str, seconds: float) -> tuple[int | None, str]:
    """Exit code (None: out of time) and output of main.py among these files."""
    folder = tempfile.mkdtemp(prefix="sandbox-")
    try:
        for name, text in files.items():
            with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
                f.write(text)
        pipe = subprocess.PIPE
        child = subprocess.Popen([sys.executable, "-B", "main.py"], stdin=pipe, stdout=pipe, stderr=pipe, text=True, cwd=folder, env={"PATH": "/usr/bin:/bin"}, preexec_fn=_limits)
        try:
            out, err = child.communicate(stdin, timeout=seconds)
            return child.returncode, out if child.returncode == 0 else out + err
        except subprocess.TimeoutExpired:
            return None, ""
        finally:
            # the child leads a session of its own: what it started goes with it
            with contextlib.suppress(ProcessLookupError):
                os.killpg(child.pid, signal.SIGKILL)
            child.wait()
    except (OSError, UnicodeError, ValueError) as e:
        return -1, str(e)
    finally:
        shutil.rmtree(folder, ignore_errors=True)


def observed_outputs(df: DataFrame, solution: str = "solution_code", inputs: str = "inputs", seconds: float = 10.0, least: int = 3, enabled: bool = False) -> DataFrame:
    """The rows with ``outputs``: what the solution prints for each input; null unless ``least`` inputs ran through.

    Expected values come from the run. Nothing runs unless ``enabled``, nor any code that the scan bans.
    """
    importable(df.sparkSession)
    rows = df.withColumn("_go", F.lit(enabled) & code.safe(solution))
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for go, source, given in zip(batch.column("_go").to_pylist(), batch.column(solution).to_pylist(), batch.column(inputs).to_pylist()):
                said = []
                for text in (given or []) if go else []:
                    status, printed = _run({"solution.py": source or "", "main.py": _ASK}, text or "", seconds)
                    said.append(printed.strip() if status == 0 else None)
                out.append(said if sum(s is not None for s in said) >= least else None)
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(out, pa.list_(pa.string()))], names=[*names, "outputs"])

    return rows.mapInArrow(run, StructType([*df.schema.fields, StructField("outputs", ArrayType(StringType()))]))


def run_tests(df: DataFrame, solution: str = "solution_code", tests: str = "test_code", seconds: float = 30.0, enabled: bool = False) -> DataFrame:
    """The rows with ``result`` and ``log``: Pass, Fail (also out of time), Error where it could not be started, Blocked where the scan
    or the setting forbids it."""
    importable(df.sparkSession)
    rows = df.withColumn("_go", F.lit(enabled) & code.safe(solution))
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results, logs = [], []
            for go, source, test in zip(batch.column("_go").to_pylist(), batch.column(solution).to_pylist(), batch.column(tests).to_pylist()):
                status, log = _run({"solution.py": source or "", "test_solution.py": test or "", "main.py": _TESTS}, "", seconds) if go else (None, "")
                results.append("Blocked" if not go else "Pass" if status == 0 else "Error" if status == -1 else "Fail")
                logs.append(log)
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(results, pa.string()), pa.array(logs, pa.string())], names=[*names, "result", "log"])

    return rows.mapInArrow(run, StructType([*df.schema.fields, StructField("result", StringType()), StructField("log", StringType())]))
