"""What workers keep between tasks."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEPT = """
import re, sys
sys.path.insert(0, sys.argv[1])
import pyarrow as pa
from fieldweave.llm import common, neardup

def held():
    return int(re.search(r"Anonymous:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1000

def batches():
    for k in range(3):
        texts = pa.array([f"{k} {i} some words of a text " * 60 for i in range(10_000)])
        numbers = pa.array(range(10_000))
        yield pa.RecordBatch.from_arrays([numbers, numbers, numbers, texts], ["k1", "k2", "doc_id", "text"])

before = held()
for _ in common.tidy(neardup._sign(neardup.Settings()))(batches()):
    pass
print(held() - before)
"""


def test_workers_give_back_what_a_task_took():
    done = subprocess.run([sys.executable, "-c", KEPT, ROOT], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    assert float(done.stdout) < 100
