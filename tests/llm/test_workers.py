"""What Python workers keep and hand back between tasks."""

import re
import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa

from pairloom.llm import jaccard, lines, packing, quality, tokens, workers
from pairloom.llm.workers import kept, lean, turn_to

_TASK = """
import re
import sys
from pathlib import Path

sys.path.insert(0, sys.argv[1])
last = []


def run(batches):
    blocks = [b"x" * 60_000 for _ in range(2000)]
    last.append(blocks.pop())  # above the others, so that the heap does not shrink by itself
    yield len(blocks)


if sys.argv[2] == "lean":
    from pairloom.llm.workers import lean

    run = lean(run)
list(run([]))
print(re.findall(r"Pss_Anon:\\s+(\\d+)", Path("/proc/self/smaps_rollup").read_text())[0])
"""


def test_a_task_leaves_little_behind():
    def left(how):
        root = str(Path(__file__).resolve().parents[2])
        said = subprocess.run([sys.executable, "-c", _TASK, root, how], capture_output=True, text=True, check=True)
        return int(said.stdout) // 1024

    assert left("plain") > 110
    assert left("lean") < 90  # with numpy and Arrow loaded


def test_same_batches_and_hand_back_at_any_end(monkeypatch):
    times = []
    monkeypatch.setattr(workers, "hand_back", lambda: times.append(1))
    batches = [pa.record_batch([pa.array(np.arange(n))], names=["x"]) for n in (3, 0, 2)]
    assert list(lean(iter)(batches)) == batches and len(times) == 1
    run = lean(iter)(batches)
    next(run)
    run.close()
    assert len(times) == 2


def test_other_work_lets_go():
    kept("this")["a"] = 1
    turn_to("this")
    assert kept("this") == {"a": 1} and tokens._loaded is kept("tokens")
    list(lean(iter)([]))
    assert kept("this") == {}


def test_every_task_of_the_pipeline_hands_back():
    for module in (jaccard, lines, packing, quality):
        calls = re.findall(r"mapInArrow\(\s*(\w+)", Path(module.__file__).read_text())
        assert calls and set(calls) == {"lean"}, module.__name__
