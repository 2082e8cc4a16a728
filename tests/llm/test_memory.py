"""What a Python worker keeps while it encodes and when a task is done."""

import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pytest

from clauseloom.llm import pieces
from clauseloom.llm.shared import lean


def test_words_are_forgotten_with_the_task_and_the_automaton_is_kept():
    first, again = pieces.encoder_of(pieces.load()), pieces.load()
    first.encode(["some words"])
    automaton = first.automaton
    second = pieces.encoder_of(again)
    assert second.automaton is automaton and not second.place
    ids = second.encode(["some words", None, "others"])
    assert [a.tolist() for a in ids] == [a.tolist() for a in pieces.Encoder(again).encode(["some words", None, "others"])]
    other = pieces.Pieces(["a", "b"], [0.0, -1.0], ["normal"] * 2)
    assert pieces.encoder_of(other).pieces is other


def test_many_words_are_encoded_as_by_a_fresh_encoder(monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_WORDS", 50)
    model, texts = pieces.load(), [f"word{i} of {i * 7919} é ☃" for i in range(300)]
    small = pieces.Encoder(model)
    found = [small.encode(texts[i:i + 10])[0].tolist() for i in range(0, 300, 10)]
    assert len(small.place) < 150
    assert sum(found, []) == pieces.Encoder(model).encode(texts)[0].tolist()


def test_lean_gives_the_same_data():
    def batches(given):
        for batch in given:
            yield batch

    rows = pa.RecordBatch.from_arrays([pa.array([1, 2])], names=["x"])
    assert list(lean(batches)([rows, rows])) == [rows, rows] and list(lean(batches)([])) == []
    assert lean(lambda group: group)(rows) is rows


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory can't be read here")
def test_a_worker_hands_freed_memory_back():
    script = """
import re
from clauseloom.llm.shared import lean
def held():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024
late = []
def task(batches):
    rows = [bytearray(2000) for _ in range(50_000)]
    late.append(bytearray(2000))  # what lives on behind them keeps the heap from shrinking by itself
    yield len(rows)
before = held()
list(task([]))
kept = held() - before
list(lean(task)([]))
print(kept, held() - before)
"""
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, cwd=Path(__file__).parents[2])
    assert out.returncode == 0, out.stderr
    kept, left = map(float, out.stdout.split())
    assert kept > 80 and left < 25
