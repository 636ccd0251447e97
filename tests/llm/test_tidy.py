"""Python workers give freed memory back when a task ends."""

import re
from pathlib import Path

import pyarrow as pa
import pytest

from delaylens.llm import common


def held_mb():
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def batches(n):
    return (pa.RecordBatch.from_arrays([pa.array([k])], ["k"]) for k in range(n))


def test_rows_pass_unchanged_and_memory_comes_back():
    def run(given):
        kept = [bytes(3000) + bytes([k % 7]) for k in range(50_000)]       # small pieces: the allocator keeps them
        pin = [bytes(3000) for _ in range(10)]
        for batch in given:
            assert kept and pin
            yield batch
        run.pin = pin

    before = held_mb()
    assert [b.column(0)[0].as_py() for b in common.tidy(run)(batches(5))] == [0, 1, 2, 3, 4]
    assert held_mb() - before < 60          # 150 MB were in use


def test_memory_comes_back_when_a_task_fails(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))

    def run(given):
        yield next(given)
        raise ValueError("bad row")

    with pytest.raises(ValueError, match="bad row"):
        list(common.tidy(run)(batches(2)))
    assert calls == [1]
