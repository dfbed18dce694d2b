"""What a Python worker of the pipeline keeps between its batches and tasks."""

import numpy as np
import pandas as pd
import pytest

from matchlake.llm import pii_sanitise


def _resident() -> int:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096


def test_trim_gives_freed_memory_back():
    from matchlake.llm.common import trim

    blocks = [bytearray(60_000) for _ in range(3000)]  # 180 MB in blocks of the C library's heap
    top = bytearray(60_000)
    full = _resident()
    del blocks
    trim()
    assert full - _resident() > 120 << 20
    assert len(top)


@pytest.mark.parametrize("run", [pii_sanitise._private, pii_sanitise._occurrences(np.full(4096, 255, np.uint8))])
def test_tasks_over_texts_trim_at_each_batch_and_at_their_end(monkeypatch, run):
    calls = []
    monkeypatch.setattr(pii_sanitise, "trim", lambda: calls.append(1))
    batches = [pd.DataFrame({"h": [k], "text": [f"mail a{k}@b.org from Ann"]}) for k in range(3)]
    assert len(list(run(iter(batches)))) == 3
    assert len(calls) == 4
