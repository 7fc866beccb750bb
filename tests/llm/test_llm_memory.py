import re
from pathlib import Path

import pyarrow as pa
from lodgelex.llm.common import giving_back


def held_mb():
    found = re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())
    return int(found[1]) / 1024


def batches(n):
    for i in range(n):
        yield pa.RecordBatch.from_pydict({"text": pa.array([f"{i} {j} " + "x" * 2_000 for j in range(10_000)])})


def lengths(source):
    for batch in source:
        yield pa.RecordBatch.from_pydict({"n": [len(t) for t in batch.column("text").to_pylist()]})
        del batch


def test_a_worker_gives_back_what_its_batches_took():
    wrapped = giving_back(lengths)
    before = held_mb()
    assert [b.num_rows for b in wrapped(batches(4))] == [10_000] * 4
    assert held_mb() < before + 15


def test_every_batch_passes_and_an_early_end_is_allowed():
    assert list(giving_back(lengths)(iter([]))) == []
    seen = giving_back(lengths)(batches(3))
    assert next(seen).num_rows == 10_000
    seen.close()
