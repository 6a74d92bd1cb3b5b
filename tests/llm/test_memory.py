"""Python workers, which outlive their tasks, do not keep the memory of the largest one."""

from collections.abc import Iterator

import pyarrow as pa

from ledgerweave.llm.common import giving_back

MB = 1 << 20


def _resident() -> int:
    with open("/proc/self/statm") as file:
        return int(file.read().split()[1]) * 4096


def test_freed_memory_goes_back():
    kept, seen = [], []

    def hungry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [b"x" * (50_000 + i) for i in range(4_000)]
            kept.extend(parts[::400])  # so that the top of the heap stays in use
            kept.append(parts[-1])
            seen.append(_resident())
            del parts
            yield batch

    batch = pa.RecordBatch.from_pydict({"n": [1]})
    before = _resident()
    assert list(giving_back(hungry)(iter([batch]))) == [batch]
    assert seen[0] - before > 150 * MB
    assert _resident() - before < 50 * MB
