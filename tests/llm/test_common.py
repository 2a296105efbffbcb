import re
from pathlib import Path

from tidewatt.llm.common import giving_back

_pinned = []


def resident():
    """Megabytes of this process's own memory."""
    return int(re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024


def hungry(batches):
    """Frees nearly all that it takes; the few blocks that stay lie between what is freed."""
    for batch in batches:
        taken = [b"x" * 600 + bytes(n % 7) for n in range(200_000)]
        _pinned.extend(taken[::2000])
        del taken
        yield batch


def test_what_a_task_has_freed_is_handed_back():
    before = resident()
    assert list(giving_back(hungry)(iter([1, 2]))) == [1, 2]
    assert resident() - before < 30
    assert giving_back(hungry).__name__ == "hungry"


def test_without_it_the_worker_keeps_what_it_freed():
    before = resident()
    list(hungry(iter([1])))
    assert resident() - before > 60
    list(giving_back(hungry)(iter([1])))
    assert resident() - before < 30
