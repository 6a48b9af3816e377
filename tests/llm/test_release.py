"""Python workers give back what a stage took."""

import subprocess
import sys

import pytest

CODE = """
import sys
sys.path.insert(0, {root!r})
import numpy as np, pyarrow as pa
from gapledger.llm import common

def held():
    for line in open("/proc/self/status"):
        if line.startswith("RssAnon"):
            return int(line.split()[1]) // 1024

def run(batches):
    arrays = [np.ones(100_000, np.uint8) for _ in range(2000)]
    yield arrays[-1].copy()
    kept.append(np.ones(100_000, np.uint8))  # lies above them, as what a worker keeps does

kept, before = [], held()
def group(table):
    list(run([]))
    return table

table = pa.table({{"x": np.zeros(300_000)}})
out = {{"batches": lambda f: list(f([])), "group": lambda f: f(table)}}[{kind!r}](
    {{"batches": [run, common.tidy(run)], "group": [group, common.tidy_group(group)]}}[{kind!r}][{tidied}])
print(held() - before, len(out))
"""


def _left(root, kind, tidied):
    code = CODE.format(root=root, kind=kind, tidied=int(tidied))
    return list(map(int, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()))


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
@pytest.mark.parametrize("kind", ["batches", "group"])
def test_memory_of_a_finished_task_is_given_back(kind, request):
    root = str(request.config.rootpath)
    plain, tidy = _left(root, kind, False), _left(root, kind, True)
    assert tidy[1] == plain[1]
    assert plain[0] > 150 and tidy[0] < 30, (plain, tidy)


def test_small_groups_are_left_alone(monkeypatch):
    import pyarrow as pa

    from gapledger.llm import common

    calls = []
    monkeypatch.setattr(common, "release", lambda: calls.append(1))
    table = pa.table({"x": [1, 2, 3]})
    assert common.tidy_group(lambda t: t)(table) is table and not calls
    assert common.tidy_group(lambda t: t, 8)(table) is table and calls == [1]


def test_a_worker_keeps_one_cache_and_releases_the_one_before(monkeypatch):
    from gapledger.llm import common

    calls = []
    monkeypatch.setattr(common, "_CACHES", {})
    monkeypatch.setattr(common, "release", lambda: calls.append(1))
    first = common.worker_cache("a", dict)
    assert common.worker_cache("a", dict) is first and not calls
    assert common.worker_cache("b", dict) is not first and calls == [1] and list(common._CACHES) == ["b"]
