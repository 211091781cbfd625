import json

import pytest

from tilewright.operators.timings import Timings


def test_stages_are_summed():
    t = Timings()
    for n in (3, 4):
        with t.stage("tiles", rows=n) as counters:
            counters["bytes"] = 10
    assert t.timed(len)([1, 2]) == 2
    with pytest.raises(KeyError), t.stage("broken"):
        raise KeyError
    held = t.summed()
    assert held["tiles"]["rows"] == 7 and held["tiles"]["bytes"] == 20 and {"len", "broken"} <= {*held}
    assert [json.loads(x)["stage"] for x in t.lines().splitlines()] == ["tiles", "tiles", "len", "broken"]
