"""Pages: nested tables, hostile offset bodies, and the streamed rule."""

from __future__ import annotations

import pytest

from tallyboard.plans.registry import QUERIES
from tallyboard.sources import layouts


def test_nested_tables_are_sliced_by_themselves():
    html = "<table><tr><td>out<table><tr><th colspan=2>in</th></tr></table>side</td></tr><tr><td>open</table><table/><table><tr><td>x"
    got = layouts.slice_tables(html)
    assert [rows for _, rows in got] == [[[("out side", False, 1)]], [[("in", True, 2)]]]


@pytest.mark.parametrize(
    ("body", "offset"),
    [
        ("x = x + 1.5;", 1.5), ("x=x-3*2; x = x*(1+1)", -12.0), ("if (x < 5) x = x - 4;", -4.0), ("if (x > 5) x = 1; x = 2;", 2.0), ("x = -(2 - 3);", 1.0),
        ("x = 0", None), ("y = 1", None), ("x == 1", None), ("x = alert(1)", None), ("", None), ("x = 1/0", None), ("x = (1", None), ("if (x < 1 x = 2", None), ("x = 1; constructor", None), ("x = " + "(" * 5000 + "1" + ")" * 5000, None),
    ],
)
def test_offset_of(body, offset):
    assert layouts.offset_of(body) == offset


def test_stream_equals_replay(spark, sf_dir):
    a, b = (sorted(map(tuple, QUERIES[n](spark, sf_dir).collect())) for n in ("heartbeat_writes", "streamed_writes"))
    assert a == b
