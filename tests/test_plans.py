"""What the plans must show: pruned columns, pushed filters, limits before shuffles, no cross joins."""

import contextlib
import io

import pytest

from fjordmill.plans import registry


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize(
    "name, needed",
    [
        ("a5_top_domains", ["ReadSchema: struct<domain:string>", "IsNotNull(domain)", "TakeOrderedAndProject"]),
        ("filter_p3_nonblank", ["ReadSchema: struct<row_id:bigint,content:string>", "IsNotNull(content)"]),
        ("a20_busy_accounts", ["ReadSchema: struct<account_name:string>"]),
        ("n1_keep_best", ["WindowGroupLimit"]),
        ("j11_unprocessed", ["LeftAnti"]),
        ("j13_semi", ["LeftSemi"]),
    ],
)
def test_plan(spark, sf, name, needed):
    p = plan(registry.queries()[name](spark, sf))
    assert [x for x in needed if x not in p] == []


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - {"s_stream_tumbling"}))
def test_no_cross_join(spark, sf, name):
    p = plan(registry.queries()[name](spark, sf))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p
