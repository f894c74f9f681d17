from datetime import datetime, timezone

import pytest

from fjordmill.functions.moments import readings, utc_text
from fjordmill.operators.moments import moment_micros, resolve_moments, viterbi

CPH = "Europe/Copenhagen"


def utc(text, zone=CPH):
    r = readings(text, zone)
    return utc_text(r[0][1]) if r else None


@pytest.mark.parametrize(
    "text, want",
    [
        ("2019-01-09T22:25:15.130197329Z", "2019-01-09 22:25:15.130197"),
        ("2016-03-20 16:20:12", "2016-03-20 15:20:12.000000"),
        ("2020-08-05", "2020-08-04 22:00:00.000000"),
        ("21/04/2014 19:36", "2014-04-21 17:36:00.000000"),
        ("03.04.2014", "2014-04-02 22:00:00.000000"),
        ("20161215T103215Z", "2016-12-15 10:32:15.000000"),
        ("20160223", "2016-02-22 23:00:00.000000"),
        ("1398826257", "2014-04-30 02:50:57.000000"),
        ("1570418670722", "2019-10-07 03:24:30.722000"),
        ("1743051665481401", "2025-03-27 05:01:05.481401"),
        ("1742624237,315383", "2025-03-22 06:17:17.315383"),
        ("1741554905.959786", "2025-03-09 21:15:05.959786"),
        ("Nov 30, 2018 2:15 AM", "2018-11-30 01:15:00.000000"),
        ("January 20, 2022 12:24 AM", "2022-01-19 23:24:00.000000"),
        ("Jul 6, 2015 12:37 PM", "2015-07-06 10:37:00.000000"),
        ("2014/09/18 18:49:23 CET", "2014-09-18 17:49:23.000000"),
        ("Tue, 14 Nov 2017 20:57:54 EST", "2017-11-15 01:57:54.000000"),
        ("Sun, 31 Jul 2016 13:02:25 +0200", "2016-07-31 11:02:25.000000"),
        ("18 juillet 2020 à 22h42", "2020-07-18 20:42:00.000000"),
        ("25. marts 2012 kl. 04.30", "2012-03-25 02:30:00.000000"),
        ("13. November 2021, 09:21 Uhr", "2021-11-13 08:21:00.000000"),
        ("07.07.2023 04:30 Uhr", "2023-07-07 02:30:00.000000"),
        ("  2021-06-25 ", "2021-06-24 22:00:00.000000"),
        ("2025-03-09 16:59:00.216917-04", "2025-03-09 20:59:00.216917"),
        # the wall time that occurs twice is the first, the one that is skipped keeps the earlier offset
        ("2020-10-25 02:30:00", "2020-10-25 00:30:00.000000"),
        ("2020-03-29 02:30:00", "2020-03-29 01:30:00.000000"),
    ],
)
def test_forms(text, want):
    assert utc(text) == want


@pytest.mark.parametrize("text", [None, "", "   ", "recently", "0", "N/A", "Invalid Date", "i går", "for 3 timer siden", "2025-13-45", "31.02.2024", "2024-02-30T10:00:00Z", "03/15/2024", "12345", "13:61", "2020-01-01 25:00"])
def test_no_moment(text):
    assert utc(text) is None


def test_loose_readings_and_viterbi():
    a = readings("03/04/2014", CPH, strict=False)
    assert [r[0] for r in a] == ["dmy", "mdy"]
    b = readings("03/15/2014", CPH, strict=False)
    assert [r[0] for r in b] == ["mdy"]
    # a month-first neighbour makes the ambiguous value month-first
    assert viterbi([b, a, b]) == [0, 1, 0]
    assert viterbi([a]) == [0]
    assert viterbi([]) == []


def brute_viterbi(options, switch=1.0, back=2.0):
    from itertools import product

    def cost(pick):
        r = [o[k] for o, k in zip(options, pick)]
        return sum(switch * (x[0] != y[0]) + back * (y[1] < x[1]) for x, y in zip(r, r[1:]))

    return min(cost(p) for p in product(*(range(len(o)) for o in options))), cost


def test_viterbi_is_cheapest():
    import random

    rng = random.Random(5)
    for _ in range(60):
        options = [[(rng.choice("ab"), rng.randrange(5)) for _ in range(rng.randrange(1, 4))] for _ in range(rng.randrange(1, 7))]
        best, cost = brute_viterbi(options)
        assert cost(viterbi(options)) == best


def test_resolve(spark):
    rows = [(1, "a", "2020-08-05", "2020-08-05 10:00:00", "x"), (2, None, None, "1398826257", "y"), (3, "b", "", "", None), (3, "b", "1398826257", None, None), (4, "ny", None, "2025-07-01 10:00:00", "z")]
    df = spark.createDataFrame(rows, "row_id long, source string, date string, scraped_at string, field string")
    zones = spark.createDataFrame([("a", "UTC"), ("ny", "America/New_York")], "source string, zone string")
    got = {tuple(r) for r in resolve_moments(df, zones).collect()}
    assert got == {
        (1, "date", "2020-08-04 22:00:00.000000"), (1, "scraped_at", "2020-08-05 10:00:00.000000"), (2, "scraped_at", "2014-04-30 02:50:57.000000"),
        (3, "date", "2014-04-30 02:50:57.000000"), (4, "scraped_at", "2025-07-01 14:00:00.000000"),
    }
    assert resolve_moments(df.limit(0), zones).count() == 0
    us = moment_micros(df.join(zones, "source", "left"), "scraped_at", "zone", "us").filter("row_id = 4").first()["us"]
    assert datetime.fromtimestamp(us / 1e6, timezone.utc).hour == 14


def test_blocks_cover_all_rows(spark, sf):
    from fjordmill.session import table

    pages, zones = table(spark, sf, "sample_old_facebook"), table(spark, sf, "source_zones")
    a = resolve_moments(pages, zones, block=7).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, resolve_moments(pages, zones).collect()))


def test_iso_forms_agree_with_duckdb(spark, sf):
    """An independent reading of the ISO and epoch forms of the whole table; wall times near a change of the clock are left to test_forms."""
    import pytest as pt

    from fjordmill.session import table
    from tests.oracle import connect

    con = connect(sf)
    try:
        con.execute("SELECT timezone('Europe/Copenhagen', TIMESTAMP '2020-01-01')")
    except Exception:
        pt.skip("DuckDB has no time zones here")
    zoned, wall, epoch = r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(\.\d{1,6})?(Z|[+-]\d\d:\d\d)$", r"^\d{4}-\d\d-\d\d( \d\d:\d\d(:\d\d)?)?$", r"^(\d{10}|\d{13}|\d{16})$"
    sql = f"""WITH v AS (SELECT row_id, 'date' AS field, trim(date) AS t, 'Europe/Copenhagen' AS zone FROM sample_old_facebook
            UNION ALL SELECT row_id, 'scraped_at', trim(scraped_at), zone FROM sample_old_facebook JOIN source_zones USING (source)),
        r AS (SELECT row_id, field, CASE WHEN regexp_matches(t, '{zoned}') THEN epoch_us(try_cast(t AS TIMESTAMPTZ)) WHEN regexp_matches(t, '{wall}') THEN epoch_us(timezone(zone, try_cast(t AS TIMESTAMP)))
            WHEN regexp_matches(t, '{epoch}') THEN CAST(t AS BIGINT) * CASE length(t) WHEN 10 THEN 1000000 WHEN 13 THEN 1000 ELSE 1 END END AS us, t, zone, regexp_matches(t, '{wall}') AS w FROM v)
        SELECT row_id, field, strftime(make_timestamp(us), '%Y-%m-%d %H:%M:%S.%f') AS utc FROM r WHERE us IS NOT NULL AND NOT (w AND (strftime(try_cast(t AS TIMESTAMP), '%m') IN ('03', '10', '11') AND strftime(try_cast(t AS TIMESTAMP), '%H') < '04'))"""
    want = {(a, b): c for a, b, c in con.execute(sql).fetchall()}
    got = {(r["row_id"], r["field"]): r["utc"] for r in resolve_moments(table(spark, sf, "sample_old_facebook"), table(spark, sf, "source_zones")).collect()}
    assert len(want) > 50 and {k: (v, got.get(k)) for k, v in want.items() if got.get(k) != v} == {}


def test_spans_are_the_chain():
    """Merged summaries and the readings picked at the ends of blocks against the whole chain."""
    import random

    from fjordmill.operators.moments import chain_costs, merge_spans, pick_ends

    rng = random.Random(8)
    for _ in range(80):
        options = [[(rng.choice("ab"), rng.randrange(5), float(rng.randrange(3))) for _ in range(rng.randrange(1, 4))] for _ in range(rng.randrange(2, 9))]
        cuts = sorted({0, len(options), *(rng.randrange(len(options)) for _ in range(2))})
        blocks = [options[a:b] for a, b in zip(cuts, cuts[1:])]
        spans = [([o[:2] for o in b[0]], [o[:2] for o in b[-1]], chain_costs(b)) for b in blocks]
        whole = spans[0]
        for s in spans[1:]:
            whole = merge_spans(whole, s)
        assert whole[2] == chain_costs(options)
        cost = lambda pick: sum(o[k][2] for o, k in zip(options, pick)) + sum((x[0] != y[0]) + 2.0 * (y[1] < x[1]) for x, y in zip([o[k] for o, k in zip(options, pick)], [o[k] for o, k in zip(options, pick)][1:]))
        pick = [p for b, (i, j) in zip(blocks, pick_ends(spans)) for p in viterbi(b, first=i, last=j)]
        assert cost(pick) == cost(viterbi(options)) == min(map(min, whole[2]))


def test_neighbours_decide_across_blocks(spark):
    """Without the cost of breaking rules a chain of month-first values decides about ambiguous ones, in whatever block they are; with it the rules do."""
    rows = [(k, "a", "03/15/2014" if k % 17 == 0 else f"03/{k % 9 + 16}/2014" if k % 5 == 0 else "04/05/2014", None) for k in range(100)]
    df = spark.createDataFrame(rows, "row_id long, source string, date string, scraped_at string")
    zones = spark.createDataFrame([("a", "UTC"), ("a", "UTC")], "source string, zone string")
    loose = {b: sorted(map(tuple, resolve_moments(df, zones, rule_cost=0.0, block=b, fan=3).collect())) for b in (3, 10, 1000)}
    assert loose[3] == loose[10] == loose[1000] and len(loose[3]) == 100 and all("2014-04-0" in r[2] or "2014-03" in r[2] for r in loose[3])
    ruled = sorted(map(tuple, resolve_moments(df, zones, block=10).collect()))
    assert [r[0] for r in ruled] == [k for k in range(100) if k % 17 and k % 5] and {r[2] for r in ruled} == {"2014-05-03 22:00:00.000000"}
    odd = spark.createDataFrame([(None, "a", "2020-08-05", None), (None, "a", "2020-08-05", "x"), (None, None, "1398826257", None)], "row_id long, source string, date string, scraped_at string")
    assert resolve_moments(odd, zones).count() == 3


def test_no_pass_where_rules_prevail(spark, sf, monkeypatch):
    """With the rules' full cost the chain finds what the rules say of each value by itself, so it isn't passed."""
    from fjordmill.operators import moments
    from fjordmill.plans.core import p5_found
    from fjordmill.session import table
    from tests.test_plans import plan

    texts = ["03/15/2014", "04/05/2014", "2020-10-25 02:30:00", "2020-03-29 02:30:00", "2021-06-25", "", "recently", "1398826257", "Fri, 03 Oct 2025 08:18:17 EST", None]
    rows = [(None if k % 29 == 0 else k // 2, ("a", "ny", None, "other")[k % 4], texts[k * 7 % 10], texts[k * k % 9]) for k in range(200)]
    df = spark.createDataFrame(rows, "row_id long, source string, date string, scraped_at string")
    zones = spark.createDataFrame([("a", CPH), ("a", "UTC"), ("ny", "America/New_York"), (None, CPH)], "source string, zone string")
    pages, page_zones = table(spark, sf, "sample_old_facebook"), table(spark, sf, "source_zones")
    ordered = lambda d: sorted(map(tuple, d.collect()), key=repr)

    with monkeypatch.context() as m:
        m.setattr(moments, "rules_prevail", lambda rule_cost: False)
        passed = [ordered(resolve_moments(df, zones, block=7, fan=3)), ordered(resolve_moments(pages, page_zones, block=500))]
    monkeypatch.setattr(moments, "chain_ends", None)
    assert [ordered(resolve_moments(df, zones)), ordered(p5_found(spark, sf))] == passed and all(passed)
    assert "MapInArrow" in (p := plan(p5_found(spark, sf))) and "Exchange hashpartitioning" not in p and "FlatMap" not in p


def test_rules_prevail_from_a_cost():
    """Just above the bound no chain goes against a rule; at the bound and below one may."""
    from itertools import product

    from fjordmill.operators.moments import BACK_COST, RULE_COST, SKIP_COST, SWITCH_COST, rules_prevail

    bound = max(SKIP_COST, 2 * (SWITCH_COST + BACK_COST))
    assert rules_prevail(RULE_COST) and rules_prevail(bound + 0.01) and not rules_prevail(bound) and not rules_prevail(0.0)

    def values(cost):
        return [[("a", 1, 0.0)], [("b", 2, 0.0)], [("a", 3, 0.0), ("b", 0, cost)], [("b", 0, 0.0), ("a", 3, cost)], [("a", 2, cost), (None, 0, SKIP_COST)]]

    def ruled(pick, options):
        return all(o[k][2] == 0.0 or o[k][0] is None for k, o in zip(pick, options))

    for options in product(values(bound + 0.01), repeat=4):
        assert ruled(viterbi(list(options)), options)
    assert not all(ruled(viterbi(list(options)), options) for options in product(values(bound), repeat=4))


def test_ends_of_blocks_decide_in_p5_neighbours(spark, tmp_path, monkeypatch):
    """Where neighbours decide, what the chain says of the ends of blocks shows in the rows."""
    from functools import partial

    from fjordmill.operators import moments
    from fjordmill.plans import core

    monkeypatch.setattr(core, "resolve_moments", partial(resolve_moments, block=1, fan=2))
    rows = [(k, "a", f"03/{15 + k}/2014" if k % 2 else "04/05/2014", None) for k in range(1, 8)]
    spark.createDataFrame(rows, "row_id long, source string, date string, scraped_at string").write.parquet(f"{tmp_path}/sample_old_facebook.parquet")
    spark.createDataFrame([("a", "UTC")], "source string, zone string").write.parquet(f"{tmp_path}/source_zones.parquet")
    got = lambda query: {r["row_id"]: r["utc"][:10] for r in query(spark, str(tmp_path)).collect()}
    assert got(core.p5_found) == {k: "2014-05-03" for k in (2, 4, 6)}
    chained = got(core.p5_neighbours)
    assert len(chained) == 7 and {chained[k] for k in (2, 4, 6)} == {"2014-04-04"}
    real = moments.chain_ends
    monkeypatch.setattr(moments, "chain_ends", lambda spans, fan: real(spans, fan).limit(0))
    alone = got(core.p5_neighbours)
    assert {alone[k] for k in (2, 4, 6)} == {"2014-05-03"}
