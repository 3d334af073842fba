"""What must hold whatever the records are."""

from __future__ import annotations

from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from canonflow.plans.transform import Transform
from canonflow.rulebook import Rulebook
from canonflow.session import prepare

BOOK = Rulebook(
    vendor="any",
    source={"record": {"meter_field": "m", "timestamp_field": "ts", "row_id_field": "id"}},
    mapping={"columns": [
        {"src": "a", "quantity": "x", "phase": "L1", "unit": "V", "transform": "scale_by_factor", "args": {"factor_field": "uk_ik"}},
        {"src": "b", "quantity": "y", "phase": "none", "unit": "A"}, {"src": "c", "quantity": "y", "phase": "L2", "unit": "A"},
    ]},
)
value = st.one_of(st.none(), st.integers(-5, 5).map(str))
record = st.tuples(st.sampled_from(["1", "2"]), st.sampled_from(["2025-01-01", None, "x"]), st.integers(0, 9).map(str), value, value, value)
bounds = st.tuples(st.sampled_from(["x", "y"]), st.sampled_from(["flag_suspect", "drop_row"]), st.integers(-5, 0), st.integers(0, 5))


@pytest.fixture(scope="module")
def session(spark):
    return prepare(spark)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(record, max_size=12), rules=st.lists(bounds, max_size=3))
def test_every_cell_is_accounted_for(session, rows, rules):
    spark = session
    checks = [{"quantity": q, "type": "range", "on_fail": f, "min": lo, "max": hi} for q, f, lo, hi in rules]
    t = Transform(replace(BOOK, validation={"rules": checks}))
    d = spark.createDataFrame(rows, "m string, ts string, id string, a string, b string, c string")
    factors = spark.createDataFrame([("1", 2.0, 3.0)], "meter string, uk double, ik double")
    s = t.stats(d, factors).first()
    assert s.rows_emitted + s.rows_dropped + s.cells_null_skipped + s.cells_factor_missing == 3 * len(rows)
    got = t.rows(d, factors, "t").collect()
    assert len(got) == s.rows_emitted and sum(r.quality == "suspect" for r in got) == s.rows_suspect
    assert sorted(r.measurement_id for r in got) == sorted(r.measurement_id for r in t.rows(d.repartition(2), factors, "u").collect())

    def judged(q, v):
        failing = [f for x, f, lo, hi in rules if x == q and not lo <= v <= hi]
        return "drop" if "drop_row" in failing else "suspect" if failing else "ok"

    cells = [("x", float(a) * 6) for m, _, _, a, _, _ in rows if a is not None and m == "1"] + [("y", float(v)) for *_, b, c in rows for v in (b, c) if v is not None]
    assert sorted((r.quantity, r.value, r.quality) for r in got) == sorted((q, v, judged(q, v)) for q, v in cells if judged(q, v) != "drop")
