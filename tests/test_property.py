"""Fold random batches through scd2_merge and compare with a dictionary model."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from histdim.operators.history import scd2_merge

SCHEMA = "id int, v string, dwh_create_date timestamp_ntz, is_current string, modified_dt date"
values = st.sampled_from([None, "", "a", "b", "c"])
batch = st.dictionaries(st.integers(0, 12), values, max_size=10)


def model(batches):
    active, rows = {}, []            # key -> (v, created); rows = expired history
    for day, src in enumerate(batches, start=1):
        ts = dt.datetime(2024, 1, day)
        for k, v in src.items():
            if k in active:
                old, created = active[k]
                if (old or "") != (v or ""):        # sentinel rule: NULL == ''
                    rows.append((k, old, created, "I", ts.date()))
                    active[k] = (v, ts)
            else:
                active[k] = (v, ts)
    rows += [(k, v, c, "A", None) for k, (v, c) in active.items()]
    return sorted(rows, key=repr)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(batch, min_size=1, max_size=3))
def test_merge_matches_model(spark, batches):
    table = spark.createDataFrame([], SCHEMA)
    for day, src in enumerate(batches, start=1):
        s = spark.createDataFrame(list(src.items()), "id int, v string")
        table = scd2_merge(table, s, "id", dt.datetime(2024, 1, day))
        table = spark.createDataFrame(table.collect(), SCHEMA)   # keep plans small
    got = sorted([tuple(r) for r in table.collect()], key=repr)
    assert got == model(batches)
