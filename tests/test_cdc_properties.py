"""SCD1 against a brute-force definition on random feeds (Hypothesis)."""

from __future__ import annotations

import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from unitmart.operators.cdc import latest_per_key

BASE = datetime.datetime(2024, 1, 1)
change = st.tuples(
    st.sampled_from(["a", "b", "c"]),                              # key
    st.one_of(st.none(), st.sampled_from(["x", "y", "z"])),         # payload
    st.one_of(st.none(), st.integers(0, 3)),                        # sequence (minutes), ties likely
    st.one_of(st.none(), st.sampled_from([0, 1])),                  # delete flag
)


def brute_force(feed):
    """Per key the greatest (sequence, is-delete, then the remaining columns in
    column order: payload ``v``, raw flag), nulls lowest; drop deletes."""
    best = {}
    for k, v, t, d in feed:
        rank = (t is not None, t if t is not None else -1, d == 1, v is not None, v or "",
                d is not None, d if d is not None else -1)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, v, None if t is None else BASE + datetime.timedelta(minutes=t), d))
    return sorted((r for rank, r in best.values() if not rank[2]), key=repr)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(change, min_size=1, max_size=25))
def test_both_forms_match_brute_force(spark, feed):
    df = spark.createDataFrame(
        [(k, v, None if t is None else BASE + datetime.timedelta(minutes=t), d) for k, v, t, d in feed],
        "k string, v string, updated_at timestamp_ntz, is_deleted int")
    want = brute_force(feed)
    for method in ("window", "aggregate"):
        assert rows(latest_per_key(df, ["k"], method=method)) == want, method
