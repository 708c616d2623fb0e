"""Properties of the capped take (O3), stated without its algorithm."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bellwether import schemas
from bellwether.operators import serving

CAP = 5
records = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 200), st.booleans()), max_size=25,
                   unique_by=lambda r: r[:2])


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(records)
def test_capped_take_properties(spark, rows):
    df = spark.createDataFrame([(p, o, "ok" if ok else None) for p, o, ok in rows], schemas.TOPIC_RECORD)
    got = {(r["partition"], r["offset"]): r["idx"] for r in
           serving.capped_take(df, F.col("value").isNotNull(), CAP).collect()}
    place = {r[:2]: i for i, r in enumerate(sorted(rows))}
    valid = {r[:2] for r in rows if r[2]}
    assert all(got[k] == place[k] for k in got)                     # the index is the place in the read
    assert set(got) <= valid and len(got) <= CAP + 1
    assert {k for k in valid if place[k] < CAP} <= set(got)         # nothing valid before the cap is missing
    late = [k for k in got if place[k] >= CAP]
    assert late == sorted(k for k in valid if place[k] >= CAP)[:1]  # and one valid record after it
