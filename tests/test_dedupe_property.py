"""First-wins dedupe (D1, D2) against a brute-force reading, on random rows."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from bellwether.operators.serving import first_per_key

rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]),      # title (null is a key)
                          st.sampled_from(["p1", "p2"]),                # publishedAt
                          st.integers(0, 5),                           # order (ties allowed)
                          st.text(alphabet="xyz", max_size=3)),          # payload
                min_size=1, max_size=60)


def brute_force(data):
    best = {}
    for t, p, o, payload in data:
        k = (t, p)
        if k not in best or (o, payload) < (best[k][2], best[k][3]):
            best[k] = (t, p, o, payload)
    return sorted(best.values(), key=repr)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows)
def test_first_per_key_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "title string, publishedAt string, ord int, payload string")
    once = first_per_key(df, ["title", "publishedAt"], ["ord"])
    got = sorted((tuple(r) for r in once.collect()), key=repr)
    assert got == brute_force(data)
    again = sorted((tuple(r) for r in first_per_key(once, ["title", "publishedAt"], ["ord"]).collect()),
                   key=repr)
    assert again == got                                             # idempotent
