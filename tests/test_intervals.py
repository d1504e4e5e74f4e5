import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from caudalix.operators import intervals

DAY0 = dt.date(1999, 12, 20)


def brute(rows):
    out = {}
    for k, a, b in rows:
        if k is not None and a is not None and b is not None and a <= b:
            out.setdefault(k, []).append((a, b))
    found = set()
    for k, spans in out.items():
        merged = []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1] + dt.timedelta(1):
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        for i, (a, b) in enumerate(merged):
            found.add((k, "periodo", str(a), str(b)))
            if i + 1 < len(merged):
                found.add((k, "lacuna", str(b + dt.timedelta(1)), str(merged[i + 1][0] - dt.timedelta(1))))
    return found


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 60), st.integers(-3, 40)), max_size=25))
def test_like_brute_force(spark, spans):
    rows = [(k, DAY0 + dt.timedelta(s), DAY0 + dt.timedelta(s + n)) for k, s, n in spans] + [("c", None, DAY0), ("c", DAY0, None)]
    df = spark.createDataFrame(rows, "e string, a date, b date").withColumnRenamed("e", "entity")
    got = {tuple(r) for r in intervals.periods_and_gaps(df, "entity", "a", "b").collect()}
    assert got == brute(rows)


def test_empty_and_extra_columns(spark):
    df = spark.createDataFrame([], "codmaximo string, a date, b date, start long, level int, tipo string")
    assert intervals.periods_and_gaps(df, "codmaximo", "a", "b").count() == 0
    one = spark.createDataFrame([("x", DAY0, DAY0, 5, 1, "t")] * 3, df.schema)
    assert [tuple(r) for r in intervals.periods_and_gaps(one, "codmaximo", "a", "b").collect()] == [("x", "periodo", str(DAY0), str(DAY0))]
