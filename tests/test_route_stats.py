"""Route statistics from the histogram, ranked value counts, stacked cardinalities, the guarded import."""

import datetime as dt
import random
import statistics
import subprocess
import sys

from delaylens.operators import reports as R


def test_route_stats_against_plain_python(spark):
    rng = random.Random(8)
    routes = ["A-B", "B-A", "C-D", None, "only nulls", "one"]
    rows = [(rng.choice(routes[:4]), rng.choice([None, 0.0, 0.0, 5.0, 15.5, 60.0, 61.0, 200.0]),
             dt.date(1950, 1, 1) + dt.timedelta(days=rng.randint(0, 30000)) if rng.random() < 0.95 else None) for _ in range(3000)]
    rows += [("only nulls", None, dt.date(2020, 1, 1))] * 3 + [("one", 7.0, dt.date(2020, 1, 1))]
    frame = spark.createDataFrame(rows, "Route string, DepDelayMinutes double, DepDate date")
    got = {r["Route"]: r.asDict() for r in R.route_stats(frame, min_flights=0).collect()}
    assert set(got) == set(routes) - {None}
    for route, r in got.items():
        own = [(m, d) for k, m, d in rows if k == route]
        known = [m for m, _ in own if m is not None]
        assert r["Flight_Count"] == len(known)
        assert r["Days_Operated"] == len({d for _, d in own if d is not None})
        for name, cond in (("Delay_Frequency", lambda m: m > 0), ("Major_Delay_Rate", lambda m: m > 60), ("On_Time_Rate", lambda m: m == 0)):
            assert abs(r[name] - 100 * sum(map(cond, known)) / len(own)) < 1e-9
        if known:
            assert abs(r["Avg_Delay"] - statistics.mean(known)) < 1e-9 and r["Median_Delay"] == statistics.median(known)
            assert r["Max_Delay"] == max(known)
        if len(known) > 1:
            assert abs(r["Delay_Std"] - statistics.stdev(known)) < 1e-9
        else:
            assert r["Delay_Std"] is None


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_route_stats_keep_to_hash_aggregates(spark):
    frame = spark.createDataFrame([("r", 1.0, dt.date(2020, 1, 1))], "Route string, DepDelayMinutes double, DepDate date")
    text = plan(R.route_stats(frame))
    assert "ObjectHashAggregate" not in text and "SortAggregate" not in text and "percentile" not in text


def test_value_counts_limit_the_groups_of_each_task(spark):
    rows = [(f"v{i % 50}", f"w{i % 7}", None if i % 3 else "x") for i in range(500)]
    frame = spark.createDataFrame(rows, "a string, b string, c string")
    out = R.value_counts_many(frame, ["a", "b", "c"], top={"a": 3, "b": 2})
    assert "WindowGroupLimit" in plan(out)
    assert sorted(tuple(r) for r in out.collect()) == [("a", "v0", 10), ("a", "v1", 10), ("a", "v10", 10), ("b", "w0", 72), ("b", "w1", 72),
                                                       ("c", "x", 167)]


def test_cardinality_without_expand(spark):
    frame = spark.createDataFrame([(1, "a", None), (1, "b", None), (2, None, None)], "x int, y string, z string")
    out = R.cardinality(frame, ["x", "y", "z"])
    assert "Expand" not in plan(out)
    assert dict(map(tuple, out.collect())) == {"x": 2, "y": 2, "z": 0}
    assert dict(map(tuple, R.cardinality(frame.limit(0), ["x"]).collect())) == {"x": 0}


def test_queries_load_without_what_the_corpus_operators_import():
    code = "import sys; sys.modules['public_tokenizers'] = None\nimport __spark_entry__ as E\nq = E.queries()\nassert 'route_stats' in q and 'pipeline' not in q and E.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests/", 1)[0])
