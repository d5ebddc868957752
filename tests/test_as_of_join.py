"""As-of join: every fact with its own valid and known time."""

import datetime
import random

from ledgerlens.operators import extensions as ext

DAY = datetime.date(2024, 1, 1)


def at(n):
    return None if n is None else DAY + datetime.timedelta(n)


def expected(fact, versions):
    key, valid, known = fact
    seen = [v for v in versions if v[0] == key and None not in (key, valid, known, v[1], v[2]) and v[1] <= valid and v[2] <= known]
    return max(seen, key=lambda v: v[1:])[3] if seen else None


def joined(spark, facts, versions):
    f = spark.createDataFrame([(k, at(v), at(n), i) for i, (k, v, n) in enumerate(facts)], "k string, v date, n date, id int")
    w = spark.createDataFrame([(k, at(v), at(n), x) for k, v, n, x in versions], "k string, valid date, known date, x int")
    return ext.as_of_join(f, w, ["k"], "v", "n", "valid", "known", ["x"])


def test_each_fact_sees_its_own_version(spark):
    """Ties, late corrections, times before and after all versions, nulls, a hot key."""
    r = random.Random(3)
    time = lambda: None if r.random() < 0.03 else r.randrange(40)
    name = lambda: r.choice(["hot"] * 5 + ["a", "b", "only", None])
    versions = [(name(), time(), time(), r.randrange(5)) for _ in range(300)] + [("once", 10, 70, 1)]
    versions = [v for v in versions if v[0] != "only"] + versions[:5]
    facts = [(name(), time(), time()) for _ in range(400)] + [("once", 10, 69), ("once", 10, 70), ("once", 10, 500), ("hot", -5, 10), ("hot", 10, -5)] + [("hot", 20, 20)] * 3
    got = {x.id: x.x for x in joined(spark, facts, versions).collect()}
    assert got == {i: expected(f, versions) for i, f in enumerate(facts)}


def test_empty_tables_and_columns(spark):
    assert [tuple(x) for x in joined(spark, [("a", 1, 1)], []).collect()] == [("a", at(1), at(1), 0, None)]
    out = joined(spark, [], [("a", 1, 1, 1)])
    assert out.columns == ["k", "v", "n", "id", "x"] and out.count() == 0


def test_no_pairs_in_the_plan(spark):
    """A key's facts and versions meet by dates: no join of facts with versions."""
    plan = joined(spark, [("a", 1, 1)], [("a", 1, 1, 1)])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and plan.count("Join") == 1


def test_keys_with_few_and_with_many_versions(spark, monkeypatch):
    """The same rows whether a key's versions are one row or go by blocks; without keys of
    many versions nothing is dealt out by block, and facts are dealt out once."""
    r = random.Random(5)
    versions = [(f"k{r.randrange(6) ** 2}", r.randrange(40), r.randrange(40), r.randrange(5)) for _ in range(200)]
    versions += [(f"n{i}", i, i, i) for i in range(30)] + [(None, 1, 1, 1)] * 9
    facts = [(r.choice(["k0", "k1", "k25", "n3", "n9", "none", None]), r.randrange(40), r.randrange(40)) for _ in range(300)]
    wanted = {i: expected(f, versions) for i, f in enumerate(facts)}
    for few in (0, 5, ext.FEW_VERSIONS, 1000):
        monkeypatch.setattr(ext, "FEW_VERSIONS", few)
        assert {x.id: x.x for x in joined(spark, facts, versions).collect()} == wanted, few
    plan = joined(spark, facts, versions)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Generate" not in plan and plan.count("Exchange") <= 3
