"""EXT-14: cycles in few rounds, against a plain search."""

import random

import pytest

from ledgerlens.operators import extensions as X
from tests.conftest import rows

EDGES = "hierarchy_type string, as_of_date string, child_party_key string, parent_party_key string"


def _edges(spark, pairs, kind="LEGAL_OWNERSHIP"):
    return spark.createDataFrame([(kind, "2026-03-31", c, p) for c, p in pairs], EDGES).selectExpr(
        "hierarchy_type", "cast(as_of_date as date) as as_of_date", "child_party_key", "parent_party_key")


def _on_cycles(pairs):
    """Edges whose parent reaches their child again, by search from each."""
    up = {}
    for c, p in pairs:
        up.setdefault(c, set()).add(p)
    out = set()
    for c, p in set(pairs):
        seen, todo = {p}, [p]
        while todo:
            for n in up.get(todo.pop(), ()):
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        if c in seen:
            out.add((c, p))
    return sorted(out)


@pytest.mark.parametrize("seed,parties,several", [(1, 60, 0.0), (2, 60, 0.1), (3, 40, 0.3), (4, 120, 0.05)])
def test_random_hierarchies_against_a_plain_search(spark, seed, parties, several):
    rng = random.Random(seed)
    pairs = []
    for i in range(parties):
        for _ in range(1 + (rng.random() < several)):
            if rng.random() < 0.9:  # else no parent
                pairs.append((f"p{i}", f"p{rng.randrange(parties)}"))
    # the same parties in a second hierarchy, the other way round
    back = [(p, c) for c, p in pairs]
    got = X.hierarchy_cycles(_edges(spark, pairs).unionByName(_edges(spark, back, "OTHER"))).cache()
    for kind, given in (("LEGAL_OWNERSHIP", pairs), ("OTHER", back)):
        assert rows(got.where(f"hierarchy_type = '{kind}'"), "child_party_key", "parent_party_key") == _on_cycles(given)


def test_long_chains_and_cycles_end_in_few_rounds(spark, monkeypatch):
    """A chain and a cycle of 10,000 links each, and a cycle of long chains between parties
    with two parents, in fewer than 40 written rounds."""
    n, rounds = 10_000, []
    kind = type(spark.range(1))
    written = kind.checkpoint
    monkeypatch.setattr(kind, "checkpoint", lambda self, *a, **k: (rounds.append(1), written(self, *a, **k))[1])
    chain = [(f"a{i}", f"a{i + 1}") for i in range(n)]
    cycle = [(f"c{i}", f"c{(i + 1) % n}") for i in range(n)]
    got = X.hierarchy_cycles(_edges(spark, chain + cycle))
    assert got.where("child_party_key like 'c%'").count() == n and got.count() == n
    assert len(rounds) < 40
    rounds.clear()
    ring = [(f"r{i}", f"r{(i + 1) % 3_000}") for i in range(3_000)]
    side = [("r0", "s0"), *[(f"s{i}", f"s{i + 1}") for i in range(999)], ("s999", "r1500"), ("r7", "a0")]
    got = X.hierarchy_cycles(_edges(spark, chain[:2_000] + ring + side))
    assert rows(got, "child_party_key", "parent_party_key") == sorted(ring + side[:-1])
    assert len(rounds) < 60


def test_no_edges_and_null_ends(spark):
    none = spark.createDataFrame([("L", None, "x", None), ("L", None, None, "y")], EDGES).selectExpr(
        "hierarchy_type", "cast(as_of_date as date) as as_of_date", "child_party_key", "parent_party_key")
    assert X.hierarchy_cycles(none).count() == 0


def test_rounds_send_no_table_through_the_driver_and_hanging_trees_go_first(spark, monkeypatch):
    """A wide tree over a cycle, with parties of two parents: no join of a round is a
    broadcast, and what is jumped over is no more than the cycle and its chains."""
    n = 4_000
    tree = [(f"t{i:05}", f"t{i // 20:05}") for i in range(1, n)] + [("t00000", "t00001")]
    side = [(f"t{i:05}", f"t{i + 1:05}") for i in range(100, n - 1, 500)]
    kind, plans, sizes = type(spark.range(1)), [], []
    written, steps = kind.checkpoint, X._single_steps
    monkeypatch.setattr(kind, "checkpoint", lambda self, *a, **k: (
        plans.append(self._jdf.queryExecution().executedPlan().toString()), written(self, *a, **k))[1])
    monkeypatch.setattr(X, "_single_steps", lambda edges: (sizes.append(edges.count()), steps(edges))[1])
    got = X.hierarchy_cycles(_edges(spark, tree + side))
    assert rows(got, "child_party_key", "parent_party_key") == _on_cycles(tree + side)
    assert sizes == [s for s in sizes if s < n // 10]
    assert plans and not [p for p in plans if "Broadcast" in p]
