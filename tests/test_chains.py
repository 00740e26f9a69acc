"""Chains of references to the mother's file against a walk in Python."""

import random

import pytest

from checks.inputs import scratch
from padron.operators.chains import chains


def walk(pairs):
    known = {e for e, _ in pairs if e}
    mother = {}
    for e, m in pairs:
        if e and m:
            mother[e] = min(m, mother.get(e, m))
    out = set()
    for e in mother:
        seen, at = [e], mother[e]
        while at in mother and at not in seen:
            seen.append(at)
            at = mother[at]
        if at in seen:
            out.add((e, None, None, None, min(seen[seen.index(at):])))
        else:
            out.add((e, at, len(seen), at in known, None))
    return out


def run(spark, pairs):
    rows = spark.createDataFrame([(i, e, m) for i, (e, m) in enumerate(pairs, 1)], "id int, expediente int, exp_madre int")
    found = chains(rows, scratch(spark)).collect()
    return {tuple(r) for r in found}, len(found)


LINE = [(n, n + 1) for n in range(1, 70)]
CASES = {
    "line up": LINE,
    "line down, end unknown": [(n + 1, n) for n in range(1, 40)],
    "fork": [(n, 500) for n in range(1, 30)] + [(500, 600), (600, None)],
    "self": [(7, 7), (8, 7)],
    "tail into a circle": [(n, n + 1) for n in range(1, 20)] + [(20, 18)],
    "circles and lines": [(1, 2), (2, 3), (3, 1), (9, 3), (8, 9), (30, 31), (31, 32), (40, 41), (41, 40)],
    "repeated and missing numbers": [(1, 5), (1, 2), (2, None), (None, 3), (0, 4), (6, 0), (5, 9), (5, 9)],
    "nothing": [(1, None)],
}


@pytest.mark.parametrize("name", CASES)
def test_cases(spark, name):
    found, n = run(spark, CASES[name])
    assert found == walk(CASES[name]) and n == len(found)


def test_random(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.choice([None, rng.randrange(300), rng.randrange(300)])) for _ in range(320)]
    found, n = run(spark, pairs)
    assert found == walk(pairs) and n == len(found)
    assert any(f[4] for f in found) and any((f[2] or 0) > 3 for f in found)
