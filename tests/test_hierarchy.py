import random

import pytest

from leafmill.operators.hierarchy import circle_trees, descendants, hierarchy, level_errors

SCHEMA = "id long, parent_section_id long, doc_id long, level int, path string, exit string"


def brute(rows):
    up = {}
    for i, p, *_ in rows:
        if i is not None and (i not in up or up[i] is None or (p is not None and p < up[i])):
            up[i] = p
    out = {}
    for i in up:
        way, seen, x = [i], {i}, i
        while up[x] in up:
            x = up[x]
            if x in seen:
                out[i] = (min(way[way.index(x) :]), None, True, None)
                break
            way.append(x)
            seen.add(x)
        else:
            out[i] = (x, len(way) - 1, False, way[::-1])
    return out


def found(df):
    return {r["id"]: (r["root_id"], r["depth"], r["in_cycle"], r["path"]) for r in df.collect()}


@pytest.mark.parametrize("limit", [7, 60, 10_000])
@pytest.mark.parametrize("kind", ["random", "chain and circle", "hot"])
def test_against_walking_up(spark, limit, kind):
    rng = random.Random(3)
    if kind == "random":
        ids = rng.sample(range(1000), 150)
        rows = [(i, rng.choice([*ids, None, 5000]), rng.choice([1, 2, None]), rng.choice([0, 1, None]), "x", None) for i in ids]
    elif kind == "chain and circle":
        rows = [(i, i - 1, i % 3, i, "x", "y") for i in range(1, 250)] + [(1000 + i, 1000 + (i + 1) % 70, i, 0, "", "") for i in range(70)] + [(2000, 1003, 1, 1, "", "")]
    else:
        rows = [(i, i // 2 if i else None, 1, 0, "", "") for i in range(200)]
    rows += rows[:3] + [(None, 1, 1, 1, None, None)]
    assert found(hierarchy(spark.createDataFrame(rows, SCHEMA), limit=limit)) == brute(rows)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert hierarchy(df).collect() == [] and level_errors(df).collect() == []


def test_descendants_and_levels(spark):
    rows = [(1, None, 1, 0, "", ""), (2, 1, 1, 1, "", ""), (3, 2, 1, 5, "", ""), (4, 2, 1, None, "", ""), (8, 9, 1, 0, "", ""), (9, 8, 1, None, "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in descendants(hierarchy(df)).collect()} == {(1, 2, 1), (1, 3, 2), (2, 3, 1), (1, 4, 2), (2, 4, 1)}
    assert {tuple(r) for r in level_errors(df).collect()} == {(3, 1), (8, 8), (9, 8)}


@pytest.mark.parametrize("limit", [20, 10_000])
def test_pairs_below_circles(spark, limit):
    rng = random.Random(5)
    up = {i: i + 1 for i in range(40)} | {39: 0, 50: 50, 90: None} | {i: rng.choice([*range(40), 50, *range(100, i)]) for i in range(100, 180)} | {200: 90}
    df = spark.createDataFrame([(i, p, i % 3, 0, "", "") for i, p in up.items()], SCHEMA)
    on = {*range(40), 50}
    want = set()
    for i in range(100, 180):
        x, far = i, 0
        while x not in on:
            x, far = up[x], far + 1
            want.add((x, i, far))
    got = circle_trees(df, hierarchy(df, limit=limit), limit=limit)
    assert {tuple(r) for r in descendants(got).collect()} == want
    assert {(r["id"], r["root_id"], r["path"] == [r["id"]]) for r in got.where("on_circle").collect()} == {(i, 50 if i == 50 else 0, True) for i in on}
    assert circle_trees(df.where("id >= 90 AND id < 100"), hierarchy(df.where("id >= 90 AND id < 100"))).collect() == []
