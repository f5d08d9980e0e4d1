import numpy as np

from adstream.llm.multi_index import Grid, Index, near_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int, cell int, members long"


def brute(rows):
    known = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v) and len(v) == 8:
            known[i] = np.array(v, np.float32).astype(float)
    ids = list(known)
    unit = np.array([known[i] / np.linalg.norm(known[i]) for i in ids]).reshape(-1, 8)
    near = unit @ unit.T >= 0.95
    root = {i: i for i in known}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in np.argwhere(near):
        x, y = find(ids[a]), find(ids[b])
        root[max(x, y)] = min(x, y)
    links = {i: int(near[k].sum()) - 1 for k, i in enumerate(ids)}
    return sorted(
        ((i, links.get(i, 0), find(i) if i in known else i, i is not None and (i not in known or find(i) == i)) for i, _ in rows),
        key=str,
    )


def found(spark, rows, how=Index()):
    made = near_duplicates(spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], SCHEMA), how)
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in made.collect()), key=str)


def test_odd_vectors_and_copies(spark):
    one = [1.0] + [0.0] * 7
    rows = [
        (5, one), (3, one), (4, [2 * x for x in one]), (6, [1.0, 0.1] + [0.0] * 6), (7, None), (8, []),
        (9, [0.0] * 8), (10, [float("nan")] * 8), (11, [None] * 8), (12, one[:4]), (None, one), (13, [0.0] * 7 + [1.0]),
        (5, one), (14, [float("inf")] + one[1:]),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == [] and found(spark, [(1, None)]) == [(1, 0, 1, True)]


def test_links_of_random_vectors(spark):
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(40, 8))
    rows = [(k, (centres[k % 40] + draw.normal(0, 0.12, 8)).tolist()) for k in range(600)]
    made, wanted = found(spark, rows, Index(per_cell=16, block=32)), brute(rows)
    seen, true = sum(r[1] for r in made), sum(r[1] for r in wanted)
    assert 0.99 * true <= seen <= true


def test_visits_are_the_nearest_cells():
    draw = np.random.default_rng(2)
    unit = draw.normal(size=(50, 6))
    grid = Grid(unit, 5, 4)
    one, other = grid.near(unit)
    total = (one[:, :, None] + other[:, None, :]).reshape(50, -1)
    for cells in (1, 3, 9, 25):
        made = np.take_along_axis(total, grid.visits(unit, cells), axis=1)
        assert np.allclose(made, np.sort(total, axis=1)[:, :cells])


def test_rare_links_are_found_whatever_the_sample_holds(spark):
    draw = np.random.default_rng(3)
    unit = draw.normal(size=(4000, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    aside = draw.normal(size=(100, 64))
    aside -= (aside * unit[:100]).sum(1)[:, None] * unit[:100]
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    near = 0.96 * unit[:100] + (1 - 0.96**2) ** 0.5 * aside
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([unit, near]))]
    made = found(spark, rows, Index(queries=16))
    assert sum(r[1] for r in made) >= 0.9 * 200
    assert all(r[1] <= 1 and r[2] == (r[0] - 4000 if r[0] >= 4000 and r[1] else r[0]) for r in made)


def test_vectors_of_each_dimension_link_among_themselves(spark):
    rows = [(k, [1.0, k / 1000] + [0.0] * 6) for k in range(5)] + [(10 + k, [0.0, 2.0, 1.0]) for k in range(3)]
    rows += [(20, [1.0, 0.0]), (21, [0.0, 1.0]), (22, [3.0])]
    got = {r[0]: r[1:3] for r in found(spark, rows)}
    assert [got[k] for k in range(5)] == [(4, 0)] * 5
    assert [got[10 + k] for k in range(3)] == [(2, 10)] * 3
    assert [got[k] for k in (20, 21, 22)] == [(0, 20), (0, 21), (0, 22)]
