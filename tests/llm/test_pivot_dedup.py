import numpy as np

from dwellmap.llm import pivot_dedup
from dwellmap.llm.queries import op1_near_vectors


def brute(rows, least=0.9):
    units = {}
    for i, v in rows:
        u = pivot_dedup.unit(v)
        if u is not None and i is not None and len(u) == len(rows[0][1]):
            units[i] = u
    ids = sorted(units)
    u = np.stack([units[i] for i in ids])
    close = u @ u.T >= least
    np.fill_diagonal(close, False)
    component = {i: i for i, _ in rows if i is not None}
    changed = True
    while changed:
        changed = False
        for a, b in zip(*np.nonzero(close), strict=True):
            low = min(component[ids[a]], component[ids[b]])
            changed |= component[ids[a]] != low or component[ids[b]] != low
            component[ids[a]] = component[ids[b]] = low
    links = {i: int(n) for i, n in zip(ids, close.sum(axis=1), strict=True)}
    return {i: (links.get(i, 0), c) for i, c in component.items()}


def rows_of(rng, groups, sizes, noise, dim=48):
    rows = []
    for g in range(groups):
        center = rng.normal(size=dim)
        for _ in range(sizes[g % len(sizes)]):
            rows.append((len(rows), (center + rng.normal(size=dim) * noise).tolist()))
    return rows


def test_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = rows_of(rng, 500, [1, 1, 2, 3, 9], 0.2)
    rows += [(len(rows) + i, rows[0][1]) for i in range(700)]
    rows += [(9000, None), (9001, [0.0] * 48), (9002, [float("nan")] * 48), (9003, [1.0, None]), (9004, [1.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in pivot_dedup.near_vectors(docs).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(g[0] for g in got.values()) >= 0.95 * sum(w[0] for w in want.values())
    assert np.mean([got[i] == want[i] for i in want]) > 0.95


def test_long_lists_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(pivot_dedup, "BLOCK", 16)
    rng = np.random.default_rng(1)
    rows = rows_of(rng, 1, [300], 0.05) + [(1000 + i, v) for i, v in rows_of(rng, 200, [1], 1)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in pivot_dedup.near_vectors(docs).collect()}
    want = brute(rows)
    assert all(got[i][1] == want[i][1] for i in want)
    assert sum(g[0] for g in got.values()) > 0.98 * sum(w[0] for w in want.values())
    assert sum(g[2] for g in got.values()) == 201


def test_recall_on_the_table(spark):
    path = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id) for r in op1_near_vectors(spark, path).collect()}
    assert got == brute(rows)


def test_edge_rows(spark):
    schema = "vec_id long, embedding array<float>, unit string, top string, n_links string"
    assert pivot_dedup.near_vectors(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, [1.0, 2.0], "u", "t", "n"), (1, [1.0, 2.0], "u", "t", "n"), (None, [1.0, 2.0], None, None, None)]
    rows += [(2, [2.0, 4.0], "u", "t", "n"), (3, [-1.0, -2.0], "u", "t", "n"), (4, [], "u", "t", "n")]
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in pivot_dedup.near_vectors(spark.createDataFrame(rows, schema)).collect())
    assert got == [(0, 0, None, False), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True)]


def test_a_vector_that_makes_up_most_of_the_table(spark):
    rng = np.random.default_rng(5)
    rare = rows_of(rng, 60, [1, 2, 3], 0.1, 16)
    common = spark.range(400_000).selectExpr("id + 100000 AS vec_id", "array(1D, 2D, 3D, 4D) AS embedding")
    # Near the common one, and all others of another length.
    close = [(50_000, [1.0, 2.0, 3.0, 4.5]), (50_001, [1.0, 2.0, 3.5, 4.0])]
    others = spark.createDataFrame(rare + close, "vec_id long, embedding array<double>")
    out = pivot_dedup.near_vectors(common.unionByName(others)).where("n_links > 0 OR vec_id < 100000").persist()
    assert out.where("vec_id >= 100000 AND n_links = 400001 AND component_id = 50000").count() == 400_000
    got = {r.vec_id: (r.n_links, r.component_id) for r in out.where("vec_id < 100000").collect()}
    assert got[50_000] == (400_001, 50_000) and got[50_001] == (400_001, 50_000)
    assert {i: got[i] for i, _ in rare} == brute(rare)
    out.unpersist()


def test_every_length_is_indexed(spark):
    rng = np.random.default_rng(6)
    short, long = rows_of(rng, 100, [1, 3], 0.1, 8), rows_of(rng, 90, [2, 1], 0.1, 40)
    long = [(i + 5000, v) for i, v in long]
    ten = [(9000 + i, [1.0, 2.0, 3.0]) for i in range(10)] + [(9100 + i, [1.0, float(i)]) for i in range(4)]
    docs = spark.createDataFrame(short + long + ten, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in pivot_dedup.near_vectors(docs).collect()}
    want = brute(short) | brute(long) | brute(ten[:10]) | brute(ten[10:])
    assert got == want
