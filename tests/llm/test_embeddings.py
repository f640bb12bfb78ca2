"""Embedding near-dedup against brute force."""

import numpy as np

from quarry.llm import embeddings
from quarry.llm import queries as q

from .test_simhash import plain_components

SCHEMA = "vec_id long, embedding array<float>, label int, n string, cls string"
SF = "/root/testdata/sf0.001"


def brute(rows):
    """vec_id -> (links, component); rows: (vec_id, vector, label)."""
    ok = {}
    for i, v, label in rows:
        if label is not None and v and None not in v and np.isfinite(np.float32(v)).all() and np.any(np.float32(v)):
            x = np.float32(v).astype(float)
            ok[i] = (label, x / np.linalg.norm(x))
    ids, linked = sorted(ok), []
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if ok[a][0] == ok[b][0] and len(ok[a][1]) == len(ok[b][1]) and ok[a][1] @ ok[b][1] >= 0.98:
                linked.append((a, b))
    comp = plain_components([r[0] for r in rows], linked)
    links = {r[0]: 0 for r in rows}
    for a, b in linked:
        links[a] += 1
        links[b] += 1
    return {i: (links[i], comp[i]) for i in comp}


def sample(dim=16, seed=2):
    rng, rows = np.random.default_rng(seed), []

    def add(v, label):
        rows.append((len(rows), None if v is None else [None if x is None else float(x) for x in v], label))

    for k in range(60):
        base = rng.normal(size=dim)
        add(base, k % 3)
        for _ in range(k % 4):
            add(base + rng.normal(size=dim) * 0.05, k % 3)
        if k % 10 == 0:
            add(base, k % 3)
            add(base * 7, k % 3)
            add(base, (k + 1) % 3)
            add(base, None)
    centre = rng.normal(size=dim)
    for _ in range(80):
        add(centre + rng.normal(size=dim) * 0.03, 1)
    for v in (None, [], [0.0] * dim, [None] + [1.0] * (dim - 1), [float("nan")] * dim, [float("inf")] * dim,
              [1.0], [2.0], [-3.0], [1.0, 0.0], [1.0, 0.05]):
        add(v, 2)
    return rows


def collect(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(4)
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_groups(df, **kw).collect()}


def test_equals_brute_force_with_full_recall(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "PART", 20)
    rows = sample()
    want = {i: (n, c, i == c) for i, (n, c) in brute(rows).items()}
    # every vector is described by all pivots, so the index must find everything
    got = collect(spark, rows, pivots=6, nearest=6)
    assert got == want
    assert sum(n for n, *_ in want.values()) > 1000


def test_recall_and_precision_with_the_parameters_of_the_query(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    want = brute([(r.vec_id, r.embedding, r.label) for r in table])
    got = {r.vec_id: r for r in q.op6_embedding_groups(spark, SF).collect()}
    assert got.keys() == want.keys()
    true, found = sum(n for n, _ in want.values()), sum(r.n_links for r in got.values())
    assert found >= 0.99 * true
    assert all(got[i].n_links <= n for i, (n, _) in want.items())
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_empty_and_repeated_rows(spark):
    assert collect(spark, []) == {}
    got = embeddings.near_groups(spark.createDataFrame([(1, [1.0, 2.0], 0, "", "")] * 2, SCHEMA)).collect()
    assert [(r.n_links, r.component_id, r.kept) for r in got] == [(1, 1, True)] * 2
