import numpy as np
from pyspark.sql import functions as F

from riskloom.llm import neighbours, vector_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, node int"


def cloud(n=900, d=12, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d)).astype(np.float32)
    x[100:160] = x[100] + 0.02 * rng.standard_normal((60, d))
    x[200:203] = x[200]
    label = rng.integers(0, 3, n)
    label[100:160], label[200:203] = 1, 2
    rows = [(i, x[i].tolist(), int(label[i]), 0) for i in range(n)]
    odd = [(n, None, 1, 0), (n + 1, [0.0] * d, 1, 0), (n + 2, [float("nan")] * d, 1, 0), (n + 3, [1.0] * (d + 1), 1, 0), (n + 4, x[100].tolist(), None, 0), (n + 5, [None] * d, 1, 0)]
    return x.astype(np.float64), label, rows + odd


def test_links_and_groups_equal_brute_force(shared):
    x, label, rows = cloud()
    df = shared.createDataFrame(rows, SCHEMA).repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_dedup.near_duplicates(df).collect()}
    norm = np.linalg.norm(x, axis=1)
    near = ((x @ x.T) / (norm[:, None] * norm[None]) >= 0.98) & (label[:, None] == label[None])
    np.fill_diagonal(near, False)
    low = np.arange(len(x))
    for _ in range(len(x)):
        low = np.minimum(low, np.where(near, low[None], len(x)).min(axis=1))
    assert len(got) == len(rows)
    for i in range(len(x)):
        assert got[i] == (near[i].sum(), low[i], low[i] == i)
    for i in range(len(x), len(rows)):
        assert got[i] == (0, i, True)


def test_block_of_a_saturated_group(shared, monkeypatch):
    monkeypatch.setattr(vector_dedup, "BLOCK", 16)
    x, label, rows = cloud(300)
    got = {r.vec_id: r.n_links for r in vector_dedup.near_duplicates(shared.createDataFrame(rows, SCHEMA)).collect()}
    norm = np.linalg.norm(x, axis=1)
    near = ((x @ x.T) / (norm[:, None] * norm[None]) >= 0.98) & (label[:, None] == label[None])
    assert [got[i] for i in range(300)] == (near.sum(axis=1) - 1).tolist()


def test_isolated_pairs_are_not_lost(shared, monkeypatch):
    # Runs this short lose most pairs, and few vectors have one: the audit's sample alone cannot tell.
    monkeypatch.setattr(vector_dedup, "RUN", 2)
    monkeypatch.setattr(vector_dedup, "NEIGHBOURS", 2)
    monkeypatch.setattr(vector_dedup, "WIDENED", 0)
    rng = np.random.default_rng(9)
    x = rng.standard_normal((3000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.standard_normal((30, 24))
    side -= (side * x[:30]).sum(axis=1, keepdims=True) * x[:30]
    x[30:60] = 0.982 * x[:30] + np.sqrt(1 - 0.982**2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    df = shared.createDataFrame([(i, v.tolist(), 1, 0) for i, v in enumerate(x)], SCHEMA).repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.near_duplicates(df).collect()}
    assert sum(got[i] == (1, i % 30) for i in range(60)) == 60 and all(got[i] == (0, i) for i in range(60, 3000))


def test_labels_in_full_if_links_stay_missing(shared, monkeypatch):
    monkeypatch.setattr(vector_dedup, "BLOCK", 40)
    monkeypatch.setattr(vector_dedup, "WIDENED", 0)
    monkeypatch.setattr(vector_dedup, "RECALL", 1.1)
    monkeypatch.setattr(vector_dedup, "_links", lambda lists, *_: lists.select("u", "v", F.lit(1).alias("cu"), F.lit(1).alias("cv")).limit(0))
    x, label, rows = cloud(300)
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.near_duplicates(shared.createDataFrame(rows, SCHEMA)).collect()}
    norm = np.linalg.norm(x, axis=1)
    near = ((x @ x.T) / (norm[:, None] * norm[None]) >= 0.98) & (label[:, None] == label[None])
    low = np.arange(300)
    for _ in range(300):
        low = np.where(near, low[None], 300).min(axis=1)
    assert [got[i] for i in range(300)] == list(zip((near.sum(axis=1) - 1).tolist(), low.tolist(), strict=True))


def test_chains_between_blocks_hang_together():
    on = np.zeros((4, 3), dtype=bool)
    on[[0, 2, 2, 3], [0, 0, 1, 1]] = True
    row, column = vector_dedup._joined(on)
    assert row.tolist() == [0, 1, 0, 0] and column.tolist() == [0, 0, 4]


def test_orders_grow_with_the_label():
    small, large, huge = (vector_dedup._orders(n, 0.98) for n in (500, 100_000, 500_000_000))
    assert small[0] < large[0] < huge[0] and small[1] == vector_dedup.BITS < huge[1] <= 31


def test_empty_vectors(shared):
    assert vector_dedup.near_duplicates(shared.createDataFrame([], SCHEMA)).count() == 0
    assert neighbours.search(neighbours.build_index(shared.createDataFrame([], SCHEMA)), shared.createDataFrame([], "id long, vector array<double>")).count() == 0


def test_search_recall_ties_and_scores(shared):
    x, _, rows = cloud(2000)
    rows = [r for r in rows if r[2] is not None]
    df = shared.createDataFrame([*rows, rows[7]], SCHEMA).repartition(5)
    index = neighbours.build_index(df, parts=8)
    assert index.parts == 8 and index.visits <= 8 and index.recall >= 0.95
    queries = index.table.where(F.col("id") % 20 == 0).select("id", "vector")
    got = neighbours.search(index, queries, 10).collect()
    by_query = {}
    for r in got:
        by_query.setdefault(r.query_id, []).append((r.rank, r.id, r.score))
    assert set(by_query) == {i for i in range(2000) if i % 20 == 0}
    hits = 0
    for q, found in by_query.items():
        distance = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 11)) and all(distance[i] == s and i != q for _, i, s in found)
        assert [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found)
        distance[q] = np.inf
        hits += len(set(np.lexsort((np.arange(2000), distance))[:10].tolist()) & {i for _, i, _ in found})
    assert hits >= 0.9 * 10 * len(by_query)
    index.visits = index.parts
    exact = {(r.query_id, r.id) for r in neighbours.search(index, queries, 10).collect()}
    distance = np.sqrt(((x - x[200]) ** 2).sum(axis=1))
    distance[200] = np.inf
    assert {i for q, i in exact if q == 200} == set(np.lexsort((np.arange(2000), distance))[:10].tolist())


def test_repeated_rows_take_no_places(shared):
    x, _, rows = cloud(600)
    rows = [r for r in rows[:600] if r[2] is not None]
    near = int(np.argsort(((x - x[0]) ** 2).sum(axis=1))[1])
    df = shared.createDataFrame(rows + [rows[near]] * 20, SCHEMA).coalesce(1)
    index = neighbours.build_index(df)
    assert index.table.count() == 600
    got = {r.id: r.rank for r in neighbours.search(index, index.table.where("id = 0").select("id", "vector"), 10).collect()}
    distance = np.sqrt(((x - x[0]) ** 2).sum(axis=1))
    distance[0] = np.inf
    index.visits = index.parts
    exact = [r.id for r in neighbours.search(index, index.table.where("id = 0").select("id", "vector"), 10).orderBy("rank").collect()]
    assert len(got) == 10 and exact == np.lexsort((np.arange(600), distance))[:10].tolist()


def test_balanced_parts():
    x = np.random.default_rng(0).standard_normal((512, 8))
    part = neighbours.balanced_parts(neighbours._graph(x, 6), 8)
    assert np.bincount(part).tolist() == [64] * 8


def brute(vectors, labels, threshold=0.98):
    """(n_links, component) of each row by comparing all rows, as plainly as can be."""
    n = len(vectors)
    on = np.zeros((n, n), dtype=bool)
    for i in range(n):
        for j in range(n):
            if i != j and labels[i] is not None and labels[i] == labels[j] and len(vectors[i]) == len(vectors[j]):
                x, y = np.array(vectors[i], dtype=np.float64), np.array(vectors[j], dtype=np.float64)
                on[i, j] = (x * y).sum() / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold
    low = np.arange(n)
    for _ in range(n):
        low = np.minimum(low, np.where(on, low[None], n).min(axis=1))
    return list(zip(on.sum(axis=1).tolist(), low.tolist(), strict=True))


def test_text_labels_every_length_and_doubles_beside_the_threshold(shared):
    rng = np.random.default_rng(4)
    vectors, labels = [], []
    for i in range(60):
        x = rng.standard_normal(8)
        x /= np.linalg.norm(x)
        away = rng.standard_normal(8)
        away -= (away @ x) * x
        away /= np.linalg.norm(away)
        cosine = 0.98 + (1e-9 if i % 2 else -1e-9)
        vectors += [x.tolist(), (cosine * x + np.sqrt(1 - cosine**2) * away).tolist()]
        labels += ["b" * (i % 3 + 1)] * 2
    vectors += [[1.0, 2.0], [1.0, 2.0], [2.0, 4.0], [1.0, 2.0], [1.0, 2.0, 3.0]]
    labels += ["short", "short", "short", None, "short"]
    df = shared.createDataFrame([(i, v, t) for i, (v, t) in enumerate(zip(vectors, labels, strict=True))], "vec_id long, embedding array<double>, label string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.near_duplicates(df).collect()}
    assert [got[i] for i in range(len(vectors))] == brute(vectors, labels)


def test_labels_beyond_32_bits(shared):
    rows = [(0, [1.0, 0.0], 2**40), (1, [1.0, 0.01], 2**40), (2, [1.0, 0.02], 2**41), (3, [0.0, 1.0], 2**40)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.near_duplicates(shared.createDataFrame(rows, "vec_id long, embedding array<float>, label long")).collect()}
    assert got == {0: (1, 0), 1: (1, 0), 2: (0, 2), 3: (0, 3)}


def test_core_of_a_group_is_counted_and_the_rest_compared(shared, monkeypatch):
    # A dense middle, a rim that is linked with part of it, and a chain that leads away.
    monkeypatch.setattr(vector_dedup, "BLOCK", 16)
    rng = np.random.default_rng(6)
    centre = rng.standard_normal(16)
    centre /= np.linalg.norm(centre)
    vectors = [(centre + 0.015 * rng.standard_normal(16)).tolist() for _ in range(80)]
    vectors += [(centre + 0.05 * rng.standard_normal(16)).tolist() for _ in range(60)]
    step = rng.standard_normal(16) * 0.04
    vectors += [(centre + i * step).tolist() for i in range(20)]
    vectors += [vectors[0], vectors[100], vectors[159]]
    df = shared.createDataFrame([(i, v, 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int").repartition(5)
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.near_duplicates(df).collect()}
    assert [got[i] for i in range(len(vectors))] == brute(vectors, [1] * len(vectors))
