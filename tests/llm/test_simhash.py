import random

import numpy as np
import pytest
import xxhash

from riskloom.llm import simhash
from riskloom.llm.graph import components


def plain_fingerprint(text):
    words = bytes((text or "").encode().lower()).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(pairs, limit=4):
    """component per position by comparing everything."""
    fps = [plain_fingerprint(t) for _, t in pairs]
    label = list(range(len(pairs)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= limit:
                label[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(pairs):
        r = root(i)
        if d is not None:
            low[r] = min(low.get(r, d), d)
    return [(d, f"{f:016x}", low.get(root(i))) for i, (d, f) in enumerate(zip([p[0] for p in pairs], fps, strict=True))]


def sample_texts():
    rng = random.Random(5)
    words = ["Alpha", "beta", "gamma", "Été", "x", "delta\x1c", "omega"]
    rows = [(7, None), (3, ""), (9, " \t"), (1, "one two"), (1, "one two"), (None, "ONE two"), (None, "lonely nameless words here now")]
    for i in range(60):
        base = [rng.choice(words) + str(rng.randint(0, 99)) for _ in range(rng.randint(1, 120))]
        rows.append((100 + 3 * i, " ".join(base)))
        for k in range(2):
            changed = list(base)
            changed[rng.randrange(len(changed))] = "changed"
            rows.append((101 + 3 * i + k, "\n".join(changed)))
    return rows


def test_against_brute_force(shared):
    rows = sample_texts()
    df = shared.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, fp int")
    got = [tuple(r) for r in simhash.near_duplicates(df.repartition(5)).collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


@pytest.mark.parametrize("bucket", [50_000, 3])
def test_links_lose_nothing(shared, bucket):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = {0, (1 << 64) - 1}
    for c in centres.tolist():
        for _ in range(12):
            x = c
            for b in rng.integers(0, 64, rng.integers(0, 6)).tolist():
                x ^= 1 << b
            fps.add(x)
    values = np.array(sorted(fps), dtype=np.uint64)
    df = shared.createDataFrame([(int(x),) for x in values.view(np.int64)], "fp long")
    nodes = {r.node: r.component for r in components(simhash.fingerprint_links(df, 4, bucket)).collect()}
    label = np.arange(len(values))
    near = np.bitwise_count(values[:, None] ^ values[None]) <= 4
    for _ in range(len(values)):
        label = np.where(near, label[None], len(values)).min(axis=1)
    mine = [nodes.get(x, x) for x in values.view(np.int64).tolist()]
    for i in range(len(values)):
        for j in range(i):
            assert (label[i] == label[j]) == (mine[i] == mine[j])


def test_keeps_one_of_each_group(shared):
    rows = sample_texts()
    df = shared.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, low string")
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    found = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    want = {(c is None, c or 0) for _, _, c in brute(rows)}
    assert found == sorted(want)


def test_empty(shared):
    df = shared.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).count() == 0
    assert simhash.drop_near_duplicates(df).count() == 0


def test_components_of_a_long_path_and_a_hub(shared):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(5, 5), (None, 3)]
    df = shared.createDataFrame(edges, "a long, b long").where("a is not null")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(1000, 1300), 1000)}


def test_workers_give_back_what_they_freed():
    """A kept Python worker returns freed memory to the system, so that one stage's does not count beside the next."""
    import gc
    import sys

    import pytest

    from riskloom.llm.shared import give_back

    if sys.platform != "linux":
        pytest.skip("sizes are read from /proc")

    def held() -> int:
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    texts = [bytes(1000) for _ in range(200_000)]
    last = bytes(1000)  # keeps the end of the heap in use, so that only a trim returns what lies before
    del texts
    gc.collect()
    before = held()
    give_back()
    assert last and before - held() > 50_000_000
