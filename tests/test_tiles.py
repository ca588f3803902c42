"""The cheap matrix of a block pair is looked at in tiles and few pairs are measured exactly; answers stay exact."""

import numpy as np
import pytest

from riskloom.operators import neighbors


def plain(a, b, k, metric, farthest):
    gap = a[:, None, :] - b[None, :, :]
    dist = np.abs(gap).sum(-1) if metric == "l1" else np.sqrt((gap * gap).sum(-1))
    order = np.argsort(-dist if farthest else dist, axis=1, kind="stable")[:, :k]
    return order, np.take_along_axis(dist, order, axis=1)


@pytest.mark.parametrize("metric", ["l1", "l2"])
@pytest.mark.parametrize("farthest", [False, True])
@pytest.mark.parametrize("bounded", [False, True])
def test_tiles_give_the_exact_answer(monkeypatch, metric, farthest, bounded):
    rng = np.random.default_rng(5)
    a, b = np.round(rng.normal(size=(90, 6)), 1), np.round(rng.normal(size=(5003, 6)), 1)  # ties within and across tiles
    order, dist = plain(a, b, 7, metric, farthest)
    bound = np.where(rng.random(90) < 0.5, np.inf, (-1 if farthest else 1) * dist[:, 6]) if bounded else None
    held, measured = [], []
    hits, gathered = neighbors._hits, neighbors._gathered
    monkeypatch.setattr(neighbors, "_hits", lambda mask: held.append(mask.size) or hits(mask))
    monkeypatch.setattr(neighbors, "_gathered", lambda a, b, row, *rest: measured.append(len(row)) or gathered(a, b, row, *rest))
    monkeypatch.setattr(neighbors, "TILE", (64, 1024), raising=False)
    row, col, found = neighbors.block_top(a, b, 7, metric, farthest, bound)
    assert max(held) <= 64 * 1024  # not whole rows of the block
    assert row.tolist() == np.repeat(np.arange(90), 7).tolist()
    assert col.reshape(90, 7).tolist() == order.tolist()
    assert np.allclose(found.reshape(90, 7), dist)
    if metric == "l2":
        assert sum(measured) <= 90 * 4 * 7  # the k-th best of a part alone leaves several times as many
