import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from riskloom.llm import spelling
from riskloom.llm.shared import read

COLUMNS = ["word", "n", "n_near", "form", "form_n", "root"]
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(rows):
    """The contract's words and counts, by hand."""
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(LOW)):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += len(run) >= 6
    return {w: n for w, n in out.items() if n >= 5}


def plain_groups(n):
    """Every word against every word that shares it with a letter cut or masked."""
    masked, cut = defaultdict(set), defaultdict(set)
    for w in n:
        for k in range(len(w)):
            masked[w[:k] + "*" + w[k + 1 :]].add(w)
            cut[w[:k] + w[k + 1 :]].add(w)
    near = {}
    for w in n:
        own = set(cut[w])
        for k in range(len(w)):
            own |= masked[w[:k] + "*" + w[k + 1 :]] | ({w[:k] + w[k + 1 :]} & n.keys())
        near[w] = own - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], n.get(form[w]), root))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_whole_documents_against_plain_search(shared):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in read(shared, folder, "documents").select("doc_id", "text").collect()]
    assert rows_of(spelling.op11_spelling_variants(shared, folder)) == plain_groups(plain_words(docs))


@pytest.mark.parametrize("layout", [{}, {"block": 60, "depth": 1}, {"depth": 0, "block": 40}, {"depth": 4}, {"groups": 3}])
def test_layouts_give_the_same_groups(shared, layout):
    rnd = random.Random(7)
    words = {"".join(rnd.choice("abcé") for _ in range(rnd.randint(6, 8))): rnd.choice([5, 6, 30, 200, 2000]) for _ in range(500)}
    words |= {"a" * 300: 5, "a" * 299: 40, "b" + "a" * 299: 1000}
    df = shared.createDataFrame(sorted(words.items()), "word string, n long")
    assert rows_of(spelling.group_variants(df, **layout)) == plain_groups(words)


def test_odd_texts(shared):
    rows = [(1, None), (2, ""), (None, "Letters " * 6), (3, "lettersé ×÷ÿÀaé " * 7), (3, "lettersé ×÷ÿÀaé " * 7), (4, "a😀letters1letters_LETTERS " * 3), (5, "x" * 40_000 + " " + "short one " * 9)]
    rows += [(6, "y" * 30_000)] * 6 + [(7, "y" * 29_999)] * 5
    df = shared.createDataFrame([(*r, "a", 1) for r in rows], "doc_id long, text string, word string, n int")
    got = spelling.group_variants(spelling.counted_words(df, change=spelling.damaged()))
    assert rows_of(got) == plain_groups(plain_words(rows))


def test_empty_tables(shared):
    docs = shared.createDataFrame([], "doc_id long, text string")
    assert spelling.group_variants(spelling.counted_words(docs)).count() == 0
    with pytest.raises(ValueError):
        spelling.group_variants(shared.createDataFrame([], "word string, n long"), ratio=1)


def test_the_key_changes_cover_every_pair_once():
    rnd = np.random.default_rng(1)
    for depth in (0, 1, 2, 4):
        changes = spelling.steps(depth)
        for _ in range(300):
            a = rnd.integers(0, 4, 6)
            b = a.copy()
            kind = rnd.integers(3)
            if kind != 1:
                b[rnd.integers(6)] += 1
            if kind != 0 and b.max() > 0:
                b[rnd.choice(np.flatnonzero(b))] -= 1
            keys = [tuple(int(x) for x in (v.sum(), *v[:depth])) for v in (a, b)]
            gap = tuple(y - x for x, y in zip(*keys, strict=True))
            found = (gap in changes) + (tuple(-x for x in gap) in changes and any(gap))
            assert found == 1


def test_trie_reaches_what_the_budget_allows():
    rnd = np.random.default_rng(2)
    vectors = rnd.integers(0, 3, (200, 5))
    frame = pd.DataFrame({"word": ["".join("abcde"[g] * c for g, c in enumerate(v)).ljust(10, "z") for v in vectors]})
    trie = spelling._Trie(vectors)
    got = set()
    for rows, first, end in trie.search(vectors, 1, 1):
        for r, f, e in zip(rows, first, end, strict=True):
            got |= {(int(r), int(j)) for j in trie.order[f:e]}
    gap = vectors[None] - vectors[:, None]
    want = (np.maximum(gap, 0).sum(2) <= 1) & (np.maximum(-gap, 0).sum(2) <= 1)
    assert got == {(int(i), int(j)) for i, j in np.argwhere(want)} and len(frame) == 200
