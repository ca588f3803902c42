"""Spelling variant grouping: words one letter apart, found by a trie over letter-group counts.

The letters are dealt into a dozen groups of similar frequency, and a word becomes the vector of its counts per group. Two words
one inserted, deleted or replaced letter apart differ by a surplus of at most one and a deficit of at most one over all counts.
The words are arranged in a trie by successive counts; a depth-first search walks it with that budget, and the words at the leaves
it reaches are verified letter by letter.

The upper levels of the trie (length and the first counts) are Spark keys: a word is sent to the few keys that its budget can
reach, so all pairs of a key are never formed. Keys of many words are cut into blocks of bounded bytes, and one task sees one
block of words and one block of a trie. More words make the keys deeper. Every pair of words meets in exactly one place.

Near words are counted where they are found; only a count and the best partner leave a task. The relation "next form" climbs by a
factor of at least ``RATIO`` in n, so chains are short and the roots follow from a fixed number of joins.

Null and empty texts hold no words; a text may be as long as a string; ties between partners go to the smallest word in code-point
order; repeated documents count each time; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.shared import Stored, read

RUN = r"[A-Za-zÀ-ÿ]"
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
GROUPS = 12
BLOCK = 1 << 20  # letters of the words in one block
PAIRS = 1 << 22  # letters compared at once
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, _UPPER, _UPPER.lower())


def runs_of(text: Column, least: int = LEAST_LENGTH) -> Column:
    """The maximal runs of letters of at least ``least`` code points, A-Z in lower case, repeats included."""
    return F.regexp_extract_all(lowered(text), F.lit(f"({RUN}{{{least},}})"), F.lit(1))


def counted_words(
    docs: DataFrame, text: str = "text", change: Callable[[Column], Column] | None = None, least: int = LEAST_LENGTH, most_rare: int = LEAST_COUNT
) -> DataFrame:
    """(word, n): the words of at least ``least`` letters that occur at least ``most_rare`` times in all texts.

    ``change`` maps a run to the word that is counted; it may shorten a run but not lengthen it. Counts are summed before the
    shuffle, so a word that makes up a third of all occurrences is one row per task.
    """
    runs = docs.withColumn("run", F.explode(runs_of(F.col(text), least)))
    word = change(F.col("run")) if change else F.col("run")
    words = runs.select(word.alias("word")).where(F.length("word") >= least)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= most_rare)


def letter_groups(words: DataFrame, groups: int = GROUPS) -> list[str]:
    """The letters of the words dealt into groups of similar frequency, the most frequent first.

    At most one row per distinct letter reaches the driver.
    """
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''").groupBy("letter").agg(F.count(F.lit(1)).alias("n"))
    dealt = [[0, ""] for _ in range(groups)]
    for row in sorted(letters.collect(), key=lambda r: (-r["n"], r["letter"])):
        least = min(dealt, key=lambda g: g[0])
        least[0] += row["n"]
        least[1] += row["letter"]
    return [g[1] for g in sorted(dealt, key=lambda g: (-g[0], g[1])) if g[1]]


def _counts(word: Column, groups: list[str]) -> list[Column]:
    return [(F.length(word) - F.length(F.translate(word, g, ""))).cast("int") for g in groups]


def steps(depth: int) -> list[tuple[int, ...]]:
    """The changes of (length, first ``depth`` counts) between near words, each pair of opposite changes once.

    The first number is the change of length, 0 or 1; the counts spend at most one surplus and one deficit.
    """
    out = []
    still = (0,) * depth
    for plus in [None, *range(depth)]:
        for minus in [None, *range(depth)]:
            if plus is not None and plus == minus:
                continue
            counts = tuple(1 if i == plus else -1 if i == minus else 0 for i in range(depth))
            if minus is None:
                out.append((1, *counts))
            if counts >= still:
                out.append((0, *counts))
    return sorted(set(out))


class _Trie:
    """Count vectors as a trie: per level the sorted (node, count) pairs of its children; a leaf is a range of words."""

    def __init__(self, counts: np.ndarray):
        self.order = np.lexsort(counts.T[::-1]) if counts.shape[1] else np.arange(len(counts))
        counts = counts[self.order]
        self.base = int(counts.max(initial=0)) + 3
        node = np.zeros(len(counts), np.int64)
        self.levels = []
        for level in range(counts.shape[1]):
            children, node = np.unique(node * self.base + counts[:, level] + 1, return_inverse=True)
            self.levels.append(children)
        self.starts = np.searchsorted(node, np.arange(int(node.max(initial=-1)) + 2))

    def search(self, asked: np.ndarray, surplus: int, deficit: int):
        """Depth first: (query rows, first words, ends) of the leaves that a budget of ``surplus`` and ``deficit`` reaches."""
        stack = [(0, np.arange(len(asked)), np.zeros(len(asked), np.int64), surplus, deficit)]
        while stack:
            level, rows, nodes, more, less = stack.pop()
            if level == len(self.levels):
                yield rows, self.starts[nodes], self.starts[nodes + 1]
                continue
            children = self.levels[level]
            for change in (0, *([1] if more else []), *([-1] if less else [])):
                count = asked[rows, level] + change
                wanted = nodes * self.base + count + 1
                at = np.minimum(np.searchsorted(children, wanted), len(children) - 1)
                hit = (children[at] == wanted) & (count >= 0) & (count < self.base - 2)
                if hit.any():
                    stack.append((level + 1, rows[hit], at[hit], more - (change > 0), less - (change < 0)))


def _letters(words: pd.Series, length: int) -> np.ndarray:
    """Words of one length as a matrix of letters; all letters of a run lie below 256."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def one_apart(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """True where the rows differ by exactly one replaced letter (same width) or one inserted letter (one wider)."""
    width = short.shape[1]
    if long.shape[1] == width:
        return (short != long).sum(1) == 1
    front = np.logical_and.accumulate(short == long[:, :width], axis=1).sum(1)
    back = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(1)
    return front + back >= width


def near_pairs(short: pd.DataFrame, long: pd.DataFrame, change: tuple[int, ...], same: bool):
    """Positions (i, j) of near words in two blocks whose keys differ by ``change``; in one block (``same``) each pair once.

    Frames hold ``word`` (of one length each) and ``rest``, the counts below the key.
    """
    if short.empty or long.empty:
        return
    surplus, deficit = 1 - change[1:].count(1), 1 - change[1:].count(-1)
    if change[0] == 1:
        deficit = 0
    mine, theirs = np.stack(short["rest"].to_numpy()).astype(np.int64), np.stack(long["rest"].to_numpy()).astype(np.int64)
    a, b = _letters(short["word"], len(short["word"].iloc[0])), _letters(long["word"], len(long["word"].iloc[0]))
    trie = _Trie(theirs)
    for rows, first, end in trie.search(mine, surplus, deficit):
        many = end - first
        step = max(1, PAIRS // (a.shape[1] + 1))
        edges = np.cumsum(many)
        start = 0
        while start < len(rows):
            stop = max(start + 1, int(np.searchsorted(edges, (edges[start - 1] if start else 0) + step, "right")))
            n = many[start:stop]
            i = np.repeat(rows[start:stop], n)
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            j = trie.order[np.repeat(first[start:stop], n) + within]
            if same:
                i, j = i[i < j], j[i < j]
            for cut in range(0, len(i), step):
                x, y = i[cut : cut + step], j[cut : cut + step]
                ok = one_apart(a[x], b[y])
                if ok.any():
                    yield x[ok], y[ok]
            start = stop


class _Partners:
    """Per word of one side: how many partners, and the first of them by n (largest first) and word."""

    def __init__(self, words: pd.DataFrame, others: pd.DataFrame):
        self.words, self.others = words, others
        self.by_rank = np.lexsort((np.argsort(np.argsort(others["word"].to_numpy(object))), -others["n"].to_numpy(np.int64)))
        self.rank = np.empty(len(others), np.int64)
        self.rank[self.by_rank] = np.arange(len(others))
        self.many, self.best = np.zeros(len(words), np.int64), np.full(len(words), len(others))

    def add(self, mine: np.ndarray, theirs: np.ndarray) -> None:
        self.many += np.bincount(mine, minlength=len(self.many))
        np.minimum.at(self.best, mine, self.rank[theirs])

    def columns(self) -> list[np.ndarray]:
        found = np.flatnonzero(self.many)
        best = self.by_rank[self.best[found]]
        words, others = self.words["word"].to_numpy(object), self.others["word"].to_numpy(object)
        return [words[found], self.many[found], -self.others["n"].to_numpy(np.int64)[best], others[best]]


_FOUND = "word string, n_near long, less long, near string"


def _meet(group: pd.DataFrame) -> pd.DataFrame:
    """Near words of one block of words and one block of the trie, as counts and best partners of both sides."""
    change = tuple(int(x) for x in group["change"].iloc[0])
    first = group[group["side"] == 0].reset_index(drop=True)
    same = bool(group["same"].iloc[0])
    other = first if same else group[group["side"] == 1].reset_index(drop=True)
    ours, theirs = _Partners(first, other), _Partners(other, first)
    for i, j in near_pairs(first, other, change, same):
        ours.add(i, j)
        theirs.add(j, i)
    columns = [np.concatenate(pair) for pair in zip(ours.columns(), theirs.columns(), strict=True)]
    return pd.DataFrame(dict(zip(("word", "n_near", "less", "near"), columns, strict=True)))


def depth_for(words: int) -> int:
    """Counts in the key: two, and one more for each threefold of the words beyond 100,000."""
    return min(GROUPS - 2, 2 + max(0, math.ceil(math.log(max(words, 1) / 100_000, 3))))


def near_words(words: DataFrame, depth: int | None = None, block: int = BLOCK, groups: int = GROUPS) -> DataFrame:
    """(word, n_near, near, near_n) of every word that has a near word; ``words`` holds distinct ``word`` and ``n``.

    ``depth`` and ``block`` choose the layout only, never the result.
    """
    spark = words.sparkSession
    depth = depth_for(words.count()) if depth is None else depth
    dealt = letter_groups(words, groups)
    depth = min(depth, max(len(dealt) - 1, 0))
    counts = _counts(F.col("word"), dealt) if dealt else []
    key = F.array(F.length("word").cast("int"), *counts[:depth])
    laid = words.select("word", "n", key.alias("key"), F.array(*counts[depth:]).cast("array<int>").alias("rest"))
    cells = laid.groupBy("key").agg(F.greatest(F.ceil(F.count(F.lit(1)) * F.col("key")[0] / F.lit(float(block))), F.lit(1)).cast("int").alias("blocks"))
    changes = F.array(*[F.array(*[F.lit(x) for x in s]) for s in steps(depth)])
    there = cells.select(F.col("key").alias("to"), F.col("blocks").alias("to_blocks"))
    # Which keys can meet: one row per pair of keys, from the keys alone.
    pairs = cells.withColumn("change", F.explode(changes)).withColumn("to", F.zip_with("key", "change", lambda a, b: a + b)).join(there, "to")
    pairs, _ = Stored(spark, "spelling").put(pairs)
    own = F.col("key") == F.col("to")
    blocked = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")

    short = laid.join(pairs, "key").withColumn("block", blocked)
    short = short.withColumn("to_block", F.explode(F.sequence(F.when(own, F.col("block")).otherwise(0), F.col("to_blocks") - 1)))
    same = own & (F.col("block") == F.col("to_block"))
    short = short.select("word", "n", "rest", "key", "to", "change", "block", "to_block", same.alias("same"), F.lit(0).alias("side"))
    long = laid.withColumnRenamed("key", "to").join(pairs, "to")
    long = long.withColumn("to_block", F.pmod(F.xxhash64("word"), F.col("to_blocks")).cast("int"))
    long = long.withColumn("block", F.explode(F.sequence(F.lit(0), F.when(own, F.col("to_block")).otherwise(F.col("blocks") - 1))))
    long = long.select("word", "n", "rest", "key", "to", "change", "block", "to_block", same.alias("same"), F.lit(1).alias("side")).where(~F.col("same"))
    met = short.unionByName(long).groupBy("key", "to", "block", "to_block").applyInPandas(_meet, _FOUND)
    best = F.min(F.struct("less", "near"))
    found = met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def group_variants(words: DataFrame, ratio: int = RATIO, **layout) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of distinct words with their counts.

    ``form`` is the near word of largest n if that is at least ``ratio`` times the word's n, ``root`` the last word on the way of forms.
    """
    if ratio < 2:
        raise ValueError("a ratio below 2 would not make the chains of forms short")
    stored = Stored(words.sparkSession, "spelling")
    words, _ = stored.put(words.select("word", F.col("n").cast("long").alias("n")))
    near = near_words(words, **layout)
    joined = words.join(near, "word", "left")
    to = F.col("near_n") >= ratio * F.col("n")
    table, _ = stored.put(
        joined.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(to, F.col("near")).alias("form"), F.when(to, F.col("near_n")).alias("form_n"))
    )
    # n grows by the ratio along a chain, so its length is known beforehand; pointers are doubled that often.
    largest = table.agg(F.max("n")).first()[0] or 1
    length = math.floor(math.log(max(largest, 1), ratio)) + 1
    climb = table.where(F.col("form").isNotNull()).select("word", F.col("form").alias("top"))
    for _ in range(max(0, math.ceil(math.log2(length)))):
        higher = climb.select(F.col("word").alias("top"), F.col("top").alias("higher"))
        climb = climb.join(higher, "top", "left").select("word", F.coalesce("higher", "top").alias("top"))
        climb, _ = stored.put(climb)
    return table.join(climb, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("top", "word").alias("root"))


def damaged(doc_id: str = "doc_id") -> Callable[[Column], Column]:
    """The contract's spelling errors: a run loses the letter crc32 % length where 199 divides crc32(`doc_id:run`); a null id counts as empty."""

    def change(run: Column) -> Column:
        h = F.crc32(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
        at = (h % F.length(run)).cast("int")
        return F.when(h % 199 == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)

    return change


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of the damaged documents with its near words, next form and root."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return group_variants(counted_words(docs, change=damaged()))


def crc32_sql(text: str) -> str:
    """DuckDB expression for the unsigned crc32 of a text of letters below U+0800: a shift register over the bits of its bytes."""
    octets = f"flatten(list_transform(regexp_split_to_array({text}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + unicode(c) // 64, 128 + unicode(c) % 64] END))"
    steps_in = f"flatten(list_transform({octets}, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1]))"
    # A step takes in a byte (0 to 255) or shifts by one bit (-1); 3988292384 is the reflected polynomial.
    register = f"list_reduce(list_prepend(4294967295::BIGINT, list_transform({steps_in}, lambda x: x::BIGINT)), lambda r, x: CASE WHEN x >= 0 THEN xor(r, x) ELSE xor(r >> 1, 3988292384 * (r & 1)) END)"
    return f"xor({register}, 4294967295)"


OP11_SQL = f"""
WITH RECURSIVE runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), each AS (
    SELECT run, {crc32_sql("id || ':' || run")} AS h, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL
), words AS (
    SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n)::BIGINT AS n
    FROM each GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5
), places AS (
    SELECT word, n, unnest(range(length(word))) AS k FROM words
), cut AS (
    SELECT word, n, k, left(word, k) AS a, substr(word, k + 2) AS b FROM places
), pairs AS (
    SELECT x.word, y.word AS near FROM cut x JOIN cut y ON x.k = y.k AND x.a = y.a AND x.b = y.b AND x.word <> y.word
    UNION SELECT c.word, w.word FROM cut c JOIN words w ON w.word = c.a || c.b
    UNION SELECT w.word, c.word FROM cut c JOIN words w ON w.word = c.a || c.b
), best AS (
    SELECT p.word, count(*) AS n_near, first(p.near ORDER BY y.n DESC, p.near) AS near, max(y.n) AS near_n FROM pairs p JOIN words y ON y.word = p.near GROUP BY 1
), forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * w.n THEN near END AS form, CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n
    FROM words w LEFT JOIN best USING (word)
), climb(word, spot, further) AS (
    SELECT word, word, form FROM forms
    UNION ALL SELECT c.word, f.word, f.form FROM climb c JOIN forms f ON f.word = c.further
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, c.spot AS root FROM forms f JOIN climb c ON c.word = f.word AND c.further IS NULL
"""
