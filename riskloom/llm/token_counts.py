"""Token counts of a sentencepiece BPE vocabulary by rank-synchronous merging of ragged arrays.

The vocabulary file is read for its pieces and scores only. Text is normalised as the file says (a word mark for
every space and one in front), cut into sequences that no merge can cross, and the sequences of a batch that were not
met before are merged together as ragged numpy arrays. A symbol that is no piece counts as its UTF-8 bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.merges import PairTable, merge_ragged
from riskloom.llm.shared import fresh, per_process, read

VOCABULARY = "piece_bpe_32k.model"
#: A document with more tokens than this is marked.
LIMIT = 4096
#: Counts of words kept per Python worker; the store is emptied when it is full.
KEPT_WORDS = 400_000
#: Words merged together.
GROUP = 50_000
_MARK = "▁"


class PieceCounter:
    """Counts tokens of texts with one vocabulary."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = {}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
                pieces[model.id_to_piece(i)] = model.get_score(i)
        if any(a != _MARK and b == _MARK for p in pieces for a, b in zip(p, p[1:], strict=False)):
            raise ValueError("a piece of this vocabulary goes on over a word mark; its texts cannot be cut at words")
        singles = sorted({c for p in pieces for c in p})
        ids = {c: i for i, c in enumerate(singles)}
        for p in pieces:
            ids.setdefault(p, len(ids))
        level = {s: r for r, s in enumerate(sorted(set(pieces.values()), reverse=True))}
        rows, follows = [], set()
        for p, score in pieces.items():
            follows.update(zip(p, p[1:], strict=False))
            for cut in range(1, len(p)):
                if p[:cut] in ids and p[cut:] in ids:
                    rows.append((ids[p[:cut]], ids[p[cut:]], level[score], ids[p]))
        left, right, rank, merged = np.array(rows, dtype=np.int64).T
        self.table = PairTable(left, right, rank, merged)
        pairs = np.array([(ord(a), ord(b)) for a, b in follows], dtype=np.int64)
        one = np.ones(len(pairs), dtype=np.int64)
        self.follows = PairTable(pairs[:, 0], pairs[:, 1], one, one)
        # Ids behind the last piece stand for characters outside the vocabulary, by their number of UTF-8 bytes.
        self.other = len(ids)
        self.symbol = np.full(0x110000, -1, dtype=np.int32)
        self.symbol[[ord(c) for c in singles]] = np.arange(len(singles))
        self.cost = np.ones(self.other + 5, dtype=np.int64)
        self.cost[self.other :] = np.arange(5)
        for c in singles:
            if c not in pieces:
                self.cost[ids[c]] = len(c.encode())
        self.known: dict[str, int] = {}

    def words(self, text: str) -> list[str]:
        """The text in parts that no merge can cross: a run of word marks and what follows up to the next run."""
        if _MARK not in text and "  " not in text:
            return text.split(" ") if text[:1] != " " and text[-1:] != " " else re.findall(r"▁+[^▁]*", _MARK + text.replace(" ", _MARK))
        return re.findall(r"▁+[^▁]*", _MARK + text.replace(" ", _MARK))

    def learn(self, words: list[str]) -> None:
        """Merge words that are not in the store, all together."""
        for at in range(0, len(words), GROUP):
            part = words[at : at + GROUP]
            texts = [w if w[:1] == _MARK else _MARK + w for w in part]
            size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
            points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
            word = np.repeat(np.arange(len(texts)), size)
            symbols = self.symbol[points].astype(np.int64)
            strange = symbols < 0
            p = points[strange]
            symbols[strange] = self.other + 1 + (p > 0x7F) + (p > 0x7FF) + (p > 0xFFFF)
            # A boundary that lies inside no piece can be inside no token either.
            joined = (word[1:] == word[:-1]) & (self.follows.find(points[:-1], points[1:])[1] >= 0)
            starts = np.concatenate(([0], np.flatnonzero(~joined) + 1))
            lengths = np.diff(np.concatenate((starts, [len(points)])))
            left, sizes = merge_ragged(symbols, lengths, self.table)
            counts = np.bincount(np.repeat(word[starts], sizes), weights=self.cost[left], minlength=len(texts))
            self.known.update(zip(part, counts.astype(np.int64).tolist(), strict=True))

    def count(self, texts: list[str | None]) -> list[int]:
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        cut = [self.words(t) if t else [] for t in texts]
        missing: dict[str, None] = {}
        known = self.known
        for ws in cut:
            for w in ws:
                if w not in known:
                    missing[w] = None
        self.learn(list(missing))
        return [sum(map(known.__getitem__, ws)) for ws in cut]


counter = per_process(PieceCounter)


def count_tokens(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of each whole text added as column ``out``.

    Null and empty texts have 0 tokens. Other columns are passed on as they are, whatever their names; a column that is
    already called ``out`` is an error. Rows may repeat; an empty table gives an empty table. Texts of any length are
    counted whole. Memory per Python worker: one Arrow batch, ``KEPT_WORDS`` words and one slice of 256 texts.
    """
    if fresh(docs, out) != out:
        raise ValueError(f"the table already has a column {out}")

    @F.arrow_udf("long")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = counter(path)
        for batch in batches:
            counts: list[int] = []
            for at in range(0, len(batch), 256):
                counts += model.count(batch.slice(at, 256).to_pylist())
            yield pa.array(counts, type=pa.int64())

    return docs.withColumn(out, tokens(F.col(text)))


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Contract query: doc_id, n_bytes, n_tokens, over_limit for every document."""
    import public_tokenizers

    docs = read(spark, folder, "documents").select("doc_id", "text")
    counted = count_tokens(docs, public_tokenizers.path(VOCABULARY))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > LIMIT).alias("over_limit"),
    )
