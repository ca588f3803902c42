"""Byte-level BPE encoding and decoding in length-bucketed padded numpy matrices.

Text is split by the vocabulary's pattern; each match is a row of byte symbols. Rows not met before are put into
matrices by length, and every round each row merges its leftmost minimum-rank pair (hashed pair lookup), until rows
without a pair are compacted away. Decoding puts the bytes of the ids together again.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.merges import LONG, PairTable, merge_long, merge_padded
from riskloom.llm.shared import fresh, give_back, per_process, read

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Encoded chunks kept per Python worker, some 70 MB; the store outlives the task and is emptied when it is full.
KEPT_CHUNKS = 100_000
#: Rows of one matrix.
GROUP = 20_000
#: A space that is followed by white space or the end: there a match may reach over more than one space.
_TRICKY = re.compile(r" (?:\s|\Z)")


class ByteEncoder:
    """Encodes and decodes texts with the ranks of one file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        rows = [
            (ranks[b[:cut]], ranks[b[cut:]], i, i)
            for b, i in ranks.items()
            for cut in range(1, len(b))
            if b[:cut] in ranks and b[cut:] in ranks
        ]
        self.table = PairTable(*np.array(rows, dtype=np.int64).T)
        self.whole = ranks
        self.pattern = regex.compile(pattern)
        self.known: dict[str, bytes] = {}

    def merge(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts laid end to end, and how many each part has; a part that is a token is that token."""
        lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        token = np.fromiter((self.whole.get(b, -1) for b in parts), dtype=np.int64, count=len(parts))
        symbols = self.byte_ids[np.frombuffer(b"".join(parts), dtype=np.uint8)]
        start = np.cumsum(lengths) - lengths
        sizes = np.where(token >= 0, 1, 0)
        done: list[tuple[np.ndarray, np.ndarray]] = [(np.flatnonzero(token >= 0), token[token >= 0])]
        for i in np.flatnonzero((token < 0) & (lengths > LONG)).tolist():
            ids = merge_long(symbols[start[i] : start[i] + lengths[i]], self.table)
            sizes[i] = len(ids)
            done.append((np.array([i]), ids))
        # Widths grow by a quarter or so, which bounds the padding.
        steps = np.array([4, 6, 8, 10, 12, 16, 20, 24, 32, 48, 64, 96, 128, 192, LONG])
        todo = np.flatnonzero((token < 0) & (lengths <= LONG))
        bucket = np.searchsorted(steps, lengths[todo])
        for k in np.unique(bucket).tolist():
            members, width = todo[bucket == k], int(steps[k])
            step = max(1, GROUP * 16 // max(width, 16))
            for at in range(0, len(members), step):
                group = members[at : at + step]
                filled = np.arange(width) < lengths[group][:, None]
                rows = np.full(filled.shape, -1, dtype=np.int64)
                rows[filled] = symbols[np.repeat(start[group] - np.cumsum(lengths[group]) + lengths[group], lengths[group]) + np.arange(int(lengths[group].sum()))]
                rows, left = merge_padded(rows, lengths[group], self.table)
                sizes[group] = left
                done.append((group, rows[np.arange(width) < left[:, None]]))
        out = np.empty(int(sizes.sum()), dtype=np.int64)
        begin = np.cumsum(sizes) - sizes
        for group, ids in done:
            size = sizes[group]
            out[np.repeat(begin[group] - np.cumsum(size) + size, size) + np.arange(len(ids))] = ids
        return out, sizes

    def chunks(self, text: str) -> list[str]:
        """The text in pieces that can be split by the pattern one by one.

        Where every space stands before a visible character, a match never reaches from before a space to behind it, so
        the text may be cut in front of each space. Other texts are one piece.
        """
        if _TRICKY.search(text):
            return self.pattern.findall(text)
        first, *rest = text.split(" ")
        return [first, *(" " + w for w in rest)]

    def learn(self, chunks: list[str]) -> None:
        """Encode chunks that are not in the store, all together."""
        split = list(map(self.pattern.findall, chunks))
        parts: dict[str, int] = {}
        used = np.array([parts.setdefault(p, len(parts)) for s in split for p in s], dtype=np.int64)
        ids, sizes = self.merge([p.encode() for p in parts])
        begin = np.cumsum(sizes) - sizes
        size = sizes[used]
        laid = ids[np.repeat(begin[used] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))].astype("<u4").tobytes()
        last = np.cumsum(np.fromiter(map(len, split), dtype=np.int64, count=len(split)))
        end = np.concatenate(([0], np.cumsum(size)))[last] * 4
        a = 0
        for chunk, b in zip(chunks, end.tolist(), strict=True):
            self.known[chunk] = laid[a:b]
            a = b

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known) > KEPT_CHUNKS:
            self.known.clear()
        cut = [self.chunks(t) if t else [] for t in texts]
        known = self.known
        missing = {c: None for cs in cut for c in cs if c not in known}
        if missing:
            self.learn(list(missing))
        return [b"".join(map(known.__getitem__, cs)) for cs in cut]

    def decode(self, ids: bytes) -> bytes:
        """The bytes that little-endian unsigned 32-bit ids stand for."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


encoder = per_process(ByteEncoder)


def encode_texts(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the token ids of each whole text as an array column ``out``.

    Null and empty texts give an empty array. Other columns pass unchanged; a column already called ``out`` is an error.
    """
    if fresh(docs, out) != out:
        raise ValueError(f"the table already has a column {out}")

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = encoder(path, pattern)
        for batch in batches:
            found: list[np.ndarray] = []
            for at in range(0, len(batch), 256):
                found += [np.frombuffer(b, dtype="<i4") for b in coder.encode(batch.slice(at, 256).to_pylist())]
            ends = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
            flat = pa.array(np.concatenate([np.zeros(0, dtype=np.int32), *found]))
            del found
            yield pa.ListArray.from_arrays(pa.array(ends), flat)
            del flat
        give_back()

    return docs.withColumn(out, ids(F.col(text)))


def decode_ids(docs: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of an id array as a binary column ``out``; a null array gives no bytes."""
    if fresh(docs, out) != out:
        raise ValueError(f"the table already has a column {out}")

    @F.arrow_udf("binary")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = encoder(path, pattern)
        for batch in batches:
            yield pa.array([coder.decode(np.array(x or [], dtype="<u4").tobytes()) for x in batch.to_pylist()], type=pa.binary())

    return docs.withColumn(out, text(F.col(ids)))


def encode_digests(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "tokens") -> DataFrame:
    """``docs`` with a struct column ``out``: n_tokens, ids_sha256 and decoded_sha256 of each whole text.

    Encodes and decodes in one pass, so that the ids need not travel. Null and empty texts have no tokens, and both
    digests are those of nothing. Other columns pass unchanged; a column already called ``out`` is an error.
    """
    if fresh(docs, out) != out:
        raise ValueError(f"the table already has a column {out}")

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = encoder(path, pattern)
        for batch in batches:
            counts: list[int] = []
            of_ids: list[str] = []
            of_text: list[str] = []
            for at in range(0, len(batch), 256):
                for ids in coder.encode(batch.slice(at, 256).to_pylist()):
                    counts.append(len(ids) // 4)
                    of_ids.append(hashlib.sha256(ids).hexdigest())
                    of_text.append(hashlib.sha256(coder.decode(ids)).hexdigest())
            yield pa.StructArray.from_arrays(
                [pa.array(counts, type=pa.int64()), pa.array(of_ids, type=pa.string()), pa.array(of_text, type=pa.string())],
                names=["n_tokens", "ids_sha256", "decoded_sha256"],
            )
        give_back()

    return docs.withColumn(out, digests(F.col(text)))


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Contract query: doc_id, n_tokens, ids_sha256, decoded_sha256 for every document."""
    import public_tokenizers

    docs = read(spark, folder, "documents").select("doc_id", "text")
    coded = encode_digests(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return coded.select("doc_id", "tokens.n_tokens", "tokens.ids_sha256", "tokens.decoded_sha256")
