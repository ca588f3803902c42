"""SimHash near duplicates with a pigeonring filter.

A fingerprint of 64 bits is cut into a ring of ``limit + 1`` segments. If two fingerprints differ in at most ``limit``
bits, the differences of the segments sum to at most ``limit``, and then some segment starts a chain whose every
prefix of k segments has at most k * limit / (limit + 1) differing bits: none in the first segment, at most one in
the first two, and so on round the ring. Candidates therefore agree in a segment and differ in at most one
bit of the next; they must pass the longer chains as well before all 64 bits are compared.

Fingerprints are grouped first, so copies of a text cost one row. Rows are dealt by (segment number, segment value);
within a task the next segment is looked up in sorted order with its one-bit variants, so the work in a bucket is near
linear. Segment values with more than ``BUCKET`` fingerprints are dealt by two segments instead, with the variants as
extra rows. A task sends back a spanning forest of the links it found, never all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.graph import components
from riskloom.llm.shared import Stored, fresh, give_back, read

#: Words of a shingle and the largest number of differing bits, as the contract gives them.
SHINGLE = 4
LIMIT = 4
SEED = 42
#: A segment value shared by more fingerprints than this is dealt by two segments.
BUCKET = 50_000
#: Candidate pairs compared at a time in a task.
PAIRS = 2_000_000


def fingerprint_of(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text's UTF-8 bytes, as an unsigned integer; 0 without words."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], dtype="<u8")
    count = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536]
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * count > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text column as a signed 64-bit integer.

    ASCII letters are lower-cased; words are runs of characters other than space and \\t\\n\\v\\f\\r. A null text, like a text
    without words, has fingerprint zero.
    """

    @F.arrow_udf("long")
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [fingerprint_of(x.as_py(), shingle) for x in batch]
            yield pa.array(np.array(found, dtype=np.uint64).view(np.int64), type=pa.int64())
        give_back()

    return digest(text.cast("binary"))


def ring(limit: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of each segment, ``limit + 1`` segments that cover 64 bits."""
    m = limit + 1
    cuts = [round(64 * i / m) for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _segment(fp: Column, part: tuple[int, int]) -> Column:
    return F.shiftrightunsigned(fp, part[0]).bitwiseAND((1 << part[1]) - 1)


def _bits(x: np.ndarray, part: tuple[int, int]) -> np.ndarray:
    return (x >> np.uint64(part[0])) & np.uint64((1 << part[1]) - 1)


def _passes(diff: np.ndarray, start: int, parts: list[tuple[int, int]], limit: int) -> np.ndarray:
    """Which candidates keep every prefix of the chain from segment ``start`` within its proportional budget."""
    alive = np.arange(len(diff))
    total = np.zeros(len(diff), dtype=np.int64)
    m = len(parts)
    for k in range(1, m + 1):
        total = total + np.bitwise_count(_bits(diff[alive], parts[(start + k - 1) % m]))
        ok = total <= k * limit // m
        alive, total = alive[ok], total[ok]
    return alive


class _Forest:
    """A spanning forest of links between the positions of an array."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up


def _link(fps: np.ndarray, bucket: np.ndarray, queries: np.ndarray, values: np.ndarray, owner: np.ndarray, start: int, parts, limit: int):
    """Links of ``owner`` positions to stored positions with an equal (bucket, second segment), as a spanning forest.

    ``bucket`` is the key of each stored fingerprint, sorted; ``queries`` the looked-up keys of ``owner`` positions in ``values``.
    """
    forest = _Forest(len(values))
    lo, hi = np.searchsorted(bucket, queries, "left"), np.searchsorted(bucket, queries, "right")
    size = hi - lo
    use = size > 0
    lo, size, owner = lo[use], size[use], owner[use]
    at = 0
    ends = np.cumsum(size)
    while at < len(size):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
        s = size[at:stop]
        if stop == at + 1 and s[0] > PAIRS:
            ranges = [(lo[at] + k, min(PAIRS, int(s[0]) - k)) for k in range(0, int(s[0]), PAIRS)]
            pieces = [(np.full(n, owner[at]), np.arange(k, k + n)) for k, n in ranges]
        else:
            inside = np.arange(int(s.sum())) - np.repeat(np.cumsum(s) - s, s)
            pieces = [(np.repeat(owner[at:stop], s), np.repeat(lo[at:stop], s) + inside)]
        for left, right in pieces:
            apart = forest.label[left] != forest.label[right]
            left, right = left[apart], right[apart]
            ok = _passes(values[left] ^ fps[right], start, parts, limit)
            forest.add(left[ok], right[ok])
        at = stop
    moved = np.flatnonzero(forest.label != np.arange(len(values)))
    return moved, forest.label[moved]


def _links_of_bucket(seg: int, fps: np.ndarray, parts, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints (distinct, unsigned) that agree in segment ``seg``, a chain starting there."""
    m = len(parts)
    second = parts[(seg + 1) % m]
    # Only equality in the first segment is known to the caller; the key is (first, second) segment.
    order = np.lexsort((_bits(fps, second), _bits(fps, parts[seg])))
    fps = fps[order]
    first = _bits(fps, parts[seg]) << np.uint64(second[1])
    key = first | _bits(fps, second)
    budget = 2 * limit // m
    flips = [0] + ([1 << i for i in range(second[1])] if budget >= 1 else [])
    everyone = np.arange(len(fps))
    queries = np.concatenate([first | (_bits(fps, second) ^ np.uint64(f)) for f in flips])
    owner = np.tile(everyone, len(flips))
    a, b = _link(fps, key, queries, fps, owner, seg, parts, limit)
    return fps[a], fps[b]


def _search(limit: int):
    parts = ring(limit)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches sorted by key (segment number and value, or two segments); yields links bucket run by bucket run."""

        def answer(key: np.ndarray, seg: np.ndarray, fp: np.ndarray):
            found = []
            for s in np.unique(seg).tolist():
                mine = seg == s
                # Different keys have different first segments (or are separate two-segment buckets): one call answers all.
                sub = key[mine]
                values = fp[mine]
                if (sub < 0).any():
                    for k in np.unique(sub[sub < 0]).tolist():
                        found.append(_links_of_bucket(s, np.unique(values[sub == k]), parts, limit))
                plain = values[sub >= 0]
                if len(plain):
                    found.append(_links_of_bucket(s, plain, parts, limit))
            a = np.concatenate([x for x, _ in found]) if found else np.zeros(0, dtype=np.uint64)
            b = np.concatenate([y for _, y in found]) if found else np.zeros(0, dtype=np.uint64)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            key, seg, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            held.append((key, seg, fp.view(np.uint64)))
            if sum(len(k) for k, _, _ in held) < 200_000:
                continue
            key, seg, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            cut = int(np.searchsorted(key, key[-1], "left"))  # the last key may go on in the next batch
            if cut:
                yield answer(key[:cut], seg[:cut], fp[:cut])
            held = [(key[cut:], seg[cut:], fp[cut:])]
        if held:
            key, seg, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            if len(key):
                yield answer(key, seg, fp)
        give_back()

    return search


def fingerprint_links(fps: DataFrame, limit: int = LIMIT, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that span the groups of fingerprints within ``limit`` bits; ``fps`` has distinct values in column fp."""
    parts = ring(limit)
    m = len(parts)
    rows = fps.select("fp", F.posexplode(F.array(*[_segment(F.col("fp"), p) for p in parts])).alias("seg", "value"))
    width = max(n for _, n in parts)
    rows = rows.withColumn("key", F.col("seg").cast("long") * (1 << width) + F.col("value"))
    # At most m * 2**width segment values exist (40,960 for 4 bits), whatever the number of documents.
    hot = [r[0] for r in rows.groupBy("key").count().where(F.col("count") > bucket).select("key").collect()]
    usual = rows.where(~F.col("key").isin(hot)) if hot else rows
    dealt = usual.select("key", "seg", "fp")
    if hot:
        second = F.element_at(F.array(*[_segment(F.col("fp"), parts[(i + 1) % m]) for i in range(m)]), F.col("seg") + 1)
        flips = F.array(F.lit(0), *[F.lit(1 << i) for i in range(width)]) if 2 * limit // m else F.array(F.lit(0))
        wide = rows.where(F.col("key").isin(hot)).withColumn("flip", F.explode(flips)).withColumn("other", second.bitwiseXOR(F.col("flip")))
        # Negative keys mark two-segment buckets; every pair within one bit there meets under one of the two values.
        dealt = dealt.union(wide.select((-1 - (F.col("key") * (1 << width) + F.col("other"))).alias("key"), "seg", "fp"))
    return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(_search(limit), "a long, b long")


def _grouped(docs: DataFrame, id_column: str, text: str, shingle: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """((id, fp) of every row; (fp, label, low) of every fingerprint), both stored; label marks the group."""
    stored = Stored(docs.sparkSession, "simhash")
    held, _ = stored.put(docs.select(F.col(id_column).alias("id"), fingerprints(F.col(text), shingle).alias("fp")))
    groups, _ = stored.put(held.groupBy("fp").agg(F.min("id").alias("low")))
    nodes = components(fingerprint_links(groups.select("fp"), limit))
    labelled = groups.join(nodes, groups["fp"] == nodes["node"], "left").select("fp", "low", F.coalesce("component", "fp").alias("label"))
    lowest = labelled.groupBy("label").agg(F.min("low").alias("low"))
    by_fp, _ = stored.put(labelled.select("fp", "label").join(lowest, "label"))
    return held, by_fp


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE, limit: int = LIMIT) -> DataFrame:
    """(id, fingerprint as 16 hex digits, component_id: smallest id of the group), one row per row of ``docs``.

    Null texts, empty texts and texts without words have fingerprint zero and are linked like any other. Repeated rows
    belong to the same group. A null id is never a group's smallest id; a group without any id has a null component.
    An empty table gives an empty table. Columns other than the two named are not read, whatever they are called.
    """
    held, by_fp = _grouped(docs, id_column, text, shingle, limit)
    return held.join(by_fp, "fp", "left").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("low").alias("component_id")
    )


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE, limit: int = LIMIT) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id, any one of them if that row repeats.

    Texts are not shuffled but for groups whose smallest id stands on several rows, or that have no id at all.
    Null and empty texts are a group like any other; all columns pass unchanged.
    """
    held, by_fp = _grouped(docs, id_column, text, shingle, limit)
    at_low = held.join(by_fp, "fp").where(F.col("id").eqNullSafe(F.col("low"))).groupBy("label").agg(F.first("id").alias("id"), F.count(F.lit(1)).alias("n"))
    key, fp, label = fresh(docs, "kept_id"), fresh(docs, "kept_fp"), fresh(docs, "kept_label")
    once = at_low.where((F.col("n") == 1) & F.col("id").isNotNull()).select(F.col("id").alias(key))
    # An id may stand once in a group and again, with another text, elsewhere: those ids go the longer way as well.
    many = held.groupBy("id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1 or id is null").select(F.col("id").alias(key))
    single = once.join(many, key, "left_anti")
    kept = docs.join(single, F.col(id_column) == F.col(key), "left_semi")
    again = docs.join(many, F.col(id_column).eqNullSafe(F.col(key)), "left_semi").withColumn(fp, fingerprints(F.col(text), shingle))
    low = fresh(docs, "kept_low")
    marks = by_fp.select(F.col("fp").alias(fp), F.col("label").alias(label), F.col("low").alias(low))
    again = again.join(marks, fp).where(F.col(id_column).eqNullSafe(F.col(low))).dropDuplicates([label])
    return kept.unionByName(again.select(*[F.col(f"`{c}`") for c in docs.columns]))


def op3_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Contract query: doc_id, fingerprint, component_id for every document."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return near_duplicates(docs)
