"""Language identification by cross-parsing entropy against suffix automata.

For each language a suffix automaton holds a sample of its labelled text. A text is parsed greedily into phrases: each
phrase is the longest match from where the last one ended that occurs in the language's sample, plus the letter that broke
it off. The fewer phrases, the closer the language; phrases are normalised by the logarithm of the sample's size and the
number of letters, which makes them bits per letter. The automata are laid out as one dense table (state x
letter), and many stretches of text walk through all of them in step, letter by letter, in numpy.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.shared import Stored, held_out, per_process, read

#: Labelled texts sampled per language (smallest digests of the id), and characters of the sample kept per language.
TRAIN_TEXTS = 400
SAMPLE = 24_000
#: Characters taken from one sampled text, from a place that its digest chooses, so that no text dominates.
EXCERPT = 400
#: Letter classes of the automata: the most frequent letters of the sample, a word gap, and one class for other letters.
CLASSES = 64
#: Texts are parsed in stretches of this many characters; a phrase ends where a stretch ends, in every language alike.
STRETCH = 256
UNKNOWN = "und"
#: The table of languages is broadcast up to this many rows.
SMALL_LANGUAGES = 10_000


def suffix_automaton(symbols: list[int], classes: int) -> np.ndarray:
    """Transitions (states x classes, -1: none) of the automaton that accepts every substring of ``symbols``."""
    size = 2 * len(symbols) + 2
    move = np.full((size, classes), -1, dtype=np.int32)
    link, length = [-1] * size, [0] * size
    last, used = 0, 1
    steps: list[dict[int, int]] = [{} for _ in range(size)]
    for c in symbols:
        here = used
        used += 1
        length[here] = length[last] + 1
        p = last
        while p >= 0 and c not in steps[p]:
            steps[p][c] = here
            p = link[p]
        if p < 0:
            link[here] = 0
        else:
            q = steps[p][c]
            if length[p] + 1 == length[q]:
                link[here] = q
            else:
                copy = used
                used += 1
                length[copy] = length[p] + 1
                steps[copy] = dict(steps[q])
                link[copy] = link[q]
                while p >= 0 and steps[p].get(c) == q:
                    steps[p][c] = copy
                    p = link[p]
                link[q] = link[here] = copy
        last = here
    for s in range(used):
        for c, t in steps[s].items():
            move[s, c] = t
    return move[:used]


def letters_only(text: str) -> str:
    """Lower case, with every run of characters that are no letters as one space."""
    low = text.lower()
    return " ".join("".join(c if c.isalpha() else " " for c in low).split())


@dataclass
class Model:
    """Languages, their automata as one table of (next state * 2 + phrase ended), and the bits a phrase costs."""

    name: str
    languages: list[str]
    code: np.ndarray
    table: np.ndarray
    roots: np.ndarray
    bits: np.ndarray


def build(samples: dict[str, str]) -> Model:
    """The model of sample texts (already ``letters_only``) by language."""
    languages = sorted(samples)
    frequency: dict[str, int] = {}
    for text in samples.values():
        for c in text:
            frequency[c] = frequency.get(c, 0) + 1
    frequency.pop(" ", None)
    # Class 0: other letters; class 1: the gap between words.
    code = np.fromiter((0 if chr(i).isalpha() else 1 for i in range(0x110000)), dtype=np.int32, count=0x110000)
    for i, c in enumerate(sorted(frequency, key=lambda c: (-frequency[c], c))[: CLASSES - 2]):
        code[ord(c)] = i + 2
    parts, roots, bits = [], [], []
    at = 0
    for language in languages:
        symbols = code[np.frombuffer(samples[language].encode("utf-32-le"), dtype=np.uint32)].tolist()
        move = suffix_automaton(symbols, CLASSES)
        move[:, 0] = -1  # an unknown letter matches nothing
        # Without a way on, the phrase ends with this letter and the next one starts at the root.
        packed = np.where(move >= 0, (move + at) * 2, at * 2 + 1)
        parts.append(packed)
        roots.append(at)
        bits.append(np.log2(max(2, len(symbols))))
        at += len(move)
    table = np.concatenate(parts).astype(np.int32) if parts else np.zeros((0, CLASSES), dtype=np.int32)
    return Model(uuid.uuid4().hex, languages, code, table.ravel(), np.array(roots, dtype=np.int64), np.array(bits))


class Parser:
    """Bits per letter of texts in every language of a model."""

    def __init__(self, model: Model):
        self.model = model

    def codes(self, text: str) -> np.ndarray:
        """The text's letter classes in lower case, every run of other characters as one gap; none without a letter."""
        code = self.model.code[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        gap = code == 1
        first = np.concatenate(([False], gap))[: len(gap)]
        return code[~(gap & (first | (np.cumsum(~gap) == 0)))]

    def phrases(self, rows: list[np.ndarray]) -> np.ndarray:
        """Phrases of each row of letter classes, one column per language."""
        model = self.model
        owner, starts, flat = [], [], []
        at = 0
        for i, r in enumerate(rows):
            n = len(r)
            flat.append(r)
            for s in range(0, n, STRETCH):
                owner.append(i)
                starts.append((at + s, min(STRETCH, n - s)))
            at += n
        out = np.zeros((len(rows), len(model.languages)))
        if not starts:
            return out
        letters = np.concatenate([*flat, np.zeros(1, dtype=np.int32)])
        begin, size = np.array(starts, dtype=np.int64).T
        order = np.argsort(-size, kind="stable")
        begin, size, who = begin[order], size[order], np.array(owner)[order]
        count = np.zeros((len(model.languages), len(begin)), dtype=np.int32)
        state = np.repeat(model.roots[:, None], len(begin), axis=1).astype(np.int32)
        longest = int(size[0])
        # How many stretches are longer than k letters; longer ones come first, so live rows are a prefix.
        live = np.searchsorted(-size, -np.arange(longest), side="left")
        for k in range(longest):
            n = int(live[k])
            got = model.table[state[:, :n] * CLASSES + letters[begin[:n] + k]]
            count[:, :n] += got & 1
            state[:, :n] = got >> 1
        count += state != model.roots[:, None]  # the phrase that the end cut off
        np.add.at(out, who, count.T)
        return out

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """(language, score) of each text."""
        model = self.model
        rows = [self.codes(t) if t else np.zeros(0, dtype=np.int32) for t in texts]
        bits = self.phrases(rows) * model.bits
        names, scores = [], []
        for i, r in enumerate(rows):
            if not len(r) or not model.languages:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            rate = bits[i] / len(r)
            best = int(rate.argmin())
            # Relative odds of the languages, one unit of evidence per tenth of a bit a letter.
            weight = np.exp(-np.clip((rate - rate[best]) * 10, 0, 60))
            names.append(model.languages[best])
            scores.append(float(1 / weight.sum()))
        return names, scores


_named: dict[str, Model] = {}
_parser = per_process(lambda name: Parser(_named[name]))


def _ready(shared) -> Parser:
    model = shared.value
    _named.clear()
    _named[model.name] = model
    return _parser(model.name)


def fit(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Learn from at most ``TRAIN_TEXTS`` texts per language that are not held out; ids only choose rows.

    A language's sample is an excerpt of each chosen text, up to ``SAMPLE`` characters together. Null languages, null
    texts and texts without letters teach nothing. Without any usable row the model knows no language.
    """
    stored = Stored(spark, "language")
    usable = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(id_column))
    digest = F.xxhash64(F.col(id_column), F.lit("language"))
    marks = usable.select(F.col(lang).alias("lang"), digest.alias("digest"))
    languages = marks.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # A digest below the share TRAIN_TEXTS / n of its range is chosen: about as many rows as wanted, without a sort.
    share = F.least(F.lit(1.0), F.lit(float(TRAIN_TEXTS)) / F.col("n"))
    limits = languages.select("lang", (F.lit(-(2.0**63)) + share * F.lit(2.0**64)).alias("limit"))
    limits, _ = stored.put(limits)
    # One row per language; counted before it is broadcast, so that no text is shuffled.
    side = F.broadcast(limits) if limits.limit(SMALL_LANGUAGES + 1).count() <= SMALL_LANGUAGES else limits
    chosen = usable.select(F.col(lang).alias("lang"), digest.alias("digest"), F.col(text).alias("text")).join(side, "lang")
    chosen = chosen.where(F.col("digest").cast("double") <= F.col("limit"))
    start = F.pmod(F.col("digest"), F.greatest(F.length("text") - EXCERPT + 1, F.lit(1))).cast("int") + 1
    excerpts, _ = stored.put(chosen.select("lang", "digest", F.substring("text", start, F.lit(EXCERPT)).alias("text")))
    samples: dict[str, str] = {}
    for r in excerpts.orderBy("lang", "digest", "text").toLocalIterator():
        if len(samples.get(r.lang, "")) < SAMPLE and (clean := letters_only(r.text)):
            samples[r.lang] = (samples.get(r.lang, "") + " " + clean)[:SAMPLE].strip()
    return build(samples)


def identify(spark: SparkSession, model: Model, text: Column) -> Column:
    """A struct (lang_pred, score) of a text column; ``und`` with score 0 for null texts and texts without letters."""
    shared = spark.sparkContext.broadcast(model)  # languages * 2 * SAMPLE * CLASSES numbers at most

    @F.arrow_udf("lang_pred string, score double")
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        parser = _ready(shared)
        for batch in batches:
            names: list[str] = []
            scores: list[float] = []
            for at in range(0, len(batch), 512):
                n, s = parser.judge(batch.slice(at, 512).to_pylist())
                names += n
                scores += s
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    return judged(text)


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Contract query: doc_id, held_out, lang_pred, score for every document."""
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang")
    model = fit(spark, docs)
    judged = docs.select("doc_id", held_out("doc_id").alias("held_out"), identify(spark, model, F.col("text")).alias("j"))
    return judged.select("doc_id", "held_out", "j.lang_pred", "j.score")
