"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

A text is read as a stream of letters; what is neither letter nor digit, white space included, is a gap. Two strings are similar if
they share subsequences of three characters, each counting less the more letters it skips; the kernel is normalised for length.
Two machines of this kind judge a text, and the one more sure of itself decides. The first sees single tokens as they stand. The second
sees windows of up to ``WINDOW`` letters that run from the start of any token to the end of any token and pass over the gaps between, so
``i-d-i-o-t``, ``id iot`` and ``i  d  i  o  t`` all hold the window ``idiot``, and a phrase is a window too; it also learns from windows with
letters inserted. One machine for both would have to call a word clean because two clean words can spell it together.

A machine is trained on labelled texts as bags of windows: a clean text has only clean windows, a toxic one may owe its label to any. Windows
that explain most toxic texts are the first witnesses; in the second machine each also teaches with letters put into it. Training then alternates with a
search for the most deceptive clean windows and for further witnesses. A text's margin is its best window's.

The kernel has explicit features (triples with their spread), so after training the landmarks fold into one table of
weights per triple. Scoring is linear in the text whatever the number of landmarks: running sums of the table's entries over the letter
stream give the margin of every window by a few differences.

Texts may be as long as a string and are scored whole, piece by piece; repeated rows score alike; ties between windows do not matter, as only the largest margin counts;
columns other than the id and the text are not looked at.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.shared import Stored, give_back, held_out, per_process, read

#: Labelled texts taken per class for fitting, those with the smallest digests of their ids.
TRAIN_TEXTS = 3_000
#: Units kept as candidates for witnesses, and clean units taken as negatives at first and in each later round.
WITNESSES = 4_000
NEGATIVES = 8_000
#: A toxic text is explained when so many of its units are witnesses.
WITNESSED = 2
ROUNDS = 2
#: Weight of the errors of either class against the size of the machine's weights.
COST = 30_000.0
LANDMARKS = 160
#: A subsequence of three characters may be spread over at most this many; its weight is DECAY to the number of letters skipped.
SPREAD = 7
DECAY = 0.6
#: Letters of the longest window; a token of more letters counts as several of half that length.
WINDOW = 16
#: Character classes: 0 a gap, 1 and 2 the start and end of a window, then the OWN most frequent characters of the training
#: windows; all others share the rest by a hash of their code point, so letters of other scripts differ too.
CLASSES = 64
OWN = 45
#: Variants of every witness with one letter inserted; together they weigh half as much in training as the witness itself.
VARIANTS = 6
#: Letters scored at once.
PART = 1 << 18

_OFFSETS = [(a, b) for b in range(2, SPREAD) for a in range(1, b)]
_TOKEN = re.compile(r"[^\W_]+")


def tokens_of(text: str | None) -> list[str]:
    """Runs of letters and digits in lower case; longer ones than a window in parts of half a window."""
    out: list[str] = []
    for token in _TOKEN.findall((text or "").lower()):
        half = WINDOW // 2
        out += [token] if len(token) <= WINDOW else [token[i : i + half] for i in range(0, len(token), half)]
    return out


def windows_of(text: str | None) -> list[str]:
    """The windows of a text as strings: consecutive tokens put together, up to ``WINDOW`` letters."""
    tokens = tokens_of(text)
    out = []
    for i in range(len(tokens)):
        unit = ""
        for t in tokens[i:]:
            unit += t
            if len(unit) > WINDOW:
                break
            out.append(unit)
    return out


def _gaps() -> np.ndarray:
    """True for every code point that is no letter or digit."""
    return np.fromiter((not _TOKEN.match(chr(i)) for i in range(0x110000)), bool, 0x110000)


class Alphabet:
    """Characters as small class numbers."""

    gaps: np.ndarray | None = None

    def __init__(self, characters: str):
        if Alphabet.gaps is None:
            Alphabet.gaps = _gaps()
        self.characters = characters
        points = np.arange(0x110000, dtype=np.uint64)
        rest = CLASSES - 3 - OWN
        self.code = (3 + OWN + ((points * np.uint64(2654435761)) >> np.uint64(16)) % np.uint64(rest)).astype(np.int32)
        for i, c in enumerate(characters[:OWN]):
            self.code[ord(c)] = i + 3
        self.code[Alphabet.gaps] = 0

    def matrix(self, strings: list[str]) -> np.ndarray:
        """Strings of one length as rows of class numbers with both marks."""
        n = len(strings[0])
        points = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        rows = np.empty((len(strings), n + 2), dtype=np.int32)
        rows[:, 0], rows[:, -1] = 1, 2
        rows[:, 1:-1] = self.code[points].reshape(len(strings), n)
        return rows


def triples(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(triple ids, one row per string; weight of each column), scaled to length one if no triple repeats."""
    n = rows.shape[1]
    ids, weights = [], []
    for a, b in _OFFSETS:
        if b < n:
            ids.append((rows[:, : n - b] * CLASSES + rows[:, a : n - b + a]) * CLASSES + rows[:, b:])
            weights.append(np.full(n - b, DECAY ** (b - 2)))
    if not ids:
        return np.zeros((len(rows), 0), dtype=np.int32), np.zeros(0)
    weight = np.concatenate(weights)
    return np.concatenate(ids, axis=1), weight / np.sqrt((weight**2).sum())


@dataclass
class Part:
    """One machine: its characters, a weight per triple, the bias and the two numbers of its probability curve."""

    characters: str
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def logit(self, similarity: np.ndarray | float) -> np.ndarray | float:
        """The logit that belongs to a normalised sum of weights."""
        return self.slope * (self.bias + similarity) + self.shift


@dataclass
class Machine:
    """What scoring needs: the machine of tokens and the one of windows, which share their characters."""

    name: str
    tokens: Part
    windows: Part

    @property
    def bias(self) -> float:
        """The logit of a text without any token."""
        return max(p.logit(0.0) for p in (self.tokens, self.windows))


def _norms() -> np.ndarray:
    """Length of the feature vector of a window of n letters, if no triple repeats."""
    out = np.ones(WINDOW + 1)
    for n in range(1, WINDOW + 1):
        out[n] = np.sqrt(sum((n + 2 - b) * DECAY ** (2 * (b - 2)) for a, b in _OFFSETS if b < n + 2)) or 1.0
    return out


class _Table:
    """The weights of both machines in the shapes that the stream looks them up in: the tokens' as real parts, the windows' as imaginary ones."""

    def __init__(self, machine: Machine):
        self.flat = np.empty(CLASSES**3, dtype=np.complex64)
        self.flat.real, self.flat.imag = machine.tokens.weights, machine.windows.weights
        cube = self.flat.reshape(CLASSES, CLASSES, CLASSES)
        # Triples that begin with the start mark or end with the end mark, as tables of two characters; and those that do both.
        self.start, self.end, self.both = cube[1].ravel(), cube[:, :, 2].ravel(), cube[1, :, 2].astype(np.complex128)

    def ends(self, c: np.ndarray, begin: np.ndarray, finish: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the first and the last letter of a window add to its sum, per number of letters (more than SPREAD - 1 count as that) and
        token, and what the triples with both marks add, per number of letters and first token.

        The triples inside a window are those that begin at or behind its first letter less those that begin too late to end in it.
        """
        m = len(c)
        first, last, whole = np.zeros((3, SPREAD, len(begin)), dtype=np.complex128)
        left, middle = c * CLASSES**2, c * CLASSES
        # The first and last letters of every token on; where the stream ends before, no window asks.
        heads = [c[np.minimum(begin + k, m - 1)] for k in range(SPREAD - 1)]
        tails = [c[np.maximum(finish - 1 - k, 0)] for k in range(SPREAD - 1)]
        for b in range(2, SPREAD):
            run = np.zeros(m + 1, dtype=np.complex128)
            if m > b:
                outer, total = left[: m - b] + c[b:], run[1 : m - b + 1]
                for a in range(1, b):
                    total += self.flat.take(outer + middle[a : m - b + a])
            run = np.cumsum(run, out=run)
            inside = run[np.maximum(finish - b, 0)]
            marked, closed = -run[begin], self.both[heads[0]]
            for a in range(1, b):
                marked += self.start.take(heads[a - 1] * CLASSES + heads[b - 1])
                inside += self.end.take(tails[b - 1] * CLASSES + tails[b - 1 - a])
                if a > 1:
                    closed += self.both[heads[a - 1]]
            # A window of n letters holds the spreads of up to n.
            weight = DECAY ** (b - 2)
            first[b], last[b] = first[b - 1] + weight * marked, last[b - 1] + weight * inside
            whole[b - 1] = weight * closed
        return first, last, whole


class Scorer:
    """Logits of texts: the best of all their windows."""

    def __init__(self, machine: Machine):
        self.machine = machine
        self.alphabet = Alphabet(machine.tokens.characters)
        self.table = _Table(machine)
        self.norms = _norms()

    def texts(self, texts: list[str | None]) -> list[float]:
        """The logit of each text; that of no evidence where there is no token. Long lists and long texts are scored in parts."""
        out = [-np.inf] * len(texts)
        held, size = [], 0
        for i, text in enumerate(texts):
            low = (text or "").lower()
            # Parts of a long text overlap by more than any window of unbroken letters; they are cut where its letters are counted.
            for part in self._parts(low):
                held.append((i, part))
                size += len(part)
                if size >= PART:
                    self._score(held, out)
                    held, size = [], 0
        if held:
            self._score(held, out)
        return [m if np.isfinite(m) else self.machine.bias for m in out]

    def _parts(self, low: str) -> Iterator[np.ndarray]:
        codes = self.alphabet.code[np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)]
        if len(codes) <= PART:
            yield codes
            return
        # Cut between tokens; a part also holds the letters before it that a window reaching into it may begin with.
        letters = np.flatnonzero(codes)
        begins = letters[(letters == 0) | (codes[np.maximum(letters - 1, 0)] == 0)]
        at = 0
        while at < len(codes):
            after = begins[np.searchsorted(begins, at + PART) :]
            stop = int(after[0]) if len(after) else len(codes)
            reach = letters[max(0, int(np.searchsorted(letters, at)) - WINDOW)] if at and len(letters) else at
            first = int(begins[max(0, int(np.searchsorted(begins, reach, "right")) - 1)]) if at and len(begins) else at
            yield codes[min(first, at) : stop]
            at = stop

    def _score(self, held: list[tuple[int, np.ndarray]], out: list[float]) -> None:
        codes = np.concatenate([c for _, c in held])
        owner = np.repeat(np.arange(len(held)), [len(c) for _, c in held])
        at = np.flatnonzero(codes)
        if not len(at):
            return
        c, text = codes[at].astype(np.int64), owner[at]
        m = len(c)
        new = np.ones(m, bool)
        new[1:] = (np.diff(at) > 1) | (np.diff(text) > 0)
        # Tokens of more letters than a window begin anew every half window.
        begin = np.flatnonzero(new)
        long = np.diff(np.append(begin, m))
        place = np.arange(m) - np.repeat(begin, long)
        new |= (np.repeat(long, long) > WINDOW) & (place % (WINDOW // 2) == 0)
        begin = np.flatnonzero(new)
        finish = np.append(begin[1:], m)
        best = np.full(len(held), -np.inf)
        first, last, whole = self.table.ends(c, begin, finish)
        ends = np.searchsorted(text, text[begin], "right")  # end of the letters of the token's text
        tokens = np.arange(len(begin))
        upto, single = tokens.copy(), True
        # Round k looks at the windows of k + 1 tokens that are still short enough.
        while len(tokens):
            n = finish[upto] - begin[tokens]
            ok = (n <= WINDOW) & (finish[upto] <= ends[tokens])
            tokens, upto, n = tokens[ok], upto[ok], n[ok]
            if len(tokens):
                most = np.minimum(n, SPREAD - 1)
                total = (first[most, tokens] + last[most, upto] + whole[most, tokens]) / self.norms[n]
                of = text[begin[tokens]]
                if single:
                    np.maximum.at(best, of, self.machine.tokens.logit(total.real))
                np.maximum.at(best, of, self.machine.windows.logit(total.imag))
            single = False
            upto = upto + 1
            more = upto < len(begin)
            tokens, upto = tokens[more], upto[more]
        for k, (i, _) in enumerate(held):
            out[i] = max(out[i], float(best[k]))


_named: dict[str, Machine] = {}
_scorer = per_process(lambda name: Scorer(_named[name]))


def _ready(shared) -> Scorer:
    machine = shared.value
    _named.clear()
    _named[machine.name] = machine
    return _scorer(machine.name)


def logits_of(spark: SparkSession, machine: Machine, text: Column) -> Column:
    """The logit of a text column: of the machine that is more sure."""
    shared = spark.sparkContext.broadcast(machine)  # one number per triple: about 1 MB

    @F.arrow_udf("double")
    def margin(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = _ready(shared)
        for batch in batches:
            found: list[float] = []
            for at in range(0, len(batch), 256):
                found += scorer.texts(batch.slice(at, 256).to_pylist())
            yield pa.array(found, type=pa.float64())
        give_back()

    return margin(text)


def _unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, toxic, text) -> one row per different window of the text; ``token`` says that it is a single token somewhere."""
    for batch in batches:
        for at in range(0, batch.num_rows, 16):
            part = batch.slice(at, 16).to_pydict()
            doc, toxic, unit, token = [], [], [], []
            for d, y, t in zip(part["doc"], part["toxic"], part["text"], strict=True):
                single, found = set(tokens_of(t)), set(windows_of(t))
                doc += [d] * len(found)
                toxic += [y] * len(found)
                unit += found
                token += [u in single for u in found]
            columns = [pa.array(doc, pa.int64()), pa.array(toxic, pa.int32()), pa.array(unit, pa.string()), pa.array(token, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "toxic", "unit", "token"])


def _cover(pairs: dict[str, set[int]], against: dict[str, int], clean_share: float) -> dict[str, int]:
    """Units that explain the toxic texts, greedily, each text up to ``WITNESSED`` times: unit -> texts it was needed for."""
    left = {u: set(d) for u, d in pairs.items()}
    times: dict[int, int] = {}
    chosen: dict[str, int] = {}
    while left:
        gain = {u: len(d) - 5 * against[u] * clean_share for u, d in left.items()}
        best = min(gain, key=lambda u: (-gain[u], u))
        if gain[best] < 2:
            break
        done = left.pop(best)
        chosen[best] = len(done)
        for d in done:
            times[d] = times.get(d, 0) + 1
        full = {d for d in done if times[d] >= WITNESSED}
        left = {u: rest for u, d in left.items() if len(rest := d - full) > 1}
    return chosen


def _variants(units: dict[str, float], letters: str) -> dict[str, float]:
    """Every unit with a letter put between two of its own, ``VARIANTS`` times, sharing half the unit's weight."""
    out: dict[str, float] = {}
    for u, weight in units.items():
        if 4 <= len(u) < WINDOW:
            rng = np.random.default_rng(list(u.encode()))
            for _ in range(VARIANTS):
                at = int(rng.integers(1, len(u)))
                out.setdefault(u[:at] + letters[int(rng.integers(len(letters)))] + u[at:], weight / (2 * VARIANTS))
    return {u: w for u, w in out.items() if u not in units}


def _kernel(alphabet: Alphabet, strings: list[str], landmarks: list[str]) -> np.ndarray:
    """The kernel of strings against landmarks; one landmark's feature table at a time."""
    out = np.zeros((len(strings), len(landmarks)))
    by_length: dict[int, list[int]] = {}
    for i, s in enumerate(strings):
        by_length.setdefault(len(s), []).append(i)
    groups = [(np.array(members), *triples(alphabet.matrix([strings[i] for i in members]))) for members in by_length.values()]
    table = np.zeros(CLASSES**3, dtype=np.float32)
    for k, s in enumerate(landmarks):
        ids, weight = triples(alphabet.matrix([s]))
        np.add.at(table, ids[0], weight)
        for members, rows, column in groups:
            if len(column):
                out[members, k] = table[rows] @ column
        table[ids[0]] = 0
    return out


def _folded(alphabet: Alphabet, landmarks: list[str], factor: np.ndarray) -> np.ndarray:
    """The weight of every triple: the landmarks' features, each times its factor."""
    table = np.zeros(CLASSES**3)
    for s, f in zip(landmarks, factor.tolist(), strict=True):
        ids, weight = triples(alphabet.matrix([s]))
        np.add.at(table, ids[0], f * weight)
    return table.astype(np.float32)


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, by Newton steps."""
    n, d = x.shape
    z = np.hstack([x, np.ones((n, 1))])
    w = np.zeros(d + 1)
    ridge = np.eye(d + 1)
    ridge[d, d] = 1e-3
    for _ in range(40):
        slack = 1 - y * (z @ w)
        on = slack > 0
        zo, co = z[on], weight[on]
        gradient = ridge @ w - zo.T @ (co * y[on] * slack[on])
        step = np.linalg.solve(ridge + (zo * co[:, None]).T @ zo, gradient)
        w = w - step
        if np.abs(step).max() < 1e-7:
            break
    return w[:d], float(w[d])


def _curve(margin: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the probability that belongs to a margin (Platt's targets, Newton steps)."""
    pos, neg = int(toxic.sum()), int((1 - toxic).sum())
    target = np.where(toxic > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -40, 40)))
        s = p * (1 - p) + 1e-9
        g = np.array([((p - target) * margin).sum(), (p - target).sum()])
        h = np.array([[(s * margin * margin).sum(), (s * margin).sum()], [(s * margin).sum(), s.sum()]]) + 1e-3 * np.eye(2)
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Machine:
    """Learn from at most ``TRAIN_TEXTS`` labelled, not held-out texts of each class.

    Only the id (to choose rows), the text and the label are read. An id labelled more than once is toxic if one of its
    labels says so. Without texts of both classes the machine gives every text a probability below one half.
    """
    stored = Stored(spark, "toxicity")
    known = labels.where(F.col(toxic).isNotNull() & F.col(id_column).isNotNull() & ~held_out(id_column))
    known = known.groupBy(F.col(id_column).alias("doc")).agg(F.max(F.col(toxic).cast("int")).alias("toxic"))
    present = docs.where(F.col(text).isNotNull()).select(F.col(id_column).alias("doc")).distinct()
    known, _ = stored.put(known.join(present, "doc"))
    order = [F.xxhash64(F.col("doc"), F.lit("toxicity")), F.col("doc")]
    chosen = known.where("toxic = 1").orderBy(*order).limit(TRAIN_TEXTS).union(known.where("toxic = 0").orderBy(*order).limit(TRAIN_TEXTS))
    # At most 2 * TRAIN_TEXTS ids and labels: a proven bound for the broadcast.
    texts = docs.select(F.col(id_column).alias("doc"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc")
    texts, _ = stored.put(texts.select("doc", "toxic", "text").repartition(spark.sparkContext.defaultParallelism))
    number = {r[0]: r[1] for r in texts.groupBy("toxic").agg(F.count_distinct("doc")).collect()}
    blank = Part("", np.zeros(CLASSES**3, dtype=np.float32), -1.0)
    empty = Machine(uuid.uuid4().hex, blank, blank)
    if not number.get(0) or not number.get(1):
        return empty
    rows, _ = stored.put(texts.mapInArrow(_unit_rows, "doc long, toxic int, unit string, token boolean").groupBy("doc", "toxic", "unit").agg(F.max("token").alias("token")))
    singles = rows.where("token")
    letters = singles.select("unit").distinct().select(F.explode(F.split("unit", "")).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    characters = "".join(r.c for r in letters.where("c <> ''").orderBy(F.desc("n"), "c").limit(OWN).collect() if len(r.c) == 1)
    share = number[1] / number[0]
    parts = []
    for units, variants in ((singles, False), (rows, True)):
        stats, _ = stored.put(units.groupBy("unit").agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg")))
        parts.append(_learn(spark, units, stats, share, characters, variants) or replace(blank, characters=characters))
    machine = Machine(uuid.uuid4().hex, *parts)
    # Each curve comes from the margins of its own machine; the other one is silent meanwhile.
    silent = replace(parts[0], weights=blank.weights, bias=-1e6)
    for k in range(2):
        alone = Machine(uuid.uuid4().hex, *[p if i == k else silent for i, p in enumerate(parts)])
        judged = texts.select("toxic", logits_of(spark, alone, F.col("text")).alias("margin")).where("margin > -1e5").toPandas()
        # A machine that has learned nothing stays below one half whatever the classes' shares.
        if len(judged) and parts[k].weights.any():
            parts[k].slope, parts[k].shift = _curve(judged["margin"].to_numpy(), judged["toxic"].to_numpy())
    return machine


def _learn(spark: SparkSession, rows: DataFrame, stats: DataFrame, share: float, characters: str, variants: bool) -> Part | None:
    """One machine from the windows (doc, toxic, unit) of the labelled texts and their counts; None where nothing explains a toxic text."""
    candidates = stats.where("pos >= 2").where(F.col("pos") > 8 * share * F.col("neg")).orderBy(F.desc("pos"), "unit").limit(WITNESSES)
    against = {r.unit: r.neg for r in candidates.select("unit", "neg").collect()}
    if not against:
        return None
    pairs: dict[str, set[int]] = {u: set() for u in against}
    wanted = rows.where("toxic = 1").join(F.broadcast(candidates.select("unit")), "unit").select("unit", "doc")
    for r in wanted.toLocalIterator():
        pairs[r.unit].add(r.doc)
    witness = _cover(pairs, against, share)
    if not witness:
        return None
    # Windows of clean texts; those in more texts stand for more.
    clean = stats.where(F.col("neg") > 0)
    first = clean.orderBy(F.xxhash64("unit", F.lit("negatives"))).limit(NEGATIVES).select("unit").collect()
    usual = clean.orderBy(F.desc("neg"), "unit").limit(NEGATIVES // 4).select("unit").collect()
    negatives = {r.unit for r in first + usual}
    alphabet = Alphabet(characters)
    positives = {u: float(n) for u, n in witness.items()}
    part = None
    for turn in range(ROUNDS + 1):
        negatives -= set(positives)
        ordered = sorted(negatives)
        # Landmarks: the witnesses that explain most, and clean windows spread over the alphabet's order.
        best = sorted(positives, key=lambda u: (-positives[u], u))[: LANDMARKS // 2]
        rest = LANDMARKS - len(best)
        landmarks = best + [ordered[i] for i in np.linspace(0, len(ordered) - 1, min(rest, len(ordered))).astype(int)]
        # A witness counts as often as it was needed, so that chance words of a few texts weigh little; kindred ones add up.
        needed = {u: min(n, 20.0) for u, n in positives.items()}
        spread = {u: n for u, n in _variants(needed, characters).items() if u not in negatives} if variants else {}
        strings = [*positives, *spread, *ordered]
        similar = _kernel(alphabet, strings, landmarks)
        own = _kernel(alphabet, landmarks, landmarks)
        value, vector = np.linalg.eigh((own + own.T) / 2)
        use = value > 1e-6 * value[-1]
        root = vector[:, use] / np.sqrt(value[use])
        y = np.concatenate([np.ones(len(positives) + len(spread)), -np.ones(len(ordered))])
        much = np.array([*needed.values(), *spread.values()])
        weight = np.concatenate([much / much.sum(), np.full(len(ordered), 1.0 / len(ordered))]) * COST
        w, bias = _svm(similar @ root, y, weight)
        part = Part(characters, _folded(alphabet, landmarks, root @ w), bias)
        if turn == ROUNDS:
            break
        scored = stats.withColumn("margin", logits_of(spark, Machine(uuid.uuid4().hex, replace(part, weights=part.weights * 0, bias=-1e6), part), F.col("unit")))
        deceptive = scored.where(F.col("neg") > 0).where(F.col("pos") <= 8 * share * F.col("neg")).orderBy(F.desc("margin"), "unit").limit(NEGATIVES)
        negatives |= {r.unit for r in deceptive.select("unit").collect()}
        more = scored.where("neg = 0 and pos >= 2 and margin > 0.5").orderBy(F.desc("margin"), "unit").limit(WITNESSES)
        margin = dict(zip(positives, (similar[: len(positives)] @ (root @ w) + bias).tolist(), strict=True))
        positives = {u: n for u, n in positives.items() if margin[u] > 0}
        for r in more.collect():
            positives.setdefault(r.unit, 1.0)
        if not positives:
            return None
    return part


def score(docs: DataFrame, machine: Machine, text: str = "text") -> Column:
    """The probability that a whole text is toxic, as a column; null and empty texts get that of no evidence."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logits_of(docs.sparkSession, machine, F.col(text))))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Contract query: doc_id, held_out, score, predicted for every document."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    machine = fit(spark, docs, read(spark, folder, "labels").select("doc_id", "toxic"))
    scored = docs.select("doc_id", held_out("doc_id").alias("held_out"), score(docs, machine).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
