"""Toxic texts by a string-kernel support vector machine over Nystrom landmarks."""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_shared
from .common import small_slices, text_or_empty

MAX_TRAINING_DOCS = 40_000
MAX_WORDS = 6_000
VARIED_WORDS = 24
LANDMARKS = 240
LENGTH, DECAY = 3, 0.75
WINDOW, STEP, HEAD = 24, 12, 6
CHANCE = 0.05
ROUNDS = 4
CACHED_WORDS = 600_000
SENTENCE = re.compile(r"[.!?\n]+")
RUNS = re.compile(r"\b\w\s\w\s\w\b")
EDGE = "\"'()[]{}<>,;:.!?-_*"
ALPHABET = 64


def units(sentence: str) -> list[str]:
    """The strings of a sentence that the kernel sees: its words, and runs of single letters as one word."""
    out, run = [], []
    for word in sentence.split():
        if len(word) == 1 and word.isalnum():
            run.append(word)
            continue
        if len(run) > 2:
            out.append("".join(run))
        run = []
        out.append(word)
    if len(run) > 2:
        out.append("".join(run))
    return out


def windows(unit: str) -> list[str]:
    """Bounded pieces of a unit: the whole of it or overlapping windows, and its first letters."""
    unit = unit.strip(EDGE)
    if not unit.isalpha():  # letters with other characters put in between are read once more without them
        bare = "".join(filter(str.isalpha, unit))
        if len(bare) != len(unit) and len(bare) >= LENGTH:
            return windows(bare) + (cover(unit) if len(unit) <= 2 * len(bare) else [])
    return cover(unit)


def cover(unit: str) -> list[str]:
    if len(unit) <= WINDOW:
        found = [unit]
    else:
        found = [unit[at : at + WINDOW] for at in range(0, len(unit) - WINDOW + STEP, STEP)]
    if len(unit) > HEAD:
        found.append(unit[:HEAD])
    return [w for w in found if len(w) >= LENGTH]


def letter_codes(words: list[str]) -> np.ndarray:
    """Letters of equally long words as small codes; rare letters share codes."""
    raw = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    return (raw % ALPHABET).astype(np.int64).reshape(len(words), -1)


@lru_cache(maxsize=64)
def gapped(n: int) -> tuple[np.ndarray, np.ndarray]:
    """All rising index triples below ``n`` and the decay of the span that each covers."""
    at = np.array(list(itertools.combinations(range(n), LENGTH)), np.int64).reshape(-1, LENGTH)
    return at, DECAY ** (at[:, -1] - at[:, 0] + 1.0)


def subsequences(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places in ``words``, subsequence codes, weights) for words of one length at a time.

    A gapped subsequence weighs less the longer the stretch it covers; the kernel of two words is the dot
    product of these weights, summed over equal subsequences, over the product of their norms.
    """
    by_length: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        by_length.setdefault(len(word), []).append(i)
    for n, places in by_length.items():
        at, weight = gapped(n)
        block = max(1, 400_000 // len(at))
        for a in range(0, len(places), block):
            part = places[a : a + block]
            letters = letter_codes([words[i] for i in part])[:, at]
            codes = (letters[..., 0] * ALPHABET + letters[..., 1]) * ALPHABET + letters[..., 2]
            yield np.array(part), codes, weight


def norms(codes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Length of each word's weight vector, equal subsequences added first."""
    order = np.argsort(codes, axis=1, kind="stable")
    codes = np.take_along_axis(codes, order, 1)
    weights = weight[order]
    ends = np.ones(codes.shape, bool)
    ends[:, :-1] = codes[:, 1:] != codes[:, :-1]
    if ends.all():
        return np.sqrt((weights**2).sum(axis=1))
    total = np.cumsum(weights, axis=1)
    before = np.where(ends, total, 0.0)
    before = np.maximum.accumulate(before, axis=1)
    previous = np.zeros_like(before)
    previous[:, 1:] = before[:, :-1]
    return np.sqrt(np.where(ends, (total - previous) ** 2, 0.0).sum(axis=1))


class StringMachine:
    """score(word) = sum of alpha x kernel(word, landmark) + bias, for words and for sentences (their best word).

    The landmark sum is folded into one weight per subsequence, so a word costs one look-up per gapped triple.
    """

    def __init__(self, landmarks: list[str], projection: np.ndarray, weights: np.ndarray, bias: float, scale: float, shift: float):
        self.landmarks, self.bias, self.scale, self.shift = landmarks, bias, scale, shift
        alpha = projection @ weights
        self.table = np.zeros(ALPHABET**LENGTH)
        for places, codes, weight in subsequences(landmarks):
            size = norms(codes, weight)
            np.add.at(self.table, codes, weight * (alpha[places] / size)[:, None])
        self.known: dict[str, float] = {}

    def words(self, words: list[str]) -> np.ndarray:
        out = np.full(len(words), self.bias)
        for places, codes, weight in subsequences(words):
            out[places] += (self.table[codes] @ weight if codes.ndim == 1 else (self.table[codes] * weight).sum(axis=1)) / norms(codes, weight)
        return out

    def learn(self, new: list[str]) -> None:
        """Scores of units that were not met lately: the best of each unit's windows."""
        pieces, owner = [], []
        for i, unit in enumerate(new):
            for piece in windows(unit):
                pieces.append(piece)
                owner.append(i)
        best = np.full(len(new), self.bias)
        np.maximum.at(best, np.array(owner, np.int64), self.words(pieces) if pieces else np.zeros(0))
        self.known.update(zip(new, best.tolist()))

    def margins(self, texts: list[str]) -> list[float]:
        """The largest margin of any word of any sentence; the bias for a text without words."""
        cut = []
        for text in texts:
            text = text.lower()
            words = text.split()
            if RUNS.search(text):
                words += [u for s in SENTENCE.split(text) for u in units(s)]
            cut.append(words)
        new = set(itertools.chain.from_iterable(cut)) - self.known.keys()
        if len(self.known) + len(new) > CACHED_WORDS:
            self.known.clear()
            new = set(itertools.chain.from_iterable(cut))
        new = list(new)
        for at in range(0, len(new), 50_000):
            self.learn(new[at : at + 50_000])
        get = self.known.__getitem__
        return [max(map(get, words), default=self.bias) for words in cut]

    def probability(self, margin: float) -> float:
        """By the logistic curve; training asks for margins of 1 and -1, and what lies beyond says no more."""
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, self.scale * max(-1.0, min(1.0, margin)) + self.shift))))


def train_vector_machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss on the (Nystrom) features, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    prior = np.append(np.ones(x.shape[1] - 1), 1e-3)
    w = np.zeros(x.shape[1])

    def loss(w: np.ndarray) -> float:
        return 0.5 * prior @ w**2 + 0.5 * (cost * np.maximum(0, 1 - y * (x @ w)) ** 2).sum()

    for _ in range(rounds):
        short = y * (x @ w) < 1
        xs, cs = x[short], cost[short]
        slope = prior * w + xs.T @ (cs * (xs @ w - y[short]))
        step = np.linalg.solve(np.diag(prior) + (xs * cs[:, None]).T @ xs, slope)
        size, now = 1.0, loss(w)
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised subsequence kernel between two lists of words."""
    def dense(part: list[str]) -> np.ndarray:
        out = np.zeros((len(part), len(keep)))
        for places, codes, weight in subsequences(part):
            at = np.searchsorted(keep, codes)
            at[at == len(keep)] = 0
            hit = keep[at] == codes
            values = np.broadcast_to(weight, codes.shape) / norms(codes, weight)[:, None]
            np.add.at(out, (np.broadcast_to(places[:, None], codes.shape)[hit], at[hit]), values[hit])
        return out

    keep = np.unique(np.concatenate([codes.ravel() for _, codes, _ in subsequences(landmarks)]))
    right = dense(landmarks)
    return np.vstack([dense(words[i : i + 2000]) @ right.T for i in range(0, len(words), 2000)])


def evidence_floor(tested: int) -> float:
    return math.log(max(tested, 1) / CHANCE)


def fit(words: list[tuple[str, int, int]], tested: int, toxic_docs: int, clean_docs: int, examples: list[tuple[str, int]]) -> StringMachine:
    """Train on word counts (word, toxic texts, clean texts) and example texts with their labels.

    A word is an example of the toxic class if its evidence would come up by chance in one of twenty trials over all
    ``tested`` words, whatever its clean uses. It counts for the toxic class by the toxic share of its texts and for
    the other class by the rest, so the margin that the machine learns for it grows with that share; how large a
    margin makes a text toxic is left to the calibration on whole texts.
    """
    floor = evidence_floor(tested)
    share = max(1, toxic_docs) / max(1, toxic_docs + clean_docs)

    def evidence(tox: int, clean: int) -> float:
        """Log-likelihood gain of a word's own toxic share over the overall one, if it is higher."""
        n, own = tox + clean, tox / (tox + clean)
        if own <= share:
            return 0.0
        rest = clean * math.log((1 - own) / (1 - share)) if clean and share < 1 else 0.0
        return tox * math.log(own / share) + rest

    ranked = sorted(((evidence(t, c), w, t, c) for w, t, c in words), reverse=True)
    bad = {w for e, w, t, c in ranked if e >= floor}
    seen_in: dict[str, int] = {}
    clean_in: dict[str, int] = {}
    for e, w, t, c in ranked:
        for piece in windows(w) if w in bad else []:
            seen_in[piece] = seen_in.get(piece, 0) + t
            clean_in[piece] = clean_in.get(piece, 0) + c
    positive = list(seen_in)[: MAX_WORDS // 4]
    for piece in sorted(positive, key=lambda p: -seen_in[p])[:VARIED_WORDS]:  # gapped forms are examples as well
        for form in gapped_forms(piece):
            if form not in seen_in:
                seen_in[form] = 1
                clean_in[form] = clean_in[piece] / seen_in[piece]
                positive.append(form)
    if not positive:
        return StringMachine(["aaa"], np.zeros((1, 1)), np.zeros(1), -1.0, 4.0, 0.0)
    clean_words = [w for e, w, t, c in ranked if c and e < floor and windows(w)]
    rng = np.random.default_rng(11)
    negative = [clean_words[i] for i in rng.permutation(len(clean_words))[:MAX_WORDS]]
    heads: dict[str, int] = {}
    marks = []
    for piece in positive[: MAX_WORDS // 4]:  # few landmarks that begin alike, so all kinds get some
        heads[piece[:4]] = heads.get(piece[:4], 0) + 1
        if heads[piece[:4]] <= 8 and len(marks) < LANDMARKS // 2:
            marks.append(piece)
    marks += list(dict.fromkeys(p for w in negative for p in windows(w)))[: LANDMARKS - len(marks)]
    own = kernel(marks, marks)
    values, vectors = np.linalg.eigh(own)
    good = values > 1e-6 * values.max()
    projection = vectors[:, good] / np.sqrt(values[good])
    machine, taken = None, set(positive) | bad
    toxic_part = np.array([seen_in[p] / (seen_in[p] + clean_in[p]) for p in positive])
    mixed = np.flatnonzero(toxic_part < 1)
    for _ in range(ROUNDS):
        pieces = list(dict.fromkeys(p for w in negative for p in windows(w) if p not in taken))
        x = kernel(positive + pieces, marks) @ projection
        x = np.vstack([x, x[mixed]])
        y = np.concatenate([np.ones(len(positive)), -np.ones(len(pieces) + len(mixed))])
        often = np.array([float(seen_in[p]) for p in positive])
        balance = max(1.0, len(pieces) / len(positive)) ** 0.5
        often = balance * np.clip(often / np.median(often), 0.2, 10.0)
        cost = 10.0 * np.concatenate([often * toxic_part, np.ones(len(pieces)), (often * (1 - toxic_part))[mixed]])
        weights, bias = train_vector_machine(x, y, cost)
        machine = StringMachine(marks, projection, weights, bias, 4.0, 0.0)
        machine.learn(clean_words)
        hard = sorted(clean_words, key=machine.known.__getitem__, reverse=True)[: MAX_WORDS // 4]
        hard = [w for w in hard if machine.known[w] > -1.0]
        before = len(negative)
        negative = list(dict.fromkeys(negative + hard))
        if len(negative) == before:
            break
    machine.known.clear()
    machine.scale, machine.shift = calibrate(machine.margins([t for t, _ in examples]), [label for _, label in examples])
    machine.known.clear()
    return machine


def calibrate(margins: list[float], labels: list[int]) -> tuple[float, float]:
    """Scale and shift of a logistic curve, by Newton steps with a small prior on both."""
    m, y = np.clip(np.array(margins), -1.0, 1.0), np.array(labels, float)
    if len(y) == 0 or y.min() == y.max():
        return 4.0, 0.0
    w = np.array([4.0, 0.0])
    x = np.stack([m, np.ones(len(m))], 1)

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - y * z).sum() + 0.25 * ((w - np.array([4.0, 0.0])) ** 2).sum())

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (p - y) + 0.5 * (w - np.array([4.0, 0.0]))
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(2)
        step, now = np.linalg.solve(curve, slope), loss(w)
        while np.abs(step).max() > 1e-6 and loss(w - step) > now:  # a full step overshoots where the curve is flat
            step = step / 2
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return float(max(w[0], 0.5)), float(w[1])


def gapped_forms(word: str) -> list[str]:
    """The word with one letter put in at several places."""
    if len(word) < 5:
        return []
    return [word[:i] + letter + word[i:] for i, letter in zip(range(1, len(word)), itertools.cycle("xzqk*"))]


def held_out(key: str = "doc_id"):
    """Rows of the test fold: crc32 of the id as text leaves no remainder by 5."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def evidence(toxic_docs: int, clean_docs: int) -> Column:
    """Log-likelihood gain of the toxic share of a row's (tox, clean) over the overall one, if it is higher."""
    share = max(1, toxic_docs) / max(1, toxic_docs + clean_docs)
    own = F.col("tox") / (F.col("tox") + F.col("clean"))
    rest = F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - own) / (1 - share))).otherwise(0.0) if share < 1 else F.lit(0.0)
    return F.when(own > share, F.col("tox") * F.log(own / share) + rest).otherwise(0.0)


def first_by_hash(rows: DataFrame, column: str, wanted: int, count: int) -> DataFrame:
    """The ``wanted`` rows whose values hash lowest, of ``count``.

    Rows above a bound on the hash that leaves about a fifth more than wanted go first, so what the sort brings to
    one place is of that size whatever the number of partitions.
    """
    share = 1.2 * (wanted + 100) / max(1, count)
    low = rows if share >= 1 else rows.where(F.xxhash64(column) < int(-(2**63) + share * 2**64))
    return low.orderBy(F.xxhash64(column), column).limit(wanted)


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAINING_DOCS) -> StringMachine:
    """Fit on labelled rows outside the test fold.

    Labels are per text. A sentence of a toxic text counts as toxic by the words that toxic texts have far more
    often than clean ones; all other words of clean texts are the other class, and clean words that the machine
    takes for toxic are added as examples in a few rounds. At most about ``max_docs`` labelled texts are used,
    picked by a hash of their id; their words are counted on the cluster, and only bounded lists reach the driver.
    """
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.col("toxic").cast("int")).alias("toxic")
    ).where(~held_out())
    share = min(1.0, max_docs / max(1, marks.count()))
    taken = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)
    # about max_docs marks are left, so they are broadcast and no text is shuffled
    marks = F.broadcast(write_shared(marks.where(taken), "toxicity-marks"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).where(taken).join(marks, "doc_id")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches):
            out, marks = [], []
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = {w for s in SENTENCE.split(text.lower()) for u in units(s) for w in (u.strip(EDGE), u.strip(EDGE)[:HEAD]) if len(w) >= LENGTH}
                out.extend(own)
                marks.extend([toxic] * len(own))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(marks, pa.int32())], names=["word", "toxic"])

    texts = write_shared(texts.select("text", "toxic"), "toxicity-training")
    counted = texts.mapInArrow(words, "word string, toxic int").groupBy("word").agg(
        F.sum("toxic").alias("tox"), F.sum(1 - F.col("toxic")).alias("clean")
    )
    counted = write_shared(counted, "toxicity-words")
    tested = counted.where("tox + clean >= 3").count()
    totals = {row["toxic"]: row["n"] for row in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    ranked = counted.withColumn("gain", evidence(totals.get(1, 0), totals.get(0, 0)))
    floor = evidence_floor(tested) - 1e-6  # fit() decides, by the same rule
    suspects = write_shared(ranked.where(F.col("gain") >= floor).orderBy(F.desc("gain"), "word").limit(MAX_WORDS), "toxicity-suspects").collect()
    others = ranked.where((F.col("clean") > 0) & (F.col("gain") < floor))
    common = first_by_hash(others, "word", 10 * MAX_WORDS, others.count()).collect()
    examples = first_by_hash(texts, "text", 2000, sum(totals.values())).collect()
    return fit(
        [(r["word"], r["tox"], r["clean"]) for r in suspects + common], tested, totals.get(1, 0), totals.get(0, 0),
        [(r["text"], r["toxic"]) for r in examples],
    )


def score(docs: DataFrame, machine: StringMachine) -> DataFrame:
    """doc_id, held_out, score, predicted per row; the text alone decides (null: empty, scored by the bias)."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for batch in small_slices(batches):
            found = [machine.probability(m) for m in machine.margins(batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.float64()), pa.array([int(p >= 0.5) for p in found], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id bigint, held_out boolean, score double, predicted int"
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labelled rows of four folds and score every row of ``docs``.

    Repeated rows get equal scores; unlabelled or absent rows change nothing; without any toxic label every
    score is low; an empty table gives no row; columns other than doc_id and text are not read.
    """
    return score(docs, train(docs, labels))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose own text scores under one half, all columns kept."""
    machine = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf("boolean")
    def clean(texts):
        import pandas as pd

        machine, out = shared.value, []
        for at in range(0, len(texts), 200):
            out.extend(machine.probability(m) < 0.5 for m in machine.margins(texts.iloc[at : at + 200].tolist()))
        return pd.Series(out, dtype=bool)

    return docs.where(clean(text_or_empty()))
