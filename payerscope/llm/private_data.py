"""Personal data by fixed patterns and a skip-chain conditional random field."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_shared
from .common import small_slices, text_or_empty

KINDS = ("email", "ip", "card", "phone")
OUTSIDE = 0
TRAINING_DOCS = 20_000
SURE = 0.9
ROUNDS, DAMPING = 30, 0.3
NEAR = 3
LONG_KEY = 6

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
ADDRESS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SALIENT = re.compile(r"[0-9@]")
TOKEN = re.compile(r"\S+")


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at sign outwards: the letters before it, down to the match before, and its domain after it."""
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        domain = DOMAIN.match(text, at)
        if domain:
            start = at
            while start > done and (text[start - 1].isascii() and text[start - 1].isalnum() or text[start - 1] in "._%+-"):
                start -= 1
            if start < at:
                yield start, domain.end()
                done = at = domain.end()
                continue
        at += 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number from 1, start, end) of the four patterns, ordered by kind, then start."""
    found = [(1, a, b) for a, b in emails(text)]
    if not text.isascii() or any(c in text for c in "0123456789"):
        for match in ADDRESS.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match[0].split(".")):
                found.append((2, match.start(), match.end()))
        for match in CARD.finditer(text):
            if match.end() - match.start() >= 16:
                digits = match[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found.append((3, match.start(), match.end()))
        if "+" in text:
            for match in PHONE.finditer(text):
                if 8 <= sum(map(str.isdigit, match[0])) <= 15:
                    found.append((4, match.start(), match.end()))
    return found


def shape(token: str) -> str:
    """What the field sees of a token: bounded counts and signs, never the token itself."""
    digits = "".join(c for c in token if "0" <= c <= "9")
    n = len(digits)
    parts = (
        "@" if "@" in token else "-", min(n, 20) if n > 6 else (n + 2) // 3, min(token.count("."), 4),
        "+" if token.startswith("+") else "-", "(" if "(" in token else "-", "h" if "-" in token else "-",
        "a" if any(c.isalpha() for c in token) else "-", "L" if 16 <= n <= 19 and luhn(digits) else "-", min(len(token) // 8, 4),
    )
    return "|".join(map(str, parts))


def key_of(token: str) -> str | None:
    """Tokens with equal keys are similar: the digits of a numeric token, else its letters and digits."""
    core = "".join(c for c in token.lower() if c.isalnum() or c == "@")
    return core if len(core) >= LONG_KEY else None


def graph_of(text: str, spans: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int]], np.ndarray, list[str], np.ndarray, np.ndarray]:
    """Tokens with a digit or at sign, their labels by the base spans, shapes, chain edges and skip edges.

    Tokens without either sign are outside by definition and are no nodes. Neighbours of at most three
    characters' distance form a chain; each occurrence of a key is joined to the next one, however far.
    """
    tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text) if SALIENT.search(text, m.start(), m.end())]
    labels = np.zeros(len(tokens), np.int64)
    starts = np.array([a for a, _ in tokens], np.int64)
    ends = np.array([b for _, b in tokens], np.int64)
    for kind, a, b in reversed(spans):
        labels[np.searchsorted(ends, a, side="right") : np.searchsorted(starts, b, side="left")] = kind
    words = [text[a:b] for a, b in tokens]
    chain = np.flatnonzero(starts[1:] - ends[:-1] <= NEAR) if len(tokens) > 1 else np.zeros(0, np.int64)
    skip, last = [], {}
    for i, word in enumerate(words):
        key = key_of(word)
        if key is not None:
            if key in last:
                skip.append((last[key], i))
            last[key] = i
    return tokens, labels, [shape(w) for w in words], np.stack([chain, chain + 1], 1), np.array(skip, np.int64).reshape(-1, 2)


class Field:
    """A skip-chain conditional random field, trained piece by piece on tokens that the patterns label."""

    def __init__(self, nodes: dict[str, np.ndarray], chain: np.ndarray, skip: np.ndarray):
        size = len(KINDS) + 1
        total = sum(nodes.values(), np.zeros(size)) + 1.0
        prior = total / total.sum()
        self.unknown = np.log(prior)
        self.nodes = {s: np.log((n + 2 * prior) / (n.sum() + 2)) for s, n in nodes.items()}

        def potential(counts: np.ndarray, agreement: float) -> np.ndarray:
            counts = counts + counts.T + agreement * np.eye(size) + 0.1
            row = counts.sum(axis=1)
            return np.log(counts * counts.sum() / np.outer(row, row))

        self.chain = potential(chain, 1.0)
        self.skip = potential(skip, 20.0)

    def marginals(self, shapes: list[str], known: np.ndarray, chain: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """Loopy sum-product; tokens of base spans are fixed to their kind."""
        local = np.array([self.nodes.get(s, self.unknown) for s in shapes])
        fixed = known > 0
        local[fixed] = -50.0
        local[fixed, known[fixed]] = 0.0
        edges = np.concatenate([chain, skip])
        if len(edges):
            source = np.concatenate([edges[:, 0], edges[:, 1]])
            target = np.concatenate([edges[:, 1], edges[:, 0]])
            back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
            weight = np.concatenate([np.repeat(self.chain[None], len(chain), 0), np.repeat(self.skip[None], len(skip), 0)])
            weight = np.concatenate([weight, weight.transpose(0, 2, 1)])
            messages = np.zeros((len(source), local.shape[1]))
            for _ in range(ROUNDS):
                belief = local.copy()
                np.add.at(belief, target, messages)
                new = np.logaddexp.reduce((belief[source] - messages[back])[:, :, None] + weight, axis=1)
                new -= new.max(axis=1, keepdims=True)
                moved = np.abs(new - messages).max()
                messages = DAMPING * messages + (1 - DAMPING) * new
                if moved < 1e-4:
                    break
            np.add.at(local, target, messages)
        local = np.exp(local - local.max(axis=1, keepdims=True))
        return local / local.sum(axis=1, keepdims=True)

    def added(self, text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Spans of tokens outside the base spans that the field is sure of; neighbours of one kind are joined."""
        if not SALIENT.search(text):
            return []
        tokens, known, shapes, chain, skip = graph_of(text, spans)
        if not (known == 0).any():
            return []
        found = self.marginals(shapes, known, chain, skip)
        label = found.argmax(axis=1)
        out: list[tuple[int, int, int]] = []
        for i in np.flatnonzero((label > 0) & (known == 0) & (found.max(axis=1) >= SURE)).tolist():
            a, b = tokens[i]
            while a < b and not text[a].isalnum() and text[a] not in "+(":
                a += 1
            while b > a and not text[b - 1].isalnum() and text[b - 1] != ")":
                b -= 1
            if a == b:
                continue
            if out and out[-1][0] == label[i] and i and tokens[i][0] - tokens[i - 1][1] <= NEAR and known[i - 1] == 0 and out[-1][2] > tokens[i - 1][0]:
                out[-1] = (out[-1][0], out[-1][1], b)
            else:
                out.append((int(label[i]), a, b))
        return out


def train(docs: DataFrame, max_docs: int = TRAINING_DOCS) -> Field:
    """Count labels by token shape and by chain and skip edges over about ``max_docs`` texts with digits or at signs.

    The texts are picked by their hash; only the counts, whose number does not grow with the texts, reach the driver.
    """
    rows = docs.select(text_or_empty().alias("text")).where(F.col("text").rlike("[0-9@]"))
    n = rows.count()
    rows = rows.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, max_docs / max(n, 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str, int, int], int] = {}
        for batch in small_slices(batches):
            for text in batch.column(0).to_pylist():
                tokens, labels, shapes, chain, skip = graph_of(text, base_spans(text))
                for s, label in zip(shapes, labels.tolist()):
                    counts["node", s, label, 0] = counts.get(("node", s, label, 0), 0) + 1
                for kind, edges in (("chain", chain), ("skip", skip)):
                    for a, b in zip(labels[edges[:, 0]].tolist(), labels[edges[:, 1]].tolist()):
                        counts[kind, "", a, b] = counts.get((kind, "", a, b), 0) + 1
        rows = [(*key, n) for key, n in counts.items()]
        columns = list(zip(*rows)) or [[]] * 5
        types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["kind", "shape", "a", "b", "n"])

    counted = write_shared(
        rows.mapInArrow(run, "kind string, shape string, a bigint, b bigint, n bigint").groupBy("kind", "shape", "a", "b").agg(F.sum("n").alias("n")),
        "private-counts",
    )
    size = len(KINDS) + 1
    nodes: dict[str, np.ndarray] = {}
    edges = {"chain": np.zeros((size, size)), "skip": np.zeros((size, size))}
    for row in counted.collect():
        if row["kind"] == "node":
            nodes.setdefault(row["shape"], np.zeros(size))[row["a"]] += row["n"]
        else:
            edges[row["kind"]][row["a"], row["b"]] += row["n"]
    return Field(nodes, edges["chain"], edges["skip"])


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k - 1]}:{a}:{b}" for k, a, b in spans)


def private_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added for each row (null text: empty).

    The base patterns give the base spans; the field adds tokens that it is sure of, mostly further mentions of
    something that a base span names elsewhere in the text. Places count code points. Repeated rows get equal
    results; texts without digits and at signs get none; an empty table gives no row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in small_slices(batches):
            counts = np.zeros((batch.num_rows, len(KINDS)), np.int64)
            shas, spans_, added_ = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                base = base_spans(text)
                for kind, _, _ in base:
                    counts[i, kind - 1] += 1
                more = field.added(text, base)
                shas.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans_.append(joined(sorted({*base, *more})))
                added_.append(len(more))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c) for c in counts.T.copy()), pa.array(shas, pa.string()), pa.array(spans_, pa.string()), pa.array(added_, pa.int64())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"
    )


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span, overlapping ones joined, replaced by the name of its (first) kind."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"[{KINDS[kind - 1].upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def without_private_data(docs: DataFrame) -> DataFrame:
    """All rows and columns, personal data in ``text`` masked and ``n_chars`` counted anew; null texts stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))

    @F.pandas_udf("string")
    def mask(texts):
        field = shared.value
        return texts.map(lambda t: t if t is None or not SALIENT.search(t) else masked(t, [*(base := base_spans(t)), *field.added(t, base)]))

    out = docs.withColumn("text", mask(F.col("text").cast("string")))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
