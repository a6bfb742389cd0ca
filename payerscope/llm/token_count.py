"""Token counts by a finite-state transducer compiled from a piece vocabulary."""

from __future__ import annotations

import ast
import gc
from collections.abc import Iterator
from functools import lru_cache
from sys import intern

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_shared
from . import vocab
from .common import small_slices, text_or_empty

CHUNK = 32_768
CHUNKS_PER_TEXT = 64
WARM_UP = 64
MAX_STATES = 250_000
LIMIT = 4096
NORMAL, USER_DEFINED, UNUSED = 1, 4, 5


class State(dict):
    """One transducer state: character -> (next state, tokens emitted); missing transitions are compiled on use.

    ``tail`` is the longest suffix of the input that begins some piece. ``last`` holds, for every place in
    the tail from which a piece may still start, the token that ends there in the segmentation of the text up to there (None: a boundary that
    every token may follow), and ``ahead`` how many tokens that segmentation has more than the current one.
    These decide everything that follows, so equal keys are one state.
    """

    __slots__ = ("home", "tail", "last", "ahead")

    def __init__(self, home: "Transducer", tail: str, last: tuple, ahead: tuple):
        self.home, self.tail, self.last, self.ahead = home, tail, last, ahead

    def __missing__(self, letter: str):
        step = self[letter] = self.home.step(self, letter)
        return step

    def key(self) -> str:
        return repr((self.tail, self.last, self.ahead))


class Transducer:
    """A deterministic transducer for the merges of a sentencepiece byte-fallback model.

    A sequence of tokens is what the merges give if and only if each pair of neighbours is, so the last
    token of every prefix is known from a bounded stretch of text, and reading one more character changes
    the number of tokens by a number that the state determines.
    """

    def __init__(self, model_path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_path, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        if rules.name != "identity" or rules.remove_extra_whitespaces or not rules.add_dummy_prefix:
            raise ValueError("only models without text normalisation are compiled")
        if any(p.type == USER_DEFINED for p in model.pieces):
            raise ValueError("user-defined pieces are not compiled")
        self.score = {p.piece: p.score for p in model.pieces if p.type in (NORMAL, UNUSED)}
        self.letters = {p for p in self.score if len(p) == 1}
        if any(c not in self.letters for p in self.score for c in p):
            raise ValueError("every letter of a piece must be a piece")
        self.heads = {p[:i] for p in self.score for i in range(1, len(p) + 1)}
        self.joined = {p[i : i + 2] for p in self.score for i in range(len(p) - 1)}
        self.fits: dict[tuple[str, str], bool] = {}
        self._reset()

    def _reset(self) -> None:
        self.states: dict[tuple, State] = {}
        self.root = self.state("", (None,), (0,))
        self.start = self.root["▁"][0]

    def state(self, tail: str, last: tuple, ahead: tuple) -> State:
        key = (tail, last, ahead)
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = State(self, tail, last, ahead)
        return found

    def merge(self, text: str) -> list[str]:
        """The tokens of a short text: the best pair is merged until none is a piece."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def may_follow(self, left: str | None, right: str) -> bool:
        fits = self.fits.get((left, right))
        if fits is None:
            if left is None:
                fits = len(right) == 1 or self.merge(right) == [right]
            else:
                fits = self.merge(left + right) == [left, right]
            self.fits[(left, right)] = fits
        return fits

    def step(self, state: State, letter: str) -> tuple[State, int]:
        letter = "▁" if letter == " " else letter
        if letter not in self.letters:  # its bytes are tokens, and nothing merges across it
            return self.root, len(letter.encode("utf-8", "surrogatepass"))
        if state.tail and state.tail[-1] + letter not in self.joined:  # no piece spans this place
            return self.root[letter]
        text = state.tail + letter
        for at in range(len(text)):
            token = intern(text[at:])
            if token in self.score and self.may_follow(state.last[at], token):
                break
        else:
            raise AssertionError(f"no token ends {text!r}")
        added = state.ahead[at] + 1
        keep = next((i for i in range(len(text)) if text[i:] in self.heads), len(text))
        last, ahead = [], []
        for i in range(keep, len(text) + 1):
            if i == len(text):
                last.append(token), ahead.append(0)
            elif text[i:] in self.heads:
                last.append(state.last[i]), ahead.append(state.ahead[i] - added)
            else:  # no piece can start here any more
                last.append(""), ahead.append(0)
        return self.state(intern(text[keep:]), tuple(last), tuple(ahead)), added

    def run(self, text: str, state: State, count: int = 0) -> tuple[State, int]:
        """Feed a text; forgets compiled states now and then, so memory stays bounded."""
        for at in range(0, len(text), CHUNK):
            for letter in text[at : at + CHUNK]:
                state, more = state[letter]
                count += more
            if len(self.states) > MAX_STATES or len(self.fits) > 2 * MAX_STATES:
                tail, last, ahead = state.tail, state.last, state.ahead
                self.fits.clear()
                self._reset()
                state = self.state(tail, last, ahead)
                gc.collect()
        return state, count

    def state_of(self, key: str) -> State:
        """The state that ``State.key`` names."""
        return self.state(*ast.literal_eval(key))

    def count(self, text: str) -> int:
        return self.run(text, self.start, 1)[1] if text else 0


@lru_cache(maxsize=1)
def transducer(model_path: str) -> Transducer:
    return Transducer(model_path)


START = "start"
MAP_SCHEMA = "row bigint, doc_id bigint, chunk int, enter string, leave string, n bigint, bytes bigint"


def chunk_maps(chunks: DataFrame, path: str) -> DataFrame:
    """One entry of each chunk's state map: the state it is entered in, the state it leaves, the tokens between.

    ``chunks`` names the state to enter in; where it is null, it is the one that the last 64 characters of left
    context (``lead``) lead to. The first chunk of a text is entered in ``START``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in small_slices(batches):
            rows = (batch.column(name).to_pylist() for name in ("enter", "lead", "text"))
            enter, leave, counts, sizes = [], [], [], []
            for known, lead, text in zip(*rows):
                if known == START:
                    state, count = machine.start, 1 if text else 0
                else:
                    state, count = machine.state_of(known) if known else machine.run(lead, machine.root)[0], 0
                    known = state.key()
                enter.append(known)
                state, count = machine.run(text, state, count)
                leave.append(state.key())
                counts.append(count)
                sizes.append(len(text.encode("utf-8", "surrogatepass")))
            columns = [batch.column("row"), batch.column("doc_id"), batch.column("chunk"), pa.array(enter, pa.string()),
                       pa.array(leave, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "chunk", "enter", "leave", "n", "bytes"])

    return chunks.select("row", "doc_id", "chunk", "enter", "lead", "text").mapInArrow(run, MAP_SCHEMA)


def unmet_states(maps: DataFrame) -> DataFrame:
    """(row, chunk, enter): states that some entry of the chunk before leaves and for which a chunk has no entry yet."""
    last = maps.groupBy("row").agg(F.max("chunk").alias("last"))
    left = maps.join(last, "row").where("chunk < last").select("row", (F.col("chunk") + 1).alias("chunk"), F.col("leave").alias("enter"))
    return left.distinct().join(maps.select("row", "chunk", "enter"), ["row", "chunk", "enter"], "left_anti")


def closed_maps(cut: DataFrame, path: str) -> DataFrame:
    """Entries of all chunks' state maps such that every state that a chunk leaves is an entry of the next one.

    All chunks are first entered in a guessed state, at once. Every round then adds the entries that are missing,
    for all chunks at once; a round completes at least one more chunk of each text, so there are fewer rounds than
    chunks in a text (64), and none where all guesses are right. Only texts with a missing entry are read again, and
    once: their chunks are written for the rounds.
    """
    maps = write_shared(chunk_maps(cut, path), "chunk-maps")
    held = None
    while True:
        unmet = write_shared(unmet_states(maps), "chunk-states")
        if unmet.isEmpty():
            return maps
        if held is None:
            held = write_shared(cut.drop("enter").join(unmet.select("row").distinct(), "row", "left_semi"), "chunks")
        more = chunk_maps(held.join(unmet, ["row", "chunk"]).repartition("row", "chunk", "enter"), path)
        maps = write_shared(maps.unionByName(more), "chunk-maps")


def composed_maps(maps: DataFrame) -> DataFrame:
    """doc_id, bytes, n of each text: its chunks' maps applied one after the other to the start state."""
    steps = F.array_sort(F.collect_list(F.struct("chunk", "enter", "leave", "n", "bytes")))
    walk = F.aggregate(
        F.col("steps"),
        F.struct(F.lit(0).alias("chunk"), F.lit(START).alias("state"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("bytes")),
        lambda at, step: F.when(
            (step["chunk"] == at["chunk"]) & (step["enter"] == at["state"]),
            F.struct((at["chunk"] + 1).alias("chunk"), step["leave"].alias("state"), (at["n"] + step["n"]).alias("n"), (at["bytes"] + step["bytes"]).alias("bytes")),
        ).otherwise(at),
    )
    return maps.groupBy("row").agg(F.first("doc_id").alias("doc_id"), steps.alias("steps")).select("doc_id", walk.alias("end")).select("doc_id", "end.bytes", "end.n")


def count_tokens(docs: DataFrame, model_path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row; a null text counts as empty.

    Texts of up to 32,768 characters are counted where they are read. Longer ones are cut in at most 64
    chunks that are dealt over the cluster; each chunk's map from the state it is entered in to the state it
    leaves and its tokens is found for the states that can occur, and the maps of a text are composed. A chunk is
    first entered in a guessed state; where guesses do not match (long runs of one character), only the entries
    that are missing are computed, never the whole text in one task.

    Rows are told apart by their place in the input, so repeated rows and repeated or null ids stay; an
    empty table gives no row. Give the function a written table: its splits must read the same twice.
    """
    path = model_path or vocab.path_of("piece_bpe_32k.model")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")
    ).withColumn("letters", F.length("text"))
    short = rows.where(F.col("letters") <= CHUNK).select(
        "row", "doc_id", F.lit(0).alias("chunk"), F.lit(START).alias("enter"), F.lit("").alias("lead"), "text"
    )
    long = rows.where(F.col("letters") > CHUNK)
    size = F.greatest(F.lit(CHUNK), F.ceil(F.col("letters") / CHUNKS_PER_TEXT)).cast("int")
    cut = (
        long.withColumn("size", size)
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("letters") / F.col("size")) - 1).cast("int"))))
        .select(
            "row", "doc_id", "chunk", F.when(F.col("chunk") == 0, START).alias("enter"),
            F.when(F.col("chunk") == 0, "").otherwise(
                F.expr(f"substring(text, chunk * size + 1 - {WARM_UP}, {WARM_UP})")
            ).alias("lead"),
            F.expr("substring(text, chunk * size + 1, size)").alias("text"),
        )
        .repartition("row", "chunk")
    )
    counted = chunk_maps(short, path).select("doc_id", "bytes", "n").unionByName(composed_maps(closed_maps(cut, path)))
    return counted.select("doc_id", F.col("bytes").alias("n_bytes"), F.col("n").alias("n_tokens"), (F.col("n") > limit).alias("over_limit"))
