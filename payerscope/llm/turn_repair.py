"""Repair of the turn structure of conversations by Hirschberg's divide and conquer.

Allowed are conversations whose role initials read ``(s?(ua)+)?``. Four states tell where a repaired prefix stands:
nothing yet, after the system turn, after a user turn, after an assistant turn. Every source row is one step from
state to state: some inserted turns (only those that the state asks for), then Keep, Rerole or Delete. The steps of
a row depend on its initial and its fault alone, so a row is one byte.

The search halves the rows: a forward pass over the first half gives for each state the least cost and the rank of
its audit among the four, a backward pass over the second half the least cost to the end. The crossing with the least
sum, then the least rank, lies on the audit-least cheapest path; both halves are solved on their own. Two audits that
have used up the same rows end with a row's letter, so none is a prefix of another and ranks order them fully. A
pass holds four numbers a state; no table of rows by states is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ranking import dense_key, null_safe_join
from ..session import write_shared
from .chat_rows import Digest, conversations_of, fold_pieces, in_batches, together

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ASKED = [USER, USER, ASSISTANT, USER]  # the turn that an inserted or reroled one becomes, by state
ROLES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = ["", "s", "u", "a"]
KIND, BAD, CUT = 3, 4, 8  # bits of a row's code: initial, blank or duplicate, truncated
FAR = float("inf")
WORD = "[^\\x20\\x09-\\x0D]"
# A conversation up to these sizes is repaired as one row; a longer one takes the path of streams.
ROWS_IN_ONE, CHARS_IN_ONE = 50_000, 16_000_000


def after(state: int, kind: int) -> int | None:
    """The state after a kept turn of that initial, if the grammar allows it there."""
    allowed = {SYSTEM: state == NOTHING, USER: state in (NOTHING, SYSTEM, ASSISTANT), ASSISTANT: state == USER}
    return kind if allowed.get(kind) else None


def steps_of(code: int) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, letters) of a row: the cheapest, then ASCII-least way between each two states."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    penalty = TRUNCATED if code & CUT else 0
    for state in range(4):
        at, letters, cost = state, "", 0
        for _ in range(3):  # after two inserted turns the states repeat
            ways = [(DELETE, "D", at)]
            if not code & BAD:
                ways.append((REROLE + penalty, "R", ASKED[at]))
                kept = after(at, code & KIND)
                if kept is not None:
                    ways.append((KEEP + penalty, "K", kept))
            for extra, letter, to in ways:
                way = (cost + extra, letters + letter)
                best[state, to] = min(best.get((state, to), way), way)
            at, letters, cost = ASKED[at], letters + "I", cost + INSERT
    return [(state, to, cost, letters) for (state, to), (cost, letters) in sorted(best.items())]


STEPS = [steps_of(code) for code in range(16)]
CLOSING = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
CLOSED = [INSERT * len(CLOSING[state]) for state in range(4)]


def forward(codes: bytes, state: int) -> tuple[list[float], list[int]]:
    """Least cost to each state after the rows, and the rank of the least audit that gets there."""
    cost, rank = [FAR] * 4, [0] * 4
    cost[state] = 0
    for code in codes:
        best: list[tuple | None] = [None] * 4
        for origin, to, extra, letters in STEPS[code]:
            if cost[origin] < FAR:
                way = (cost[origin] + extra, rank[origin], letters)
                if best[to] is None or way < best[to]:
                    best[to] = way
        order = sorted((way[1], way[2], to) for to, way in enumerate(best) if way)
        cost = [way[0] if way else FAR for way in best]
        rank = [0] * 4
        for place, (_, _, to) in enumerate(order):
            rank[to] = place
    return cost, rank


def backward(codes: bytes, ending: list[float]) -> list[float]:
    """Least cost from each state before the rows to the end."""
    for code in reversed(codes):
        cost = [FAR] * 4
        for origin, to, extra, _ in STEPS[code]:
            cost[origin] = min(cost[origin], extra + ending[to])
        ending = cost
    return ending


def solve(codes: memoryview, state: int, ending: list[float]) -> Iterator[tuple[str, int]]:
    """(letters, state after) of each row on the audit-least cheapest path."""
    if len(codes) == 1:
        ways = [(cost + ending[to], letters, to) for origin, to, cost, letters in STEPS[codes[0]] if origin == state and ending[to] < FAR]
        _, letters, to = min(ways)
        yield letters, to
        return
    half = len(codes) // 2
    cost, rank = forward(codes[:half], state)
    rest = backward(codes[half:], ending)
    _, _, crossing = min((cost[s] + rest[s], rank[s], s) for s in range(4))
    yield from solve(codes[:half], state, [0 if s == crossing else FAR for s in range(4)])
    yield from solve(codes[half:], crossing, ending)


def audit_of(codes: bytes) -> str:
    """Letters of the cheapest edits in order (K, R, D, I), the ASCII-least of the cheapest."""
    if not codes:
        return ""
    letters, state = [], NOTHING
    for letter, state in solve(memoryview(codes), NOTHING, CLOSED):
        letters.append(letter)
    return "".join(letters) + CLOSING[state]


def cost_of(codes: bytes, audit: str) -> int:
    price = {"K": KEEP, "R": REROLE, "D": DELETE}
    rows = iter(codes)
    total = INSERT * audit.count("I")
    for letter in audit:
        if letter != "I":
            code = next(rows)
            total += price[letter] + (TRUNCATED if code & CUT and letter != "D" else 0)
    return total


def edited(audit: str, rows: Iterator[dict]) -> Iterator[dict]:
    """The repaired turns: role, text and the edit that each came from."""
    state = NOTHING
    for letter in audit:
        row = None if letter == "I" else next(rows)
        if letter == "D":
            continue
        state = row["code"] & KIND if letter == "K" else ASKED[state]
        yield {"role": row["role"] if letter == "K" else ROLES[state], "text": row["text"] if row else "", "edit": letter}


class Faults:
    """Counts over the rows of a conversation in turn order, and the code of each row."""

    def __init__(self):
        self.codes = bytearray()
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self._last, self._turn, self._first, self._distinct = None, None, None, 0

    def add(self, row: dict, duplicate: bool) -> int:
        """Count a row; its code has the fault bits on top of its initial."""
        kind, turn = row["code"] & KIND, row["turn"]
        fault = "blank" if row["code"] & BAD else "duplicate" if duplicate else "truncated" if row["code"] & CUT else None
        if fault:
            self.counts[fault] += 1
        if self._last is not None and (INITIALS[self._last] + INITIALS[kind]) not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self._last = kind
        if turn is not None and turn != self._turn:
            self._first = turn if self._first is None else self._first
            self._turn, self._distinct = turn, self._distinct + 1
        self.codes.append(kind | {"blank": BAD, "duplicate": BAD, "truncated": CUT, None: 0}[fault])
        return self.codes[-1]

    def report(self) -> dict:
        codes = bytes(self.codes)
        audit = audit_of(codes)
        gaps = self._turn - self._first + 1 - self._distinct if self._distinct else 0
        return {"gaps": gaps, **self.counts, "cost": cost_of(codes, audit), "audit": audit}


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
TURN = T.StructType([T.StructField(n, T.StringType()) for n in ("role", "text", "edit")])
ARROW_TURNS = pa.list_(pa.struct([(n, pa.string()) for n in ("role", "text", "edit")]))


def row_code() -> Column:
    """Initial of the role, blank and truncated as bits; whether a row repeats is known only in its conversation."""
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(0)
    blank = ~F.col("text").rlike(WORD)
    whole = F.col("text").rlike("[.!?][\\x20\\x09-\\x0D]*\\z")
    return (kind + F.when(blank, BAD).when(~whole, CUT).otherwise(0)).cast("int")


def repair(rows: DataFrame, rows_in_one: int = ROWS_IN_ONE, chars_in_one: int = CHARS_IN_ONE) -> DataFrame:
    """Repaired conversations as pieces: (conv_id, piece, whole, counts, cost, audit, turns).

    ``rows`` has conv_id, turn, role and text. A conversation's rows stand in the order of turn (nulls first), then
    role, then text, so the result does not depend on how rows are stored; equal rows may swap places unseen. A null
    role or text counts as one space, a missing conv_id is a conversation of its own. Any other column is ignored.
    A row's first fault counts: blank, duplicate (role and text seen earlier), truncated. Without rows there is no
    result row.

    Normal conversations are one piece (``whole``). One of more than ``rows_in_one`` rows or ``chars_in_one`` letters
    is never held: its repeats come from a grouped count, its audit from a stream of one byte a row, and its turns
    from a second stream over the rows; they come in pieces, and the counts stand in the first.
    """
    clean = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        *[F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name) for name in ("role", "text")],
    ).withColumn("code", row_code())
    schema = T.StructType([
        T.StructField("conv_id", T.LongType()), T.StructField("piece", T.LongType()), T.StructField("whole", T.BooleanType()),
        *[T.StructField(n, T.LongType()) for n in COUNTS], T.StructField("audit", T.StringType()),
        T.StructField("turns", T.ArrayType(TURN)),
    ])
    arrow = pa.schema([
        ("conv_id", pa.int64()), ("piece", pa.int64()), ("whole", pa.bool_()), *[(n, pa.int64()) for n in COUNTS],
        ("audit", pa.string()), ("turns", ARROW_TURNS),
    ])

    def one(key: int | None, stream: Iterator[dict]) -> dict:
        faults, held, seen, chars = Faults(), [], set(), 0
        for row in stream:
            held.append(row)
            chars += len(row["text"]) + len(row["role"])
            if len(held) > rows_in_one or chars > chars_in_one:
                return {"conv_id": key, "whole": False}
            same = (row["role"], row["text"])
            row["code"] = faults.add(row, same in seen)
            seen.add(same)
        report = faults.report()
        return {"conv_id": key, "piece": 0, "whole": True, **report, "turns": list(edited(report["audit"], iter(held)))}

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches((one(key, stream) for key, stream in conversations_of(batches)), arrow, 50)

    first = write_shared(together(clean, ["turn", "role", "text"]).mapInArrow(short, schema), "repaired")
    long_ids = first.where("not whole").select("conv_id")
    if long_ids.isEmpty():
        return first
    return first.where("whole").unionByName(long_repair(null_safe_join(clean, long_ids, ["conv_id"]), schema, arrow))


def long_repair(rows: DataFrame, schema: T.StructType, arrow: pa.Schema, turns_a_piece: int = 5000) -> DataFrame:
    """``repair`` for conversations that are too long to hold: streams only, each row's code before its text."""
    placed = dense_key(rows, ["conv_id", "turn", "role", "text"], "place", "long-conversations")
    same = ["conv_id", "role", "print"]
    prints = placed.withColumn("print", F.sha2("text", 256))
    earliest = prints.groupBy(*same).agg(F.min("place").alias("earliest"), F.count(F.lit(1)).alias("copies"))
    marked = null_safe_join(prints, earliest.where("copies > 1").drop("copies"), same, "left")
    marked = write_shared(
        marked.select("conv_id", "place", "turn", "role", "text", "code", (F.col("place") > F.coalesce("earliest", "place")).alias("repeat")),
        "long-marked",
    )

    def audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def report(key: int | None, stream: Iterator[dict]) -> dict:
            faults = Faults()
            for row in stream:
                faults.add(row, row["repeat"])
            return {"conv_id": key, "piece": 0, "whole": False, **faults.report()}

        return in_batches((report(key, stream) for key, stream in conversations_of(batches)), arrow, 1)

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[dict]:
            for key, stream in conversations_of(batches):
                audit, held, piece = next(stream)["audit"], [], 1
                for turn in edited(audit, stream):
                    held.append(turn)
                    if len(held) == turns_a_piece:
                        yield {"conv_id": key, "piece": piece, "whole": False, "turns": held}
                        held, piece = [], piece + 1
                yield {"conv_id": key, "piece": piece, "whole": False, "turns": held}

        return in_batches(pieces(), arrow, 1)

    bare = marked.select("conv_id", "place", "turn", "code", "repeat")
    reports = write_shared(together(bare, ["place"]).mapInArrow(audits, schema), "long-audits")
    ahead = reports.select("conv_id", F.lit(0).cast("bigint").alias("place"), "audit")
    both = marked.select("conv_id", "place", "role", "text", "code").unionByName(ahead, allowMissingColumns=True)
    return reports.unionByName(together(both, ["place"]).mapInArrow(turns, schema))


# --- the registered query: damaged conversations, repaired, as digests -----------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, cut, repeated or reroled by a hash of their place; null is a space."""
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), spaced("role").alias("role"),
        spaced("text").alias("text"), (F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20).alias("_fault"),
    ).where("_fault <> 0")
    fault = F.col("_fault")
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


DIGEST_SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), *[T.StructField(n, T.LongType()) for n in COUNTS],
    T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
])


def digest_of(key: int | None, pieces: Iterator[dict]) -> dict:
    """One row per conversation: the counts of its first piece and the digest of all its turns."""
    first = next(pieces)
    digest, between = Digest(), ""
    for piece in chain([first], pieces):
        for turn in piece["turns"] or []:
            digest.add(f"{between}{turn['role']}:{turn['text']}")
            between = "\n"
    return {"conv_id": key, **{n: first[n] for n in COUNTS}, "audit": first["audit"], "repaired_sha256": digest.hex()}


def repair_report(conversations: DataFrame, **limits: int) -> DataFrame:
    """One row per conversation id of the table, with the faults and the repair of its damaged rows."""
    found = fold_pieces(repair(damaged(conversations), **limits), "whole", ["piece"], digest_of, DIGEST_SCHEMA)
    ids = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    nothing = {**dict.fromkeys(COUNTS, 0), "audit": "", "repaired_sha256": Digest().hex()}
    return null_safe_join(ids, found, ["conv_id"], "left").fillna(nothing)
