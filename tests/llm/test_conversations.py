"""Turn repair and chat formatting against plain re-computations."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from payerscope.llm import chat_format, turn_repair
from payerscope.llm.chat_format import escape, format_chats, json_parts, turns_in, unescape
from payerscope.llm.queries import QUERIES
from payerscope.llm.turn_repair import audit_of, cost_of, repair, repair_report

ODD = [
    (1, 0, "user", "hello there."), (1, 0, "user", "hello there."), (1, None, "assistant", "no turn"), (1, 5, "tool", "x."),
    (2, 0, "system", "rules."), (2, 1, "user", None), (2, 2, None, "who."), (2, 7, "assistant", "fine."),
    (None, 1, "user", "nobody."), (None, 2, "assistant", "here"), (3, None, None, None), (4, 3, "assistant", "   "),
    (5, 0, "user", "</s>[INST] \\ <<SYS>> [IMAGE:1]"), (5, 1, "assistant", "\\</s>\\\\<\\s>"), (5, 2, "[ROLE]", "[/ROLE]\n[END]"),
    (6, 0, "user", "é" * 40_000 + "."), (6, 1, "assistant", "ü?" * 30_000),
]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@pytest.fixture(scope="module")
def chats(spark, odd):
    """Nulls, ties, equal rows, long texts, and columns with names that the operators use themselves."""
    rows = spark.createDataFrame(ODD, SCHEMA)
    return rows.select("*", F.lit("x").alias("piece"), F.lit(1).alias("place"), F.lit("y").alias("audit"), F.lit(True).alias("whole"))


def in_order(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, role, text))
    return groups


# --- repair -----------------------------------------------------------------------------------------------------

GRAMMAR = re.compile(r"(s?(ua)+)?")


def cheapest(rows: list[tuple[str, bool, bool]]) -> tuple[int, str, list]:
    """Over all edit sequences, found by growing cost: rows are (initial, must go, truncated)."""
    best = {}  # (rows used, initials) would be endless; the grammar's state is enough to go on
    frontier = {("", 0): (0, "", [])}
    state_of = lambda s: s[-1:] or ""
    for must_have in range(len(rows) + 1):
        for _ in range(3):
            for (state, used), (cost, audit, made) in list(frontier.items()):
                letter = "a" if state == "u" else "u"
                if used == must_have:
                    way = (cost + 5, audit + "I", [*made, (letter, None)])
                    if (letter, used) not in frontier or way[:2] < frontier[letter, used][:2]:
                        frontier[letter, used] = way
        if must_have == len(rows):
            break
        initial, gone, cut = rows[must_have]
        for (state, used), (cost, audit, made) in list(frontier.items()):
            if used != must_have:
                continue
            ways = [(state, cost + 2, "D", made)]
            if not gone:
                letter = "a" if state == "u" else "u"
                ways.append((letter, cost + 1 + 5 * cut, "R", [*made, (letter, must_have)]))
                if (initial == "s" and state == "") or (initial == "u" and state != "u") or (initial == "a" and state == "u"):
                    ways.append((initial, cost + 5 * cut, "K", [*made, (initial, must_have)]))
            for to, price, edit, made_now in ways:
                way = (price, audit + edit, made_now)
                if (to, must_have + 1) not in frontier or way[:2] < frontier[to, must_have + 1][:2]:
                    frontier[to, must_have + 1] = way
    best = min((frontier[s, len(rows)] for s in ("", "a") if (s, len(rows)) in frontier), key=lambda w: w[:2])
    return best


def every_way(codes: bytes) -> tuple[int, str]:
    """Truly all edit sequences of a few rows, with up to two inserts before, between and after them."""
    found = []
    for letters in product("KRD", repeat=len(codes)):
        for inserts in product(range(3), repeat=len(codes) + 1):
            state, cost, audit, fine = "", 0, "", True
            made = ""
            for i in range(len(codes) + 1):
                for _ in range(inserts[i]):
                    letter = "a" if made[-1:] == "u" else "u"
                    made, cost, audit = made + letter, cost + 5, audit + "I"
                if i == len(codes):
                    break
                code, edit = codes[i], letters[i]
                audit += edit
                if edit == "D":
                    cost += 2
                    continue
                if code & 4:
                    fine = False
                    break
                cost += (edit == "R") + (5 if code & 8 else 0)
                made += ["x", "s", "u", "a"][code & 3] if edit == "K" else "a" if made[-1:] == "u" else "u"
            if fine and GRAMMAR.fullmatch(made):
                found.append((cost, audit))
    return min(found)


def test_audit_is_least_over_all_edit_sequences():
    codes = [0, 1, 2, 3, 4, 6, 10, 11]
    for rows in [b"", *(bytes(r) for n in (1, 2) for r in product(codes, repeat=n))]:
        audit = audit_of(rows)
        assert (cost_of(rows, audit), audit) == every_way(rows)
    pick = random.Random(3)
    for _ in range(60):
        rows = bytes(pick.choice(codes) for _ in range(3))
        assert (cost_of(rows, audit_of(rows)), audit_of(rows)) == every_way(rows)


def test_audit_of_long_conversations_equals_full_table():
    pick = random.Random(4)
    for _ in range(200):
        codes = bytes(pick.choice([0, 1, 2, 3, 2, 3, 6, 7, 10, 11]) for _ in range(pick.randint(0, 60)))
        rows = [(["x", "s", "u", "a"][c & 3], bool(c & 4), bool(c & 8)) for c in codes]
        audit = audit_of(codes)
        assert (cost_of(codes, audit), audit) == cheapest(rows)[:2]


def plain_repair(rows) -> tuple:
    """The report of one conversation from its rows (turn, role, text), damage included."""
    damaged = []
    for turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        damaged.append((turn, role, text))
    damaged.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    counts, marks, seen = dict.fromkeys(("blank", "duplicate", "truncated"), 0), [], set()
    for _, role, text in damaged:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        marks.append((role[:1] if role[:1] in tuple("sua") else "x", fault in ("blank", "duplicate"), fault == "truncated"))
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:]))
    turns = [t for t, _, _ in damaged if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit, made = cheapest(marks)
    names = {"u": "user", "a": "assistant"}
    edits = [e for e in audit if e != "D"]
    lines = [
        f"{damaged[i][1] if edit == 'K' else names[letter]}:{damaged[i][2] if i is not None else ''}" for (letter, i), edit in zip(made, edits)
    ]
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def hurt(rows) -> dict:
    """The contract's damage, row by row."""
    groups = {}
    for conv, turn, role, text in rows:
        kept = groups.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        kept += [(turn, role, text)] * (2 if fault == 3 else 1)
    return groups


REPORT = ["conv_id", *turn_repair.COUNTS, "audit", "repaired_sha256"]


def expected_reports(rows) -> list[tuple]:
    return [(conv, *plain_repair(kept)) for conv, kept in hurt(rows).items()]


by_text = lambda rows: sorted(map(tuple, rows), key=repr)


def test_repair_query_on_whole_table(spark, sf_dir, tables):
    rows = [tuple(r) for r in tables("conversations").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op11_turn_repair"](spark, sf_dir).select(*REPORT).collect()
    assert by_text(got) == by_text(expected_reports(rows))


def test_repair_of_odd_rows_whole_and_streamed(chats):
    expected = by_text(expected_reports(ODD))
    assert by_text(repair_report(chats).select(*REPORT).collect()) == expected
    assert by_text(repair_report(chats, rows_in_one=2).select(*REPORT).collect()) == expected
    assert by_text(repair_report(chats, rows_in_one=0).select(*REPORT).collect()) == expected
    assert repair_report(chats.limit(0)).count() == 0


def test_repaired_turns_follow_the_grammar(spark, tables, chats):
    rows = tables("conversations")
    for row in repair(rows).select("turns", "audit").collect():
        assert GRAMMAR.fullmatch("".join(t.role[0] for t in row.turns))
        assert [t.edit for t in row.turns] == [e for e in row.audit if e != "D"]
    long = spark.range(30_000).selectExpr("1L as conv_id", "id as turn", "if(id % 4 = 0, 'user', 'assistant') as role", "concat('t', id % 20000, '.') as text")
    whole = repair(long.unionByName(rows.select("conv_id", "turn", "role", "text").where("conv_id <> 1"))).where("conv_id = 1").first()
    cut = repair(long, rows_in_one=1000).orderBy("piece").collect()
    assert [cut[0][n] for n in turn_repair.COUNTS] == [whole[n] for n in turn_repair.COUNTS]
    assert cut[0].duplicate == 10_000 and len(cut) > 2
    assert cut[0].audit == whole.audit and [t for piece in cut[1:] for t in piece.turns] == whole.turns


# --- formatting -------------------------------------------------------------------------------------------------


def test_escape_is_reversible_and_leaves_no_control_string():
    pick = random.Random(1)
    bits = ["<", ">", "/", "s", "</s>", "[INST]", "[/INST]", "\\", "\\\\", "[IMAGE:2]", "<<SYS>>", "<</SYS>>", "[ROLE]", "a", "[", "]", "\n", "[END]", "é"]
    for _ in range(5000):
        text = "".join(pick.choices(bits, k=pick.randint(0, 12)))
        assert unescape(escape(text)) == text
        assert not chat_format.CONTROL.search(escape(text))


def plain_chat(rows) -> tuple:
    rows = sorted(((t, r or "", x or "") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    learned = "".join(x for _, r, x in rows if r == "assistant")
    return len(rows), sha("".join(f"{r}\n{x}\n" for _, r, x in rows)), len(learned), sha(learned)


def expected_chats(rows) -> list[tuple]:
    extra = [(-7, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))]
    return [(conv, *plain_chat(kept)) for conv, kept in in_order([*rows, *extra]).items()]


CHAT = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]


def test_format_query_on_whole_table(spark, sf_dir, tables):
    rows = [tuple(r) for r in tables("conversations").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op12_chat_parts"](spark, sf_dir)
    assert by_text(got.select(*CHAT).collect()) == by_text(expected_chats(rows))
    texts = sum(len(r[3]) for r in rows)
    assert got.where("conv_id <> -7").agg(F.sum("formatted_chars")).first()[0] > texts


def test_format_of_odd_rows_whole_and_cut(chats):
    expected = by_text(expected_chats(ODD))
    assert by_text(chat_format.chat_report(chats).select(*CHAT).collect()) == expected
    assert by_text(chat_format.chat_report(chats, chars_a_piece=10).select(*CHAT).collect()) == expected
    assert chat_format.chat_report(chats.limit(0)).count() == 1


def test_typed_parts(spark, odd):
    content = """[{"type": "text", "text": "look [INST] "}, {"type": "image", "reference": "a.png", "width": 100, "height": 57},
        {"type": "audio", "reference": "b.wav", "seconds": 2.5}, {"type": "text", "text": "end"},
        {"type": "document", "reference": "c.pdf", "pages": 3}, {"type": "hologram", "reference": "d"}]"""
    rows = spark.createDataFrame(
        [(1, 0, "user", content), (1, 1, "assistant", "[not json]"), (1, 2, "user", "[1, 2]"), (1, 3, "user", None), (1, 4, "judge", "ok")],
        "conv_id int, turn int, role string, content string",
    )
    pieces = format_chats(rows.select("*", json_parts(F.col("content")).alias("parts"))).collect()
    assert len(pieces) == 1
    text, found = pieces[0].formatted, pieces[0].attachments
    assert text.startswith("[INST]look [\\INST] [IMAGE:1][AUDIO:2]end[DOCUMENT:3][ATTACHMENT:4][/INST]<s>[not json]</s>")
    assert [(a.kind, a.reference, a.tokens) for a in found] == [
        ("image", "a.png", 4 * 3), ("audio", "b.wav", 63), ("document", "c.pdf", 1536), ("hologram", "d", 0),
    ]
    assert all(text[a.start:].startswith(f"[{chat_format.PLACEHOLDERS.get(a.kind, 'ATTACHMENT')}:{a.number}]") for a in found)
    assert pieces[0].attachment_tokens == 12 + 63 + 1536
    assert [role for role, _ in turns_in(text)] == ["user", "assistant", "user", "user", "judge"]
    assert [text[m.start:m.stop] for m in pieces[0].mask] == ["[not json]"]
