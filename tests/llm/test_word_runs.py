"""Periodic runs against a search over all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

from payerscope.llm.queries import QUERIES
from payerscope.llm.word_runs import periodic_runs, run_report, runs_of_texts


def all_runs(words: list) -> list[tuple[int, int, int]]:
    n, found = len(words), []
    for period in range(1, n // 4 + 1):
        at = 0
        while at + period < n:
            stop = at
            while stop + period < n and words[stop] == words[stop + period]:
                stop += 1
            start, end = at, stop + period
            if end - start >= max(6, 4 * period) and not any(
                all(words[i] == words[i + d] for i in range(start, end - d)) for d in range(1, period)
            ):
                found.append((start, end - start, period))
            at = max(stop, at + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def reports(doc_id: int | None, text: str | None) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = all_runs(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    dropped = {i for s, l, p in runs for i in range(s + p, s + l)}
    lines = "".join(f"{s},{l},{p}\n" for s, l, p in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    power = 1000 * best[1] // best[2] if runs else None
    return doc_id, len(runs), *best, power, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def planted(seed: int) -> list[bytes]:
    pick = random.Random(seed)
    n, letters = pick.randint(0, 400), pick.choice([1, 2, 3, 5, 50])
    words = [pick.randrange(letters) for _ in range(n)]
    for _ in range(pick.randint(0, 4) if n > 4 else 0):
        period, at = pick.randint(1, max(1, n // 4)), pick.randrange(n)
        for i in range(at + period, min(n, at + pick.randint(1, 6 * period))):
            words[i] = words[i - period]
    return [b"%d" % w for w in words]


def test_equal_to_search_over_all_periods_on_random_words():
    texts = [planted(seed) for seed in range(300)]
    assert sum(map(len, runs_of_texts(texts))) > 300
    assert runs_of_texts(texts) == [all_runs(words) for words in texts]


def test_periodic_words_of_every_period():
    pick = random.Random(5)
    for period in [*range(1, 40), 63, 64, 65, 127, 128, 129]:
        root = [b"%d" % pick.randrange(10**6) for _ in range(period)]
        for length in (4 * period - 1, 4 * period, 5 * period + period // 2):
            words = [b"left", *(root * 6)[:length], b"right"]
            assert runs_of_texts([words]) == [[(1, length, period)] if length >= max(6, 4 * period) else []]


def test_runs_of_runs():
    """A square of a highly periodic stretch: short periods inside a long one, and words of the Fibonacci kind."""
    inner = [b"a"] * 40 + [b"b"] + [b"a", b"c"] * 12
    fib = [b"x"]
    nxt = [b"x", b"y"]
    while len(nxt) < 600:
        fib, nxt = nxt, nxt + fib
    for words in (inner * 5, nxt, [b"a"] * 500, [b"a", b"a", b"b"] * 100):
        assert runs_of_texts([words]) == [all_runs(words)]


def test_query_equals_brute_force_on_whole_table(spark, sf_dir, tables):
    rows = QUERIES["op13_periodic_runs"](spark, sf_dir).select(*COLUMNS).collect()
    expected = [reports(r.doc_id, r.text) for r in tables("documents").collect()]
    assert sorted(map(tuple, rows)) == sorted(expected)
    assert sum(r.n_runs for r in rows) > 10


def test_odd_rows(spark, odd, nothing):
    rows = [tuple(r) for r in run_report(odd).select(*COLUMNS).collect()]
    expected = [reports(r.doc_id, r.text) for r in odd.where("doc_id is null or doc_id <> 5").collect()]
    long = (5, 1, 0, 9000, 1, 9000000, hashlib.sha256(b"0,9000,1\n").hexdigest(), hashlib.sha256(b"word").hexdigest())
    key = lambda row: [str(v) for v in row]
    assert sorted(rows, key=key) == sorted([*expected, long], key=key)
    assert run_report(nothing).count() == 0
    assert periodic_runs(odd.where("doc_id = 5")).first().collapsed == "word"
