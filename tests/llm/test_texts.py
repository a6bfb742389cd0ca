from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from payerscope.llm import common, decontaminate, license_scan, near_text, private_data, repeated_bytes, toxicity

from .conftest import ROWS


def bag(text):
    words = (text or "").lower().split()
    size = min(5, len(words))
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if size else Counter()


def jaccard(a, b):
    both = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - both
    return both / total if total else 1.0


def components(bags):
    parent = list(range(len(bags)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(bags)):
        for j in range(i):
            if jaccard(bags[i], bags[j]) >= 0.8:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(bags))]


def test_near_texts_equal_brute_force(tables):
    docs = sorted(tables("documents").select("doc_id", "text").collect())
    want = components([bag(r["text"]) for r in docs])
    got = {r["doc_id"]: r for r in near_text.near_texts(tables("documents")).collect()}
    first = {i: docs[c]["doc_id"] for i, c in enumerate(want)}
    assert {docs[i]["doc_id"]: first[i] for i in first} == {k: r["component_id"] for k, r in got.items()}
    assert sum(r["kept"] for r in got.values()) == len(set(want))


@pytest.mark.parametrize("block_nodes", [2048, 5])
def test_near_copies_of_one_text_keep_their_links_and_no_others(spark, monkeypatch, block_nodes):
    monkeypatch.setattr(near_text, "BLOCK_NODES", block_nodes)
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(60):
        words = list(base)
        for at in rng.sample(range(150), rng.choice([1, 2, 4, 6, 9])):
            words[at] = f"own{i}x{at}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = components([bag(t) for _, t in rows])
    assert 1 < len(set(want)) < 60
    got = sorted((r["doc_id"], r["component_id"]) for r in near_text.near_texts(docs).collect())
    assert got == list(enumerate(want))


def test_near_texts_join_a_chain_through_one_bucket_member(spark, odd):
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows, words = [], list(base)
    for i in range(12):
        rows.append((i, " ".join(words)))
        words[10 * i % 110] = f"new{i}"
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = components([bag(t) for _, t in rows])
    got = sorted((r["doc_id"], r["component_id"]) for r in near_text.near_texts(docs).collect())
    assert got == list(enumerate(want))


def test_signatures_are_unbiased():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(150):
        items = np.sort(rng.integers(0, 2**62, 200).astype(np.uint64))
        a, b = rng.integers(1, 6, 200), rng.integers(1, 9, 200)
        keep = rng.random(200) < 0.8
        got = (near_text.signatures([(items, a)]) == near_text.signatures([(items[keep], b[keep])])).mean()
        errors.append(got - near_text.overlap((items, a), (items[keep], b[keep])))
    assert abs(np.mean(errors)) < 0.012


def test_near_texts_of_odd_rows(odd, nothing):
    got = near_text.near_texts(odd).collect()
    assert len(got) == len(ROWS)
    by_id = defaultdict(set)
    for r in got:
        by_id[r["doc_id"]].add(r["component_id"])
    assert by_id[0] == by_id[1] == {0} and by_id[2] == by_id[3] == by_id[7] == {2}
    kept = near_text.without_near_copies(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r["kept"] for r in got)
    assert near_text.near_texts(nothing).count() == 0


def test_columns_named_like_helpers_survive_near_dedup(odd):
    docs = odd.withColumnsRenamed({"row": "_row", "lang": "_word", "source": "met"})
    kept = near_text.without_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, near_text.without_near_copies(odd).withColumnsRenamed({"row": "_row", "lang": "_word", "source": "met"}).collect()))


@pytest.mark.parametrize("words", [1, 1 << 20])
def test_bit_map_only_saves_work(spark, odd, monkeypatch, words):
    monkeypatch.setattr(common, "MAP_WORDS", words)
    table = spark.createDataFrame([(i, i % 7 if i % 5 else None) for i in range(300)], "row bigint, k bigint")
    keys = spark.createDataFrame([(k, f"g{k}") for k in (1, 4, 900)] + [(None, "none")], "k bigint, name string")
    want = sorted((i, i % 7) for i in range(300) if i % 5 and i % 7 in (1, 4))
    assert sorted(tuple(r) for r in common.only_met(table, keys, "k").collect()) == want
    named = {r["row"]: r["name"] for r in common.with_groups(table, keys, "k").collect()}
    assert len(named) == 300 and {i: n for i, n in named.items() if n} == {i: f"g{k}" for i, k in want}
    assert common.only_met(table, keys.limit(0), "k").count() == 0


def cut_by_hand(texts):
    seen = Counter(t[i : i + 400] for t in texts for i in range(len(t) - 399))
    for text in texts:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - 399):
            if seen[text[i : i + 400]] > 1:
                gone[i : i + 400] = True
        kept = bytes(b for b, g in zip(text, gone) if not g)
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        yield len(text), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("shared_by", [4000, 2])
def test_repeats_equal_brute_force(spark, odd, shared_by, monkeypatch):
    monkeypatch.setattr(repeated_bytes, "SHARED_BY", shared_by)
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randint(2, 9)))
    passage = " ".join(word() for _ in range(110))
    near = " ".join(word() for _ in range(200))
    texts = [" ".join(word() for _ in range(rng.randint(0, 150))) + passage[rng.randint(0, 9) :] + " ".join(word() for _ in range(60)) for _ in range(9)]
    texts += [near[:i] + "#" + near[i:] for i in range(50, 1000, 90)]
    texts += ["ab" * 500, "ab" * 500, "z" * 401, "z" * 399, "", passage, passage[:420], near[300:720] + near[:450]]
    docs = spark.createDataFrame([*((i, t) for i, t in enumerate(texts)), (99, None)], "doc_id bigint, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in repeated_bytes.remove_repeats(docs).collect()}
    want = dict(enumerate(cut_by_hand([t.encode() for t in texts])))
    assert got.pop(99) == (0, 0, 0, hashlib.sha256().hexdigest())
    assert got == want


def test_repeats_on_tables(tables, odd, nothing):
    docs = tables("documents").select("doc_id", "text").where("length(text) < 9000")
    rows = docs.collect()
    want = dict(zip([r["doc_id"] for r in rows], cut_by_hand([r["text"].encode() for r in rows])))
    assert {r["doc_id"]: tuple(r)[1:] for r in repeated_bytes.remove_repeats(docs).collect()} == want
    assert repeated_bytes.remove_repeats(odd).count() == len(ROWS)
    assert repeated_bytes.remove_repeats(nothing).count() == 0


def edit_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (p != t))
    return min(row)


def test_edit_search_equals_the_table():
    rng = random.Random(1)
    for _ in range(60):
        pattern = "".join(rng.choice("abc") for _ in range(rng.randint(1, 80)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 120)))
        assert decontaminate.EditPattern(pattern).search(text)[0] == edit_distance(pattern, text)


def test_leaks_equal_brute_force(spark, tables, odd, nothing):
    items = [(r["item_id"], decontaminate.plain(r["text"])) for r in tables("benchmark").collect()][:6]
    rng = random.Random(3)
    rows, want = [], set()
    for n in range(36):
        item, text = rng.choice(items)
        letters = list(text)
        for _ in range(rng.randint(0, int(0.16 * len(text)))):
            at = rng.randrange(len(letters))
            letters[at : at + rng.randint(0, 1)] = rng.choice(["", "q", "zz"])
        doc = "before it " + "".join(letters) + " and after"
        rows.append((n, doc))
        for i, t in items:
            if edit_distance(t, decontaminate.plain(doc)) <= int(0.1 * len(t)):
                want.add((n, i))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame([*items, (None, None), (77, ""), (78, "ab")], "item_id bigint, text string")
    for block in (20_000, 2):
        assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench, per_block=block).collect()} == want
    assert {r["doc_id"] for r in decontaminate.without_leaks(docs, bench).collect()} == {n for n, _ in rows} - {n for n, _ in want}
    assert decontaminate.leaks(odd, bench).count() == 0
    assert decontaminate.without_leaks(odd, bench).count() == len(ROWS)
    assert decontaminate.leaks(nothing, bench).count() == 0 and decontaminate.leaks(docs, bench.limit(0)).count() == 0


def test_short_items_are_found_between_words(spark):
    rows = ["see short item 12345 here", "Short  ITEM 12345", "short item 123456", "ashort item 12345", "(short item 12345)", "x c++ y", "xc++", "c+ +", None, ""]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "short item 12345"), (2, "short item 12345"), (3, "C++"), (4, " "), (5, None)], "item_id bigint, text string")
    want = {(d, i, 0) for d in (0, 1, 4) for i in (1, 2)} | {(5, 3, 0)}
    for block in (20_000, 1):
        got = decontaminate.leaks(docs, bench, per_block=block).collect()
        assert {(r["doc_id"], r["item_id"], r["distance"]) for r in got} == want and len(got) == len(want)
        assert {r["doc_id"] for r in decontaminate.without_leaks(docs, bench, per_block=block).collect()} == {2, 3, 6, 7, 8, 9}


def test_blocks_are_bounded_in_characters(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "CHARS_PER_BLOCK", 100)
    bench = spark.createDataFrame([(n, f"{n} " + "x" * (30 if n else 400)) for n in range(10)], "item_id bigint, text string")
    blocks = list(decontaminate.item_blocks(bench, 0.1, 1000))
    assert sum(map(len, blocks)) == 10 and all(len(b) == 1 or sum(len(t) for _, t in b) <= 100 for b in blocks)


RULES = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub(r"\D", "", m)) <= 19 and private_data.luhn(re.sub(r"\D", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub(r"\D", "", m)) <= 15),
]


def spans_by_rule(text):
    return [(k, m.start(), m.end()) for k, (_, rule, good) in enumerate(RULES, 1) for m in re.finditer(rule, text) if good(m[0])]


def test_base_spans_equal_the_rules(tables):
    rng = random.Random(5)
    pieces = ["a@b.c", "@", "1", ".", "255.1.2.3", "4929 3813 3266 4295", "-", " ", "+1", "(386) 555-3733", "x", "é", "٣", "4929381332664295", "..", "a@b", "+"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    texts += [r["text"] for r in tables("documents").select("text").collect()]
    for text in texts:
        assert private_data.base_spans(text) == spans_by_rule(text), text


def test_private_data_rows(spark, tables, odd, nothing):
    rows = private_data.private_data(odd).collect()
    assert len(rows) == len(ROWS) and sum(r["n_email"] for r in rows) == 1 and sum(r["n_phone"] for r in rows) == 1
    empty = hashlib.sha256().hexdigest()
    assert sum(r["base_sha256"] != empty for r in rows) == 1
    clean = private_data.without_private_data(odd)
    assert clean.columns == odd.columns
    text = [r["text"] for r in clean.collect() if r["doc_id"] is None][0]
    assert text == "mail [EMAIL] or [PHONE] now"
    assert private_data.private_data(nothing).count() == 0 and private_data.without_private_data(nothing).count() == 0


def test_the_field_carries_a_label_to_a_distant_mention():
    nodes = {private_data.shape("555-3733"): np.array([3.0, 0, 0, 0, 3.0])}
    field = private_data.Field(nodes, np.zeros((5, 5)), np.zeros((5, 5)))
    text = "+1 (386) 555-3733 " + "word " * 200 + "call 555-3733"
    assert field.added(text, private_data.base_spans(text)) == [(4, len(text) - 8, len(text))]
    assert field.added("call 555-3733", []) == []


def test_licenses(spark, tables, odd, nothing):
    lines = ["Licensed under CC BY-NC 4.0.", "Released under the MIT License.", "no word of it", "All licenses of the drivers were checked",
             "This work is licensed under the GNU General Public License, version 2."]
    docs = tables("documents").select("doc_id", "text").unionByName(spark.createDataFrame([(10**6, "\n".join(lines))], "doc_id bigint, text string"))
    rows = license_scan.license_notices(docs).collect()
    own = sorted((r["start"], r["family"]) for r in rows if r["doc_id"] == 10**6)
    assert [f for _, f in own] == ["CC-BY-NC", "MIT", "unknown", "GPL"]
    named = {r["doc_id"] for r in rows if r["family"] != "unknown"}
    assert named == {r["doc_id"] for r in docs.where("text RLIKE '(?i)licensed under|released under the mit'").collect()}
    assert license_scan.license_notices(odd).count() == 0 and license_scan.license_notices(nothing).count() == 0


def test_string_kernel_equals_its_definition():
    def by_hand(a, b):
        def weights(word):
            out = Counter()
            for i in range(len(word)):
                for j in range(i + 1, len(word)):
                    for k in range(j + 1, len(word)):
                        out[word[i] + word[j] + word[k]] += toxicity.DECAY ** (k - i + 1)
            return out
        x, y = weights(a), weights(b)
        dot = lambda p, q: sum(p[s] * q[s] for s in p)
        return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5

    words, marks = ["idiot", "idixot", "aaaa", "banana"], ["idiot", "banana", "aaab"]
    assert np.allclose(toxicity.kernel(words, marks), [[by_hand(w, m) for m in marks] for w in words])


def test_toxicity_on_held_out_rows(spark, odd, nothing):
    rng = random.Random(6)
    plain = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(3, 9))) for _ in range(400)]
    rows, labels = [], []
    for n in range(1500):
        words = [rng.choice(plain) for _ in range(40)]
        toxic = int(n % 6 == 0)
        if toxic:
            words[rng.randrange(40)] = rng.choice(["idiotx", "wrkkd", "Scumbag!", "h0pelezz"])
        rows.append((n, " ".join(words)))
        labels.append((n, 1, toxic))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame([*labels, (None, 1, 1), (9999, None, None)], "doc_id bigint, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, marks).collect()}
    held = [(got[n]["predicted"], t) for n, _, t in labels if got[n]["held_out"]]
    assert 200 < len(held) < 400 and sum(p == t for p, t in held) >= 0.97 * len(held)
    kept = toxicity.without_toxic(docs, marks)
    assert {r["doc_id"] for r in kept.collect()} == {n for n, r in got.items() if r["predicted"] == 0}
    assert toxicity.toxicity(odd, marks).count() == len(ROWS)
    assert toxicity.toxicity(nothing, marks).count() == 0 and toxicity.toxicity(docs, marks.limit(0)).where("predicted = 1").count() == 0


WRAPPED = [
    ("GPL", "# This program is free software: you can redistribute it and/or\n# modify it under the terms of the GNU General Public\n# License as published by the Free Software Foundation, either\n# version 3 of the License, or (at your option) any later version."),
    ("LGPL", " * This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n * License as published by the Free Software Foundation; either"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining\na copy of this software and associated documentation files"),
    ("AGPL", "it under the terms of the GNU Affero\nGeneral Public License as published\nby the Free Software Foundation"),
    ("GPL", "Released under GPLv3."), ("LGPL", "Distributed under LGPL-2.1-or-later"), ("AGPL", "AGPLv3"), ("BSD", "Released under the BSD 3-Clause terms."),
    ("Apache-2.0", "Available under Apache-2.0"), ("MIT", "This file is under the MIT terms."), ("GPL", "SPDX-License-Identifier: GPL-2.0-only"),
    ("MIT", "SPDX-License-Identifier: MIT"), ("MPL-2.0", "MPL-2.0"), ("CC-BY-NC", "Text: CC-BY-NC-4.0"),
]


def test_wrapped_notices_and_short_names(spark, tables):
    rows = [(10**6 + i, f"A first line\n\n{notice}\n\nand the rest of it") for i, (_, notice) in enumerate(WRAPPED)]
    prose = "Er kam mit den anderen und ging unter die Leute\nthe terms of the house and a copy of this\nuse in the public square"
    docs = tables("documents").select("doc_id", "text").unionByName(spark.createDataFrame([*rows, (2 * 10**6, prose)], "doc_id bigint, text string"))
    got = defaultdict(list)
    for r in license_scan.license_notices(docs).where("doc_id >= 1000000").collect():
        got[r["doc_id"]].append(r)
    assert [[r["family"] for r in got[i] if r["family"] != "unknown"] for i, _ in rows] == [[family] for family, _ in WRAPPED]
    assert all(min(r["start"] for r in got[i]) == len("A first line\n\n") for i, _ in rows) and not got[2 * 10**6]


def test_insults_with_clean_uses_are_learned(spark, odd):
    rng = random.Random(8)
    plain = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(3, 9))) for _ in range(400)]
    insults = ["idiotx", "wrkkd", "scumbag", "hopelezz"]
    rows, labels = [], []
    for n in range(3000):
        words = [rng.choice(plain) for _ in range(30)]
        toxic = int(n % 8 == 0)
        if toxic or rng.random() < 0.03:  # about a fifth of the texts that hold an insult are clean
            words[rng.randrange(30)] = rng.choice(insults)
        rows.append((n, " ".join(words)))
        labels.append((n, toxic))
    docs, marks = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    share = {w: np.mean([t for (_, text), (_, t) in zip(rows, labels) if w in text.split()]) for w in insults}
    assert all(0.7 < s < 0.9 for s in share.values())
    got = [r for r in toxicity.toxicity(docs, marks).collect() if r["held_out"]]
    holds = {n for n, text in rows if set(insults) & set(text.split())}
    assert len(got) > 400 and np.mean([r["predicted"] == (r["doc_id"] in holds) for r in got]) >= 0.97


def test_rows_are_decontaminated_by_their_own_text(spark, odd):
    item = "the quick brown fox jumps over the lazy dog and runs away"
    rows = [(None, f"before {item} after", 1), (None, "a clean text", 2), (7, f"x {item}", 3), (7, "a clean text with the id of another", 4), (8, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n int")
    bench = spark.createDataFrame([(1, item), (2, "another passage that nothing here holds at all")], "item_id bigint, text string")
    for block in (20_000, 1):
        kept = decontaminate.without_leaks(docs, bench, per_block=block)
        assert kept.columns == docs.columns and sorted(r["n"] for r in kept.collect()) == [2, 4, 5]
