from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from payerscope.llm import packing, token_count, token_files, vector_graph, vocab
from payerscope.llm.common import connected_components

from .conftest import ROWS


def mixed_texts():
    rng = random.Random(1)
    letters = "ab .,'\n\t1é<|ß–  "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    return texts + ["", " ", "a\n\nb  c \n d\t e", "it's <|endoftext|> x", "İstanbul ΣΑΣ ²³ ½ª", "日本 語 🤗 é ́x", "<|startoftext|>a", "=" * 70, " " * 40]


@pytest.mark.parametrize("name, make", [("byte_bpe_50k.json", vocab.byte_bpe), ("word_bpe_49k.json", vocab.word_bpe)])
def test_chunked_ids_equal_the_library(name, make, tables):
    path = vocab.path_of(name)
    texts = mixed_texts() + [r["text"] for r in tables("documents").select("text").limit(60).collect()]
    for text, raw in zip(texts, make(path).encode(texts)):
        assert np.frombuffer(raw, vocab.ID_TYPE).tolist() == vocab.library(path).encode(text, add_special_tokens=False).ids, text


def test_word_vocabulary_merges_to_itself():
    model = vocab.library(vocab.path_of("word_bpe_49k.json"))
    wrong = [t for t, i in model.get_vocab().items() if t.endswith("</w>") and t != "</w>" and [x.id for x in model.model.tokenize(t[:-4])] != [i]]
    assert wrong == []


def test_transducer_counts_equal_the_library(tables):
    import sentencepiece

    path = vocab.path_of("piece_bpe_32k.model")
    model, machine = sentencepiece.SentencePieceProcessor(model_file=path), token_count.transducer(path)
    rng = random.Random(2)
    known = sorted(machine.score)
    texts = mixed_texts() + ["".join(rng.choice(known) for _ in range(8)).replace("▁", " ") for _ in range(1500)]
    assert [machine.count(t) for t in texts] == [len(ids) for ids in model.encode(texts)]


def test_token_counts_of_long_texts(spark, odd, nothing):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocab.path_of("piece_bpe_32k.model"))
    long = ["=" * 90_001, " " * 70_000, "a b" * 30_000, "é🤗x" * 25_000, "lorem ipsum dolor " * 9000]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(long)], "doc_id bigint, text string"))
    got = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in token_count.count_tokens(docs).collect())
    want = sorted((-1 if d is None else d, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for d, t in [*((r[0], r[1]) for r in ROWS), *((100 + i, t) for i, t in enumerate(long))])
    assert got == want
    assert token_count.count_tokens(nothing).count() == 0


def test_seams_that_do_not_match_are_composed(spark, monkeypatch):
    import sentencepiece

    path = vocab.path_of("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    monkeypatch.setattr(token_count, "CHUNK", 100)
    texts = ["=" * 1517, " " * 999, "-" * 333 + "=" * 800 + "x " * 200, "lorem ipsum " * 90, "=" * 100, "*" * 101]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = sorted(tuple(r)[:3] for r in token_count.count_tokens(docs).collect())
    assert got == [(i, len(t), len(model.encode(t))) for i, t in enumerate(texts)]


def ids_of(text, name, end):
    return np.array([*vocab.library(vocab.path_of(name)).encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_packing_holds_every_id_once(spark, tables, odd, nothing):
    docs = tables("documents").select("doc_id", "text").limit(80).unionByName(odd.where("doc_id <> 3").selectExpr("doc_id + 1000000 AS doc_id", "text"))
    pieces, places = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs).collect():
        pieces[r["doc_id"]].append(r)
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for row in docs.collect():
        ids, at = ids_of(row["text"], "byte_bpe_50k.json", 0), 0
        for r in sorted(pieces[row["doc_id"]], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024 and end & (end - 1) == 0  # nothing is padded
    assert packing.pack(odd).where("doc_id = 3").count() == 2 and packing.pack(nothing).count() == 0


def test_costs_are_balanced():
    rng = random.Random(7)
    lengths = [min(1023, int(rng.expovariate(1 / 200)) + 1) for _ in range(3000)]
    parts, costs, plain = packing.assign(lengths), defaultdict(float), defaultdict(float)
    for n, own in enumerate(parts):
        assert sum(p[2] for p in own) == lengths[n]
        for sequence, _, length in own:
            costs[sequence] += packing.piece_cost(length)
    free = [1024] * len(costs)
    for n in sorted(lengths, reverse=True):  # the fullest sequence that still has room, whatever its cost
        fits = [i for i, f in enumerate(free) if f >= n]
        if fits:
            best = min(fits, key=free.__getitem__)
            free[best] -= n
            plain[best] += packing.piece_cost(n)
    assert np.std(list(costs.values())[:-10]) < np.std(list(plain.values()))


def test_elias_fano_gives_every_value():
    rng = np.random.default_rng(1)
    for values in ([0], [0, 0, 0], [5], np.cumsum(rng.integers(0, 3, 2000)), np.cumsum(rng.integers(0, 90_000, 3000)), np.repeat([7, 10**6], 700)):
        values = np.array(values)
        coded = token_files.EliasFano.from_bytes(token_files.EliasFano.build(values).to_bytes())
        assert [coded.select(i) for i in range(0, len(values), 7)] == values[::7].tolist()
        for a, n in ((0, len(values)), (len(values) // 2, len(values) // 3), (len(values) - 1, 1)):
            assert coded.block(a, n).tolist() == values[a : a + n].tolist()
    assert len(token_files.EliasFano.build(np.cumsum(rng.integers(0, 1000, 20_000))).to_bytes()) < 20_000 * 12 / 8 + 2000


def test_token_files_round_trip(spark, tables, odd, nothing, tmp_path):
    docs = tables("documents").select("doc_id", "text").limit(70).unionByName(odd.where("doc_id IS NULL OR doc_id <> 3").selectExpr("doc_id + 1000000 AS doc_id", "text"))
    manifest = token_files.write_token_files(docs, str(tmp_path / "out"), bytes_per_shard=6000)
    got = {r["doc_id"]: r for r in token_files.read_token_files(manifest).collect()}
    assert manifest.count() > 2 and not [p for p in (tmp_path / "out").iterdir() if "draft" in p.name]
    start = 0
    for row in sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)):
        ids = ids_of(row["text"], "word_bpe_49k.json", 1)
        r = got[row["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    first = manifest.orderBy("shard").first()
    file = token_files.ShardReader(first["path"])
    assert all(file.start(i) == got[d]["start"] for i, d in enumerate(file.doc_ids(0, file.docs).tolist()) if i >= file.nulls)
    assert token_files.encode_to_files(spark, odd).count() == len(ROWS)
    assert token_files.encode_to_files(spark, nothing).count() == 0


def test_rows_of_one_doc_id_and_long_texts_are_split(spark, odd, tmp_path):
    rows = [(None, f"no id {n % 3} of these rows") for n in range(150)] + [(7, f"one id for text {n}") for n in range(150)]
    rows += [(9, "a text longer than a shard " * 60)] * 2 + [(11, "the last")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    manifest = token_files.write_token_files(docs, str(tmp_path / "out"), bytes_per_shard=1000)
    got = token_files.read_token_files(manifest).collect()
    sizes = [len(ids_of(text, "word_bpe_49k.json", 1)) for _, text in rows]
    assert manifest.agg({"n_ids": "max"}).first()[0] <= 2 * max(sizes) + 300
    assert len({r["shard"] for r in got if r["doc_id"] is None}) > 2 and len({r["shard"] for r in got if r["doc_id"] == 7}) > 2
    want = sorted((d or -1, zlib.crc32(ids_of(text, "word_bpe_49k.json", 1).tobytes())) for d, text in rows)
    assert sorted((r["doc_id"] or -1, r["ids_crc32"]) for r in got) == want
    got.sort(key=lambda r: r["start"])
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist() and sum(sizes) == got[-1]["start"] + got[-1]["n_tokens"]
    assert [r["doc_id"] or -1 for r in got] == sorted(r["doc_id"] or -1 for r in got)


def by_hand(rows):
    """n_links and component of each row by comparing all pairs."""
    unit = {}
    for i, (_, vector, label) in enumerate(rows):
        if label is not None and vector and all(v is not None and np.isfinite(v) for v in vector) and any(vector):
            v = np.array(vector, float) / np.abs(vector).max()
            unit[i] = v / np.linalg.norm(v)
    links = {i: [j for j in unit if j != i and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93] for i in unit}
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j), todo.append(j)
        out.append((rows[i][0], len(links.get(i, [])), min(rows[j][0] for j in seen)))
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [8192, 60, 50, 6])
def test_vectors_equal_brute_force(spark, odd, shard_rows):
    rng = np.random.default_rng(3)
    rows, centres = [], rng.normal(size=(12, 16))
    for n in range(420):
        v = centres[n % 12] + rng.normal(size=16) * (0.12 if n % 3 else 0.9)
        rows.append((n, [float(x) for x in v], n % 12 % 3))
    rows += [(500 + i, rows[5][1], rows[5][2]) for i in range(40)]
    rows += [(600, None, 1), (601, [0.0] * 16, 1), (602, [float("nan")] * 16, 1), (603, [None] * 16, 1), (604, rows[5][1], None), (605, [1e300] * 16, 1), (606, [1e-300] * 16, 1), (607, [], 1)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = sorted(tuple(r)[:3] for r in vector_graph.near_vectors(table, shard_rows=shard_rows).collect())
    assert got == by_hand(rows)
    assert vector_graph.near_vectors(table.limit(0)).count() == 0


def test_graph_search_finds_what_a_full_scan_finds():
    rng = np.random.default_rng(4)
    x = vector_graph.unit(rng.normal(size=(40, 24))[rng.integers(0, 40, 3000)] + 0.35 * rng.normal(size=(3000, 24)))
    graph = vector_graph.SmallWorld(x)
    q, r = graph.near(x[:300], 0.9, audit=False)
    truth = np.count_nonzero(x[:300].astype(np.float32) @ x.T.astype(np.float32) >= 0.9)
    assert len(q) >= 0.95 * truth


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7)]
    got = dict(connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), "test").collect())
    assert {got[i] for i in range(1, 201)} == {0} and {got[1000 + i] for i in range(1, 50)} == {1000}


@pytest.mark.parametrize("other", [8, 15])
def test_vectors_of_two_widths_in_one_partition(spark, odd, other):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 16))
    rows = [(n, [float(x) for x in centres[n % 6] + 0.1 * rng.normal(size=16)], n % 3) for n in range(120)]
    rows += [(200 + n, rows[n][1][:other], rows[n][2]) for n in range(12)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").coalesce(1)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = sorted(tuple(r)[:3] for r in vector_graph.near_vectors(table).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert got == by_hand(rows)
