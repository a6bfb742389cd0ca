"""The parallel scan gives the rows that a one-task reader gives, wherever the splits end."""

import random

import pytest

from payerscope.sources.csv_scan import ROW, Split, compose, left_open, scan_records


def cell(pick: random.Random) -> str:
    if pick.random() < 0.4:
        return pick.choice(["a", "b c", "12.5", "", 'x"y', '5" pipe', " z ", '""', '"a"b', "é"])
    return '"' + "".join(pick.choice(["a", ",", "\n", '""', " ", "\n\n", "ü"]) for _ in range(pick.randint(0, 12))) + '"'


@pytest.fixture()
def tiny_splits(spark):
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {k: spark.conf.get(k) for k in keys}
    yield lambda size, cost: [spark.conf.set(k, v) for k, v in zip(keys, (size, cost))]
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed", range(8))
def test_same_rows_as_one_task(spark, tmp_path, tiny_splits, seed):
    pick = random.Random(seed)
    header = pick.choice(['h1,"h ""2""",h3', 'h1,"h 2","h3\n\n, a long name that splits cut"'])
    for f in range(pick.randint(1, 3)):
        rows = [",".join(cell(pick) for _ in range(3)) for _ in range(pick.randint(0, 40))]
        (tmp_path / f"p{f}.csv").write_bytes(("\n".join([header, *rows]) + pick.choice(["", "\n", "\n\n"])).encode())
    tiny_splits(pick.choice([37, 64, 200, 10000]), pick.choice([1, 50, 4000]))
    scanned = scan_records(spark, str(tmp_path))
    got = [tuple(r) for r in scanned.orderBy(ROW).collect()]
    plain = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    want = [tuple(r) for f in sorted(tmp_path.iterdir()) for r in plain.csv(str(f)).collect()]
    assert got == [(*row, i) for i, row in enumerate(want, start=1)]
    assert scanned.columns[:-1] == plain.csv(str(tmp_path)).columns


def test_many_tasks_read_one_file_with_line_ends_in_cells(spark, tmp_path, tiny_splits):
    lines = [f'{i},"first\r\nsecond ""{i}""",x' for i in range(400)]
    (tmp_path / "one.csv").write_bytes(("a,b,c\r\n" + "\r\n".join(lines) + "\r\n").encode())
    tiny_splits(500, 1)
    found = scan_records(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() > 10
    assert [tuple(r) for r in found.orderBy(ROW).collect()] == [(str(i), f'first\r\nsecond "{i}"', "x", i + 1) for i in range(400)]
    assert "Sort" not in found._jdf.queryExecution().executedPlan().toString().replace("SortAggregate", "").replace("sort_array", "")


def test_quotes_open_only_as_first_letter_of_a_cell():
    assert [left_open(t, False) for t in ['a,"b', 'a,b"', 'a,"b""', 'a,"b"""', '"a"b,"c', ' "a', '"', '""', '"""', ""]] == [
        True, False, True, False, True, False, True, False, True, False]
    assert [left_open(t, True) for t in ["a", 'a"', 'a""', 'a",b', 'a","b', 'a"",b"', ""]] == [True, False, True, False, True, False, True]


def test_states_are_composed_file_by_file():
    splits = [Split("b", 0, (False, True), (2, 0)), Split("a", 9, (False, False), (3, 1)), Split("a", 0, (True, False), (4, 0)),
              Split("a", 20, (True, False), (0, 0))]
    found = compose(splits)
    assert found["a", 0][:3] == (False, 1, True) and found["a", 9][:3] == (True, 4, False)
    assert found["a", 20][:3] == (False, 5, False) and found["b", 0][:3] == (False, 5, True)


def test_an_empty_file_has_no_header(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    with pytest.raises(ValueError):
        scan_records(spark, str(tmp_path))
