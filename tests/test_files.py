"""Files as they lie: first-seen values in file order, quoted newlines over many tasks."""

import csv
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillstat.operators import profile as P
from quillstat.sources.readers import read_csv


@pytest.fixture
def small_ranges(spark):
    """Files are cut into byte ranges of 1,500 bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "1500", "spark.sql.files.openCostInBytes": "10"}
    old = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in old.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("prune_rows", [100_000, 7, None])
def test_first_seen_values_equal_pandas_over_three_files(spark, small_ranges, tmp_path, prune_rows):
    rnd = random.Random(4)
    frames = []
    for i in range(3):
        n = [400, 30, 700][i]
        frame = pd.DataFrame({"a": [f"v{rnd.randrange(90):02d}" for _ in range(n)], "few": [rnd.choice("yx") for _ in range(n)],
                              "late": ["" if i < 2 else f"z{rnd.randrange(9)}" for _ in range(n)], "none": [""] * n})
        frame.to_csv(tmp_path / f"part-{i}.csv", index=False)
        frames.append(frame)
    whole = pd.concat(frames)
    df = read_csv(spark, str(tmp_path)).select("late", "a", "few", "none")
    assert df.rdd.getNumPartitions() > 4
    got: dict[str, list[str]] = {}
    for r in P.sample_values(df, file_order=True, prune_rows=prune_rows).orderBy("ordinal", "sample_rank").collect():
        got.setdefault(r["column_name"], []).append(r["sample_value"])
    assert got == {c: [v for v in whole[c].unique() if v][:5] for c in ("a", "few", "late")}


def _write(path, rows, end="\r\n"):
    with open(path, "w", newline="") as f:
        csv.writer(f, lineterminator=end).writerows(rows)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_newlines_over_many_tasks_equal_multiline(spark, small_ranges, tmp_path, end):
    """Fields with newlines, quotes, commas and blank lines; one far longer than a byte range; some open at a range's edge."""
    rnd = random.Random(5)
    header, written = ["id", "no\nte", "x"], []
    for i in range(3):
        rows = [header]
        for k in range(300):
            note = "".join(rnd.choice(["a", "b", " ", "\n", "\n\n", '"', ",", "é", '""\n']) for _ in range(rnd.randrange(12)))
            rows.append([f"{i}-{k}", note, rnd.choice(["", "1", 'say "hi"'])])
        if i == 1:
            rows.insert(100, ["long", "line\n" * 2000, "after"])
        _write(tmp_path / f"f{i}.csv", rows, end)
        written += rows[1:]
    got = read_csv(spark, str(tmp_path), multiline=True)
    assert got.columns == header
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(tuple(v or None for v in row)) for row in written)
    if end == "\n":   # with \r\n, multiLine leaves \r on the last column
        want = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path))
        assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8


def test_quoted_newlines_edges(spark, tmp_path):
    """A header alone, empty files, a quote that is never closed."""
    _write(tmp_path / "only.csv", [["a", "b"]])
    assert read_csv(spark, str(tmp_path / "only.csv"), multiline=True).columns == ["a", "b"]
    assert read_csv(spark, str(tmp_path / "only.csv"), multiline=True).count() == 0
    (tmp_path / "empty.csv").write_text("")
    assert read_csv(spark, str(tmp_path / "empty.csv"), multiline=True).count() == 0
    (tmp_path / "open.csv").write_text('a,b\n1,2\n3,"never\nclosed\n')
    rows = read_csv(spark, str(tmp_path / "open.csv"), multiline=True).collect()
    assert len(rows) == 2 and {r["a"] for r in rows} == {"1", "3"}
