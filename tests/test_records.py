"""Files with line breaks inside quoted values, cut into many ranges: the same rows as one task that reads a whole file."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql.types import StructType

from tallyspark.sources import files, records

DDL = "a string, b string, c string"


def _value(rng, line_end):
    kind = rng.random()
    if kind < 0.3:
        return "".join(rng.choice("xyz ") for _ in range(rng.randint(0, 6)))
    if kind < 0.45:  # quotes inside values that don't begin with one
        return rng.choice(['5" pipe', 'a"b"', 'x"', 'say "hi" now'])
    other = "\r\n" if line_end == "\n" else "n"
    inside = ["p", "q", ",", '""', "\n", line_end, other, "  ", "é", '""""', "\n\n"]
    return '"' + "".join(rng.choice(inside) for _ in range(rng.randint(0, 8))) + '"'


def _text(seed):
    rng = random.Random(seed)
    end = rng.choice(["\n", "\r\n"])
    lines = [rng.choice(["a,b,c", f'a,"b{end}b",c'])]
    for _ in range(rng.randint(0, 40)):
        lines.append(",".join(_value(rng, end) for _ in range(3)))
        if rng.random() < 0.05:
            lines.append("")
    return end.join(lines) + (end if end == "\r\n" or rng.random() < 0.7 else "")


@pytest.fixture
def small_ranges(spark):
    names = {"spark.sql.files.maxPartitionBytes": "40", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in names}

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


def _whole(spark, path, ddl=DDL):
    reader = spark.read.options(**files.CSV_OPTIONS).option("mode", "FAILFAST")
    return sorted(map(tuple, reader.schema(ddl).csv(path).collect()), key=str)


@pytest.mark.parametrize("seed", range(12))
def test_same_rows_whatever_the_ranges(spark, tmp_path, small_ranges, seed):
    (tmp_path / "f.csv").write_bytes(_text(seed).encode())
    if seed % 2:
        (tmp_path / "g.csv").write_bytes(_text(seed + 1000).encode())
    want = _whole(spark, str(tmp_path))
    small_ranges([16, 40, 100, 300][seed % 4])
    got = files.read_delimited(spark, str(tmp_path), DDL, normalise_nulls=False).collect()
    assert sorted(map(tuple, got), key=str) == want


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path, small_ranges):
    rows = 40_000
    body = "".join(f'{i},"line one of {i}\nline two, ""{i}""",{"x" * (i % 90)}\n' for i in range(rows))
    (tmp_path / "f.csv").write_text("id,note,pad\n" + body)
    ddl = "id bigint, note string, pad string"
    want = _whole(spark, str(tmp_path / "f.csv"), ddl)
    small_ranges(1 << 18)
    df = files.read_delimited(spark, str(tmp_path / "f.csv"), ddl, normalise_nulls=False)
    assert df.rdd.getNumPartitions() > 10
    assert sorted(map(tuple, df.collect()), key=str) == want and len(want) == rows


def test_files_without_line_breaks_in_values_use_sparks_own_split_scan(spark, tmp_path, small_ranges):
    (tmp_path / "f.csv").write_text("a,b,c\n" + "".join(f'{i},"x, ""y""",5" pipe\n' for i in range(3000)))
    want = _whole(spark, str(tmp_path))
    small_ranges(4096)
    df = files.read_delimited(spark, str(tmp_path), DDL, normalise_nulls=False)
    assert "FileScan csv" in df._jdf.queryExecution().executedPlan().toString() and df.rdd.getNumPartitions() > 5
    assert sorted(map(tuple, df.collect()), key=str) == want


def test_typed_columns_malformed_records_and_other_separators(spark, tmp_path, small_ranges):
    small_ranges(32)
    (tmp_path / "t.csv").write_text('id;note;day\n1;"a\nb";2024-01-31\n2;;2024-02-01\n')
    ddl = "id int, note string, day date"
    got = files.read_delimited(spark, str(tmp_path / "t.csv"), ddl, sep=";").collect()
    assert sorted((r["id"], r["note"], str(r["day"])) for r in got if r["id"] == 1) == [(1, "a\nb", "2024-01-31")] and len(got) == 2
    (tmp_path / "bad.csv").write_text('id;note;day\n1;"a\nb";2024-01-31\nx;y;z\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_delimited(spark, str(tmp_path / "bad.csv"), ddl, sep=";").collect()
    lenient = files.read_delimited(spark, str(tmp_path / "bad.csv"), ddl, sep=";", mode="PERMISSIVE").collect()
    assert sorted(str(r["id"]) for r in lenient) == ["1", "None"]


def test_latin1_and_single_returns(spark, tmp_path, small_ranges):
    small_ranges(32)
    (tmp_path / "l.csv").write_bytes('a,b,c\né,"ö\nü",x\n'.encode("latin-1"))
    got = files.read_delimited(spark, str(tmp_path / "l.csv"), DDL, encoding="ISO-8859-1").collect()
    assert list(map(tuple, got)) == [("é", "ö\nü", "x")]
    (tmp_path / "mac.csv").write_bytes(b'a,b,c\r1,"x\ry",2\r3,4,5\r')
    assert sorted(map(tuple, files.read_delimited(spark, str(tmp_path / "mac.csv"), DDL).collect())) == _whole(spark, str(tmp_path / "mac.csv"))
    assert records.shape(spark, str(tmp_path / "mac.csv")).stray_returns


def test_empty_files(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    assert files.read_delimited(spark, str(tmp_path), DDL).count() == 0
    (tmp_path / "h.csv").write_text('a,"b\nb",c\n')
    assert files.read_delimited(spark, str(tmp_path), DDL).count() == 0


def test_states_compose(spark):
    """Every line maps a state to a state; the vector form equals a loop, however the lines are cut."""
    rng = np.random.default_rng(0)
    for _ in range(50):
        a, b = rng.random(30) < 0.4, rng.random(30) < 0.6
        for start in (False, True):
            want, s = [], start
            for x, y in zip(a, b, strict=True):
                s = bool(y if s else x)
                want.append(s)
            assert records.states(a, b, start).tolist() == want
            cut = int(rng.integers(1, 29))
            first = records.states(a[:cut], b[:cut], start)
            assert first.tolist() + records.states(a[cut:], b[cut:], bool(first[-1])).tolist() == want
    assert StructType.fromDDL(DDL).fieldNames() == ["a", "b", "c"]
