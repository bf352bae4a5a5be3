"""A batch is appended exactly once, however often its job is run."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tallyspark.sources import ledger

from .conftest import SF_SMALL

LAYOUT = "region_key INT NOT NULL, region_name STRING, zone STRING"


@pytest.fixture
def rows(spark):
    return spark.read.parquet(f"{SF_SMALL}/region.parquet").select(F.col("r_regionkey").alias("region_key"), F.col("r_name").alias("region_name"))


def _table(spark, path):
    return sorted(map(tuple, ledger.read_table(spark, path, LAYOUT).collect()), key=str)


def test_a_repeated_insert_adds_nothing(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    assert _table(spark, path) == []
    assert ledger.append_batch(rows, path, LAYOUT, "2024-01", {"zone": F.lit("z")})
    once = _table(spark, path)
    assert len(once) == 5 and {r[2:] for r in once} == {("z", "2024-01")}
    assert not ledger.append_batch(rows, path, LAYOUT, "2024-01")
    assert _table(spark, path) == once
    assert ledger.append_batch(rows.filter("region_key < 2"), path, LAYOUT, "2024-02")
    assert len(_table(spark, path)) == 7
    assert {r["batch_id"] for r in ledger.batches(spark, path).collect()} == {"2024-01", "2024-02"}


def test_a_failed_attempt_leaves_no_rows(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    holed = rows.withColumn("region_key", F.when(F.col("region_key") != 3, F.col("region_key")))
    with pytest.raises(Exception, match="NULL in NOT NULL column region_key"):
        ledger.append_batch(holed, path, LAYOUT, "b1")
    assert _table(spark, path) == []
    assert ledger.append_batch(rows, path, LAYOUT, "b1") and len(_table(spark, path)) == 5


def test_an_attempt_that_died_before_its_claim_does_not_count(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    monkeypatch.setattr(ledger, "_claim", lambda *_: (_ for _ in ()).throw(RuntimeError("lost driver")))
    with pytest.raises(RuntimeError):
        ledger.append_batch(rows, path, LAYOUT, "b1")
    monkeypatch.undo()
    assert _table(spark, path) == []
    assert ledger.append_batch(rows, path, LAYOUT, "b1") and len(_table(spark, path)) == 5
    assert ledger.drop_leftovers(spark, path) == []
    assert len(ledger.drop_leftovers(spark, path, older_than_seconds=-10)) == 1
    assert len(_table(spark, path)) == 5 and len(os.listdir(f"{path}/batch=b1")) == 1


def test_of_two_attempts_at_once_one_counts(spark, rows, tmp_path, monkeypatch):
    """Both find no claim and write; the second to claim is refused."""
    path = str(tmp_path / "t")
    first = ledger.claimed
    monkeypatch.setattr(ledger, "claimed", lambda s, p, b, seen=[]: first(s, p, b) if seen else seen.append(1))  # noqa: B006
    claim = ledger._claim

    def late(s, p, b, attempt):
        assert claim(s, p, b, "someone-else")
        return claim(s, p, b, attempt)

    monkeypatch.setattr(ledger, "_claim", late)
    assert not ledger.append_batch(rows, path, LAYOUT, "b1")
    assert first(spark, path, "b1") == "someone-else"


def test_batch_ids_are_names(spark, rows, tmp_path):
    for bad in ("", "a/b", "..", "a=b"):
        with pytest.raises(ValueError):
            ledger.append_batch(rows, str(tmp_path / "t"), LAYOUT, bad)
