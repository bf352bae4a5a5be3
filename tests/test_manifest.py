"""File manifests: snapshots, differences, and the copy that copies only what changed."""

from __future__ import annotations

import os

import pytest

from tallyspark.sources import manifest


def _put(root, name, text, when=1_000_000):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    os.utime(path, (when, when))


@pytest.fixture
def src(tmp_path):
    root = tmp_path / "src"
    for name, text in (("a.csv", "id\n1\n2\n"), ("b.csv", "id\n3\n"), ("deep/c.csv", "id\n4\n"), ("e.csv", ""), ("note.txt", "x")):
        _put(root, name, text)
    return root


def _status(df):
    return {r["path"]: r["status"] for r in df.collect()}


def test_rows_of_a_manifest(spark, src):
    rows = {r["path"]: r for r in manifest.take(spark, str(src), "*.csv", contents=True).collect()}
    assert set(rows) == {"a.csv", "b.csv", "deep/c.csv"}  # a file of no bytes has nothing to copy
    assert (rows["a.csv"]["length"], rows["a.csv"]["lines"]) == (7, 3)
    assert rows["a.csv"]["modification_time"].timestamp() == 1_000_000
    with pytest.raises(FileNotFoundError):
        manifest.take(spark, str(src / "absent"))


@pytest.mark.parametrize("contents", [False, True])
def test_differences_between_snapshots(spark, src, tmp_path, contents):
    folder = str(tmp_path / "snapshots")
    assert manifest.snapshots(spark, folder) == []
    manifest.keep(manifest.take(spark, str(src), "*.csv", contents), folder)
    (src / "b.csv").unlink()
    _put(src, "a.csv", "id\n1\n9\n", 2_000_000)  # same length
    _put(src, "deep/c.csv", "id\n4\n", 2_000_000)  # same contents
    _put(src, "deep/d.csv", "id\n5\n")
    manifest.keep(manifest.take(spark, str(src), "*.csv", contents), folder)
    first, last = (manifest.read(spark, s) for s in manifest.snapshots(spark, folder))
    touched = "touched" if contents else "changed"
    want = {"a.csv": "changed", "b.csv": "vanished", "deep/c.csv": touched, "deep/d.csv": "new"}
    assert _status(manifest.difference(first, last)) == want
    assert set(_status(manifest.difference(last, last)).values()) == {"same"}
    assert set(_status(manifest.difference(manifest.read(spark, None), first)).values()) == {"new"}


def test_a_snapshot_without_its_marker_does_not_count(spark, src, tmp_path):
    folder = str(tmp_path / "snapshots")
    done = manifest.keep(manifest.take(spark, str(src)), folder)
    died = manifest.keep(manifest.take(spark, str(src)), folder)
    os.remove(f"{died}/_SUCCESS")
    assert [s.rsplit("/", 1)[1] for s in manifest.snapshots(spark, folder)] == [done.rsplit("/", 1)[1]]


def test_copy_copies_only_what_changed(spark, src, tmp_path):
    dst, folder = str(tmp_path / "dst"), str(tmp_path / "snapshots")

    def copy():
        rows = manifest.copy_changes(spark, str(src), dst, folder, "*.csv").collect()
        assert all(r["matched"] for r in rows)
        return {r["path"]: (r["status"], r["source_lines"], r["dest_lines"]) for r in rows}

    assert copy() == {"a.csv": ("new", 3, 3), "b.csv": ("new", 2, 2), "deep/c.csv": ("new", 2, 2)}
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "dst").rglob("part-*")}
    again = copy()
    assert {s for s, *_ in again.values()} == {"same"}
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "dst").rglob("part-*")} == files  # nothing written
    (src / "b.csv").unlink()
    _put(src, "a.csv", "id\n1\n2\n3\n", 3_000_000)
    _put(src, "odd name=1%.csv", "id\n7\n", 3_000_000)
    assert copy() == {"a.csv": ("changed", 4, 4), "b.csv": ("vanished", 0, 0), "deep/c.csv": ("same", 2, 2), "odd name=1%.csv": ("new", 2, 2)}
    untouched = [p for p in files if "c.csv" in str(p)]
    assert untouched and all(p.stat().st_mtime_ns == files[p] for p in untouched)


def test_a_damaged_destination_is_named(spark, src, tmp_path):
    dst, folder = tmp_path / "dst", str(tmp_path / "snapshots")
    manifest.copy_changes(spark, str(src), str(dst), folder, "*.csv")
    part = next(p for p in dst.rglob("part-*") if "a.csv" in str(p))
    part.write_text("id\n1\n8\n")
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    rows = manifest.copy_changes(spark, str(src), str(dst), folder, "*.csv").collect()
    assert {r["path"] for r in rows if not r["matched"]} == {"a.csv"}


def test_a_missing_source_stops_before_anything_is_written(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        manifest.copy_changes(spark, str(tmp_path / "absent"), str(tmp_path / "dst"), str(tmp_path / "snapshots"))
    assert not (tmp_path / "dst").exists()
