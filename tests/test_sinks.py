"""Writers: safe replacement, one file from parallel parts, modes."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from marquee.sources import sinks as SK


def files(path):
    return sorted(f for f in os.listdir(path) if f.startswith("part-"))


def text(path):
    out = b""
    for f in files(path):
        with open(os.path.join(path, f), "rb") as data:
            out += data.read()
    return out


def numbers(spark, n, tasks=4):
    return spark.range(n, numPartitions=tasks).select(F.format_string("line %05d é", "id").alias("line"))


def failing(spark):
    return numbers(spark, 50).select(F.when(F.col("line").contains("00049"), F.raise_error(F.lit("broken"))).otherwise(F.col("line")).alias("line"))


@pytest.mark.parametrize("single_file", [False, True])
def test_a_failed_write_leaves_the_old_result(spark, tmp_path, single_file):
    path = str(tmp_path / "out")
    SK.write_text(numbers(spark, 30), path, single_file=single_file)
    before = text(path)
    with pytest.raises(Exception, match="broken"):
        SK.write_text(failing(spark), path, single_file=single_file)
    assert text(path) == before and os.listdir(tmp_path) == ["out"]
    SK.write_text(numbers(spark, 7), path, single_file=single_file)
    assert text(path).decode().splitlines() == [f"line {k:05d} é" for k in range(7)]
    assert os.listdir(tmp_path) == ["out"] and os.path.exists(os.path.join(path, "_SUCCESS"))


def test_an_interrupted_replacement_is_put_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    SK.write_text(numbers(spark, 5), path)
    before = text(path)
    real, calls = SK._rename, []

    def dies(fs, old, new):
        calls.append(new.getName())
        if new.getName() == "out" and len(calls) == 2:
            raise KeyboardInterrupt  # the driver stops between the two renames
        real(fs, old, new)

    monkeypatch.setattr(SK, "_rename", dies)
    with pytest.raises(KeyboardInterrupt):
        SK.write_text(numbers(spark, 9), path)
    monkeypatch.setattr(SK, "_rename", real)
    assert not os.path.exists(path) and text(SK.previous_path(path)) == before
    with pytest.raises(Exception, match="broken"):
        SK.write_text(failing(spark), path)
    assert text(path) == before and os.listdir(tmp_path) == ["out"]


def test_one_file_from_several_writing_tasks(spark, tmp_path):
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    rows = numbers(spark, 5000, tasks=6)
    SK.write_text(rows, one, single_file=True)
    SK.write_text(rows, many)
    assert len(files(one)) == 1 and len(files(many)) == 6
    assert text(one) == text(many)
    assert [f for f in os.listdir(one) if "part-" not in f and f not in ("_SUCCESS", "._SUCCESS.crc")] == []
    assert spark.read.text(one).count() == 5000  # checksums fit the joined bytes


def test_one_file_of_no_rows_and_modes(spark, tmp_path):
    path = str(tmp_path / "out")
    SK.write_text(numbers(spark, 9).where("false"), path, single_file=True)
    assert len(files(path)) == 1 and text(path) == b""
    SK.write_text(numbers(spark, 3), path, mode="append", single_file=True)
    assert len(files(path)) == 2 and spark.read.text(path).count() == 3
    SK.write_text(numbers(spark, 3), path, mode="ignore", single_file=True)
    assert spark.read.text(path).count() == 3
    with pytest.raises(FileExistsError):
        SK.write_text(numbers(spark, 3), path, mode="error", single_file=True)
    assert os.listdir(tmp_path) == ["out"]
