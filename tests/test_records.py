"""Files cut anywhere give the records of a reader that takes them whole."""

from __future__ import annotations

import csv
import json
import random

import pytest

from textloom.sources import files, records
from textloom.sources.scratch import new_path

ODD = ["", "plain", 'a "quoted" b', "}", "]}", '{"x": [1, 2', "\\", '\\"', "line\nbreak", "cr\r\nlf", "}{" * 300, "漢字 😀 é", ",", '"', "\\\\", "\t"]


@pytest.fixture
def splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "97b", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def local(path):
    return path.removeprefix("file:")


def rows_of(df):
    return sorted(((r.question or "", r.answer or "") for r in df.collect()))


@pytest.mark.parametrize("indent", [None, 2])
def test_one_json_array_by_many_tasks(spark, splits, indent):
    pick = random.Random(3)
    rows = [{"question": pick.choice(ODD) + str(i), "answer": pick.choice(ODD) * pick.randrange(4), "more": {"deep": [{"a": "}"}, []]}} for i in range(120)]
    path = new_path(spark, "array")
    spark.range(1).write.parquet(path)  # makes the folder
    folder = path + "/in"
    spark.range(2).write.parquet(folder)
    for name, some in (("one.json", rows), ("two.json", [*rows[:7], {}, None, 5, "text", [1, {"question": "no"}]]), ("three.json", [])):
        with open(f"{local(folder)}/{name}", "w") as out:
            json.dump(some, out, indent=indent, ensure_ascii=False)
    found = records.read_json_array(spark, f"{folder}/*.json", files.FAQ)
    assert rows_of(found) == sorted((r["question"], r["answer"]) for r in [*rows, *rows[:7]])
    assert spark.read.option("lineSep", "}").text(f"{folder}/one.json").rdd.getNumPartitions() > 20


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_csv_with_line_breaks_by_many_tasks(spark, splits, ending):
    pick = random.Random(4)
    rows = [(str(i), pick.choice(ODD) + "x", pick.choice(ODD) * pick.randrange(1, 4) + "y") for i in range(150)]
    folder = new_path(spark, "csv")
    spark.range(1).write.parquet(folder)
    for name, some in (("one.csv", rows), ("two.csv", rows[:3]), ("three.csv", [])):
        with open(f"{local(folder)}/{name}", "w", newline="") as out:
            writer = csv.writer(out, lineterminator=ending, quoting=csv.QUOTE_ALL)
            writer.writerow(["id", "answer", "question"])
            writer.writerows(some)
    found = records.read_csv(spark, f"{folder}/*.csv", files.FAQ)
    assert rows_of(found) == sorted((q, a) for _, a, q in [*rows, *rows[:3]])
    with pytest.raises(ValueError, match="no column other"):
        records.read_csv(spark, f"{folder}/*.csv", "other string")


def test_states_are_carried_over_splits():
    def row(block, turned, low, deep):
        return {"file": "f", "block": block, "turned": turned, "low": low, "deep": deep}

    rows = [row(0, [1, 0], [0, 0], [2, 1]), row(50, [0, 1], [0, 0], [0, 0]), row(100, [0, 1], [-1, 0], [0, 3])]
    assert records.carried(rows, records.JSON) == {("f", 0): (0, 0, 0), ("f", 50): (1, 2, 0), ("f", 100): (1, 2, 0)}
