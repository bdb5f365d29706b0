"""Arrays of JSON objects read by byte ranges, against the reader that takes a file as a whole."""

import json
import random

import pytest
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tablewright.sources.nested_json import CORRUPT, scan_json_array, scan_nested_json

INNER = StructType([StructField("x", StringType())])
SCHEMA = StructType([StructField("id", LongType()), StructField("s", StringType()), StructField("o", INNER), StructField("l", ArrayType(INNER))])


def documents(seed, n):
    pick = random.Random(seed)
    parts = ["a", "}", "{", '"', "\\", "]", "[", ",", "\n", "é", "\U0001f600", "}\\", '\\"}', " "]
    text = lambda: "".join(pick.choices(parts, k=pick.randrange(12)))
    return [
        {"id": i, "s": text(), "o": pick.choice([None, {}, {"x": text()}]), "l": [{"x": text()} for _ in range(pick.randrange(3))], "other": {"deep": [{}, [{"y": text()}]]}}
        for i in range(n)
    ]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("indent, chunk", [(None, 128), (2, 5), ("\t", 16)])
def test_one_file_by_many_tasks(spark, rows, tmp_path, small_splits, indent, chunk):
    found = documents(str(indent), 120)
    (tmp_path / "a.json").write_text(json.dumps(found, indent=indent, ensure_ascii=indent is None))
    path = str(tmp_path / "a.json")
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 10
    got = scan_json_array(spark, path, SCHEMA, chunk=chunk).collect()
    want = scan_nested_json(spark, path, SCHEMA).collect()
    assert sorted(got, key=lambda r: r.id) == sorted(want, key=lambda r: r.id) and len(got) == 120
    assert [r.s for r in sorted(got, key=lambda r: r.id)] == [d["s"] for d in found]


def test_several_files_and_empty_arrays(spark, tmp_path):
    for n, text in enumerate(["[]", " [ ] \n", "", json.dumps(documents(1, 3)), json.dumps(documents(2, 2)) + "\n" + json.dumps(documents(3, 1))]):
        (tmp_path / f"{n}.json").write_text(text)
    got = scan_json_array(spark, str(tmp_path), SCHEMA)
    assert sorted(r.id for r in got.collect()) == [0, 0, 0, 1, 1, 2] and got.where(f"{CORRUPT} is not null").count() == 0


def test_what_is_no_object_is_corrupt(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1}, {"id": "no number"}, 7, {"id": 3}, {"id": 4')
    got = {r.id: r[CORRUPT] for r in scan_json_array(spark, str(tmp_path / "a.json"), SCHEMA).collect() if r.id is not None}
    assert got[1] is None
    assert scan_json_array(spark, str(tmp_path / "a.json"), SCHEMA).where(f"{CORRUPT} is not null").count() >= 2
