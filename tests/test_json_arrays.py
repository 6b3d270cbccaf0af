"""Array files read by byte ranges, against Python's JSON reader."""

import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from statloom.sources.json_arrays import _pieces, read_elements
from statloom.sources.series_json import read_series_files

HARD = ['plain', 'a}b{c', '}}}}', '[[', 'quote " in', 'back\\slash', 'end\\', '\\"}', 'ñandú, 東京 }', '', '],[{']


def _value(rng, depth=0):
    kind = rng.randrange(6 if depth < 3 else 3)
    if kind < 2:
        return rng.choice(HARD)
    if kind == 2:
        return rng.choice([1, -2.5, None, True])
    if kind == 3:
        return [_value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(HARD): _value(rng, depth + 1) for _ in range(rng.randrange(4))}


def _objects(rng, n):
    return [{"id": i, rng.choice(HARD): _value(rng)} for i in range(n)]


@pytest.fixture
def ranges(spark):
    """Byte ranges of so few bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    yield lambda n: [spark.conf.set(k, n) for k in keys]
    for k, v in zip(keys, before):
        spark.conf.set(k, v)


def _write(folder, **files):
    os.makedirs(folder)
    for name, text in files.items():
        with open(f"{folder}/{name}.json", "w", encoding="utf-8", newline="") as fh:
            fh.write(text)
    return folder


def _read(spark, folder):
    rows = sorted(read_elements(spark, folder).collect(), key=lambda r: r.place)
    assert len({r.place for r in rows}) == len(rows)
    return rows


@pytest.mark.parametrize("size", [3, 300, 1 << 20])
def test_elements_and_order_at_any_range_size(spark, scratch, ranges, size):
    rng = random.Random(size)
    many, few, lone = _objects(rng, 60 if size > 3 else 4), _objects(rng, 3), _objects(rng, 1)
    folder = _write(scratch + "/f", a=json.dumps(many, ensure_ascii=False), b=json.dumps(few, indent=2) + "\n", c=json.dumps(lone[0]), d="[]", e=" [ ]\r\n", f="")
    ranges(size)
    rows = _read(spark, folder)
    assert not any(r.broken for r in rows)
    assert [json.loads(r.text) for r in rows] == many + few + lone
    assert [r.file_name for r in rows] == ["a.json"] * len(many) + ["b.json"] * 3 + ["c.json"]


def test_a_file_is_read_by_many_tasks(spark, scratch, ranges):
    folder = _write(scratch + "/f", a=json.dumps([{"Nombre": "x" * 50, "Data": [{"Anyo": i}]} for i in range(2000)]))
    ranges(4000)
    per_task = _pieces(spark, folder).groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 20 and max(r["count"] for r in per_task) < 400
    rows = read_series_files(spark, folder).orderBy("series_pos").collect()
    assert [int(r.Data[0]["Anyo"]) for r in rows] == list(range(2000))


def test_one_large_element_over_many_ranges(spark, scratch, ranges):
    doc = {"Nombre": "n", "Data": [{"Anyo": i, "Valor": i / 2} for i in range(3000)]}
    folder = _write(scratch + "/f", x50913=json.dumps([{"Nombre": "a", "Data": []}, doc, {"Nombre": "z", "Data": []}]))
    ranges(2000)
    rows = read_series_files(spark, folder).orderBy("series_pos").collect()
    assert [r.Nombre for r in rows] == ["a", "n", "z"] and {r.table_code for r in rows} == {50913}
    assert len(rows[1].Data) == 3000


#: Text, the objects read from it, and what is broken.
ODD = [
    ('[{"a": 1}, {"a": 2}', [1, 2], [""]),  # no closing bracket
    ('[{"a": 1}, {"a": 2', [1], ['{"a": 2']),
    ('[{"a": 1}, {"a": "x}', [1], ['{"a": "x}']),
    ('[{"a": 1}, {"a": {"b": 2}', [1], ['{"a": {"b": 2}']),
    ('[1, {"a": 1}, null, "x", {"a": 2}, 3]', [1, 2], ["1", 'null, "x"', "3]"]),
    ('[{"a": 1}] tail', [1], ["] tail"]),
    ('{"a": 1}\n{"a": 2}\n', [1, 2], []),  # objects one after the other
    ("no json", [], ["no json"]),
    ("[", [], [""]),
    ('\ufeff[{"a": 1}]', [1], []),
    ('\ufeff{"a": 1}', [1], []),
]


@pytest.mark.parametrize("size", [5, 1 << 20])
def test_text_that_is_no_array_of_objects(spark, scratch, ranges, size):
    folder = _write(scratch + "/f", **{f"{i:02}": text for i, (text, _, _) in enumerate(ODD)})
    ranges(size)
    rows = _read(spark, folder)
    for i, (_, good, broken) in enumerate(ODD):
        own = [r for r in rows if r.file_name == f"{i:02}.json"]
        assert [json.loads(r.text)["a"] for r in own if not r.broken] == good
        assert [r.text for r in own if r.broken] == broken


def test_compressed_files_and_broken_documents(spark, scratch):
    docs = [{"Nombre": "a", "Data": [{"Anyo": 1}]}, {"Nombre": "b", "Data": 5}, {"Nombre": "c", "Data": []}]
    os.makedirs(scratch + "/f/table_code=77")
    for name, text in {"1.json.gz": json.dumps(docs), "2.json.gz": json.dumps(docs[0])}.items():
        with gzip.open(f"{scratch}/f/table_code=77/{name}", "wt") as fh:
            fh.write(text)
    rows = read_series_files(spark, scratch + "/f").orderBy("series_pos").collect()
    assert [r.Nombre for r in rows] == ["a", "b", "c", "a"] and {r.table_code for r in rows} == {77}
    assert [r._bad_record is not None for r in rows] == [False, True, False, False]
