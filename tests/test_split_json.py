"""Files that each hold one JSON document, read by split, against Spark's multiLine reader."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qalathe.sources.split_json import read_json_items

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("tags", T.ArrayType(T.StringType()))])
TRICKY = ['plain', 'a, b, c', '[not, an, array]', '{"x": 1, "y": [2, 3]}', 'quote " and \\ back\\slash,',
          '\\",\\"', 'é ü 漢字, ok', '']


@pytest.fixture()
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _items(n):
    return [{"id": k, "text": TRICKY[k % len(TRICKY)] * (k % 5), "tags": ["a,b", "]"] if k % 3 else []}
            for k in range(n)]


def _rows(df):
    return sorted((r.id, r.text, tuple(r.tags or ())) for r in df.collect())


def test_array_per_file_equals_multiline_reader(spark, tmp_path, small_splits):
    (tmp_path / "a.json").write_text(json.dumps(_items(300)))
    (tmp_path / "b.json").write_text(json.dumps(_items(40), indent=2))
    (tmp_path / "c.json").write_text("[]")
    (tmp_path / "d.json").write_text("  [ ]  ")
    path = str(tmp_path)
    assert spark.read.option("lineSep", ",").text(str(tmp_path / "a.json")).rdd.getNumPartitions() > 5
    got = read_json_items(spark, path, SCHEMA)
    whole = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", T.ArrayType(SCHEMA))).alias("r"))
    assert _rows(got) == _rows(whole.select("r.*"))
    ordered = [r.id for r in got.where(F.col("_pos.file").endswith("a.json")).orderBy("_pos").collect()]
    assert ordered == list(range(300))


def test_items_inside_a_document_and_the_rest(spark, tmp_path, small_splits):
    doc = {"tag": "en, all", "n": {"k": 2}, "items": _items(120), "after": "x"}
    (tmp_path / "r.json").write_text(json.dumps(doc))
    got = read_json_items(spark, str(tmp_path), SCHEMA, item_depth=2)
    assert sorted(r.id for r in got.collect()) == list(range(120))
    rest = json.loads(got.first()._outside)
    assert rest["tag"] == "en, all" and rest["after"] == "x"


def test_empty_file(spark, tmp_path):
    (tmp_path / "e.json").write_text("")
    assert read_json_items(spark, str(tmp_path), SCHEMA).count() == 0


def _batches(column, values, size=50):
    import pyarrow as pa

    for i in range(0, len(values), size):
        part = values[i:i + size]
        yield pa.RecordBatch.from_arrays(
            [pa.array(["f"] * len(part)), pa.array([0] * len(part)), pa.array(part, pa.binary())],
            names=["file", "block", column])


def test_a_task_does_not_hold_its_split(monkeypatch):
    """Items leave while the split is still being read."""
    from types import SimpleNamespace

    from qalathe.sources import split_json

    monkeypatch.setattr(split_json, "HELD_CHARS", 1000)
    taken = []

    def source():
        for batch in _batches("piece", json.dumps(_items(500)).encode().split(b",")):
            taken.append(batch.num_rows)
            yield batch

    run = split_json.assemble(SimpleNamespace(value={("f", 0): (False, 0, None, True)}), 1)(source())
    next(run)
    early = len(taken)
    rest = sum(1 for _ in run)
    assert rest > 3 and early * 3 < len(taken)


def test_documents_hold_one_tag_of_a_split_each(spark, tmp_path):
    from registry.acquire import _write_documents

    rows = spark.range(0, 1000, 1, 3).select(
        F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 2 == 0, 'a "b"').otherwise("").alias("tag"),
        F.to_json(F.struct("id")).alias("item"))
    path = str(tmp_path / "documents")
    _write_documents(rows, path, lambda tag: f'{{"tag":{json.dumps(tag)},"items":[', "]}")
    files = [json.loads(r.value) for r in spark.read.text(path, wholetext=True).collect()]
    assert len(files) == 9  # three tags in each of three splits, not one file for every hundred items
    assert sorted(x["id"] for d in files for x in d["items"]) == list(range(1000))
    assert all((x["id"] % 7 == 0) == (d["tag"] is None) for d in files for x in d["items"])
