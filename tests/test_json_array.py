"""The splittable JSON array scan equals the whole-file scan, at any split size."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tessera.sources.files import PAYLOAD_SCHEMA, read_payload
from tessera.sources.json_array import SourceError, read_json_array

ODD_TEXTS = ['a}b', '}', '}}', '"}"', '\\', '\\"}', ']', '[', '[]', ']}', ',{', '{"data":"x"}', "é}ü", "", "\n}", "}]", "[ ]}", '},{"']


@pytest.fixture()
def split_bytes(spark):
    """Sets the split size for a test."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def put(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield put
    for k, v in old.items():
        spark.conf.set(k, v)


def write(folder, name, text):
    path = folder / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def rows(df):
    return sorted(((r.data, r.valor) for r in df.collect()), key=repr)


def whole_file(spark, path):
    return rows(spark.read.schema(PAYLOAD_SCHEMA).option("multiLine", True).json(path))


@pytest.mark.parametrize("indent", [None, 2])
def test_large_payload_is_read_by_several_tasks(spark, tmp_path, split_bytes, indent):
    items = [{"data": f"{i % 28 + 1:02d}/01/2020", "valor": f"{i},5"} for i in range(3000)]
    path = write(tmp_path, "p.json", json.dumps(items, indent=indent))
    split_bytes(10_000)
    found = read_payload(spark, path)
    assert found.rdd.getNumPartitions() > 5
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.select(F.spark_partition_id()).distinct().count() > 5
    assert rows(found) == whole_file(spark, path) == sorted(((x["data"], x["valor"]) for x in items), key=repr)


@pytest.mark.parametrize("n_bytes", [7, 40, 400, 1 << 20])
def test_braces_and_escapes_in_strings(spark, tmp_path, split_bytes, n_bytes):
    rnd = random.Random(n_bytes)
    count = 8 if n_bytes < 40 else 60
    items = [
        {"data": "".join(rnd.choices(ODD_TEXTS, k=rnd.choice([1, 1, 3, 12]))), "valor": rnd.choice(["1", "{}", *ODD_TEXTS])}
        for _ in range(count)
    ]
    path = write(tmp_path, "p.json", json.dumps(items, ensure_ascii=False))
    split_bytes(n_bytes)
    want = sorted(((x["data"], x["valor"]) for x in items), key=repr)
    assert rows(read_json_array(spark, path, PAYLOAD_SCHEMA)) == want == whole_file(spark, path)


def test_several_files_and_odd_items(spark, tmp_path, split_bytes):
    write(tmp_path, "a.json", '\n [ {"data":"1","valor":2.5} ,\n{"other":[1,2],"valor":"x"},{}] \n')
    write(tmp_path, "b.json", "[ ]")
    write(tmp_path, "c.json", '[{"data":"}","valor":null}]')
    write(tmp_path, "d.json", "")
    split_bytes(20)
    found = rows(read_json_array(spark, str(tmp_path), PAYLOAD_SCHEMA))
    assert found == sorted([("1", "2.5"), (None, "x"), (None, None), ("}", None)], key=repr)


@pytest.mark.parametrize("n_bytes", [9, 1 << 20])
@pytest.mark.parametrize(
    "text",
    [
        '{"data":"1"}',
        '[{"data":"1"}',
        '[{"data":"1"',
        '[{"data":"1"}]]',
        '[{"data":"1"}][{"data":"2"}]',
        '[{"data":"1"}{"data":"2"}]',
        '[{"data":"1"},{"data":"2"},]',
        '[{"data":"1"},,{"data":"2"}]',
        '[,{"data":"1"}]',
        '[{"data":"1"},[{"data":"2"}]',
        '[{"data":"1"}],{"data":"2"}]',
        '[{"data":"}"}][{"data":"}"}]',
        '[{"data":"}"}],{"data":"}"}]',
        '[{"data":{"a":"1"}}]',
        '[{"data":"1},{"data":"2"}]',
        '[{"data":"1}]',
        '[{"data" "1"}]',
        '[1,2]',
        "text",
    ],
)
def test_malformed_input_raises(spark, tmp_path, split_bytes, text, n_bytes):
    path = write(tmp_path, "p.json", text)
    split_bytes(n_bytes)
    with pytest.raises(Exception) as e:  # noqa: PT011 (SourceError at once, or Spark's error of an item)
        read_payload(spark, path).collect()
    assert isinstance(e.value, SourceError) or "flat object" in str(e.value) or "MALFORMED" in str(e.value)


def test_empty_payload(spark, tmp_path):
    for i, text in enumerate(["[]", "", " [\n] "]):
        path = write(tmp_path, f"{i}.json", text)
        assert read_json_array(spark, path, PAYLOAD_SCHEMA).count() == 0
        with pytest.raises(SourceError, match="empty payload"):
            read_payload(spark, path)
