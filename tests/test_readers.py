import json

import pytest
from pyspark.sql import functions as F

from siltworks.sources import csv_files, fingerprints, json_files, xml_files
from siltworks.sources.files import discover, list_files, manifest


def write(root, texts):
    for path, text in texts.items():
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_bytes(text if isinstance(text, bytes) else text.encode())
    return [str(root / p) for p in texts]


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_csv_files_by_their_own_headers(spark, tmp_path):
    paths = write(tmp_path, {
        "a/t.csv": "id,name,phone\n1,ann,11\n2,bob,22\n", "b/t.csv": "name,id,phone\ncarl,3,33\n", "c/t.csv": "﻿id,name,extra\n4,dora,x\n", "d d/é+%.csv": "\n\nid,name,phone\n5,eve,55\n",
        "e/t.csv": "id,name,phone\n6,Renée,66\n".encode("latin-1"), "f/t.csv": 'id,name,phone\n7,"two\nlines",77\n', "g/t.csv": "", "h/t.csv": "id,ID,,phone\n8,9,10,11\n", "i/t.csv": 'phone,"a\nname"\n12,x\n', "j/t.csv": "id,name,phone\n",
    })
    found = csv_files.read_csv(spark, paths)
    assert found.columns == ["id", "name", "phone", "extra", "id0", "ID1", "_c2", "a\nname"] or sorted(found.columns) == sorted(["id", "name", "phone", "extra", "id0", "ID1", "_c2", "a\nname"])
    assert rows(found, "id", "name", "phone", "extra") == sorted(
        [("1", "ann", "11", None), ("2", "bob", "22", None), ("3", "carl", "33", None), ("4", "dora", None, "x"), ("5", "eve", "55", None), ("6", "Renée", "66", None), ("7", "two\nlines", "77", None), (None, None, "11", None), (None, None, "12", None)], key=str
    )
    assert len(csv_files.kinds_of_files(spark, paths)) == 7
    with pytest.raises(ValueError, match="no header"):
        csv_files.read_csv(spark, [paths[6]])


def test_json_of_any_form_gives_the_same_rows(spark, tmp_path):
    records = [{"id": 1, "name": "a", "in": {"x": 1.5}}, {"id": 2, "name": "b", "tags": [1, 2]}, {"id": 3, "mixed": 1}, {"id": 4, "mixed": "text", "odd `name": True}]
    lines, array, pretty = "\n".join(map(json.dumps, records)), json.dumps(records), json.dumps(records, indent=1)
    forms = {"lines.json": "﻿" + lines + "\n\n", "array.json": array, "pretty.json": pretty}
    for path in write(tmp_path, forms):
        got = json_files.read_json(spark, [path])
        assert dict(got.dtypes) == {"id": "bigint", "in": "struct<x:double>", "mixed": "string", "name": "string", "odd `name": "boolean", "tags": "array<bigint>"}
        assert rows(got, "id", "name", "mixed") == [(1, "a", None), (2, "b", None), (3, None, "1"), (4, None, "text")]
    assert json_files.read_json(spark, [str(tmp_path / f) for f in forms]).count() == 12
    wrapped = write(tmp_path / "w", {"1.json": json.dumps({"rows": records}, indent=2), "2.json": json.dumps({"id": 9}), "3.json": pretty})
    assert rows(json_files.read_rows(spark, wrapped), "id") == [(1,), (1,), (2,), (2,), (3,), (3,), (4,), (4,), (9,)]
    objects = write(tmp_path / "o", {"1.json": json.dumps({"k": records, "one": {"id": 7}, "n": 5, "s": [1, "x"]}, indent=2), "2.json": json.dumps({"k": records[:1]}), "3.json": pretty})
    assert rows(json_files.read_wrapped(spark, objects), "id") == [(1,), (1,), (1,), (2,), (2,), (3,), (3,), (4,), (4,), (7,)]


def test_broken_json_is_told(spark, tmp_path):
    path = write(tmp_path, {"a.json": '{"id": 1}\nno json\n{"id": 2}\n5\n'})
    assert rows(json_files.read_json(spark, path), "id", "_corrupt_record") == [(1, None), (2, None), (None, "no json")]
    path = write(tmp_path, {"b.json": "{\n no json"})
    assert rows(json_files.read_json(spark, path), "_corrupt_record") == [("a document that is no JSON, or too large",)]
    assert json_files.read_json(spark, write(tmp_path, {"c.json": ""})).count() == 0


def test_lines_are_split_into_tasks(spark, tmp_path):
    path = write(tmp_path, {"a.json": "\n".join(json.dumps({"id": i, "pad": "x" * 50}) for i in range(5000))})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = json_files.read_json(spark, path)
        assert got.rdd.getNumPartitions() >= 4 and got.agg(F.sum("id")).first()[0] == sum(range(5000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_xml_children_of_any_tag(spark, tmp_path):
    paths = write(tmp_path, {
        "1.xml": "\ufeff<?xml version='1.0'?>\n<!-- <no>\n -->\n<!DOCTYPE all [<!ELEMENT a ANY>]>\n<all>\n<a><x>1</x></a><b><x>2</x><y>t</y></b><a><x>3</x><b><x>9</x></b></a><n>5</n></all>",
        "2.xml": "<all><c k='v'><z>4</z></c></all>", "3.xml": "<other><a><x>5</x></a></other>",
    })
    got = xml_files.read_xml(spark, paths)
    # a <b> inside an <a> is no child of the root
    assert rows(got, "x", "y", "z") == sorted([("1", None, None), ("2", "t", None), ("3", None, None), (None, None, "4"), ("5", None, None)], key=str)
    with pytest.raises(ValueError, match="no root"):
        xml_files.read_xml(spark, write(tmp_path, {"4.xml": "nothing"}))


def test_fingerprints_do_not_depend_on_ranges(spark, tmp_path):
    text = "\n".join(f"line {i} {'x' * (i % 90)}" for i in range(20_000))
    paths = write(tmp_path / "f", {"a b.csv": text, "same.csv": text, "swapped.csv": text.replace("line 1 ", "line 2 ", 1), "bytes.csv": bytes(range(256)) * 40, "empty.csv": ""})
    seen = []
    for size in ("100m", "200k", "37k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        seen.append(sorted(map(tuple, fingerprints.fingerprints(spark, paths).collect())))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 4
    digests = [d for _, d, _ in seen[0]]
    assert len(set(digests)) == 3
    one, two = [(1, 5, 7), (2, 11, 13)], [(3, 17, 19)]
    left = fingerprints.joined(fingerprints.joined(one[0], one[1]), two[0])
    assert left == fingerprints.joined(one[0], fingerprints.joined(one[1], two[0]))


def test_manifest_sees_every_change(spark, tmp_path):
    root = tmp_path / "raw"
    write(root, {"source_file/a b+é%.csv": "id\n1\n2\n", "source_file/e.csv": "", "x/public/t/1.json": "{}"})

    def hashes():
        return {r["group_key"]: r["hash"] for r in manifest(spark, str(root), discover(list_files(spark, str(root)))).collect()}

    before = hashes()
    assert len(before) == 3 and hashes() == before
    write(root, {"source_file/a b+é%.csv": "id\n2\n1\n"})
    assert {k for k, v in hashes().items() if v != before[k]} == {"source_file/a b+é%"}
    write(root, {"source_file/a b+é%.csv": "id\r\n1\r\n2\r\n", "source_file/e.csv": "\n"})
    assert {k for k, v in hashes().items() if v != before[k]} == {"source_file/a b+é%", "source_file/e"}
