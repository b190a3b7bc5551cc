"""Readers of byte ranges give the rows of the whole file, wherever the ranges begin."""

import csv
import io
import json
import random

import pytest

from formflow import sources
from formflow.schemas import ExportLayout
from formflow.sources import splits

ODD = ["plain", "a } b", 'q"}"{ x', "back\\slash", "\\\\}", "é,[]{}", " ", "line\nbreak", '"' * 3, "}" * 5, "]", ""]


@pytest.fixture
def split_size(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def put(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield put
    for n, v in before.items():
        spark.conf.set(n, v)


def objects(seed, n, nested):
    rng = random.Random(seed)
    for i in range(n):
        o = {"record": str(i), "field_name": "f", "value": rng.choice(ODD if nested else ODD[:1])}
        yield o | ({"more": {"a": {"b": [{"c": "}"}, {}]}}, "value": None} if nested and rng.random() < 0.2 else {})


@pytest.mark.parametrize("size", [97, 1000, 1 << 20])
def test_json_arrays(spark, tmp_path, split_size, size):
    files = {"easy": list(objects(1, 150, False)), "odd": list(objects(2, 60, True)), "deep": list(objects(3, 60, True)), "none": []}
    for i, (name, rows) in enumerate(files.items()):
        (tmp_path / f"{name}.json").write_text(("﻿" if i == 1 else "") + json.dumps(rows, indent=2 if i == 2 else None, ensure_ascii=i != 1) + "\n" * i, encoding="utf-8")
    split_size(size)
    got = splits.json_array_objects(spark, str(tmp_path))
    text = lambda o: json.dumps(o, sort_keys=True)
    assert sorted(text(json.loads(r.value)) for r in got.collect()) == sorted(text(o) for rows in files.values() for o in rows)


@pytest.mark.parametrize("text", ['[{"a":1},{"a":2}', '[{"a":1},{"a":2', '[{"a":"x}]', '[{"a":{"b":1}]', '[{"a":1}}]', '[{"a":1}', "[", '[{"a":"}'])
def test_cut_json_arrays_fail(spark, tmp_path, split_size, text):
    (tmp_path / "x.json").write_text(text)
    split_size(7)
    with pytest.raises(Exception, match="no whole JSON array"):
        splits.json_array_objects(spark, str(tmp_path)).collect()


def test_array_export_is_read_by_many_tasks_without_a_shuffle_of_its_rows(spark, tmp_path, split_size):
    (tmp_path / "x.json").write_text(json.dumps([{"rid": str(i), "centre": "c", "field_name": "f", "value": str(i)} for i in range(20_000)]))
    split_size(64 << 10)
    df = sources.read_eav_json(spark, str(tmp_path), ExportLayout("rid", "centre"), array_files=True)
    assert df.rdd.getNumPartitions() > 8 and df.count() == 20_000
    assert df.select("record").distinct().count() == 20_000


@pytest.mark.parametrize("size", [61, 1000, 1 << 20])
def test_csv_in_file_order(spark, tmp_path, split_size, size):
    rng, want = random.Random(1), []
    for f, (end, quoting) in enumerate([("\n", csv.QUOTE_MINIMAL), ("\r\n", csv.QUOTE_ALL), ("\n", csv.QUOTE_MINIMAL)]):
        rows = [[f"n{f}_{i}", rng.choice(["plain", "two\nlines", 'say "x"', "a,b", "", "\n\n x", '"', "é\r\nü", '",\n"']), "z"] for i in range(100)]
        out = io.StringIO(newline="")
        csv.writer(out, lineterminator=end, quoting=quoting).writerows([["field_name", "field_label", "other"], *rows])
        text = out.getvalue().replace("\nn2_7", "\n\nn2_7")  # an empty line is no record
        with open(tmp_path / f"f{f}.csv", "w", newline="", encoding="utf-8") as file:
            file.write(("﻿" if f == 1 else "") + (text if f else text.rstrip("\n")))
        want += rows
    split_size(size)
    got = sources.read_dictionary(spark, str(tmp_path)).orderBy("row_seq").collect()
    assert [r.row_seq for r in got] == list(range(1, 301))
    assert [[r.field_name, r.field_label or "", r.other] for r in got] == want


def test_an_open_quote_fails(spark, tmp_path):
    (tmp_path / "x.csv").write_text('field_name,field_label\na,"b\nc,d\n')
    with pytest.raises(Exception, match="never closed"):
        sources.read_dictionary(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("size", [1000, 1 << 20])
def test_a_byte_range_is_sorted_in_stretches(spark, tmp_path, split_size, monkeypatch, size):
    """What one task sorts followed the byte range: no block has more than 2 ** STRETCH pieces, and the rows stay the same."""
    monkeypatch.setattr(splits, "STRETCH", 3)
    rows = list(objects(4, 200, True))
    (tmp_path / "json").mkdir()
    (tmp_path / "json" / "x.json").write_text(json.dumps(rows))
    split_size(size)
    text = lambda o: json.dumps(o, sort_keys=True)
    got = splits.json_array_objects(spark, str(tmp_path / "json")).collect()
    assert sorted(text(json.loads(r.value)) for r in got) == sorted(map(text, rows))
    (tmp_path / "x.csv").write_text("field_name,field_label\n" + "".join(f'n{i},"a\nb ""{i}""\n"\n' for i in range(300)))
    blocks = splits.csv_blocks(spark, str(tmp_path / "x.csv"))
    assert blocks.where("high - low >= 8").count() == 0 and blocks.count() > 100
    got = sources.read_dictionary(spark, str(tmp_path / "x.csv")).orderBy("row_seq").collect()
    assert [(r.row_seq, r.field_name, r.field_label) for r in got] == [(i + 1, f"n{i}", f'a\nb "{i}"\n') for i in range(300)]


def test_rows_of_an_array_move_once(spark, tmp_path):
    """Braces inside texts: the pieces were shuffled for every join with the table of blocks."""
    (tmp_path / "x.json").write_text(json.dumps([{"record": str(i), "value": f"{i} }}"} for i in range(2000)]))
    df = splits.json_array_objects(spark, str(tmp_path)).select("value")
    assert df.count() == 2000
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_another_split_of_the_files_fails(spark, tmp_path, split_size):
    (tmp_path / "x.csv").write_text("field_name,field_label\n" + "".join(f'n{i},"a\nb"\n' for i in range(300)))
    split_size(1000)
    blocks = splits.csv_blocks(spark, str(tmp_path))
    split_size(300)
    with pytest.raises(Exception, match="split otherwise"):
        splits.csv_records(spark, str(tmp_path), blocks).collect()
