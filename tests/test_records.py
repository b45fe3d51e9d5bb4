"""CSV records of several lines, read split by split."""

import csv
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from basketmill.schemas import struct
from basketmill.sources import files, records
from conftest import rows

SPLIT = "spark.sql.files.maxPartitionBytes"
SCHEMA = struct(id=StringType(), note=StringType(), last=StringType())


@pytest.fixture
def splits(spark):
    """Splits of a few kilobytes, so that a small file has many."""
    before = spark.conf.get(SPLIT)
    spark.conf.set(SPLIT, "4096")
    yield
    spark.conf.set(SPLIT, before)


def whole_file_read(spark, path):
    """Spark's own reader, one task per file."""
    return spark.read.options(**files.DIALECT, multiLine=True).csv(path)


def bag(df):
    return sorted(((r.id, r.note, r.last) for r in df.select("id", "note", "last").collect()), key=repr)


def note(rng):
    words = ["plain", 'say ""so""', "a,b", "x\ny", "\n", "cr\r\nlf", '""', "é 語", " ", "'", "\\", '\\""', "\n\n\n", '""\n""']
    return " ".join(rng.choice(words) for _ in range(rng.randrange(12)))


def quoted_file(path, count, seed, ending="\n", longest=0):
    rng = random.Random(seed)
    with open(path, "w", newline="") as out:
        out.write(f"id,note,last{ending}")
        for i in range(count):
            text = note(rng) if i % 50 != 7 else note(rng) + "\n".join(str(k) for k in range(rng.randrange(longest + 1)))
            out.write(f'{i},"{text}",{rng.choice(["z", "", chr(34) + "q" + chr(34)])}{ending}')
            if i % 40 == 3:
                out.write(ending)
    return str(path)


@pytest.mark.parametrize("ending,longest", [("\n", 0), ("\r\n", 0), ("\n", 9000)])
def test_one_large_file_equals_the_whole_file_read(spark, splits, tmp_path, ending, longest):
    path = quoted_file(tmp_path / "t.csv", 700, len(ending) + longest, ending, longest)
    lines = records.split_lines(spark, path)
    n_splits = lines.select("_part").distinct().count()
    assert n_splits > 5
    # Records really begin in one split and end in another.
    assert lines.groupBy("_part").agg(F.count_if("toggles").alias("n")).where("n % 2 = 1").count() > 0
    assert lines.rdd.getNumPartitions() > 1
    got = files.read_csv(spark, path, SCHEMA, multi_line=True)
    with open(path, newline="") as source:
        want = [(r["id"], files_blank(r["note"]), files_blank(r["last"])) for r in csv.DictReader(source)]
    assert len(want) == 700 and bag(got) == sorted(want, key=repr)
    if ending == "\n":  # where lines end in two signs, Spark's reader shortens those inside cells too
        whole = whole_file_read(spark, path).collect()
        assert bag(got) == sorted(((r.id, files_blank(r.note), files_blank(r.last)) for r in whole), key=repr)


def files_blank(text):
    """Blank cells are null in ``read_csv``."""
    return None if text is None or not text.strip(" ") else text


def test_as_many_tasks_as_splits(spark, splits, tmp_path):
    path = quoted_file(tmp_path / "t.csv", 2000, 5)
    read = spark.read.option("lineSep", "\n").text(path)
    assert read.rdd.getNumPartitions() > 10
    assert records.split_lines(spark, path).select("_part").distinct().count() >= read.rdd.getNumPartitions()


def test_record_over_several_splits(spark, splits, tmp_path):
    """One cell is longer than three splits, with commas and doubled quotes, and another record follows on its last line."""
    cell = "\n".join(f'line {i}, ""{i}""' for i in range(900))
    path = tmp_path / "t.csv"
    path.write_text(f'id,note,last\n1,"{cell}",a\n2,short,b\n3,"x\n",c\n')
    got = files.read_csv(spark, str(path), SCHEMA, multi_line=True)
    assert bag(got) == sorted([("1", cell.replace('""', '"'), "a"), ("2", "short", "b"), ("3", "x\n", "c")], key=repr)


def test_folder_of_files_each_with_a_header(spark, splits, tmp_path):
    for k in range(3):
        quoted_file(tmp_path / f"{k}.csv", 150, k)
    got = files.read_csv(spark, str(tmp_path), SCHEMA, multi_line=True)
    assert got.count() == 450 and got.where("id = 'id'").count() == 0
    assert bag(got) == sorted(
        ((r.id, files_blank(r.note), files_blank(r.last)) for r in whole_file_read(spark, str(tmp_path)).collect()), key=repr
    )


def test_odd_layouts(spark, tmp_path):
    """Header over two lines, blank lines before it, no line break at the end, short and long records, a byte order mark."""
    cases = {
        "a": '\n\n"id","note","la\nst"\n1,"a\nb",2\n\n3,c,4',
        "b": "id,note,last\n1\n2,x,y,extra\n",
        "c": "﻿id,note,last\n1,é,2\n",
        "d": "id,note,last\n",
    }
    for name, text in cases.items():
        path = tmp_path / f"{name}.csv"
        path.write_text(text)
        want = whole_file_read(spark, str(path))
        got = records.parsed_records(records.joined_records(records.split_lines(spark, str(path))), want.columns, files.DIALECT)
        assert rows(got) == rows(want), name
    path = tmp_path / "empty.csv"
    path.write_text("")
    assert records.joined_records(records.split_lines(spark, str(path))).count() == 0


def test_open_cell_fails_the_job(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id,note,last\n1,"no end,2\n3,x,4\n')
    with pytest.raises(Exception, match="a quoted cell of the file has no end"):
        files.read_csv(spark, str(path), SCHEMA, multi_line=True).collect()


def test_bulk_load_of_a_quoted_file(spark, splits, tmp_path):
    path = quoted_file(tmp_path / "t.csv", 600, 11)
    good, bad = files.load_typed(spark, path, struct(id=IntegerType(), note=StringType()), multi_line=True)
    assert good.count() == 600 and bad.count() == 0
    assert sorted(r.id for r in good.collect()) == list(range(600))
    with open(path, newline="") as source:
        notes = {int(r["id"]): r["note"] for r in csv.DictReader(source)}
    assert {r.id: r.note for r in good.collect()} == {i: files_blank(t) for i, t in notes.items()}
