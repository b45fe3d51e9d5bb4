from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType

from basketmill.functions import parsing
from basketmill.operators import cleaning, relational
from basketmill.schemas import FREE_TEXT, INVENTORY, RAW, WIDE, struct
from basketmill.session import shared_folder, stage
from basketmill.sources import files, tables
from conftest import rows
from retail_data import as_money, bag, raw_rows, widen


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_typed_cells(spark, tmp_path):
    path = write(
        tmp_path / "t.csv",
        'n,f,d,s\n7,7.5,2024-01-31,text\n , ,,"  "\n x,1,2024-01-31 10:00:00,""\n 8 ,-2,bad,"a,b"\n',
    )
    schema = struct(n=IntegerType(), f=DoubleType(), d=DateType(), s=StringType())
    got = [tuple(r) for r in files.read_csv(spark, path, schema).collect()]
    assert got == [
        (7, 7.5, date(2024, 1, 31), "text"),
        (None, None, None, None),
        (None, 1.0, date(2024, 1, 31), None),
        (8, -2.0, None, "a,b"),
    ]


def test_inferred_types_are_per_column(spark, tmp_path):
    path = write(tmp_path / "t.csv", "a,b,mixed\n1,1.5,1\n2,2.5,x\n")
    assert dict(files.read_csv(spark, path, infer=True).dtypes) == {"a": "int", "b": "double", "mixed": "string"}
    assert set(dict(files.read_csv(spark, path).dtypes).values()) == {"string"}


def test_only_wanted_columns_are_read(spark, tmp_path):
    path = write(tmp_path / "t.csv", "a,b,c\n1,2,3\n")
    df = files.read_csv(spark, path, struct(c=WIDE["order_id"].dataType, a=WIDE["order_item_id"].dataType))
    assert rows(df) == [("3", 1)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:string,c:string>" in plan
    assert rows(files.read_csv(spark, path, columns=["b"])) == [("2",)]
    with pytest.raises(ValueError, match="no column d"):
        files.read_csv(spark, path, struct(d=WIDE["order_id"].dataType))
    with pytest.raises(AnalysisException):
        files.read_csv(spark, str(tmp_path / "absent.csv"), RAW["orders"])


def test_byte_order_mark(spark, tmp_path):
    path = write(tmp_path / "t.csv", "﻿name,english\ncama,bed\n")
    assert rows(files.read_csv(spark, path, struct(name=WIDE["order_id"].dataType))) == [("cama",)]


def test_folder_of_tables(spark, tmp_path):
    """Views over a folder: typed where a schema is given, aliases, two tables, LIMIT, and what must fail."""
    write(tmp_path / "van.csv", "plate,depot,load_kg\n" + "".join(f"V{i},{i % 3},{100 * i}\n" for i in range(12)))
    write(tmp_path / "depot.csv", "depot,town\n0,North\n1,South\n")
    (tmp_path / "notes.txt").write_text("x")
    schema = struct(plate=StringType(), depot=IntegerType(), load_kg=IntegerType())
    assert files.register_folder(spark, str(tmp_path), {"van": schema}) == ["depot", "van"]
    assert spark.table("van").schema == schema and spark.table("depot").schema.names == ["depot", "town"]
    assert spark.table("depot").schema["depot"].dataType == StringType()
    assert spark.sql("SELECT plate FROM van WHERE load_kg >= 900").count() == 3
    met = spark.sql("SELECT v.plate AS which, d.town FROM van AS v, depot AS d WHERE v.depot = d.depot")
    assert met.columns == ["which", "town"] and met.count() == 8
    assert spark.sql("SELECT v.plate FROM van v, depot d LIMIT 7").count() == 7
    with pytest.raises(AnalysisException, match="AMBIGUOUS"):
        spark.sql("SELECT depot FROM van, depot")
    with pytest.raises(AnalysisException):
        spark.sql("SELECT absent FROM van")
    with pytest.raises(ParseException):
        spark.sql("SELEC 1")


HARD_TEXT = (
    "plain", 'a "quoted" word', '"all quoted"', "line\nbreak", "cr\r\nlf", 'both\n""x""', "a,b", "back\\slash", 'end\\"', " spaces ", "'", "#x", "é ß",
    'x",y', "\ttab",
)


def test_hard_text_comes_back(spark, tmp_path):
    schema = struct(comment=StringType(), n=IntegerType(), last=StringType())
    data = [(t, i, t[::-1]) for i, t in enumerate(HARD_TEXT)] + [(None, 99, None)]
    files.write_csv(spark.createDataFrame(data, schema).coalesce(2), str(tmp_path / "out"))
    back = files.read_csv(spark, str(tmp_path / "out"), schema, multi_line=True)
    assert rows(back) == sorted(data, key=repr)
    # Needed columns after a text column, without reading it.
    assert rows(files.read_csv(spark, str(tmp_path / "out"), struct(n=IntegerType()), multi_line=True)) == sorted([(d[1],) for d in data], key=repr)


def test_reviews_with_line_breaks(spark, tmp_path):
    text = 'comment,review_id,order_id,review_score\n"really good,\n""very"" good",r1,o1,5\n,r2,o2,\n"one ""ok""",r3,o3,4\n'
    write(tmp_path / "order_reviews.csv", text)
    found = files.read_raw_tables(spark, str(tmp_path), {"order_reviews": RAW["order_reviews"]}, free_text=FREE_TEXT)
    assert rows(found["order_reviews"]) == [("r1", "o1", 5), ("r2", "o2", None), ("r3", "o3", 4)]
    single = text.replace(",\n", ",", 1)
    write(tmp_path / "flat.csv", single)
    assert rows(files.read_csv(spark, str(tmp_path / "flat.csv"), RAW["order_reviews"])) == rows(found["order_reviews"])


def test_landing_counts_unfit_values(spark, tmp_path):
    path = write(tmp_path / "t.csv", "a,b,c\n1,2.5,x\nbad,1,y\nworse,none,z\n,,\n")
    schema = struct(a=IntegerType(), b=WIDE["price"].dataType, c=StringType())
    landed = files.land_csv(spark, path, schema, str(tmp_path / "landed"))
    assert landed.count() == 4 and "parquet" in landed._jdf.queryExecution().executedPlan().toString().lower()
    assert rows(files.unfit_counts({"t": landed})) == [("unfit t.a", 2), ("unfit t.b", 1), ("unfit t.c", 0)]


def csv_text(columns, data):
    lines = [",".join(columns)]
    lines += [",".join("" if v is None else str(v) for v in r) for r in data]
    return "\n".join(lines) + "\n"


def test_raw_files_to_wide_csv_and_back(spark, tmp_path):
    data = raw_rows()
    raw = tmp_path / "raw"
    raw.mkdir()
    for name, schema in RAW.items():
        write(raw / f"shop_{name}.csv", csv_text(["extra", *schema.names], [("e", *r) for r in data[name]]))
    loaded = files.read_raw_tables(spark, str(raw), RAW, "shop_{name}.csv")
    wide = cleaning.clean_wide(loaded)
    files.write_csv(wide, str(tmp_path / "wide"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "wide").glob("*.csv")))
    assert "2017-11-05 10:00:00" in text and "T10:00" not in text
    back, bad = files.load_typed(spark, str(tmp_path / "wide"), WIDE)
    assert bad.count() == 0
    assert dict(back.dtypes) == dict(wide.dtypes)
    assert bag(tuple(r) for r in back.collect()) == bag(as_money(widen(data)))


def test_rows_that_do_not_fit_are_set_aside(spark, tmp_path):
    schema = struct(a=WIDE["order_item_id"].dataType, b=WIDE["price"].dataType)
    path = write(tmp_path / "t.csv", "a,b\n1,2.50\nx,1\n2,\n")
    good, bad = files.load_typed(spark, path, schema)
    assert rows(good) == [(1, Decimal("2.50")), (2, None)]
    assert rows(bad) == [("x", "1", "a")]
    assert good.select("b").count() == 2 and rows(good, "b") == [(Decimal("2.50"),), (None,)]


def test_query_with_bound_values(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b' OR 1=1")], "k int, s string")
    found = tables.query(spark, "SELECT k FROM {t} WHERE s = :s", {"t": df}, {"s": "b' OR 1=1"})
    assert rows(found) == [(2,)]


def test_create_append_reload(spark, tmp_path):
    path = str(tmp_path / "inventory")
    for _ in range(2):  # the second call finds the table there
        tables.create_table(spark, "inventory_test", INVENTORY, path)
    try:
        df = spark.createDataFrame([(datetime(2024, 1, 1), 5, "p1")], "updated_at timestamp_ntz, stock_count int, product_id string")
        tables.append_rows(df, "inventory_test")
        tables.append_rows(df, "inventory_test")
        assert rows(spark.table("inventory_test")) == [("p1", 5, datetime(2024, 1, 1))] * 2
        first = tables.reload(spark.table("inventory_test"), "inventory_version")
        second = tables.reload(
            spark.table("inventory_version").withColumn("stock_count", F.col("stock_count") + 1), "inventory_version"
        )
        assert first != second
        assert [r.stock_count for r in spark.table("inventory_version").collect()] == [6, 6]
    finally:
        spark.sql("DROP TABLE inventory_test")


def test_publish_and_stage(spark):
    df = spark.range(10).withColumn("even", F.col("id") < 5)
    tables.publish({"numbers": df}, "x_")
    assert spark.table("x_numbers").count() == 10
    staged = stage(df, "numbers")
    assert rows(staged) == rows(df)
    assert shared_folder(spark)


def test_staged_tables_can_be_released(spark, tmp_path, monkeypatch):
    from basketmill import session

    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    staged = stage(spark.range(5), "numbers")
    assert staged.count() == 5 and any(tmp_path.rglob("*.parquet"))
    session.release(spark)
    assert not any(tmp_path.rglob("*.parquet"))


def test_session_settings_stay_as_found(spark, small):
    import __spark_entry__ as contract

    before = dict(spark.conf.getAll)
    for name in ("clean_wide", "stock_allocation", "gate_stream_valid"):
        contract.queries()[name](spark, small).count()
    assert dict(spark.conf.getAll) == before


def test_tolerant_parsing(spark):
    text = spark.createDataFrame([("7",), (" 7 ",), ("7.5",), ("2024-01-31",), ("2024-01-31 10:00:00",), ("x",), ("",), (None,)], "c string")
    c = F.col("c")
    got = text.select(
        parsing.parse_integer(c).alias("i"), parsing.parse_number(c).alias("n"), parsing.parse_date(c).alias("d"),
        parsing.parse_time(c).alias("t"), parsing.blank_to_null(c).alias("b"),
    ).collect()
    assert [r.i for r in got] == [7, 7, None, None, None, None, None, None]
    assert [r.n for r in got] == [7.0, 7.0, 7.5, None, None, None, None, None]
    assert [r.d for r in got] == [None, None, None, date(2024, 1, 31), None, None, None, None]
    assert got[4].t == datetime(2024, 1, 31, 10) and got[5].t is None
    assert [r.b for r in got][6:] == [None, None]


def test_product_and_inequality(spark):
    left, right = spark.range(7).toDF("a"), spark.range(5).toDF("b")
    assert rows(relational.product(left, right)) == [(a, b) for a in range(7) for b in range(5)]
    want = [(a, b) for a in range(7) for b in range(5) if a > b]
    assert rows(relational.theta_join(left, right, left["a"] > right["b"])) == want


def test_exists_and_null_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    other = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(relational.present_in(df, other, ["k"])) == [(1,), (1,)]
    assert rows(relational.absent_from(df, other, ["k"])) == [(2,), (None,)]
