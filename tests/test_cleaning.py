from collections import Counter

import pytest

from basketmill.operators import cleaning, modelling
from basketmill.schemas import NORMAL_FORM, WIDE_COLUMNS
from retail_data import as_money, bag, frames, random_rows, raw_rows, widen


def collected(df):
    return bag(tuple(r) for r in df.collect())


def test_wide_rows_of_the_small_tables(spark):
    wide = cleaning.clean_wide(frames(spark))
    assert tuple(wide.columns) == WIDE_COLUMNS
    assert collected(wide) == bag(as_money(widen(raw_rows())))
    got = {(r.order_id, r.order_item_id, r.review_id): r for r in wide.collect()}
    # Two reviews multiply two items; undelivered, unreadable, unreviewed and unknown drop out.
    assert {k[0] for k in got} == {"o1", "o2", "o3"} and len(got) == 6
    assert got["o1", 2, "r2"].product_category_name == "Unknown"
    assert got["o1", 2, "r2"].review_score == 3


def test_report(spark):
    report = {r.metric: r.value for r in cleaning.cleaning_report(frames(spark)).collect()}
    assert report == {
        "orders_in": 7,
        "orders_undelivered": 2,
        "orders_kept": 5,
        "categories_filled": 1,
        "reviews_unscored": 1,
        "orders_without_review": 1,
        "scores_filled": 2,
        "wide_rows": 6,
    }


@pytest.mark.parametrize("seed", range(3))
def test_random_tables(spark, seed):
    data = random_rows(seed)
    tables = frames(spark, data)
    wide = as_money(widen(data))
    assert wide
    frame = cleaning.clean_wide(tables)
    assert collected(frame) == bag(wide)

    report = {r.metric: r.value for r in cleaning.cleaning_report(tables).collect()}
    assert report["wide_rows"] == len(wide)
    assert report["orders_kept"] + report["orders_undelivered"] == report["orders_in"] == len(data["orders"])

    # Distinct projections of the wide rows, however they are reached.
    decomposed = modelling.decompose(frame)
    direct = modelling.normal_form(tables)
    for name, spec in NORMAL_FORM.items():
        places = [WIDE_COLUMNS.index(c) for c in spec.columns]
        want = Counter({tuple(str(r[i]) if hasattr(r[i], "quantize") else r[i] for i in places): 1 for r in wide})
        for form in (decomposed, direct):
            assert form[name].columns == list(spec.columns)
            assert collected(form[name]) == want, name


def test_empty_tables(spark):
    tables = frames(spark, {name: [] for name in raw_rows()})
    assert cleaning.clean_wide(tables).count() == 0
    assert {r.value for r in cleaning.cleaning_report(tables).collect()} == {0}


def test_time_text(spark):
    rows = cleaning.with_time_text(cleaning.clean_wide(frames(spark))).filter("order_id = 'o2'").collect()
    assert rows[0].order_purchase_timestamp == "2017-11-05 10:00:00"
