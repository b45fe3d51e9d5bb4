from decimal import Decimal

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from basketmill.operators import cleaning, gate, modelling, policy, quality
from basketmill.schemas import (
    DEPENDENCIES,
    FREIGHT_RULE,
    NORMAL_FORM,
    REFERENCES,
    Dependency,
    Reference,
    id_rules,
)
from conftest import rows
from retail_data import frames, random_rows, widen


def money(*pairs):
    return [(i, None if p is None else Decimal(p), None if f is None else Decimal(f)) for i, (p, f) in enumerate(pairs)]


MONEY = "id int, price decimal(10,2), freight_value decimal(10,2)"


def test_clean_model_passes_every_check(spark):
    tables = frames(spark)
    model = modelling.normal_form(tables)
    keys = {name: spec.key for name, spec in NORMAL_FORM.items()}
    assert {r.duplicated_keys for r in quality.duplicate_keys(model, keys).collect()} == {0}
    assert {r.orphans for r in quality.orphans(model, REFERENCES).collect()} == {0}
    assert {r.violations for r in quality.dependency_check(model, DEPENDENCIES).collect()} == {0}
    assert {r.violations for r in quality.not_null(model).collect()} == {0}
    grains = {n: (s.columns if n == "order_items" else s.key) for n, s in NORMAL_FORM.items()}
    assert all(r.matches for r in quality.grain(cleaning.clean_wide(tables), model, grains).collect())
    counts = quality.row_counts(model)
    assert dict(rows(counts)) == {"customers": 2, "products": 3, "orders": 3, "order_items": 4, "order_reviews": 4}
    assert quality.readiness(counts, ("products", "orders")).first().status == "ready"
    assert quality.readiness(counts, ("products", "absent")).first().status == "required data is missing"


def test_counts_each_fault(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "x" * 40)], "k int, s string")
    assert rows(quality.not_null({"t": df})) == [("t", "k", 1), ("t", "s", 1)]
    rules = {"t": {"k_small": "k < 2", **id_rules("s")}}
    # A null outcome keeps the row.
    assert rows(quality.check_rules({"t": df}, rules)) == [("t", "k_small", 1), ("t", "s_fits", 1)]
    assert rows(quality.duplicate_keys({"t": df}, {"t": ("k",)})) == [("t", "k", 1)]


def test_orphans_count_rows_and_null_keys(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "k int")
    parent = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    found = quality.orphans({"c": child, "p": parent}, [Reference("c", "k", "p")])
    assert rows(found) == [("c", "k", "p", 4)]


@pytest.mark.parametrize(
    "right, broken",
    [
        ([(1, "a"), (1, "a")], False),
        ([(1, "a"), (2, "a")], True),
        ([(None, "a"), (1, "a")], True),
        ([(None, None), (None, None)], False),
        ([(1, None), (1, "a")], True),
    ],
)
def test_dependency_with_nulls(spark, right, broken):
    df = spark.createDataFrame([("k", *r) for r in right] + [("other", 5, "z")], "l string, x int, y string")
    result = quality.dependency_check({"t": df}, [Dependency("D", "t", ("l",), ("x", "y"))]).first()
    assert (result.determinants, result.violations) == (2, int(broken))


@pytest.mark.parametrize("seed", range(2))
def test_dependencies_and_redundancy_against_the_wide_rows(spark, seed):
    data = random_rows(seed)
    tables = frames(spark, data)
    wide = widen(data)
    names = cleaning.WIDE_COLUMNS
    model = modelling.normal_form(tables)
    got = {r.dependency: r for r in quality.dependency_check(model, DEPENDENCIES).collect()}
    repeated = {
        r.dependency: r
        for r in quality.redundancy(cleaning.wide_counts(cleaning.order_tally(tables)), model, DEPENDENCIES).collect()
    }
    for d in DEPENDENCIES:
        seen = {}
        for r in wide:
            row = dict(zip(names, r))
            seen.setdefault(tuple(row[c] for c in d.left), set()).add(tuple(row[c] for c in d.right))
        assert (got[d.name].determinants, got[d.name].violations) == (len(seen), sum(len(v) > 1 for v in seen.values()))
        assert (repeated[d.name].wide_rows, repeated[d.name].distinct_facts) == (len(wide), len(seen))


def test_gate_splits_and_names_the_reason(spark):
    data = money(("100", "150"), ("100", "100"), ("100", "99.99"), (None, "5"), ("5", None))
    valid, rejected = gate.split(spark.createDataFrame(data, MONEY), FREIGHT_RULE)
    assert sorted(r.id for r in valid.collect()) == [1, 2, 3, 4]
    assert rows(rejected, "id", "reason") == [(0, "freight_not_above_price")]
    two = {**FREIGHT_RULE, "price_small": "price < 50"}
    assert rows(gate.split(spark.createDataFrame(data, MONEY), two)[1], "id", "reason") == [
        (0, "freight_not_above_price,price_small"),
        (1, "price_small"),
        (2, "price_small"),
    ]


def test_enforce_stops_the_job_and_names_both_values(spark):
    rule, message = FREIGHT_RULE["freight_not_above_price"], gate.freight_message()
    good = spark.createDataFrame(money(("100", "100"), (None, "5")), MONEY)
    assert gate.enforce(good, rule, message).count() == 2
    bad = spark.createDataFrame(money(("1", "1"), ("100", "150")), MONEY)
    with pytest.raises(SparkRuntimeException, match="freight_value 150.00 exceeds price 100.00"):
        gate.enforce(bad, rule, message).select("id").collect()


def test_hidden_column_is_gone(spark):
    model = modelling.normal_form(frames(spark))
    policy.create_public_view(model["order_items"], model["products"])
    view = spark.table(policy.PUBLIC_VIEW)
    assert view.columns == ["order_id", "order_item_id", "product_id", "product_category_name", "price"]
    assert "freight_value" in policy.visible(policy.with_category(model["order_items"], model["products"]), "admin").columns
    with pytest.raises(ValueError):
        policy.visible(view, "stranger")


def test_audit(spark):
    items = spark.createDataFrame(
        [("p1", Decimal(1), Decimal(2)), ("p1", Decimal(3), Decimal(2)), ("p2", Decimal(3), Decimal(2))],
        "product_id string, price decimal(10,2), freight_value decimal(10,2)",
    )
    products = spark.createDataFrame([("p1", "a"), ("p2", "b")], "product_id string, product_category_name string")
    assert rows(gate.audit(items, products, FREIGHT_RULE["freight_not_above_price"])) == [("a", 2, 1, 50.0), ("b", 1, 0, 0.0)]


def test_range_profile(spark):
    df = spark.createDataFrame([(1, 2.5), (None, -1.0), (7, None)], "a int, b double")
    assert rows(quality.range_profile({"t": df}, {"t": ("a", "b")})) == [("t", "a", 1.0, 7.0), ("t", "b", -1.0, 2.5)]
    assert quality.range_profile({"t": df.filter(F.lit(False))}, {"t": ("a",)}).first().min_value is None
