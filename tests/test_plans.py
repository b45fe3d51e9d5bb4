"""Plans: what reaches the scan, what is exchanged, and that crowded keys are split."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from basketmill.operators import cleaning, marts, modelling
from basketmill.sources.roles import retail
from conftest import rows

QUERIES = contract.queries()
STREAMS = [n for n in QUERIES if "stream" in n]
# The language-model operators have plans of their own kinds.
MODELS = [n for n in QUERIES if n == "pipeline" or re.match(r"op\d+_", n)]
# A product, a condition other than equality: Spark sends a side under its limit in bytes.
PRODUCTS = {"cross_join", "theta_join"}


def plan_of(df, final=False):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0] if final else text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(STREAMS) - set(MODELS)))
def test_no_product_no_global_window_no_python(spark, small, name):
    plan = plan_of(QUERIES[name](spark, small))
    assert "CartesianProduct" not in plan
    if name not in PRODUCTS:
        assert "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan
    for line in plan.splitlines():
        if " Window " in line:  # inside a sorted part, or over one row per sorted part
            assert "_part" in line


def item_reads(query, spark, folder):
    """Scans of the line items in every plan that Spark ran until the last row was there, as the plans ended up."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = {run.executionId() for run in executions(store)}
    query(spark, folder).write.format("noop").mode("overwrite").save()
    spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    reads = 0
    for run in executions(store):
        if run.executionId() not in before:
            text = run.physicalPlanDescription()
            tree, _, details = text.partition("\n\n\n")
            final = tree.split("== Initial Plan ==")[0]
            for number in re.findall(r"Scan parquet\s*\((\d+)\)", final):
                detail = re.search(rf"^\({number}\) Scan parquet.*?(?:\n\n|\Z)", details, re.S | re.M)
                reads += "lineitem.parquet" in detail[0]
    return reads


def executions(store):
    found = store.executionsList()
    return [found.apply(i) for i in range(found.size())]


@pytest.mark.parametrize("name, most", [("duplicate_keys", 4), ("fk_orphans", 3), ("next_item_id", 2), ("fd_check", 2), ("row_counts", 2),
                                        ("not_null_check", 4), ("grain_reconcile", 4), ("freight_by_quarter", 2), ("category_repurchase", 2),
                                        ("delivery_satisfaction", 2)])
def test_items_are_read_a_bounded_number_of_times(spark, small, name, most):
    """One read is the delivery date that the role of orders takes from the line items, for each use of raw orders."""
    assert 1 <= item_reads(QUERIES[name], spark, small) <= most


STAGED = {
    "headline_metrics": {"orders"},
    "next_item_id": {"listed_items", "orders", "order_items"},
    "normalize_products": {"listed_items", "orders"},
    "normalize_items": {"listed_items"},
    "normalize_reviews": set(),
    "range_profile": {"listed_items", "orders"},
    "fk_orphans": {"listed_items", "orders", "order_items"},
    "row_counts": {"listed_items", "orders", "order_items"},
    "fd_check": {"listed_items", "orders", "order_items"},
}


@pytest.mark.parametrize("name", STAGED)
def test_only_tables_that_others_follow_from_are_written(spark, small, monkeypatch, name):
    names, real = [], modelling.stage

    def watched(df, as_name):
        names.append(as_name)
        return real(df, as_name)

    monkeypatch.setattr(modelling, "stage", watched)
    QUERIES[name](spark, small).collect()
    assert set(names) <= STAGED[name] and len(names) == len(set(names))


def test_grain_does_not_expand(spark, small):
    plan = plan_of(QUERIES["grain_reconcile"](spark, small))
    assert "Expand" not in plan


def test_filter_and_columns_reach_the_scan(spark, small):
    plan = plan_of(QUERIES["filter_project"](spark, small))
    assert "GreaterThan(l_quantity,45.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_extendedprice:double>" in plan
    # The constant reaches both sides of the join.
    plan = plan_of(QUERIES["equi_join"](spark, small))
    assert "EqualTo(o_custkey,10)" in plan and "EqualTo(c_custkey,10)" in plan


def test_period_is_pruned_in_the_scan(spark, small):
    orders = marts.period_orders(retail(spark, small), 1997, 1998)
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in plan_of(orders)


def test_listings_keep_only_their_rows(spark, small):
    for name in ("admin_listing", "public_listing", "stock_seed", "stock_listing", "latest_rows", "wide_sample"):
        assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, small))


def test_hidden_column_is_not_even_sorted_on(spark, small):
    assert "freight_value" not in QUERIES["public_listing"](spark, small).columns


def test_crowded_product_and_order_are_split_in_joins(spark, small):
    """A third of the items belong to one product, another part to one order."""
    tables = retail(spark, small)
    many = spark.range(120_000).select(
        F.when(F.col("id") < 60_000, F.lit(3)).otherwise(F.col("id") % 1500).cast("long").alias("order_id"),
        (F.col("id") % 7 + 1).cast("int").alias("order_item_id"),
        F.when(F.col("id") >= 60_000, F.lit(5)).otherwise(F.col("id") % 200).cast("long").alias("product_id"),
        F.lit(1).cast("decimal(10,2)").alias("price"),
        (F.hash("id") % 100).cast("decimal(10,2)").alias("freight_value"),
    )
    tables["order_items"] = many
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    plain = cleaning.clean_wide(tables)
    want = plain.count(), plain.agg(F.sum("freight_value")).first()[0]
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = cleaning.clean_wide(tables)
        got = df.agg(F.count(F.lit(1)), F.sum("freight_value"))
        assert tuple(got.collect()[0]) == want
        assert len(re.findall(r"SortMergeJoin\(skew=true\)", plan_of(got, final=True))) >= 1
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
