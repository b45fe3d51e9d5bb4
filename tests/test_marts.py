from statistics import mean

import pytest

from basketmill.operators import cleaning, marts, modelling
from basketmill.schemas import NORMAL_FORM, WIDE_COLUMNS
from conftest import rows
from retail_data import frames, random_rows, widen

GROUPS = {"home": ("chairs", "lamps"), "beauty": ("soap",)}


def python_model(data):
    wide = widen(data)
    return {
        name: {tuple(r[WIDE_COLUMNS.index(c)] for c in spec.columns) for r in wide} for name, spec in NORMAL_FORM.items()
    }


def close(got, want):
    assert len(got) == len(want), (got, want)
    for g, w in zip(got, want):
        assert len(g) == len(w)
        for a, b in zip(g, w):
            assert a == pytest.approx(b, abs=0.00501) if isinstance(b, float) else a == b, (got, want)


@pytest.fixture(params=range(3))
def case(request, spark):
    data = random_rows(request.param, n=90)
    tables = frames(spark, data)
    return python_model(data), tables


def test_delivery_satisfaction(case):
    model, tables = case
    per_review, per_order, orders = {}, {}, {}
    for o in model["orders"]:
        if not 2017 <= o[2].year <= 2018:
            continue
        status = marts.LATE if o[3] > o[4] else marts.ON_TIME
        scores = [r[2] for r in model["order_reviews"] if r[1] == o[0]]
        per_review.setdefault(status, []).extend(scores)
        per_order.setdefault(status, []).append(mean(scores))
        orders.setdefault(status, set()).add(o[0])
    want = sorted((s, float(mean(v)), len(orders[s])) for s, v in per_review.items())
    close(rows(marts.delivery_satisfaction(tables, 2017, 2018)), want)
    want = sorted((s, float(mean(v)), len(orders[s])) for s, v in per_order.items())
    close(rows(marts.delivery_satisfaction_by_order(tables, 2017, 2018)), want)


def test_category_repurchase(case):
    model, tables = case
    group_of = {c: g for g, members in GROUPS.items() for c in members}
    spend, seen = {}, {}
    for o in model["orders"]:
        if not 2017 <= o[2].year <= 2018:
            continue
        for i in model["order_items"]:
            for p in model["products"]:
                if i[0] == o[0] and p[0] == i[2] and p[1] in group_of:
                    key = group_of[p[1]], o[1]
                    spend[key] = spend.get(key, 0) + i[3] + i[4]
                    seen.setdefault(key, set()).add(o[0])
    want = []
    for group in sorted({g for g, _ in spend}):
        customers = [k for k in spend if k[0] == group]
        again = sum(len(seen[k]) >= 2 for k in customers)
        want.append((group, float(mean(spend[k] for k in customers)), 100.0 * again / len(customers), len(customers)))
    close(rows(marts.category_repurchase(tables, GROUPS, 2017, 2018)), want)


def test_freight_by_quarter(case):
    model, tables = case
    ratios, whole = {}, {}
    for o in model["orders"]:
        if o[2].year != 2017:
            continue
        quarter = (o[2].month + 2) // 3
        items = [i for i in model["order_items"] if i[0] == o[0] and i[3] > 0]
        ratios.setdefault(quarter, []).extend(float(i[4] / i[3]) for i in items)
        if items:
            whole.setdefault(quarter, []).append(float(sum(i[4] for i in items) / sum(i[3] for i in items)))
    want = [(q, mean(v) * 100, len(v), f"Q{q}") for q, v in sorted(ratios.items()) if v]
    got = marts.freight_by_quarter(tables, 2017)
    close([tuple(r) for r in got.collect()], want)
    want = [(q, mean(v) * 100, len(v), f"Q{q}") for q, v in sorted(whole.items())]
    close([tuple(r) for r in marts.freight_by_quarter_by_order(tables, 2017).collect()], want)


def test_samples_and_listings(case):
    model, tables = case
    joined = sorted(
        (o[0], i[1], p[1], i[3], i[4], r[2], o[1], o[2], o[3], o[4])
        for o in model["orders"]
        for i in model["order_items"] if i[0] == o[0]
        for p in model["products"] if p[0] == i[2]
        for r in model["order_reviews"] if r[1] == o[0]
    )
    got = [
        (r.order_id, r.order_item_id, r.product_category_name, r.price, r.freight_value, r.review_score,
         r.customer_unique_id, r.order_purchase_timestamp, r.order_delivered_customer_date, r.order_estimated_delivery_date)
        for r in marts.wide_sample(tables, 12).collect()
    ]
    assert got == joined[:12]
    full = modelling.normal_form(tables)
    listed = sorted(
        ((i[0], i[1], i[2], p[1], i[3], i[4]) for i in model["order_items"] for p in model["products"] if p[0] == i[2]),
        key=lambda r: r[2:],
    )
    listed.sort(key=lambda r: r[:2], reverse=True)
    assert [tuple(r) for r in marts.item_listing(tables, "admin", 7).collect()] == listed[:7]
    assert [tuple(r) for r in marts.item_listing(tables, "analyst", 7).collect()] == [r[:5] for r in listed[:7]]
    following = {
        (i[0], max(j[1] for j in model["order_items"] if j[0] == i[0]) + 1, i[2], p[1])
        for i in model["order_items"] for p in model["products"] if p[0] == i[2]
    }
    assert rows(marts.next_item_id(full)) == sorted(following, key=repr)
    latest = marts.latest_rows(tables, 9).collect()
    bought = sorted((r[3] for r in cleaning.clean_wide(tables).collect()), reverse=True)
    assert [r.order_purchase_timestamp for r in latest] == bought[:9]


def test_headline(case, spark):
    model, tables = case
    row = marts.headline_metrics(modelling.normal_form(tables)).first()
    assert (row.total_orders, row.total_customers) == (len(model["orders"]), len(model["customers"]))
    assert row.avg_score == pytest.approx(mean(r[2] for r in model["order_reviews"]), abs=0.00501)


def test_gaps(spark):
    satisfaction = spark.createDataFrame([("late", 2.5, 1), ("on_time", 4.25, 3)], "delivery_status string, avg_score double, order_count long")
    assert rows(marts.score_gap(satisfaction)) == [(4.25, 2.5, 1.75, "above threshold")]
    assert marts.score_gap(satisfaction, 1.75).first().verdict == "not above threshold"
    assert marts.score_gap(satisfaction.limit(1)).count() == 0
    quarters = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.5), (4, 25.0)], "quarter int, freight_ratio double")
    assert rows(marts.q4_freight_gap(quarters)) == [(25.0, 20.1667, 4.8333, "higher")]
    assert marts.q4_freight_gap(quarters.filter("quarter < 4")).count() == 0


@pytest.mark.parametrize("n", [3, 4, 9, 50])
def test_listings_with_repeated_order_ids(spark, n):
    """Every order id has two rows, of other customers and times, as a broken dependency gives."""
    data = random_rows(11, n=40)
    twice = [(o[0], data["customers"][i % len(data["customers"])][0], "2018-02-03 04:05:06", "2018-03-01 00:00:00", o[4]) for i, o in enumerate(data["orders"])]
    data["orders"] = data["orders"] + twice
    tables, model = frames(spark, data), python_model(data)
    listed = sorted(
        ((i[0], i[1], i[2], p[1], i[3], i[4]) for i in model["order_items"] for p in model["products"] if p[0] == i[2]),
        key=lambda r: r[2:],
    )
    listed.sort(key=lambda r: r[:2], reverse=True)
    assert [tuple(r) for r in marts.item_listing(tables, "admin", n).collect()] == listed[:n]
    wide = [tuple(r) for r in cleaning.clean_wide(tables).collect()]
    bought = sorted((r[3] for r in wide), reverse=True)
    assert [r.order_purchase_timestamp for r in marts.latest_rows(tables, n).collect()] == bought[:n]
    joined = sorted(
        (o[0], i[1], p[1], i[3], i[4], r[2], o[1], o[2], o[3], o[4])
        for o in model["orders"]
        for i in model["order_items"] if i[0] == o[0]
        for p in model["products"] if p[0] == i[2]
        for r in model["order_reviews"] if r[1] == o[0]
    )
    got = marts.wide_sample(tables, n).collect()
    assert [(r.order_id, r.order_item_id, r.product_category_name, r.price, r.freight_value, r.review_score, r.customer_unique_id) for r in got] == [
        j[:7] for j in joined[:n]
    ]
