import datetime as dt

from sparkmart.operators import boosting, forecast


def test_random_search_scores_each_draw_on_time_folds(spark):
    days = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), float(10 + i % 7)) for i in range(90)]
    frame = forecast.lag_frame(spark.createDataFrame(days, "InvoiceDate date, total_qty double"), "total_qty", [7])
    found = forecast.random_search(frame, "total_qty", n_draws=3, n_splits=2, choices={"rounds": [5, 40, 80], "rate": [0.3]},
                                   base=boosting.Params(min_rows=2))
    assert [p.rounds for p, _ in found.scores] != [] and len({p for p, _ in found.scores}) == 3
    assert found.best == min(found.scores, key=lambda s: s[1]["rmse"])[0]
    assert min(m["rmse"] for _, m in found.scores) < 0.1           # the series repeats every week, its spread is 2
    table = forecast.search_table(spark, found).orderBy("rank").collect()
    assert [r.rmse for r in table] == sorted(r.rmse for r in table) and table[0].rounds == found.best.rounds


def test_search_grid_is_the_published_one():
    assert len(boosting.draws(forecast.SEARCH_CHOICES, 100)) == len(set(boosting.draws(forecast.SEARCH_CHOICES, 100))) == 100
    assert {p.rounds for p in boosting.draws(forecast.SEARCH_CHOICES, 625)} == {100, 200, 300, 400, 500}
    assert forecast.FINAL_PARAMS.rounds == 1000 and forecast.FINAL_PARAMS.leaves == 100


def test_parts_are_the_test_windows(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(23)], "InvoiceDate date, y double")
    part = [r._part for r in forecast.with_parts(days, 4).orderBy("InvoiceDate").collect()]
    assert part == [0] * 7 + [1] * 4 + [2] * 4 + [3] * 4 + [4] * 4
    assert {r._part for r in forecast.with_parts(days.limit(3), 4).collect()} == {0}


def test_demand_features_lag_by_their_own_days(spark):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), i, 100 + i, 200.0 + i, 300 + i, 400.0 + i, i % 2, 10 + i, 20 + i) for i in range(20)]
    daily = spark.createDataFrame(rows, "InvoiceDate date, total_qty int, total_unique_item int, refund_sales double, free_qty int, "
                                        "total_sales double, is_holiday int, cluster_0 int, cluster_3 int")
    got = forecast.demand_features(daily).orderBy("InvoiceDate").collect()
    last = got[-1]
    assert (last.total_unique_item_lag6, last.refund_sales_lag12, last.free_qty_lag16, last.total_sales_lag6) == (113, 207, 303, 413)
    assert (last.cluster_0_lag6, last.cluster_3_lag12, last.is_holiday, last.dayofmonth) == (23, 27, 1, 20)
    assert last.total_sales_lag_sma7 == sum(400 + i for i in range(6, 13)) / 7
    assert got[0].total_sales_lag_sma7 is None and len(got) == 20


def test_validations_learn_from_the_other_daily_columns(spark):
    """The target is yesterday's other column, and its own past tells nothing."""
    side = [(i * i * 7919 + i * 104729) % 97 for i in range(160)]
    days = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(days=i), float(side[i - 1]), side[i]) for i in range(1, 160)],
                                 "InvoiceDate date, total_qty double, all_qty int")
    frame = forecast.lagged_sma_frame(days, "total_qty", 1, ["all_qty"])
    assert frame.columns == ["InvoiceDate", "total_qty", "total_qty_lag_sma1", "all_qty_lag1"]
    assert all(r.total_qty == r.all_qty_lag1 for r in frame.collect())
    for out in (forecast.sma_cross_validation(days, windows=[1], n_splits=2),
                forecast.lag_cross_validation(days, lag_sets=((1,),), kinds=("tree",), n_splits=2)):
        assert out.first().r2 > 0.8
