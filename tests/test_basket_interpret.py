import itertools
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmart.operators import basket, interpret, segment
from sparkmart.operators.quantiles import exact_quantiles
from sparkmart.sources import model_store


def _fact(spark, rows):
    import decimal
    rows = [r[:-1] + (decimal.Decimal(r[-1]),) for r in rows]
    return spark.createDataFrame(rows, "InvoiceNo long, StockCode string, Description string, Quantity int, "
                                       "total_spend decimal(18,2)")


def test_baskets_and_rules(spark):
    rows = []
    inv = 0
    for items, times in ((("a", "b", "c"), 6), (("a", "b"), 3), (("c", "d"), 2), (("a",), 5)):
        for _ in range(times):
            inv += 1
            rows += [(inv, "X", it, 1, 1) for it in items]
    rows += [(999, "POST", "postage", 1, 1), (999, "X", "a", 1, 1)]   # non-product code dropped → 1 item
    rows += [(998, "X", "a", 1, 1), (998, "X", "b", -1, -1)]           # refund line filtered, net qty
    b = basket.baskets(_fact(spark, rows))
    assert b.count() == 11  # single-item baskets removed
    fi = basket.frequent_itemsets(b, 0.2)
    sup = {tuple(r["items"]): r["support"] for r in fi.collect()}
    assert sup[("a", "b", "c")] == pytest.approx(6 / 11)
    # support is anti-monotone
    for items, s in sup.items():
        for i in range(len(items)):
            sub = items[:i] + items[i + 1:]
            if sub:
                assert sup[sub] >= s - 1e-12
    rules = basket.association_rules(fi, min_lift=0.0).collect()
    by = {(tuple(r.antecedents), tuple(r.consequents)): r for r in rules}
    # multi-item consequents exist
    assert (("a",), ("b", "c")) in by
    r = by[(("a",), ("b", "c"))]
    assert r.confidence == pytest.approx(round(6 / 9, 6))
    # lift symmetric under swapping sides
    assert by[(("a",), ("b",))].lift == pytest.approx(by[(("b",), ("a",))].lift)
    lifts = [x.lift for x in basket.association_rules(fi).collect()]
    assert lifts == sorted(lifts, reverse=True) and all(x >= 1 for x in lifts)


def test_classification_metrics_match_definition(spark):
    y = [0, 0, 1, 1, 2, 2, 2]
    p = [0, 1, 1, 1, 2, 0, 3]
    df = spark.createDataFrame(list(zip(y, p)), "cluster int, prediction int")
    m = interpret.classification_metrics(df).first()
    classes = sorted(set(y) | set(p))
    f1s, precs, recs = [], [], []
    for c in classes:
        tp = sum(1 for a, b in zip(y, p) if a == b == c)
        pr = tp / max(1, sum(1 for b in p if b == c)) if c in p else 0.0
        rc = tp / max(1, sum(1 for a in y if a == c)) if c in y else 0.0
        precs.append(pr), recs.append(rc)
        f1s.append(0.0 if pr + rc == 0 else 2 * pr * rc / (pr + rc))
    assert m.f1_score_macro == round(float(np.mean(f1s)), 4)
    assert m.precision == round(float(np.mean(precs)), 4) and m.recall == round(float(np.mean(recs)), 4)
    assert m.accuracy == round(4 / 7, 4)


def test_interpreter_importance_and_gate(spark):
    rows = []
    for i in range(240):
        c = i % 3
        rows.append((i, c, float(c * 10 + (i % 5)), 7.0, float((i * 7) % 11)))
    df = spark.createDataFrame(rows, "CustomerID long, cluster int, x double, const double, noise double")
    cols = ("x", "const", "noise")
    model = interpret.train_interpreter(df, cols, kind="forest", n_draws=1, folds=2)
    assert interpret.evaluate(model, df).first().f1_score_macro > 0.95
    imp = {(r.cluster, r.feature): r.importance
           for r in interpret.permutation_importance(model, df, cols, n_repeats=2).collect()}
    # a constant feature cannot matter
    assert all(imp[(c, "const")] == 0 for c in (0.0, 1.0, 2.0))
    whole = {r.feature: r.importance
             for r in interpret.permutation_importance(model, df, cols, group_col=None, n_repeats=3).collect()}
    assert whole["const"] == 0 and max(whole.values()) > 0.1
    top = interpret.top_features(interpret.permutation_importance(model, df, cols, n_repeats=2), n=2)
    assert top.filter(F.col("rank_important") == 1).count() == 3
    # retrain gate branches
    assert interpret.retrain_decision(None, df)[1] == "no_model"
    assert interpret.retrain_decision(model, df, force=True)[1] == "forced"
    assert interpret.retrain_decision(model, df, threshold=0.1)[1] == "kept"
    assert interpret.retrain_decision(model, df, threshold=1.01)[1] == "below_threshold"
    # versioned store: numeric ordering (v10 after v9), reload predicts identically
    root = tempfile.mkdtemp(prefix="sparkmart-models-")
    for _ in range(10):
        v, _ = model_store.save_versioned(spark, model, root, "interpreter")
    assert v == 10 and model_store.list_versions(spark, root, "interpreter")[-2:] == [9, 10]
    again = model_store.load_latest(spark, root, "interpreter")
    a = model.transform(df).select("CustomerID", "prediction").orderBy("CustomerID").collect()
    b = again.transform(df).select("CustomerID", "prediction").orderBy("CustomerID").collect()
    assert a == b
    assert model_store.load_latest(spark, root, "absent") is None
    rec = model_store.control_record({"numTrees": 20}, {"f1_score_macro": 0.8, "accuracy": 0.9, "precision": 0.8,
                                                        "recall": 0.7}, "2024-11-09", 10, "2024-11-09", True, False)
    model_store.write_control_file(spark, rec, root, "2024-11-09")
    back = model_store.read_control_file(spark, root, "2024-11-09")
    assert back["interpreter_metrics"]["f1_score_macro"] == 0.8 and back["is_train_interpreter"] is True


def test_anomaly_flag(spark):
    rows = [(0, f"f{i}", 0.00001) for i in range(6)] + [(1, f"f{i}", float(i)) for i in range(6)]
    scores = spark.createDataFrame(rows, "cluster int, feature string, importance double")
    top = interpret.top_features(scores)
    flags = {r.cluster: r.is_anomaly for r in top.select("cluster", "is_anomaly").distinct().collect()}
    assert flags == {0: True, 1: False}
    assert interpret.anomaly_exists(top)
    all_c = spark.createDataFrame([(0,), (1,), (2,)], "cluster int")
    assert [r.cluster for r in interpret.unexplained_groups(all_c, top).collect()] == [2]


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=500), np.full(400, 2.5)])  # a heavily repeated value
    df = spark.createDataFrame([(float(v), float(v) * 2 if i % 3 else None) for i, v in enumerate(vals)], "a double, b double")
    q = exact_quantiles(df, ["a", "b"], [0.0, 0.25, 0.5, 0.9, 1.0]).first()
    assert q["a"] == pytest.approx(list(np.quantile(vals, [0.0, 0.25, 0.5, 0.9, 1.0])))
    bv = np.array([v * 2 for i, v in enumerate(vals) if i % 3])
    assert q["b"] == pytest.approx(list(np.quantile(bv, [0.0, 0.25, 0.5, 0.9, 1.0])))
    grouped = exact_quantiles(df.withColumn("g", (F.col("a") > 0).cast("int")), ["a"], [0.5], ["g"]).collect()
    assert len(grouped) == 2


def test_single_cluster_inertia_closed_form(spark):
    rows = [(i, float(i), float(i % 4)) for i in range(50)]
    df = spark.createDataFrame(rows, "CustomerID long, a double, b double")
    got = segment.single_cluster_inertia(df, ("a", "b")).first()["inertia"]
    x = np.array([[r[1], r[2]] for r in rows])
    assert got == pytest.approx(((x - x.mean(axis=0)) ** 2).sum())


def test_rank_selection_goes_through_all_passes(spark, monkeypatch):
    """Values that share their leading bits, odd values, and every number of passes."""
    from sparkmart.operators import quantiles
    rng = np.random.default_rng(4)
    a = np.concatenate([1 + rng.integers(0, 50, 300) * 2.0 ** -52, rng.normal(size=200) * 10.0 ** rng.integers(-300, 300, 200), [0.0, -0.0, np.inf, -np.inf]])
    rows = [(float(v), float(i % 2), None, float("nan") if i % 3 == 0 else -float(i)) for i, v in enumerate(a)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5)
    probs = [0.0, 0.2, 0.25, 0.5, 0.6, 1.0]
    for few in (0, 10, 1 << 16):
        monkeypatch.setattr(quantiles, "FEW", few)
        q = exact_quantiles(df, ["a", "b", "c", "d"], probs).first()
        with np.errstate(invalid="ignore"):
            assert q["a"][1:-1] == pytest.approx(list(np.quantile(a, probs[1:-1])), rel=1e-12) and (q["a"][0], q["a"][-1]) == (-np.inf, np.inf)
        assert q["b"] == [0.0, 0.0, 0.0, 0.5, 1.0, 1.0] and q["c"] is None
        assert q["d"][0] == -503.0 and np.isnan(q["d"][-1])
    assert exact_quantiles(df.where("false"), ["a"], [0.5]).first()["a"] is None
    bits = quantiles.ordered_bits(np.sort(a))
    assert (np.diff(bits.astype(object)) >= 0).all() and (quantiles.doubles_of(bits) == np.sort(a)).all()


def test_rules_grow_by_level(spark):
    """All splits of itemsets of up to five items; a long itemset alone; falling confidence."""
    names = "abcde"
    freq = {frozenset(s): 100 - 13 * len(s) - sum(map(ord, s)) % 7 for n in range(1, 6) for s in itertools.combinations(names, n)}
    rows = [(sorted(s), f / 100, len(s)) for s, f in freq.items()] + [([f"i{j:02}" for j in range(31)], 0.1, 31)]
    sets = spark.createDataFrame(rows, "items array<string>, support double, n_items int")
    got = {(tuple(r.antecedents), tuple(r.consequents)): (r.support, r.confidence, r.lift) for r in basket.association_rules(sets, 0.0).collect()}
    want = {}
    for s, f in freq.items():
        for n in range(1, len(s)):
            for left in itertools.combinations(sorted(s), n):
                right = tuple(sorted(s - set(left)))
                conf = f / freq[frozenset(left)]
                want[left, right] = (round(f / 100, 6), round(conf, 6), round(conf / (freq[frozenset(right)] / 100), 6))
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k], abs=2e-6) for k in want)
    sure = basket.association_rules(sets, 0.0, min_confidence=0.6).collect()
    assert {(tuple(r.antecedents), tuple(r.consequents)) for r in sure} == {k for k, v in want.items() if v[1] >= 0.6}
    assert basket.association_rules(sets.where("n_items = 1")).count() == 0 == basket.association_rules(sets.where("n_items = 31")).count()
