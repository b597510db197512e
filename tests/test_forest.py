"""The forest against a plain recursive one, on any partitioning."""

import tracemalloc

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lopside.plans import forest as fo


def gini(n0, n1, w):
    a, b = w[0] * n0, w[1] * n1
    return (a * a + b * b) / (a + b) if a + b else 0.0


def plain(x, y, c, name, w, leaf, most, node_rows, cuts):
    """(feature, threshold, left, right) or the value of a leaf, one candidate after the other."""
    n0, n1 = int(c[y == 0].sum()), int(c[y == 1].sum())
    value = w[1] * n1 / (w[0] * n0 + w[1] * n1)
    if not n0 or not n1:
        return value
    rows = len(y)
    best = (-np.inf, None, None)
    exact = rows <= node_rows
    for attempt in (exact, True):  # a large node without a usable cut is finished with all values
        if best[1] is not None or (attempt and rows < 2 * leaf):
            break
        order = [int(f) for f in fo.feature_order(np.array([name], np.uint64), x.shape[1])[0]]
        varying = [f for f in order if len(set(x[:, f] if attempt else np.searchsorted(cuts[f], x[:, f], "left"))) > 1][:most]
        for f in sorted(varying):
            values = np.unique(x[:, f])
            for t, go in [((a + b) / 2, x[:, f] <= a) for a, b in zip(values[:-1], values[1:])] if attempt else [(t, x[:, f] <= t) for t in cuts[f]]:
                if leaf <= go.sum() <= rows - leaf:
                    l0, l1 = int(c[go & (y == 0)].sum()), int(c[go & (y == 1)].sum())
                    score = gini(l0, l1, w) + gini(n0 - l0, n1 - l1, w)
                    if score > best[0]:
                        best = (score, f, t)
        if attempt:
            break
        if best[1] is None:
            node_rows = rows
    if best[1] is None:
        return value
    go = x[:, best[1]] <= best[2]
    kids = [plain(x[m], y[m], c[m], fo.child(np.array([name], np.uint64), s)[0], w, leaf, most, node_rows, cuts) for m, s in ((go, 1), (~go, 2))]
    return (best[1], best[2], *kids)


def as_nested(tree, at=0):
    feature, threshold, left, value = tree
    if feature[at] < 0:
        return float(value[at])
    return int(feature[at]), float(threshold[at]), as_nested(tree, left[at]), as_nested(tree, left[at] + 1)


def table(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=n), rng.integers(0, 5, n), rng.integers(0, 2, n), rng.normal(size=n).round(1), np.zeros(n)], 1)
    y = (rng.random(n) < 1 / (1 + np.exp(2 - 2 * x[:, 0] - x[:, 1] * x[:, 2]))).astype(int)
    return spark.createDataFrame([(i, Vectors.dense(v), int(t)) for i, (v, t) in enumerate(zip(x, y))], ["_key", "features", "_y"]), x, y


@pytest.mark.parametrize("leaf, node_rows, balanced", [(1, 10_000, True), (5, 10_000, False), (3, 60, True), (5, 25, True)])
def test_trees_equal_a_plain_implementation(monkeypatch, spark, leaf, node_rows, balanced):
    df, x, y = table(spark)
    made = fo.BootstrapForest(trees=4, leaf=leaf, balanced=balanced, node_rows=node_rows, bins=8)
    model = made.fit(df.repartition(5))
    keys = np.array([r.k for r in df.select(F.xxhash64("_key").alias("k")).collect()]).view(np.uint64)
    fit = fo._Fit(df.select(F.xxhash64("_key").alias("key"), F.array(F.lit(0.0), *[F.lit(0.0)] * 4).alias("x"), "_y"), 4, leaf, None, 42, balanced, node_rows, 8, 65536)
    fit.rows = df.select(F.xxhash64("_key").alias("key"), fo.vector_to_array("features").alias("x"))
    cuts = fit.cut_points()
    for t, tree in enumerate(model.forest):
        c = fo.bootstrap(keys, t, 42)
        own = c > 0
        n0, n1 = c[y == 0].sum(), c[y == 1].sum()
        w = ((n0 + n1) / (2 * n0), (n0 + n1) / (2 * n1)) if balanced else (1.0, 1.0)
        assert as_nested(tree) == plain(x[own], y[own], c[own], fo.root(t, 42), w, leaf, 2, node_rows, cuts)
    monkeypatch.setattr(fo, "COPY_BYTES", 0)  # the same trees when no table is small enough to be copied
    again = made.fit(df.orderBy(F.desc("_key")).coalesce(2))
    for a, b in zip(model.forest, again.forest):
        assert all((p == q).all() for p, q in zip(a, b))


def test_bootstrap_counts_are_poisson():
    counts = np.concatenate([fo.bootstrap(np.arange(20_000, dtype=np.uint64), t, 42) for t in range(5)])
    assert abs(counts.mean() - 1) < 0.02 and abs(counts.var() - 1) < 0.03 and abs((counts == 0).mean() - np.exp(-1)) < 0.01


def test_scores_save_and_odd_tables(spark, tmp_path):
    df, x, y = table(spark, 600)
    model = fo.BootstrapForest(trees=12, leaf=2, balanced=True).fit(df)
    scored = model.transform(df).select("_key", F.element_at(fo.vector_to_array("probability"), 2).alias("p"), "prediction").orderBy("_key").collect()
    want = np.mean([tree[3][fo.descend(x, *tree[:3])] for tree in model.forest], axis=0)
    assert np.allclose([r.p for r in scored], want) and all((r.p > 0.5) == bool(r.prediction) for r in scored)
    assert model.featureImportances.toArray().sum() == pytest.approx(1) and model.featureImportances[4] == 0
    model.write().overwrite().save(str(tmp_path / "forest"))
    loaded = fo.ForestModel.load(str(tmp_path / "forest"))
    assert loaded.transform(df).select("_key", "probability").exceptAll(model.transform(df).select("_key", "probability")).count() == 0
    one = fo.BootstrapForest(trees=3).fit(df.filter("_y = 1"))
    assert {len(t[0]) for t in one.forest} == {1} and one.transform(df).filter("prediction <> 1").count() == 0
    same = fo.BootstrapForest(trees=3, leaf=1).fit(df.withColumn("features", F.lit(None).cast("string")).select("_key", "_y").crossJoin(df.limit(1).select("features")))
    assert {len(t[0]) for t in same.forest} == {1}
    with pytest.raises(ValueError):
        fo.BootstrapForest().fit(df.limit(0))


def test_a_balanced_forest_finds_the_rare_class(spark):
    df, x, y = table(spark, 3000, 9)
    rare = df.filter("_y = 0 or _key % 12 = 0")
    hits = {}
    for balanced in (False, True):
        model = fo.BootstrapForest(trees=30, leaf=5, balanced=balanced).fit(rare)
        hits[balanced] = model.transform(rare).filter("prediction = 1 and _y = 1").count()
    assert hits[True] > hits[False]


def test_driver_holds_trees_as_arrays(spark):
    """The fitted trees come to the driver as arrays, which take a fraction of lists of Python numbers."""
    df = spark.range(3000).select(F.col("id").alias("_key"), (F.xxhash64("id") % 2 == 0).cast("int").alias("_y"),
                                  array_to_vector(F.array(*[F.rand(k) for k in range(4)])).alias("features"))
    tracemalloc.start()
    model = fo.BootstrapForest(60, 1).fit(df)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    held = sum(column.nbytes for tree in model.forest for column in tree)
    assert held > 1 << 20 and peak < 2 * held


def test_a_table_in_one_part_is_dealt_to_all_cores(monkeypatch, spark):
    rows = spark.range(3000).selectExpr("id as _key", "array_repeat(cast(id % 97 as double), 2) as x", "cast(id % 3 = 0 as double) as _y").coalesce(1)
    df = rows.select("_key", array_to_vector("x").alias("features"), "_y")
    whole = fo.BootstrapForest(trees=3, node_rows=500).fit(df)
    parts, counted = [], fo._Fit.class_weights
    monkeypatch.setattr(fo._Fit, "class_weights", lambda self: parts.append(self.rows.rdd.getNumPartitions()) or counted(self))
    monkeypatch.setattr(fo, "TASK_ROWS", 500)
    again = fo.BootstrapForest(trees=3, node_rows=500).fit(df)
    assert parts == [min(6, spark.sparkContext.defaultParallelism)]
    assert all((a == b).all() for one, two in zip(whole.forest, again.forest) for a, b in zip(one, two))


def test_large_nodes_are_grown_from_a_coded_copy(monkeypatch, spark):
    """A table with nodes too large for one group is sent out once, coded, not dealt again for every tree; the trees stay the same."""
    df, x, y = table(spark, 700, 5)
    made = fo.BootstrapForest(trees=3, leaf=2, node_rows=80, bins=8)
    copied = made.fit(df)
    with monkeypatch.context() as m:
        m.setattr(fo, "COPY_BYTES", 0)
        dealt = made.fit(df)
    assert all((a == b).all() for one, two in zip(copied.forest, dealt.forest) for a, b in zip(one, two))
    assert np.allclose(copied.featureImportances.toArray(), dealt.featureImportances.toArray())
    monkeypatch.setattr(fo._Fit, "finish_small", lambda *_: pytest.fail("dealt a copy of the rows for every tree"))
    made.fit(df)


def test_dummies_of_one_category_are_counted_together():
    rng = np.random.default_rng(2)
    category, value = rng.integers(0, 6, 900), rng.normal(size=900)
    x = np.column_stack([*(category == k for k in range(1, 6)), category % 2, value]).astype(float)
    coded = fo.Coded.of_values(x)
    assert [members for members, _ in coded.bundles] == [[0, 1, 2, 3, 4]]
    assert (coded.bundles[0][1] == category).all()
    y, count = (rng.random(900) < 0.1 + 0.1 * category).astype(np.int8), rng.integers(1, 4, 900)
    tree = fo.grow(x, y, count, np.uint64(7), (1.0, 2.0), 3, 2)
    want = plain(x, y, count, np.uint64(7), (1.0, 2.0), 3, 2, 10_000, None)
    assert as_nested(tree[:4]) == want
    at = fo.descend(x, *tree[:3])
    assert (fo.leaf_values(x.T.ravel(), 900, 7, *fo.packed(*tree[:4], 7)) == tree[3][at]).all()


@pytest.mark.parametrize("same_key", [False, True])
def test_cut_points_come_from_the_least_keys(spark, same_key):
    rows = spark.range(5000).select(F.lit(5).alias("key") if same_key else F.xxhash64("id").alias("key"), F.array(F.col("id") * 1.0).alias("x"))
    cuts = fo._Fit(rows, 1, 1, None, 42, False, 100, 8, 50).cut_points()[0]
    keys = np.array([r.key for r in rows.select("key").collect()])
    least = np.sort(np.argsort(keys)[:50]).astype(float)
    assert len(cuts) == 7 and (same_key or set(cuts) <= set((least[:-1] + least[1:]) / 2))
