"""Fitted models against their node tables, their gradients, and other engines that read the same text."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from staypath.model import evaluate, fit, optimum, prepare, trees
from staypath.operators.dictionary import as_vectors, dictionary, sparse_rows
from staypath.operators.encode import vocabulary

NAMES = ["a", "b", "flat", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    out = []
    for i in range(400):
        a, b, c = rng.random(), rng.randrange(5), rng.gauss(0, 3)
        out.append((str(i), a, b, 1, c, int(rng.random() < (0.9 if a + c / 6 > 0.6 or b == 3 else 0.15))))
    return spark.createDataFrame(out, "userId string, a double, b int, flat int, c double, label int").cache()


@pytest.fixture(scope="module")
def data(rows):
    return prepare.assemble(rows, "label")


@pytest.mark.parametrize("boosted", [False, True])
def test_node_table_scores_and_weighs_like_its_model(spark, rows, data, boosted):
    model = (fit.gbt(maxIter=6, seed=1) if boosted else fit.random_forest(maxDepth=6, numTrees=7, seed=1)).fit(data)
    nodes = trees.tree_nodes(spark, model, NAMES).cache()
    want = {r.userId: r.score for r in evaluate.churn_score(model.transform(data)).collect()}
    got = {r.userId: r.score for r in trees.scored_by_nodes(rows, nodes, boosted).collect()}
    assert got == pytest.approx(want, abs=1e-12)
    # the same text in another engine
    held = rows.toPandas()  # noqa: F841
    other = dict(duckdb.sql(f"select userId, {trees.score_sql(nodes.collect(), boosted)} from held").fetchall())
    assert other == pytest.approx(want, abs=1e-12)
    weights = {r.feature: r.score for r in trees.importances_of(nodes, boosted).collect()}
    assert [weights.get(n, 0.0) for n in NAMES] == pytest.approx(list(model.featureImportances.toArray()), abs=1e-12)
    node_table = nodes.toPandas()  # noqa: F841
    shares = "sum(gain * rows) / sum(sum(gain * rows)) over (partition by tree)" if not boosted else "sum(gain * rows)"
    sql = f"select feature, sum(g) / sum(sum(g)) over () from (select tree, feature, {shares} as g from node_table where feature is not null group by tree, feature) group by feature"
    assert dict(duckdb.sql(sql).fetchall()) == pytest.approx(weights, abs=1e-12)


def test_a_tree_without_a_split(spark, rows):
    same = rows.withColumn("label", F.lit(1)).limit(20)
    nodes = trees.tree_nodes(spark, fit.random_forest(numTrees=2).fit(prepare.assemble(same, "label")), NAMES)
    assert {r.score for r in trees.scored_by_nodes(same, nodes, False).collect()} == {1.0}
    assert trees.importances_of(nodes, False).count() == 0


@pytest.mark.parametrize("options", [{}, {"regParam": 0.1}, {"regParam": 0.05, "standardization": False}])
def test_gradient_is_zero_at_the_optimum_only(rows, data, options):
    slopes = {}
    for name, limits in (("end", {"tol": 1e-12, "maxIter": 500}), ("early", {"maxIter": 1})):
        model = fit.logistic_regression(**options, **limits).fit(data)
        slopes[name] = {r.feature: r.gradient for r in optimum.loss_gradient(model, rows, NAMES).collect()}
    assert set(slopes["end"]) == {optimum.INTERCEPT, *NAMES}
    assert max(map(abs, slopes["end"].values())) < 1e-6 < 1e-3 < max(map(abs, slopes["early"].values()))


def test_penalty_with_corners_is_refused(rows, data):
    with pytest.raises(ValueError):
        optimum.loss_gradient(fit.logistic_regression(regParam=0.1, elasticNetParam=0.5).fit(data), rows, NAMES)


def test_runs_share_one_pass_and_score_exactly(spark, data):
    got = fit.repeated_runs(data, fit.logistic_regression(), [2.0, 1.0], 0.8, runs=2).orderBy("multiplier", "run").collect()
    assert [(r.multiplier, r.run) for r in got] == [(1.0, 0), (1.0, 1), (2.0, 0), (2.0, 1)]
    for r in got:
        train, test = prepare.train_test(data, r.multiplier, 0.8, sample_seed=r.run)
        sizes = train.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
        assert (r.n_pos, r.n_neg) == tuple(sizes)
        scored = [(x.score, x.label) for x in evaluate.churn_score(fit.logistic_regression().fit(train).transform(test)).collect()]
        pairs = [(p > n) + (p == n) / 2 for p, one in scored if one for n, two in scored if not two]
        assert r.auc == pytest.approx(sum(pairs) / len(pairs), abs=2e-3)  # a fit may end elsewhere by rounding


def test_dictionary_of_many_values(spark):
    values = sorted(f"v{i}" for i in range(10_001))
    df = spark.createDataFrame([(str(i % 7), v) for i, v in enumerate(values)] + [("0", None), ("0", values[0]), (None, values[1])], "userId string, v string")
    known = dictionary(df, "v").cache()
    assert [(r.v, r.position) for r in known.orderBy("position").collect()] == [(v, i) for i, v in enumerate(values)]
    assert known.where("n = 2").count() == 2
    rows = {r.userId: r for r in sparse_rows(df, "v", known).collect()}
    assert rows["0"].size == 10_001 and rows["0"].indices == sorted(rows["0"].indices) and rows["0"].values[0] == 2.0
    assert sum(len(r.indices) for r in rows.values()) == 10_002
    vectors = as_vectors(sparse_rows(df, "v", known), "tokens")
    vector = vectors.where("userId = '3'").first().tokens
    assert vector.size == 10_001 and list(vector.indices) == rows["3"].indices
    with pytest.raises(ValueError):
        vocabulary(df, "v")
    assert len(vocabulary(df, "v", 10_001)) == 10_001
    assert dictionary(df.limit(0), "v").count() == 0
