"""A fitted forest of several trees, scored again from its saved node table."""

from collections import defaultdict

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel

from series_engine.plans import model as mdl
from series_engine.plans import queries as q

SF = "/root/testdata/sf0.001"


def _vote(trees, features):
    """Class probabilities: the mean of the leaves' class shares over all trees."""
    total = defaultdict(float)
    for nodes in trees.values():
        n = nodes[0]
        while n.leftChild >= 0:
            n = nodes[n.leftChild if features[n.split.featureIndex] <= n.split.leftCategoriesOrThreshold[0] else n.rightChild]
        for c, x in enumerate(n.impurityStats):
            total[c] += x / sum(n.impurityStats) / len(trees)
    return [total[c] for c in sorted(total)]


def test_forest_equals_its_node_table(spark, tmp_path):
    li = q.table(spark, SF, "lineitem")
    model = mdl.fit(li, q._b2_model_params())
    forest = next(s for s in model.stages if isinstance(s, RandomForestClassificationModel))
    assert len(forest.trees) > 1 and forest.totalNumNodes > 3 * len(forest.trees)
    PipelineModel(stages=[forest]).write().overwrite().save(str(tmp_path / "m"))
    data = next((tmp_path / "m" / "stages").iterdir()) / "data"
    trees = defaultdict(dict)
    for r in spark.read.parquet(str(data)).collect():
        trees[r.treeID][r.nodeData.id] = r.nodeData
    assert len(trees) == len(forest.trees) and sum(map(len, trees.values())) == forest.totalNumNodes
    rows = mdl.score(model, li).select("features_scaled", "probability", "prediction", "predicted_action").limit(500).collect()
    assert len({r.prediction for r in rows}) > 1
    names = mdl.label_names(model)
    for r in rows:
        p = _vote(trees, r.features_scaled)
        assert max(abs(a - b) for a, b in zip(p, r.probability, strict=True)) < 1e-9
        assert r.prediction == max(range(len(p)), key=lambda c: (round(p[c], 12), -c)) and r.predicted_action == names[int(r.prediction)]
