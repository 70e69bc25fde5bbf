import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from textspark.plans.extractor import FeatureExtractor
from textspark.plans.stages import SoftmaxRegression, TextFeatures, TextFeaturesModel


@pytest.fixture(scope="module")
def rows(spark):
    words = {"good": "很好 great fine nice", "bad": "太差 awful poor sad"}
    data = [(i, f"{words[label].split()[i % 4]} x{i % 5} {words[label].split()[(i + 1) % 4]}", label) for i, label in enumerate(["good", "bad"] * 15)]
    return spark.createDataFrame([*data, (90, None, "good")], "doc_id long, sentence_sep string, label_raw string")


@pytest.mark.parametrize("solver", ["lbfgs", "adam"])
def test_a_saved_pipeline_predicts_the_same(rows, tmp_path, solver):
    stages = [
        StringIndexer(inputCol="label_raw", outputCol="label", stringOrderType="alphabetAsc"),
        TextFeatures(method="char_wb_tfidf", ngramRange=[2, 3], maxFeatures=200, sublinearTF=True),
        SoftmaxRegression(labelCol="label", solver=solver, epochs=10, batchSize=8, l2=1e-3),
    ]
    unfitted = str(tmp_path / "unfitted")
    Pipeline(stages=stages).write().overwrite().save(unfitted)
    pipeline = Pipeline.load(unfitted)
    assert pipeline.getStages()[1].getOrDefault("ngramRange") == [2, 3]
    fitted = pipeline.fit(rows)
    fitted.write().overwrite().save(str(tmp_path / "fitted"))
    loaded = PipelineModel.load(str(tmp_path / "fitted"))
    assert isinstance(loaded.stages[1], TextFeaturesModel) and loaded.stages[1].uid == fitted.stages[1].uid
    first, second = ({r.doc_id: (r.pred, r.logits) for r in model.transform(rows).collect()} for model in (fitted, loaded))
    assert first == second and len(first) == 31
    labels = {r.doc_id: r.label for r in fitted.stages[0].transform(rows).collect()}
    assert sum(labels[i] == p for i, (p, _) in first.items()) >= 30


def test_the_stage_has_the_extractor_s_features(rows):
    model = TextFeatures(method="tfidf", maxFeatures=50, nullToken="nan").fit(rows)
    plain = FeatureExtractor("tfidf", 50, null_token="nan").fit(rows)
    got, want = ({r.doc_id: r.features for r in m.transform(rows).collect()} for m in (model, plain))
    assert got == want and {r["term"] for r in model.extractor.vocabulary.where(F.col("term") == "nan").collect()}
    assert TextFeatures().getOrDefault("method") == "bow"
    with pytest.raises(AttributeError, match="methods"):
        TextFeatures(methods="tfidf").fit(rows)
