"""Whole runs over the three input files: search, train, predict and compare."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textspark.plans import grid
from textspark.plans.classifier import LinearClassifier, evaluate, predict_and_save
from textspark.plans.graph_model import GraphClassifier
from textspark.plans.minibatch import Setting
from textspark.session import materialise
from textspark.sources.artefacts import exists, load_best_config, save_json, save_table
from textspark.sources.csv import load_splits
from textspark.sources.wordvec import read_word_vectors, vector_dim


def read_corpus(spark: SparkSession, train: str, dev: str, test: str) -> DataFrame:
    """The three files with a ``doc_id`` per row; written once, so that the keys hold."""
    rows = load_splits(spark, train, dev, test)
    return materialise(rows.withColumn("doc_id", F.monotonically_increasing_id()))


def run_search(data: DataFrame, results: str, **options: Any) -> DataFrame:
    """Search the grid; saves all results and the best configuration."""
    found = materialise(grid.grid_search(data, **options))
    save_table(found, f"{results}/grid_search_results")
    best = grid.best_config(found).first().asDict()
    best["ngram_range"] = [best.pop("ngram_lo"), best.pop("ngram_hi")]
    best.pop("config_no")
    save_json(data.sparkSession, f"{results}/best_config", {k: v for k, v in best.items() if v is not None})
    return found


def run_train(data: DataFrame, results: str, config: dict[str, Any] | None = None, **training: Any) -> LinearClassifier:
    """Train with the given, else the best saved, else the default configuration; saves the model.

    The solver is the configuration's optimizer; ``solver="lbfgs"`` asks for the exact fit instead.
    """
    config = config or load_best_config(data.sparkSession, f"{results}/best_config")
    training = {"solver": config["optimizer"], "epochs": 120, "patience": 12} | training if config.get("optimizer") else training
    fitted = LinearClassifier.fit(data, config, **training)
    fitted.save(f"{results}/model")
    return fitted


def run_predict(data: DataFrame, results: str, output: str) -> str:
    """Submission of the saved model for the test split."""
    saved = LinearClassifier.load(data.sparkSession, f"{results}/model")
    return predict_and_save(saved, data.where("split = 'test'"), output)


def run_compare_features(data: DataFrame, results: str, epochs: int = 120, patience: int = 12) -> DataFrame:
    config = load_best_config(data.sparkSession, f"{results}/best_config")
    setting = Setting(config["optimizer"], config["lr"], config["l2"], config["batch_size"])
    return grid.compare_features(data, setting, epochs, patience)


def run_graph_train(
    data: DataFrame, results: str, vectors: str | None = None, config: dict[str, Any] | None = None, **training: Any
) -> GraphClassifier:
    """Train the graph classifier, with word vectors from a text file if there is one; saves model and metrics."""
    spark = data.sparkSession
    config = dict(config or {})
    given = None
    if vectors is not None and not exists(spark, vectors):
        print(f"no word vectors at {vectors}: start values are used")
    elif vectors is not None:
        given = materialise(read_word_vectors(spark, vectors, config.get("embed_dim", 200)))
        config["embed_dim"] = vector_dim(given, config.get("embed_dim", 200))
    fitted = GraphClassifier.fit(data, given, config, **training)
    fitted.save(f"{results}/graph_model")
    scored = {r["split"]: r for r in evaluate(fitted, data.where("split = 'dev'")).collect()}
    sizes = {r["split"]: r["count"] for r in data.groupBy("split").count().collect()}
    metrics = {
        "best_dev_accuracy": scored["dev"]["accuracy"] if "dev" in scored else 0.0,
        "train_samples": sizes.get("train", 0),
        "eval_samples": sizes.get("dev", 0),
    }
    save_json(spark, f"{results}/metrics", metrics)
    return fitted


def run_graph_predict(data: DataFrame, results: str, output: str) -> str:
    saved = GraphClassifier.load(data.sparkSession, f"{results}/graph_model")
    return predict_and_save(saved, data.where("split = 'test'"), output)
