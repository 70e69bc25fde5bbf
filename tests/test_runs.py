import pytest

from textspark.plans import grid, runs
from textspark.plans.minibatch import Setting
from textspark.sources.artefacts import load_best_config, load_json, load_table


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("input")
    words = {"yes": "good fine great", "no": "bad awful poor"}

    def line(i):
        label = "yes" if i % 2 else "no"
        picked = words[label].split()
        return f'"{picked[i % 3]} n{i % 5}[SEP]{picked[(i + 1) % 3]}"', label, 1 if i % 2 else 0

    for name, span in (("train", range(24)), ("dev", range(24, 32))):
        body = "".join(f"{t},{a},{c}\n" for t, a, c in map(line, span))
        (folder / f"{name}.csv").write_text("sentence_sep,label_raw,c_numerical\n" + body)
    body = "".join(f"test_{i:05d},{line(i)[0]}\n" for i in range(32, 42))
    (folder / "test.csv").write_text("ID, sentence_sep\n" + body)
    vectors = "".join(f"{w} {i}.5 1 {-i}\n" for i, w in enumerate("good fine great bad awful poor".split()))
    (folder / "vectors.txt").write_text("6 3\n" + vectors)
    return folder


@pytest.fixture(scope="module")
def data(spark, files):
    return runs.read_corpus(spark, *[str(files / f"{n}.csv") for n in ("train", "dev", "test")])


def answers(spark, path):
    return {r["ID"]: int(r["c_numerical"]) for r in spark.read.option("header", True).csv(path).collect()}


def test_linear_run(spark, data, tmp_path):
    results = str(tmp_path / "results")
    choices = [Setting("adam", 0.1, 0.0, 8), Setting("sgd", 0.1, 1e-4, 8)]
    runs.run_search(data, results, feature_configs=grid.FEATURE_CONFIGS[:3], choices=choices, epochs=8, shards=1)
    assert load_table(spark, f"{results}/grid_search_results").count() == 6
    assert load_best_config(spark, f"{results}/best_config")["batch_size"] == 8
    runs.run_train(data, results, shards=1)
    searched = load_best_config(spark, f"{results}/best_config")
    again = runs.run_train(data, results, shards=1, epochs=8)
    assert again.model.info["best_val_acc"] == pytest.approx(searched["val_acc"])
    got = answers(spark, runs.run_predict(data, results, str(tmp_path / "out")))
    assert got == {f"test_{i:05d}": i % 2 for i in range(32, 42)}
    assert runs.run_compare_features(data, results, epochs=2).count() == 3


def test_graph_run(spark, data, files, tmp_path):
    results = str(tmp_path / "results")
    config = {"embed_dim": 3, "num_hidden": 16, "k": 2}
    runs.run_graph_train(data, results, str(files / "vectors.txt"), config)
    metrics = load_json(spark, f"{results}/metrics")
    assert metrics["train_samples"] == 24 and metrics["eval_samples"] == 8
    assert metrics["best_dev_accuracy"] > 0.7
    assert len(answers(spark, runs.run_graph_predict(data, results, str(tmp_path / "out")))) == 10
