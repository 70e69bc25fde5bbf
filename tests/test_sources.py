import pytest

from textspark.sources import artefacts, csv, wordvec


def test_csv_quirks(spark, tmp_path):
    path = tmp_path / "train.csv"
    body = '﻿ sentence_sep ,label_raw,c_numerical,extra\n"say ""hi"", now",a,1,x\n"two\nlines",b,2,y\n,c,3,z\n'
    path.write_text(body, encoding="utf-8")
    rows = csv.read_csv(spark, str(path), csv.LABELLED).collect()
    assert [tuple(r) for r in rows] == [('say "hi", now', "a", 1), ("two\nlines", "b", 2), (None, "c", 3)]


def test_columns_bind_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text("c_numerical,sentence_sep,label_raw\n7,text,lab\n")
    assert tuple(csv.read_csv(spark, str(tmp_path / "t.csv"), csv.LABELLED).first()) == ("text", "lab", 7)


def test_load_splits_and_submission(spark, tmp_path):
    (tmp_path / "a.csv").write_text("sentence_sep,label_raw,c_numerical\nx,l,0\n")
    (tmp_path / "b.csv").write_text("sentence_sep,label_raw,c_numerical\ny,l,0\n")
    (tmp_path / "c.csv").write_text("ID,sentence_sep\ntest_2,z\ntest_1,w\n")
    whole = csv.load_splits(spark, *[str(tmp_path / n) for n in ("a.csv", "b.csv", "c.csv")])
    assert {r["split"]: r["count"] for r in whole.groupBy("split").count().collect()} == {
        "train": 1,
        "dev": 1,
        "test": 2,
    }
    scored = whole.where("split = 'test'").selectExpr("ID", "5 AS c_numerical", "sentence_sep")
    out = csv.write_submission(scored, str(tmp_path / "deep" / "out"))
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["ID", "c_numerical"]
    assert sorted(map(tuple, back.collect())) == [("test_1", "5"), ("test_2", "5")]


def test_word_vectors(spark, tmp_path):
    path = tmp_path / "vectors.txt"
    path.write_text("3 2\na 1.0 2.0\nb 1.0\nc x 2.0\nd 0.5 -1e-2 9.0 \na 3.0 4.0\n")
    rows = wordvec.read_word_vectors(spark, str(path), 2).collect()
    assert {r["term"]: r["vec"] for r in rows} == {"a": [3.0, 4.0], "d": [0.5, -0.01]}


def test_align_vectors(spark):
    vocab = spark.createDataFrame([("<PAD>", 0, 0), ("<UNK>", 1, 0), ("a", 2, 5)], "term string, id long, freq long")
    vectors = spark.createDataFrame([("a", [1.0, 2.0]), ("zz", [9.0, 9.0])], "term string, vec array<double>")
    dim = wordvec.vector_dim(vectors, 300)
    assert dim == 2 and wordvec.vector_dim(vectors.where("false"), 300) == 300
    aligned = wordvec.align_vectors(vocab, vectors, dim)
    got = {r["term"]: r for r in aligned.collect()}
    assert got["a"]["vec"] == [1.0, 2.0] and got["<PAD>"]["vec"] == [0.0, 0.0]
    assert not got["<UNK>"]["covered"] and 0 < max(map(abs, got["<UNK>"]["vec"])) < 1
    assert tuple(wordvec.coverage(aligned).first()) == (1, 3, 1 / 3)


def test_best_config(spark, tmp_path):
    path = str(tmp_path / "best")
    assert artefacts.load_best_config(spark, path)["max_features"] == 12000
    artefacts.save_json(spark, path, {"max_features": "77", "ngram_range": [1, 3], "lr": 1, "note": "é"})
    config = artefacts.load_best_config(spark, path)
    assert config["max_features"] == 77 and config["ngram_range"] == (1, 3) and config["lr"] == 1.0
    assert config["note"] == "é" and config["optimizer"] == "adam"


def test_missing_artefact_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nothing-here"):
        artefacts.require(spark, str(tmp_path), str(tmp_path / "nothing-here"))


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 2), ("b", 3)], "term string, id long")
    artefacts.save_table(df, str(tmp_path / "t"))
    assert sorted(artefacts.load_table(spark, str(tmp_path / "t")).collect()) == sorted(df.collect())


def test_numbers_with_blanks_and_points(spark, tmp_path):
    (tmp_path / "n.csv").write_text("sentence_sep,label_raw,c_numerical\na,l,3.0\nb,l,\nc,l, \nd,l,4\n")
    assert [r["c_numerical"] for r in csv.read_csv(spark, str(tmp_path / "n.csv"), csv.LABELLED).collect()] == [3, None, None, 4]
    (tmp_path / "bad.csv").write_text("sentence_sep,label_raw,c_numerical\na,l,x\nb,l,1.5\nc,l,2\n")
    with pytest.raises(ValueError, match="'c_numerical': 2"):
        csv.read_csv(spark, str(tmp_path / "bad.csv"), csv.LABELLED)
