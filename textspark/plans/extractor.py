"""Feature extraction: fit a vocabulary on one corpus, apply it to any other."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textspark.functions.text import document_text, let
from textspark.operators.features import (
    METHODS,
    analyse,
    df_band,
    is_weighted,
    smooth_idf,
    term_weight,
    top_terms,
    weigh,
    with_text,
)
from textspark.operators.gram_counts import term_counts
from textspark.operators.gram_stats import gram_stats
from textspark.operators.lookup import measured_bytes
from textspark.operators.rank import global_rank
from textspark.operators.segment import tokenize_dict
from textspark.operators.unnest import unnest
from textspark.operators.vocab import bag_of_terms, term_stats
from textspark.plans.minibatch import Scale, count_bytes, read_counts
from textspark.session import materialise
from textspark.sources.artefacts import exists, load_json, load_table, save_json, save_table

LOCAL_VOCABULARY_BYTES = 32 << 20  # above this a vocabulary stays distributed


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.append(0, np.cumsum(sizes)), pa.int32())


def _structs(sizes: np.ndarray, term: np.ndarray, value: np.ndarray) -> list[pa.Array]:
    return [pa.ListArray.from_arrays(_offsets(sizes), pa.StructArray.from_arrays([pa.array(term, pa.int64()), pa.array(value)], ["term_id", "value"]))]


def _with_vectors(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("features", VectorUDT()) if f.name == "features" else f for f in schema.fields])


def vectors_of_counts(counts: DataFrame, scale: Scale | None, size: int) -> DataFrame:
    """Rows with sparse ML vectors ``features`` of ``size`` in place of ``count_bytes``."""
    keep = [f for f in counts.schema.fields if f.name not in ("indices", "values", "sizes")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("sizes").to_numpy().astype(np.int64)
            columns, values = read_counts(sizes, *(b"".join(batch.column(c).to_pylist()) for c in ("indices", "values")))
            n, value = len(sizes), values.astype(np.float64) if scale is None else scale.values(sizes, columns, values)
            lists = [pa.ListArray.from_arrays(_offsets(sizes), pa.array(x)) for x in (columns.astype(np.int32), value)]
            vectors = pa.StructArray.from_arrays([pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32)), *lists], ["type", "size", "indices", "values"])
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in keep), vectors], names=[*(f.name for f in keep), "features"])

    return counts.mapInArrow(work, T.StructType([*keep, T.StructField("features", VectorUDT())]))


class FeatureExtractor:
    """Count and TF-IDF features of word or character n-grams.

    ``vocabulary`` is a table ``(term, term_id, tf, df, idf)``, ids in term order.
    """

    def __init__(
        self,
        method: str = "bow",
        max_features: int | None = 5000,
        ngram_range: tuple[int, int] = (1, 1),
        min_df: int = 1,
        max_df: float = 1.0,
        sublinear_tf: bool = False,
        han_mode: str = "char",
        null_token: str = "",
        dictionary: DataFrame | None = None,
    ):
        if method not in METHODS:
            raise ValueError(f"unknown method: {method}")
        self.method = method
        self.max_features = max_features
        self.ngram_range = tuple(ngram_range)
        self.min_df = min_df
        self.max_df = max_df
        self.sublinear_tf = sublinear_tf
        self.han_mode = han_mode
        self.null_token = null_token
        self.dictionary = dictionary
        self.vocabulary: DataFrame | None = None
        self.vocab_size = 0
        self._local: list | None = None

    # -- fitting ---------------------------------------------------------------

    def texts(self, df: DataFrame) -> DataFrame:
        """``df`` with the blank-joined ``text`` that n-grams are read from.

        With a ``dictionary`` (``term``) Han text is cut into its words, else by ``han_mode``. Where there is a ``text``
        and no ``sentence_sep``, it is this text already.
        """
        if "text" in df.columns and "sentence_sep" not in df.columns:
            return df
        if self.dictionary is None:
            return with_text(df, han_mode=self.han_mode, null_token=self.null_token)
        tokens = tokenize_dict(df, self.dictionary, remove_stopwords=True, null_token=self.null_token)
        return df.join(tokens, "doc_id").withColumn("text", document_text(F.col("tokens"))).drop("tokens")

    def grams(self, df: DataFrame) -> DataFrame:
        """``df`` with the array ``grams`` of a document's n-grams."""
        lo, hi = self.ngram_range
        return self.texts(df).withColumn("grams", analyse(F.col("text"), self.method, lo, hi)).drop("text")

    def fit(self, df: DataFrame) -> "FeatureExtractor":
        n_docs = df.count()
        lo, hi = self.ngram_range
        if self.method == "char_wb_tfidf" and lo > 3:  # there short words stand for themselves besides
            stats = term_stats(bag_of_terms(self.grams(df), "grams"))
        else:
            stats = gram_stats(self.texts(df), self.method, lo, hi)
        chosen = top_terms(df_band(stats, n_docs, self.min_df, self.max_df), self.max_features)
        ranked = global_rank(chosen, ["term"], "term_id")
        self._set(materialise(ranked.withColumn("idf", smooth_idf(F.col("df"), n_docs))))
        return self

    def _set(self, vocabulary: DataFrame) -> None:
        self.vocabulary = vocabulary
        self.vocab_size = vocabulary.count()
        self._local = None

    def _fitted(self) -> DataFrame:
        if self.vocabulary is None:
            raise RuntimeError("fit must come before transform")
        return self.vocabulary

    # -- applying --------------------------------------------------------------

    def _local_terms(self) -> list | None:
        """The vocabulary in id order if it is small enough to ship to every task."""
        vocabulary = self._fitted()
        if self._local is None and measured_bytes(vocabulary) <= LOCAL_VOCABULARY_BYTES:
            self._local = vocabulary.orderBy("term_id").select("term", "idf").collect()
        return self._local

    def _by_arrow(self) -> list | None:
        """The local vocabulary, if documents are counted by walks through its terms."""
        # From lo = 4 on, short words stand for themselves besides; those are counted in the row.
        return None if self.method == "char_wb_tfidf" and self.ngram_range[0] > 3 else self._local_terms()

    def _weighed(self, df: DataFrame, terms: list, schema: str, made, keep: list[str]) -> DataFrame:
        """Columns ``keep`` and those of ``schema``, ``made`` of sizes, term ids and values of some documents."""
        scale = self.scale()

        def arrays(sizes: np.ndarray, term: np.ndarray, tf: np.ndarray) -> list[pa.Array]:
            return made(sizes, term, tf.astype(np.float64) if scale is None else scale.values(sizes, term, tf))

        lo, hi = self.ngram_range
        return term_counts(self.texts(df), [t["term"] for t in terms], self.method, lo, hi, schema, arrays, keep)

    def scale(self) -> Scale | None:
        """What makes values of counts; None if they are the values. Only with a vocabulary of bounded size."""
        return Scale(np.array([t["idf"] for t in self._local_terms()]), self.sublinear_tf) if is_weighted(self.method) else None

    def transform_rows(self, df: DataFrame) -> DataFrame:
        """``df`` with ``features array<struct<term_id, value>>``.

        With a vocabulary of bounded size every document is handled inside its row. Otherwise
        terms are matched by a join and gathered again per document.
        """
        terms = self._by_arrow()
        if terms:
            return self._weighed(df, terms, "features array<struct<term_id:bigint,value:double>>", _structs, df.columns)
        terms = self._local_terms()
        if not terms:
            return self._transform_by_join(df)
        counter = CountVectorizerModel.from_vocabulary(
            [t["term"] for t in terms], inputCol="grams", outputCol="_tf"
        )
        counts = counter.transform(self.grams(df)).drop("grams")
        # One reference to the counts: each further one would count the document again.
        return counts.withColumn("features", let(F.unwrap_udt("_tf"), self._weights(terms))).drop("_tf")

    def transform_counts(self, df: DataFrame) -> tuple[DataFrame, Scale | None]:
        """``df`` with ``count_bytes`` in place of the text, and the scale that makes weights of counts.

        They take a tenth of the place of vectors, which stand there without a vocabulary of bounded size.
        """
        terms = self._by_arrow()
        if not terms:
            return self.transform(df), None
        lo, hi = self.ngram_range
        keep = [c for c in df.columns if c != "sentence_sep"]
        schema = "indices binary, values binary, sizes int"
        return term_counts(self.texts(df), [t["term"] for t in terms], self.method, lo, hi, schema, count_bytes, keep), self.scale()

    def _transform_by_join(self, df: DataFrame) -> DataFrame:
        bag = bag_of_terms(self.grams(df), "grams")
        vocabulary = self._fitted()
        weighed = weigh(bag, vocabulary, is_weighted(self.method), self.sublinear_tf)
        pairs = weighed.select("doc_id", F.struct("term_id", "value").alias("p"))
        gathered = pairs.groupBy("doc_id").agg(F.array_sort(F.collect_list("p")).alias("features"))
        none = F.array().cast("array<struct<term_id:bigint,value:double>>")
        return df.join(gathered, "doc_id", "left").withColumn("features", F.coalesce("features", none))

    def transform_long(self, df: DataFrame) -> DataFrame:
        """``(doc_id, term_id, value)``."""
        return unnest(self.transform_rows(df), ["doc_id"], "features", "term_id")

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with sparse ML vectors ``features`` in place of the text, from a written table.

        Vectors are what iterative training reads again and again, so they are counted once. What is written are
        their counts, which become vectors as they are read; without a vocabulary of bounded size it is the vectors.
        If there is a ``split`` column, each split lies in files of its own.
        """
        split = "split" if "split" in df.columns else None
        if self._by_arrow():
            counts, scale = self.transform_counts(df)
            stored = materialise(counts, None, split)
            if split is None:
                return vectors_of_counts(stored, scale, self.vocab_size)
            order = [*[c for c in df.columns if c != "sentence_sep"], "features"]
            kind, values = stored.schema[split].dataType, [r[0] for r in stored.select(split).distinct().collect()]
            # One branch for each split, as no filter on it goes through Python.
            parts = [
                vectors_of_counts(stored.where(F.col(split).isNull() if v is None else F.col(split) == v).drop(split), scale, self.vocab_size)
                .withColumn(split, F.lit(v).cast(kind)).select(*order)
                for v in sorted(values, key=lambda v: (v is None, v))
            ]
            return reduce(DataFrame.unionByName, parts or [vectors_of_counts(stored, scale, self.vocab_size).select(*order)])
        rows = self.transform_rows(df).drop("sentence_sep")
        sparse = F.struct(
            F.lit(0).cast("tinyint").alias("type"),
            F.lit(self.vocab_size).alias("size"),
            F.transform("features", lambda p: p["term_id"].cast("int")).alias("indices"),
            F.transform("features", lambda p: p["value"]).alias("values"),
        )
        rows = rows.withColumn("features", sparse)
        # A vector column is stored as this very struct, so reading it back as one is exact.
        return materialise(rows, _with_vectors(rows.schema), split)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    # -- saving ----------------------------------------------------------------

    def params(self) -> dict:
        return {
            "method": self.method,
            "max_features": self.max_features,
            "ngram_range": list(self.ngram_range),
            "min_df": self.min_df,
            "max_df": self.max_df,
            "sublinear_tf": self.sublinear_tf,
            "han_mode": self.han_mode,
            "null_token": self.null_token,
        }

    def save(self, path: str) -> None:
        vocabulary = self._fitted()
        save_json(vocabulary.sparkSession, f"{path}/params", self.params())
        save_table(vocabulary, f"{path}/vocabulary")
        if self.dictionary is not None:
            save_table(self.dictionary, f"{path}/dictionary")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FeatureExtractor":
        loaded = cls(**load_json(spark, f"{path}/params"))
        if exists(spark, f"{path}/dictionary"):
            loaded.dictionary = load_table(spark, f"{path}/dictionary")
        loaded._set(load_table(spark, f"{path}/vocabulary"))
        return loaded


def features_by_split(extractor: FeatureExtractor, df: DataFrame, fit_splits: tuple[str, ...] = ("train",)) -> DataFrame:
    """Fit on the named splits, apply to every split; unknown terms drop out."""
    return extractor.fit(df.where(F.col("split").isin(*fit_splits))).transform(df)
