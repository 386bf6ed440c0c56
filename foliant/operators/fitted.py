"""Fitted objects as pipeline stages that can be stored and loaded in another session.

A stage keeps its tables as DataFrames and everything else as one JSON value. Stored, it
is a folder with Spark ML metadata and a Parquet folder per table, so a ``PipelineModel``
holds these stages beside MLlib's own and writes and reads them with the rest.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Transformer
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.operators import clustering, reduction
from foliant.operators.boosting import SoftmaxTrees, Tree
from foliant.operators.classification import NaiveBayesText, label_table
from foliant.operators.joins import lookup
from foliant.operators.vectors import Vocabulary


class _Writer(MLWriter):
    def __init__(self, stage: FittedStage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        extra = {"detail": self.stage.detail}
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata=extra)
        for name, df in self.stage.tables.items():
            df.write.parquet(f"{path}/tables/{name}")


class _Reader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> FittedStage:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        tables = {name: spark.read.parquet(f"{path}/tables/{name}") for name in self.cls.TABLES}
        stage = self.cls(tables, metadata["detail"])
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage


class FittedStage(Transformer, MLReadable, MLWritable):
    """``tables``: the DataFrames named by ``TABLES``; ``detail``: numbers, texts and lists."""

    TABLES: tuple[str, ...] = ()

    def __init__(self, tables: dict[str, DataFrame], detail: dict):
        super().__init__()
        self.tables, self.detail = tables, detail

    def write(self) -> _Writer:
        return _Writer(self)

    @classmethod
    def read(cls) -> _Reader:
        return _Reader(cls)


class TextVectors(FittedStage):
    """A vocabulary: adds the TF-IDF vector of a text column."""

    TABLES = ("vocabulary",)

    @classmethod
    def of(cls, vocabulary: Vocabulary, text: str = "text", output: str = "features") -> TextVectors:
        detail = {
            "n_docs": vocabulary.n_docs,
            "ngram": list(vocabulary.ngram),
            "stopwords": vocabulary.stopwords,
            "text": text,
            "output": output,
        }
        return cls({"vocabulary": vocabulary.table}, detail)

    def vocabulary(self) -> Vocabulary:
        """The vocabulary again; its rows are capped, hence a driver's list."""
        table, d = self.tables["vocabulary"], self.detail
        rows = table.orderBy("index").collect()
        terms, idf = [r["term"] for r in rows], [r["idf"] for r in rows]
        return Vocabulary(table, terms, idf, d["n_docs"], tuple(d["ngram"]), d["stopwords"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.vocabulary().tfidf_vectors(dataset, text=self.detail["text"], output=self.detail["output"])


class TextClassifier(FittedStage):
    """Vocabulary, naive Bayes and class names: adds y_pred, prob and the predicted name."""

    TABLES = ("vocabulary", "likelihood", "labels")

    @classmethod
    def of(
        cls, vocabulary: Vocabulary, model: NaiveBayesText, labels: DataFrame, *,
        id_col: str = "doc_id", text: str = "text", output: str = "label",
    ) -> TextClassifier:
        """``labels`` has label and y_true, as ``classification.label_table`` gives it."""
        detail = TextVectors.of(vocabulary, text).detail | {
            "priors": model.priors, "classes": model.classes, "id": id_col, "output": output,
        }
        names = labels.select("label", "y_true")
        return cls({"vocabulary": vocabulary.table, "likelihood": model.table, "labels": names}, detail)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        d = self.detail
        vocabulary = TextVectors({"vocabulary": self.tables["vocabulary"]}, d).vocabulary()
        model = NaiveBayesText(self.tables["likelihood"], d["priors"], d["classes"])
        weights = vocabulary.weights(dataset, id_col=d["id"], text=d["text"])
        found = model.predict(weights, dataset, id_col=d["id"])
        return LabelNames({"labels": self.tables["labels"]}, {"output": d["output"]}).transform(
            dataset.join(found, d["id"])
        )


class LabelNames(FittedStage):
    """The class table: adds the name of the predicted class."""

    TABLES = ("labels",)

    @classmethod
    def of(cls, labelled: DataFrame, label: str = "label", output: str = "label") -> LabelNames:
        return cls({"labels": label_table(labelled, label).select("label", "y_true")}, {"output": output})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = self.tables["labels"].select(
            F.col("y_true").alias("y_pred"), F.col("label").alias(self.detail["output"])
        )
        return lookup(dataset, names, "y_pred", "left")


class TreeClassifier(FittedStage):
    """Softmax trees: adds y_pred and prob from the vector column."""

    TABLES = ("nodes", "cuts")

    @classmethod
    def of(cls, spark, model: SoftmaxTrees, col: str = "features") -> TreeClassifier:
        nodes = [
            (number, k, i, int(t.feature[i]), int(t.cut[i]), float(t.value[i]))
            for number, trees in enumerate(model.rounds)
            for k, t in enumerate(trees)
            for i in range(len(t.feature))
        ]
        schema = "round int, class int, node int, feature int, cut int, value double"
        cuts = [(i, [float(c) for c in row]) for i, row in enumerate(model.cuts)]
        tables = {
            "nodes": spark.createDataFrame(nodes, schema),
            "cuts": spark.createDataFrame(cuts, "feature int, cuts array<double>"),
        }
        return cls(tables, {"classes": model.classes, "losses": model.losses, "start": model.start, "col": col})

    def model(self) -> SoftmaxTrees:
        cuts = np.array([r["cuts"] for r in self.tables["cuts"].orderBy("feature").collect()])
        out = SoftmaxTrees(cuts, self.detail["classes"], [], self.detail["losses"], self.detail.get("start"))
        rows = self.tables["nodes"].orderBy("round", "class", "node").toPandas()
        for _, trees in rows.groupby("round"):
            found = [g for _, g in trees.groupby("class")]
            out.rounds.append(
                [Tree(g["feature"].to_numpy(np.int32), g["cut"].to_numpy(np.int32), g["value"].to_numpy()) for g in found]
            )
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.model().predict(dataset, col=self.detail["col"])


class ReducedVectors(FittedStage):
    """Vocabulary and SVD basis: id and reduced coordinates of every document with known terms."""

    TABLES = ("vocabulary", "basis")

    @classmethod
    def of(cls, spark, vocabulary: Vocabulary, basis: np.ndarray, *, id_col: str = "doc_id", text: str = "text") -> ReducedVectors:
        rows = [(i, [float(x) for x in row]) for i, row in enumerate(basis)]
        tables = {
            "vocabulary": vocabulary.table,
            "basis": spark.createDataFrame(rows, "index int, row array<double>"),
        }
        return cls(tables, TextVectors.of(vocabulary, text).detail | {"id": id_col})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        d = self.detail
        vocabulary = TextVectors({"vocabulary": self.tables["vocabulary"]}, d).vocabulary()
        basis = np.array([r["row"] for r in self.tables["basis"].orderBy("index").collect()])
        rows = vocabulary.weight_rows(dataset, id_col=d["id"], text=d["text"])
        return reduction.svd_project(rows, basis, id_col=d["id"])


class NearestCenter(FittedStage):
    """Cluster centers: id, cluster and squared distance of every vector."""

    TABLES = ("centers",)

    @classmethod
    def of(cls, centers: DataFrame, *, id_col: str = "id", col: str = "embedding") -> NearestCenter:
        return cls({"centers": centers.select("cluster", "center")}, {"id": id_col, "col": col})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return clustering.assign_to_centers(
            dataset, self.tables["centers"], id_col=self.detail["id"], col=self.detail["col"]
        )
