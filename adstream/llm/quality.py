"""Quality of documents by boosted trees over their statistics."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstream.llm.boosted_trees import Boosting, Forest, learned
from adstream.llm.document_statistics import statistics
from adstream.llm.tables import hashed_sample, unused


@dataclass(frozen=True)
class Fit:
    """At most so many documents of each label, and the trees grown on them."""

    good: int = 20_000
    bad: int = 20_000
    trees: Boosting = field(default_factory=Boosting)


def _constant(share: float) -> Forest:
    leaf, none = np.zeros(1, np.int64), np.zeros(1)
    share = min(max(share, 0.001), 0.999)
    return Forest(float(np.log(share / (1 - share))), 0, leaf, leaf, none, leaf, leaf, none)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, how: Fit = Fit()) -> Forest:
    """Trees for the labelled documents for which ``learn`` (of doc_id) holds.

    Each label is learned from at most ``how.good`` or ``how.bad`` documents, those of
    the lowest hashes of their ids, weighed by how many there are in all. The driver
    gets their statistics, not their texts. Null ids and labels, and documents with
    both labels, teach nothing; a null text is an empty one; of several texts of one
    doc_id one teaches. With one label, or none, every score is that label's share (one
    half without any).
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").where(learn).groupBy("doc_id")
    known = known.agg(F.min("quality").alias("_label"), F.max("quality").alias("_most"))
    known = known.where("_label = _most").select("doc_id", "_label")
    sides = [
        hashed_sample(known.where(F.col("_label") == label), bound, "doc_id")
        for label, bound in ((1, how.good), (0, how.bad))
    ]
    total = dict(known.groupBy("_label").count().collect())
    ids = F.broadcast(sides[0].unionByName(sides[1]))  # no more ids than the two bounds
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(ids, "doc_id")

    def measured(batches):
        for batch in batches:
            x = statistics(batch.column(2))
            rows = pa.ListArray.from_arrays(
                np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel())
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), rows], ["doc_id", "label", "x"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    made = texts.select("doc_id", F.col("_label").cast("int"), "text").mapInArrow(
        measured, f"doc_id {id_type}, label int, x array<double>"
    )
    rows = made.groupBy("doc_id", "label").agg(F.min("x").alias("x")).toPandas()
    rows = rows.sort_values("doc_id")
    label = rows["label"].to_numpy(float)
    if len(np.unique(label)) < 2:
        return _constant(label.mean() if len(label) else 0.5)
    weight = np.where(label == 1, total[1] / label.sum(), total[0] / (1 - label).sum())
    return learned(np.array(rows["x"].tolist()), label, weight, how.trees)


def scored(docs: DataFrame, model: Forest) -> DataFrame:
    """The documents with the probability that their quality is good behind their columns.

    The new column is ``quality_score``, with an underscore more where they have one of
    that name. A null or empty text is scored by its statistics, which are zero. Every
    row stays; repeated rows score alike. No rows give no rows.
    """

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(statistics(texts)), pa.float64())

    return docs.withColumn(unused("quality_score", docs), score(F.col("text").cast("string")))
