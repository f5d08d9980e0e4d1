"""Tables with columns named as the operators' own helpers, through operators and stages."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from adstream.llm import (
    decontamination,
    divergence,
    language_id,
    licences,
    ngram_join,
    packing,
    quality,
    secret_scan,
    segment_dedup,
    toxicity,
)

from .conftest import LONG

NAMES = [
    "_join_shard", "language", "language_score", "toxicity", "quality_score", "text_key", "_text_key", "_kept_id",
    "_key", "_other_key", "_spans", "_merged", "_text", "_predicted", "_asked", "owner", "seed", "item", "value",
]
LEAK = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
SECRET = "the password = hunter22x and so on"
ROWS = [
    (1, "plain words here and there for a while of reading", "en", "s"),
    (2, f"before {LEAK} after", "en", "s"), (3, SECRET, "en", "t"), (4, None, None, None), (5, "", "de", "s"),
    (6, LONG, "en", "s"), (7, LONG, "en", "t"), (3, SECRET, "en", "t"), (None, "no name", "en", "s"),
]


@pytest.fixture(scope="module")
def docs(spark):
    made = spark.createDataFrame([(*r, len(r[1] or "")) for r in ROWS], "doc_id long, text string, lang string, source string, n_chars long")
    return made.select("*", *[F.lit(f"own {n}").alias(n) for n in NAMES])


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(None, LEAK, "x"), (2, "short", "y"), (3, None, "z")], "item_id long, text string, _join_shard string")


def own(row):
    return all(row[n] == f"own {n}" for n in NAMES)


def test_scores_stand_behind_the_columns(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (6, 1, 0)], "doc_id long, quality int, toxic int")
    made = [
        toxicity.scored(docs, toxicity.fit(docs, labels, F.lit(True))),
        quality.scored(docs, quality.fit(docs, labels, F.lit(True))),
        language_id.predicted(docs, language_id.fit(docs, F.lit(True), language_id.Net(epochs=1))),
    ]
    for df in made:
        assert df.columns[: len(docs.columns)] == docs.columns
        rows = df.collect()
        assert len(rows) == len(ROWS) and all(own(r) for r in rows)


def test_filters_keep_columns(docs, benchmark):
    kept = ngram_join.representatives(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "2", "3", "4", "5", "6", "None"] and all(own(r) for r in rows)
    clean = decontamination.decontaminated(docs, benchmark)
    rows = clean.collect()
    assert clean.columns == docs.columns and 2 not in {r.doc_id for r in rows} and len(rows) == len(ROWS) - 1
    marked = secret_scan.redacted(docs)
    rows = marked.collect()
    assert marked.columns == docs.columns and len(rows) == len(ROWS) and all(own(r) for r in rows)
    assert all("hunter22x" not in (r.text or "") and r.n_chars == len(r.text or "") for r in rows)


def test_reports(docs, benchmark):
    assert decontamination.contaminated(docs, benchmark).collect() == []
    named = benchmark.withColumn("item_id", F.coalesce("item_id", F.lit(9)))
    leaks = decontamination.contaminated(docs, named).collect()
    assert [(r.doc_id, r.item_id, r.first_token) for r in leaks] == [(2, 9, 1)]
    assert secret_scan.scan(docs).count() == len(ROWS)
    assert ngram_join.jaccard_components(docs).count() == len(ROWS)
    assert packing.pack(docs).agg(F.countDistinct("sequence_id")).first()[0] > 1
    assert segment_dedup.repeated_spans(docs).count() >= 1
    assert licences.scan(docs.withColumn("path", F.concat(F.lit("a/"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))).count() > 0
    assert divergence.divergence(docs).count() >= 2


def test_stages(spark, docs, benchmark, tmp_path):
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    labels = spark.createDataFrame([(1, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    left = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = corpus_pipeline.stored(stage(spark, left, str(tmp_path)), "stage")
        assert left.columns == docs.columns and all(own(r) for r in left.collect())
    assert sorted(str(r.doc_id) for r in left.collect()) == ["1", "3", "4", "5", "6", "None"]
    assert corpus_pipeline.pack_sequences(spark, left, str(tmp_path)).count() > 5
