from collections import defaultdict

import corpus_pipeline
from pyspark.sql import functions as F

from kinfold.llm import decontaminate, ngram_join

from .fixtures import empty, frame
from .test_joins import brute_join

SF = "/root/testdata/sf0.001"


def test_every_stage_against_its_rule(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "exact_dedup", "near_dedup", "decontamination", "packing"]
    known = stages["language_id"](spark, docs, SF).cache()
    assert known.columns == docs.columns and known.count() >= 0.98 * docs.count()

    single = stages["exact_dedup"](spark, known, SF).cache()
    least = defaultdict(list)
    for r in known.collect():
        least[" ".join(x for x in r["text"].replace("\n", " ").split(" "))].append(r["doc_id"])
    assert {r["doc_id"] for r in single.collect()} <= {min(v) for v in least.values()}

    near = stages["near_dedup"](spark, single, SF).cache()
    rows = [(r["doc_id"], r["text"]) for r in single.collect()]
    assert sorted(r["doc_id"] for r in near.collect()) == sorted(i for i, _, c, _ in brute_join(rows, 5, 80) if i == c)

    clean = stages["decontamination"](spark, near, SF).cache()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    matcher = decontaminate.Matcher(items)
    held = {r["doc_id"] for r in near.collect() if next(matcher.find(r["text"]), None)}
    assert held and {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in near.collect()} - held
    texts = [decontaminate.normalise(t) for _, t in items]
    assert not [r for r in clean.collect() if any(t in decontaminate.normalise(r["text"]) for t in texts)]

    packed = stages["packing"](spark, clean, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in clean.collect()}
    result = corpus_pipeline.run(spark, SF)
    assert result.agg(F.sum("length")).first()[0] == packed.agg(F.sum("length")).first()[0]


def test_stages_take_odd_and_empty_tables(spark):
    rows = [(1, "the and of " * 30), (2, None), (3, ""), (None, "the of and was " * 20), (4, "the and of " * 30), (4, "the and of " * 30), (5, "of the for and " * 2000)]
    for docs in (frame(spark, rows), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert name == "packing" or out.columns == docs.columns
            out.collect()
    assert ngram_join.representatives(frame(spark, rows)).count() < len(rows)
