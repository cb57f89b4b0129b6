"""The pipeline, stage by stage, against plain versions over the same documents."""

import math
import zlib
from collections import defaultdict

import corpus_pipeline
import pytest
from cases import AWKWARD, SF, documents, near_duplicates
from pyspark.sql import functions as F
from test_texts import ids_of, packed_bytes, plain_counts

from wayfare.llm import quality_model
from wayfare.session import written
from wayfare.sources.tables import table


def follows_the_rules(text):
    n, chars, symbols, dup, repeat, lines = plain_counts(text)
    return (n >= 50 and 100 * repeat <= 50 * n and 100 * symbols <= 5 * chars and 100 * dup <= 50 * lines
            and 2 * n <= chars <= 15 * n)


def pieces(rows):
    out = []
    for doc_id, text in rows:
        ids = ids_of(text)
        for number, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at:at + 2048]
            out.append((doc_id, number, at, len(part), zlib.crc32(packed_bytes(part))))
    return sorted(out, key=str)


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("which", ["given", "awkward", "none"])
def test_each_stage_does_its_work_on_all_it_is_given(spark, which):
    docs = {
        "given": lambda: table(spark, SF, "documents"), "awkward": lambda: documents(spark, AWKWARD),
        "none": lambda: documents(spark, []),
    }[which]()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "quality_rules", "near_duplicates", "best_fit_packing"]
    columns = docs.columns
    stages = [stage for _, stage in corpus_pipeline.STAGES]

    good = written(stages[0](spark, docs, SF), "stage")
    assert good.columns == columns
    scored = quality_model.score_documents(docs, table(spark, SF, "labels")).filter("predicted = 1")
    assert sorted(r["doc_id"] or -1 for r in good.collect()) == sorted(r["doc_id"] or -1 for r in scored.collect())

    ruled = written(stages[1](spark, good, SF), "stage")
    assert ruled.columns == columns
    assert sorted(pairs(ruled), key=str) == sorted((r for r in pairs(good) if follows_the_rules(r[1])), key=str)

    thinned = written(stages[2](spark, ruled, SF), "stage")
    assert thinned.columns == columns
    least = near_duplicates(pairs(ruled), 5, 80)
    expected = {(d, t) for d, t in pairs(ruled) if d is not None and least[d] == d}
    assert sorted((r for r in pairs(thinned) if r[0] is not None), key=str) == sorted(expected, key=str)

    packed = stages[3](spark, thinned, SF).collect()
    assert sorted((tuple(r[:5]) for r in packed), key=str) == pieces(pairs(thinned))
    sequences = defaultdict(int)
    for r in packed:
        sequences[r["sequence_id"]] += r["length"]
    assert all(n <= 2048 for n in sequences.values())
    assert len(sequences) <= 1.05 * math.ceil(sum(sequences.values()) / 2048) + 1


def test_run_applies_the_stages(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "stage")
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).drop("sequence_id", "offset").collect())) == sorted(
        map(tuple, docs.drop("sequence_id", "offset").collect()))


def test_stages_remove_junk_and_keep_the_rest(spark):
    sf = SF.replace("0.001", "0.01")
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    kept = written(corpus_pipeline.accept_quality(spark, docs, sf), "stage").select("doc_id")
    found = labels.join(kept.withColumn("kept", F.lit(True)), "doc_id", "left").groupBy("quality").agg(
        F.avg(F.coalesce("kept", F.lit(False)).cast("int")).alias("share"))
    share = {r["quality"]: r["share"] for r in found.collect()}
    assert share[1] > 0.98 and share[0] < 0.15
