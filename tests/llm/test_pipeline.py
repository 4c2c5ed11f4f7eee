"""The pipeline's stages against plain code, and on rows with nulls, repeats and clashing names."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import queries
from tarn.llm import mixing, quality, simhash

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returned, the documents first."""
    out = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("pipeline") / "out")
        stage(spark, out[-1], SF_DIR).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def ids(frame):
    return Counter(r.doc_id for r in frame.select("doc_id").collect())


def test_quality_stage_follows_the_verdicts(spark, stages):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    kept = quality.judge(stages[0], labels).filter("kept")
    assert stages[1].columns == stages[0].columns
    assert ids(stages[1]) == ids(kept)


def test_one_of_each_group_stays(stages):
    """The stage is the operator of ``op8_simhash``, which test_simhash.py holds against brute force."""
    out = simhash.near_duplicates(stages[1])
    assert ids(stages[2]) == Counter({r.component_id for r in out.collect()})


def test_contaminated_documents_go(spark, stages):
    """Here the passages are verbatim: plain text search finds the same documents."""
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    words = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    found = {r.doc_id for r in stages[2].collect() if any(words(i) in words(r.text) for i in items)}
    assert found and ids(stages[3]) == Counter(i for i in ids(stages[2]) if i not in found)


def test_mix_stage_takes_what_the_mix_says(stages):
    planned = {r.doc_id: r for r in mixing.mix(stages[3]).collect()}
    taken = ids(stages[4])
    assert stages[4].columns == stages[0].columns
    assert {i: taken[i] * r.size for i, r in planned.items()} == {i: r.taken for i, r in planned.items()}


def test_token_stage(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected, start = [], 0
    for r in sorted(stages[4].collect(), key=lambda r: r.doc_id):
        own = [*tokenizer.encode(r.text, add_special_tokens=False).ids, 0]
        expected.append((r.doc_id, start, len(own), zlib.crc32(np.array(own, dtype="<u4").tobytes())))
        start += len(own)
    assert sorted(map(tuple, stages[5].collect())) == expected


def test_run_is_the_stages(spark, stages):
    assert queries()["pipeline"] is corpus_pipeline.run
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect())) == sorted(map(tuple, stages[5].collect()))


def test_odd_rows_pass_through(spark):
    base = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    long_text = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(30000)), lambda i: F.concat(F.lit("w"), i)))
    odd = base.limit(8).select(
        F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")).alias("doc_id"),
        F.when(F.col("doc_id") % 3 > 0, F.col("text")).alias("text"),
        F.when(F.col("doc_id") % 4 > 0, F.col("lang")).alias("lang"),
        F.when(F.col("doc_id") % 5 > 0, F.col("source")).alias("source"),
        F.lit(None).cast("bigint").alias("n_chars"),
    )
    odd = odd.unionAll(odd).unionAll(odd.limit(1).withColumn("text", long_text)).unionAll(odd.limit(1).withColumn("text", F.lit("")))
    clashing = ("n_words", "fp", "text_hash", "size", "taken", "key", "stratum", "ids", "simhash_id", "quality_counts", "item_id")
    for extra in clashing:
        odd = odd.withColumn(extra, F.lit("x"))
    for start in (odd, odd.filter(F.lit(False))):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR)
            if name != "token output":
                assert docs.columns == odd.columns
        rows = docs.collect()
        assert bool(rows) == (start is odd)
