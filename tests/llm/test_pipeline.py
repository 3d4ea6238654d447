import re
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.frames import docs
from tidemark.llm.common import put, table
from tidemark.llm.queries import QUERIES
from tidemark.llm import simhash

FOLDER = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the driver's tables are not here")


def test_registered():
    names = entry.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {re.match(r"op\d+_", q)[0] for q in QUERIES} and "pipeline" in names


@here
def test_stages_and_run_agree(spark):
    frame = table(spark, FOLDER, "documents")
    start = frame.count()
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before, frame = frame, put(stage(spark, frame, FOLDER), f"test-{name}")
        kept.append(frame.count())
        if name != "best_fit_packing":
            assert frame.columns == before.columns
        if name == "simhash_near_dedup":
            found = simhash.near_duplicates(before).select("fp", "component_id").distinct().collect()
            prints = [r.fp for r in simhash.fingerprints(frame).select("fp").collect()]
            assert all(((a ^ b) % (1 << 64)).bit_count() > 2 for i, a in enumerate(prints) for b in prints[:i])
            assert len(prints) == len({r.component_id for r in found})
    assert start > kept[0] > 0.7 * start and kept[1] == kept[0] and kept[2] <= kept[1]
    bins = frame.collect()
    assert all(b.n_words <= 2048 for b in bins)
    again = corpus_pipeline.run(spark, FOLDER).collect()
    order = lambda rows: sorted(map(str, rows))
    assert order(bins) == order(again)


def test_every_stage_takes_awkward_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([(0, 0, 0), (1, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for frame in (docs(spark), docs(spark, [])):
        stored = frame.select("doc_id", "text", "lang", "source", "n_chars")
        for name, stage in corpus_pipeline.STAGES:
            stored = put(stage(spark, stored, str(tmp_path)), f"awkward-{name}")
            stored.count()
