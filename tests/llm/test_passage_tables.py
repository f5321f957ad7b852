"""What the passage search leaves behind: its passages only."""

import os

import corpus_pipeline  # noqa: F401  (registers the package with the workers)
from tidewell.llm.queries import QUERIES


def test_only_passages_stay(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    found = QUERIES["op10_passages"](spark, "/root/testdata/sf0.001")
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("passage_texts")]
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(shared)) - before}
    assert left == {"passage-found", "passage-compared"}
    assert found.count() > 0
