"""A corpus pipeline of training-data operators, each stage a table the next one reads."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import tidewell
from tidewell.llm import decontaminate, language, lines, mixing, simhash
from tidewell.scratch import written

# Executors need no copy of the package: its functions travel by value.
cloudpickle.register_pickle_by_value(tidewell)

#: (name, function of spark, documents and table folder). Rows keep the columns of documents,
#: but for the last stage, which adds what the mix decides.
STAGES = [
    ("language", language.accepted),
    ("lines", lines.deduplicated),
    ("simhash", simhash.first_of_each),
    ("decontaminate", decontaminate.clean),
    ("mixing", mixing.mixed),
]

# Trained models, fingerprints and Newton steps are not SQL: tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
