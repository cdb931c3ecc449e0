"""The queries of the package on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from check_queries import compare, connect  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from quayside.llm import registry  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert {name.split("_")[0] for name in registry.QUERIES} == {*(f"op{n}" for n in range(1, 14)), "pipeline"}
    assert set(registry.QUERIES) <= set(entry.queries()) and set(registry.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF_DIR), name, SF_DIR) is None


def test_stages_keep_clean_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / f"stage{n}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{n}"))
        counts.append(docs.count())
        assert docs.columns == columns or n == 4
    assert counts[0] >= counts[1] == counts[2] > counts[3] >= counts[4] > 0.8 * counts[0]
    assert docs.select("doc_id").distinct().count() == counts[4]
    assert docs.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").isEmpty()
