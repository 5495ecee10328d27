"""A saved query leaves nothing in the scratch folder."""

import os

import pytest

from termfold.llm import registry
from termfold.session import saved, scratch_folder, scratch_run, stored

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", ["op1_exact_topk", "op2_warc", "op11_hard_negatives", "op12_exact_dedup", "op13_conversation_trie"])
def test_saved_queries_clean_up(spark, tmp_path, name):
    with scratch_run(spark):
        stored(spark.range(1), "before")
    folder = f"{scratch_folder(spark)}/termfold"
    before = set(os.listdir(folder))
    saved(spark, lambda: registry.queries()[name](spark, SF_DIR), str(tmp_path / "out"))
    assert set(os.listdir(folder)) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0
