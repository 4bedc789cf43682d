import os
import subprocess
import sys

import pytest

import corpus_pipeline
from lodestat.llm import simhash
from lodestat.llm.decontaminate import leaks
from lodestat.llm.queries import ORACLES, QUERIES, tokenizer_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    import __spark_entry__ as entry
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, seen[-1], sf).write.parquet(str(tmp_path / name))
        seen.append(spark.read.parquet(str(tmp_path / name)))
    assert all(d.columns == docs.columns for d in seen[:-1])
    ids = [{r[0] for r in d.select("doc_id").collect()} for d in seen]
    assert all(b <= a for a, b in zip(ids, ids[1:], strict=False)) and len(ids[-1]) > 0.6 * len(ids[0])
    # What a stage has removed, it would not find again.
    distinct = simhash.near_duplicates(seen[2])
    assert distinct.where("doc_id != component_id").count() == 0
    assert leaks(seen[4], spark.read.parquet(f"{sf}/benchmark.parquet")).count() == 0
    kept = {r["doc_id"]: r["text"] for r in seen[4].collect()}
    from test_packing import check
    from tokenizers import Tokenizer
    check(Tokenizer.from_file(tokenizer_path()), list(kept.items()), seen[5].collect())


def test_run_equals_stages(spark, sf):
    assert corpus_pipeline.run(spark, sf).select("doc_id").distinct().count() > 0


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_edges(spark, sf, edge_docs, no_docs, stage):
    out = stage(spark, edge_docs, sf)
    assert out.count() > 0 and stage(spark, no_docs, sf).count() == 0


def test_entry_imports_without_this_part(tmp_path):
    """The guard, and only it, lets the entry module work without the pipeline and the operators."""
    code = ("import sys\nclass No:\n    def find_spec(self, name, path=None, target=None):\n"
            "        if name == 'corpus_pipeline' or name.startswith('lodestat.llm'): raise ModuleNotFoundError(name=name)\n"
            "sys.meta_path.insert(0, No())\nimport __spark_entry__ as e\nassert 'pipeline' not in e.queries() and len(e.queries()) > 100\n")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
