import subprocess
import sys
from collections import defaultdict
from pathlib import Path

import corpus_pipeline
import pytest
from helpers import CLASHING, documents, empty, words

from cartwise.llm import queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """What each stage got and what it returned."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, sf_dir)
        result.write.parquet(f"{folder}/{name}")
        result = spark.read.parquet(f"{folder}/{name}")
        seen[name] = (docs, result)
        docs = result
    return seen


def test_order_and_columns(stages):
    assert list(stages) == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "substring_dedup", "packing"]
    for name, (docs, result) in stages.items():
        if name != "packing":
            assert result.columns == COLUMNS, name
            assert result.dtypes == docs.dtypes


def test_rejected_documents_go(stages, spark, sf_dir):
    docs, kept = stages["quality_classifier"]
    scores = queries.QUERIES["op5_quality"](spark, sf_dir)
    want = {r.doc_id for r in scores.where("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == want and docs.count() > len(want)


def test_one_of_equal_texts(stages):
    docs, kept = stages["exact_dedup"]
    first = {}
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        first.setdefault(" ".join((r.text or "x").split()), r.doc_id)
    assert {r.doc_id for r in kept.collect()} == set(first.values())


def test_one_of_each_near_group(stages):
    from test_simhash import plain_components, plain_fingerprint
    docs, kept = stages["simhash_near_dedup"]
    want = plain_components({r.doc_id: plain_fingerprint(r.text) for r in docs.collect()})
    assert {r.doc_id for r in kept.collect()} == set(want.values())


def test_texts_lose_repeats_only(stages):
    docs, kept = stages["substring_dedup"]
    before = {r.doc_id: r.text for r in docs.collect()}
    after = {r.doc_id: r for r in kept.collect()}
    assert set(before) == set(after)
    for i, r in after.items():
        assert len(r.text) <= len(before[i]) and r.n_chars == len(r.text)
        assert set(r.text.split()) <= set(before[i].split()) or len(r.text) < len(before[i])


def test_every_token_is_packed(stages):
    docs, pieces = stages["packing"]
    length, total = defaultdict(int), {}
    for r in pieces.collect():
        length[r.doc_id] += r.length
        total[r.doc_id] = r.doc_tokens
    assert length == total and len(total) == docs.count()


def test_run(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir).select("doc_id", "start", "length", "ids").collect()
    want = stages["packing"][1].select("doc_id", "start", "length", "ids").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_odd_rows_and_empty_tables(spark, sf_dir):
    rows = [(1, words(80)), (2, words(80)), (2, words(80)), (3, None), (4, ""), (None, words(60, 3)), (5, words(9000, 4))]
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, documents(spark, rows), sf_dir)
        if name != "packing":
            assert result.columns == COLUMNS + list(CLASHING), name
        ids = {r.doc_id for r in result.collect()}
        assert ids <= {1, 2, 3, 4, 5, None} and 1 in ids, name
        assert stage(spark, empty(spark), sf_dir).collect() == [], name


def test_every_operator_is_registered():
    import __spark_entry__
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and set(queries.ORACLE) <= set(names)


def test_entry_without_the_subpackage(tmp_path):
    """A copy of the repository without the llm folders and the pipeline still imports."""
    repo = Path(__file__).resolve().parents[2]
    for source in repo.glob("cartwise/**/*.py"):
        if "llm" not in source.parts:
            copy = tmp_path / source.relative_to(repo)
            copy.parent.mkdir(parents=True, exist_ok=True)
            copy.write_text(source.read_text())
    (tmp_path / "__spark_entry__.py").write_text((repo / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; print(sum(n.startswith('op') and n[2:3].isdigit() or n == 'pipeline' for n in e.queries()), len(e.queries()) > 50)"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                          env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, timeout=100)
    assert done.stdout.split()[-2:] == ["0", "True"], done.stderr
