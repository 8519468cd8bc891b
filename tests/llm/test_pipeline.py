"""The pipeline's stages on a small corpus with known cases, and the registry."""

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.llm.test_join_and_search import shingles

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in cp.STAGES:
        out.append(cp.materialize(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def test_stages_keep_the_columns(results):
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "decontaminate", "pseudonyms", "tokens"]
    for df in results[1:-1]:
        assert df.schema.names == results[0].schema.names
    assert results[-1].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_quality_stage_follows_the_labels(spark, results):
    labels = spark.read.parquet(f"{SF}/labels.parquet").groupBy("doc_id").agg(F.max("quality").alias("q"))
    kept = results[1].select("doc_id").withColumn("kept", F.lit(1))
    got = labels.join(kept, "doc_id", "left").groupBy("q").agg(F.count("*").alias("n"), F.count("kept").alias("k"))
    share = {r["q"]: r["k"] / r["n"] for r in got.collect()}
    assert share[1] >= 0.97 and share[0] <= 0.05


def test_near_duplicate_stage_keeps_one_of_each_group(results):
    before = {r["doc_id"]: shingles(r["text"], 5) for r in results[1].select("doc_id", "text").collect()}
    after = {r["doc_id"] for r in results[2].select("doc_id").collect()}
    alike = lambda a, b: bool(a & b) and 100 * len(a & b) >= 80 * len(a | b)
    by = {}
    for d, s in before.items():
        for g in s:
            by.setdefault(g, []).append(d)
    root = {d: d for d in before}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    seen = set()
    for ds in by.values():
        for i, a in enumerate(ds):
            for b in ds[:i]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    if find(a) != find(b) and alike(before[a], before[b]):
                        root[find(a)] = find(b)
    groups = {}
    for d in before:
        groups.setdefault(find(d), []).append(d)
    assert after == {min(g) for g in groups.values()}


def test_decontaminated_texts_hold_no_item(spark, results):
    flat = lambda t: " ".join((t or "").lower().split())
    items = [flat(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = ({r["doc_id"]: flat(r["text"]) for r in results[i].collect()} for i in (2, 3))
    bad = {d for d, t in before.items() if any(i in t for i in items)}
    assert bad and not bad & after.keys() and before.keys() - after.keys() == bad


def test_registry_lists_every_operator():
    names = E.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names


def test_run_equals_the_stages(spark, results):
    got = {tuple(r) for r in cp.run(spark, SF).collect()}
    assert got == {tuple(r) for r in results[-1].collect()}


def test_stages_take_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = cp.materialize(stage(spark, docs, SF_SMALL), "test-empty")
        assert docs.count() == 0
