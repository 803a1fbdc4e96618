"""The corpus pipeline on small tables, stage by stage against plain Python, and the registry."""

import importlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__
import corpus_pipeline
from dimload.llm import bradley_terry, rule_ledger
from dimload.llm.tables import without_leftovers
from dimload.session import ensure_checkpoint_dir, sub_folders

from .conftest import HARD, SCHEMA, tokenizer_path, whole_ids
from .test_rules_and_scans import contained, failed, measures
from .test_setjoin import brute


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(8)
    words = [f"word{i}" for i in range(300)]
    rows, labels = [(r[0] if r[0] != 12 else 1000, *r[1:]) for r in HARD[:13]], []
    items = [(i, " ".join(rng.choice(words) for _ in range(20))) for i in range(5)]
    for i in range(20, 170):
        text = [rng.choice(words) for _ in range(rng.randrange(20, 90))]
        if i % 11 == 0:
            text[5:5] = items[i % 5][1].split()
        text = " ".join(text) + "."
        if i % 4 == 0:
            text = " | ".join(text.split())
        if i % 7 == 0 and rows[-1][1]:
            text = rows[-1][1] + " tail"
        rows.append((i, text, "en", "a", len(text)))
        labels.append((i, int("|" not in text), 0))
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_do_what_they_say(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {(r["doc_id"], r["text"]) for r in docs.collect()}
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        if name == "quality_classifier":
            model = bradley_terry.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
            good = {r["doc_id"] for r in bradley_terry.score(docs, model).where("score >= 0.5").collect()}
            want = {d for d in before if d[0] in good}
            assert sum("|" in (d[1] or "") for d in before) > 20 > sum("|" in (d[1] or "") for d in want)
        elif name == "quality_rules":
            want = {d for d in before if not failed(measures(d[1])) & rule_ledger.mask(rule_ledger.VERSION)}
        elif name == "near_duplicates":
            want = {d for d in before if brute(before)[d[0]][1] == d[0]}
            assert len(want) < len(before)
        elif name == "decontamination":
            bad = {d for d, *_ in contained(before, items)}
            want = {d for d in before if d[0] not in bad}
            assert len(want) < len(before)
        else:
            got = {}
            for r in sorted(out.collect(), key=lambda r: r["start"]):
                got.setdefault(r["doc_id"], []).extend(np.frombuffer(r["tokens"], "<u2").tolist())
            assert got == {d: whole_ids(t) + [2] for d, t in before}
            break
        assert out.columns == docs.columns and {(r["doc_id"], r["text"]) for r in out.collect()} == want
        docs = out
    last = corpus_pipeline.run(spark, sf_dir)
    assert {r["doc_id"] for r in last.collect()} == set(got)


def test_stages_of_an_empty_table(spark, sf_dir, empty):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, sf_dir)
        assert out.collect() == [] and (name == "packing" or out.columns == empty.columns)


def test_registry():
    names = list(__spark_entry__.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names
    assert {n for n in __spark_entry__.oracle_sql() if n.startswith("op")} == {"op5_rule_ledger", "op7_warc_index", "op8_minhash_containment", "op12_merkle_manifest"}


def test_entry_works_without_the_subpackage(monkeypatch):
    import sys

    class Missing:
        def find_spec(self, name, path=None, target=None):
            if name.startswith(("dimload.llm", "corpus_pipeline")):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    gone = [m for m in sys.modules if m.startswith(("dimload.llm", "corpus_pipeline"))]
    for m in [*gone, "__spark_entry__"]:
        monkeypatch.delitem(sys.modules, m, raising=False)
    monkeypatch.setattr(sys, "meta_path", [Missing(), *sys.meta_path])
    names = importlib.import_module("__spark_entry__").queries()
    assert "scd_load" in names and not any(n.startswith("op1_") or n == "pipeline" for n in names)


def test_tokenizer_file_is_a_parameter():
    assert zlib.crc32(open(tokenizer_path(), "rb").read()) and tokenizer_path().endswith("word_bpe_49k.json")


def test_stages_bound_arrow_batches_by_bytes(spark, sf_dir, empty):
    conf = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(conf, None)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    try:
        for name, stage in corpus_pipeline.STAGES:
            if name == "decontamination":  # no Python worker
                continue
            spark.conf.unset(conf)
            stage(spark, empty, sf_dir)
            assert int(spark.conf.get(conf)) == 4 << 20, name
        texts = spark.range(0, 5000, 1, 1).selectExpr("repeat('x', 3000) as text")
        assert texts.mapInArrow(sizes, "n long").agg({"n": "max"}).head()[0] < 5 << 20
        spark.conf.set(conf, "1000000")  # the session's own
        corpus_pipeline.packing(spark, empty, sf_dir)
        assert spark.conf.get(conf) == "1000000"
    finally:
        spark.conf.set(conf, before) if before else spark.conf.unset(conf)


def test_a_stage_is_removed_once_the_next_is_written(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(f"try{k}", lambda spark, docs, sf_dir: docs.repartition("doc_id")) for k in range(3)])
    rows = sorted(map(str, corpus_pipeline.run(spark, sf_dir).collect()))
    assert rows == sorted(map(str, spark.read.parquet(f"{sf_dir}/documents.parquet").collect()))
    left = sub_folders(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged")
    assert [name[:10] for name in left if name.startswith("stage-try")] == ["stage-try2"]


def test_the_setting_that_removes_shuffle_files_is_one_that_spark_obeys(spark):
    conf = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(conf)
    with without_leftovers(spark):
        assert spark.conf.get(conf) == "true"
    assert spark.conf.get(conf) == before
