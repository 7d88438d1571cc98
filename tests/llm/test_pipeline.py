"""The pipeline against a version that goes through the rows one by one."""

import public_tokenizers
import pytest

import corpus_pipeline as cp
from tidemark.llm import decontam, packing, secret_scan, toxicity

from .conftest import SF
from .test_decontam import brute_leaks
from .test_packing import check
from .test_simhash import brute_classes


def test_stages(spark):
    assert [name for name, _ in cp.STAGES] == ["toxicity", "near_dedup", "decontamination", "secrets", "packing"]
    assert cp.ORACLE_SQL is None


def test_run_against_row_by_row(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    model = toxicity.learn_toxicity(docs, labels)
    rows = [(r.doc_id, r.text) for r in docs.collect()
            if float(toxicity._scores(__import__("pandas").Series([r.text]), model, "test")[0]) < toxicity.THRESHOLD]
    rows = [(d, t) for d, t in rows if d in {c for *_, c in brute_classes(rows)}]
    leaked = {d for d, _ in brute_leaks(rows, items)}
    rows = [(d, t) for d, t in rows if d not in leaked]
    left = spark.createDataFrame(rows, "doc_id long, text string")
    redacted = secret_scan.redact_secrets(left, secret_scan.train_markov(left)).collect()
    pieces = cp.run(spark, SF).collect()
    check(pieces, {r.doc_id: r.text for r in redacted})


def test_stages_keep_columns_and_cope_with_odd_rows(spark):
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "fine words here", "en", "s", 15), (3, "fine words here", "en", "s", 15), (None, "other words are here", None, "s", 20)]
    docs = spark.createDataFrame([(*r, 0.5, "x") for r in odd], "doc_id long, text string, lang string, source string, n_chars long, score double, __row string")
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        kept = sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect())
        assert kept == ([(False, 1), (False, 3), (True, 0)] if name == "near_dedup" else [(False, 1), (False, 2), (False, 3), (False, 3), (True, 0)]), name
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert cp.STAGES[-1][1](spark, docs, SF).count() == 5


@pytest.mark.parametrize("module", [decontam, packing, secret_scan, toxicity])
def test_operators_do_not_name_a_local_folder(module):
    assert "tempfile" not in open(module.__file__).read()


def test_tokenizer_path_is_a_parameter():
    assert public_tokenizers.path(cp.PACKING_TOKENIZER)
