"""The five stages and the registered queries."""

import hashlib
import importlib
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline as P
from tabula.llm import classifier_chain, golay_dedup, importance, packing
from tabula.llm.queries import QUERIES
from tabula.llm.suffix_dedup import brute_force

from .test_golay_dedup import brute_components, reference_fp
from .test_packing import check, whole

SF = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    importlib.import_module("tabula.llm.queries")


def test_stages_follow_each_other(spark):
    """Each stage against a brute-force version of it on the same input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = P.quality_rules(spark, docs, SF).cache()
    kept = {r.doc_id for r in importance.judged(docs, labels).where("kept").collect()}
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == kept
    clean = P.toxicity(spark, good, SF).cache()
    toxic = {r.doc_id for r in classifier_chain.scored(good, labels).where("predicted = 1").collect()}
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == kept - toxic
    single = P.near_duplicates(spark, clean, SF).cache()
    label = brute_components([(r.doc_id, reference_fp(r.text)) for r in clean.collect()])
    assert single.columns == docs.columns
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(label.values()))
    rest = P.repeated_passages(spark, single, SF).cache()
    rows = single.collect()
    left = {r.doc_id: r for r in rest.collect()}
    want = brute_force([r.text.encode() for r in rows])
    assert rest.columns == docs.columns and len(left) == len(rows)
    for r, (n_bytes, gone, _, sha) in zip(rows, want):
        text = left[r.doc_id].text
        assert left[r.doc_id].n_chars == len(text)
        if text.encode() and hashlib.sha256(text.encode()).hexdigest() != sha:
            assert n_bytes - gone - len(text.encode()) in range(1, 30)      # halves of characters
    found = P.packed_sequences(spark, rest, SF).collect()
    assert check(found, [(r.doc_id, r.text) for r in left.values()], 2048) == 0


def test_run_gives_what_the_stages_give(spark):
    out = P.run(spark, SF).collect()
    assert out and {"doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(out[0].asDict())
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id for r in out} <= set(docs)


@pytest.mark.parametrize("stage", P.STAGES, ids=lambda s: s[0])
def test_stages_on_edge_cases(spark, stage, edge_docs, no_docs):
    name, function = stage
    out = function(spark, edge_docs, SF)
    if stage is not P.STAGES[-1]:
        assert out.columns == edge_docs.columns
    out.collect()
    assert function(spark, no_docs, SF).collect() == []


def test_checksums_of_a_known_text():
    ids = np.array(whole("hello world"), "<u4")
    encoder = packing.WordEncoder(packing.Tokenizer.from_file(
        importlib.import_module("public_tokenizers").path("word_bpe_49k.json")).to_str(), 1)
    assert zlib.crc32(next(iter(encoder(["hello world"]))).tobytes()) == zlib.crc32(ids.tobytes())


def test_registered_near_duplicates_use_three_words_and_three_bits():
    assert golay_dedup.MAX_BITS == 3 and golay_dedup.near_duplicates.__defaults__[2:] == (3, 3)
