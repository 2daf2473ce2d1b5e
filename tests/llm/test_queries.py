"""Registered corpus queries against their SQL, the pipeline against brute force, on the smallest tables."""

import hashlib
import os
import sys

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

import __spark_entry__ as entry
import corpus_pipeline
from compare import TABLES, rows_of
from sensorwarden.llm.queries import QUERIES

from . import brute

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def test_registered():
    assert set(QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "ngram_jaccard_join", "benchmark_decontamination", "byte_bpe"
    ]


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(entry.oracle_sql())))
def test_query_matches_sql(spark, db, name):
    frame = QUERIES[name](spark, SF)
    result = db.execute(entry.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(names, result.fetchall())


def test_toxicity_and_quality_against_labels(spark, db):
    labels = {d: (q, t) for d, q, t in db.execute("select doc_id, quality, toxic from labels").fetchall()}
    toxic = QUERIES["op6_toxicity"](spark, SF).collect()
    total = db.execute("select count(*) from documents").fetchone()[0]
    assert len(toxic) == total and all(r.predicted == int(r.score >= 0.5) for r in toxic)
    known = [(r.predicted, labels[r.doc_id][1]) for r in toxic if r.doc_id in labels]
    assert sum(p == t for p, t in known) >= 0.9 * len(known)
    quality = QUERIES["op3_quality"](spark, SF).collect()
    known = [(int(r.keep), labels[r.doc_id][0]) for r in quality if r.doc_id in labels]
    assert len(quality) == total and sum(p == q for p, q in known) >= 0.95 * len(known)


def test_bpe_against_tiktoken(spark, db):
    import tiktoken

    from sensorwarden.llm.byte_bpe import read_ranks

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = read_ranks(file.read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = dict(db.execute("select doc_id, text from documents").fetchall())
    for row in QUERIES["op4_byte_bpe"](spark, SF).collect():
        ids = library.encode_ordinary(texts[row.doc_id] or "")
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and row.n_tokens == len(ids)
        assert row.decoded_sha256 == hashlib.sha256((texts[row.doc_id] or "").encode()).hexdigest()


def test_pipeline_stages_against_brute_force(spark, db):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.limit(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), *docs.columns[2:])
    more = {name: F.lit("x") for name in ("toxicity", "item_hits", "row", "edge", "_gone", "component_id")}
    docs = docs.unionByName(odd).unionByName(docs.limit(1)).withColumns(more)

    def held(frame):
        assert frame.columns == docs.columns
        return sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr)

    calm = stages["toxicity"](spark, docs, SF)
    left = held(calm)
    assert 0 < len(left) < docs.count()
    expected = sorted(((d, dict(left)[d]) for d, _, _, keep, _ in brute.exact(left) if keep), key=repr)
    single = stages["exact_dedup"](spark, calm, SF)
    assert held(single) == expected
    groups = brute.components([row for row in expected if row[0] is not None], 80, 5)
    expected = [row for row in expected if row[0] is None or groups[row[0]][1] == row[0]]
    apart = stages["ngram_jaccard_join"](spark, single, SF)
    assert held(apart) == expected
    items = db.execute("select item_id, text from benchmark").fetchall()
    hit = {d for d, *_ in brute.contained(expected, items, 80, 5)}
    expected = [row for row in expected if row[0] not in hit]
    clean = stages["benchmark_decontamination"](spark, apart, SF)
    assert held(clean) == expected
    encoded = {r.doc_id: r.decoded_sha256 for r in stages["byte_bpe"](spark, clean, SF).collect()}
    assert encoded == {d: brute.sha(t or "") for d, t in expected}


def test_pipeline_runs(spark):
    assert entry.queries()["pipeline"](spark, SF).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
