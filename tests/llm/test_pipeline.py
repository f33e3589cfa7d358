"""The pipeline stage by stage, against the plain versions of its operators."""

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from lethe.llm import pieces, quality
from lethe.llm.frames import table
from tests.conftest import SMALL
from tests.llm.test_dedup import plain_components, plain_fingerprint
from tests.llm.test_lines import plain_whole_report
from tests.llm.test_pieces import plain_encode
from tests.llm.test_screening import documents
from tests.llm.test_search import plain_leaks


def expected(spark, rows):
    """What the pipeline does to rows (doc_id, text, lang, ...), for unique ids that are not null."""
    judged = quality.judge_documents(documents(spark, rows)).where("kept").collect()
    kept = {r["doc_id"] for r in judged}
    rows = [r for r in rows if r[0] in kept]
    dropped = {i: set(map(int, d.split(","))) if d else set() for i, *_, d in plain_whole_report([r[:2] for r in rows])}
    texts = {
        r[0]: "\n".join(x for no, x in enumerate(r[1].split("\n")) if no not in dropped[r[0]]) for r in rows
    }
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    roots = plain_components(set(prints.values()), 3)
    first = {}
    for i, p in prints.items():
        first[roots[p]] = min(i, first.get(roots[p], i))
    texts = {i: t for i, t in texts.items() if first[roots[prints[i]]] == i}
    bench = [tuple(r) for r in table(spark, SMALL, "benchmark").select("item_id", "text").collect()]
    leaking = {doc for doc, _ in plain_leaks(list(texts.items()), bench)}
    return {i: t for i, t in texts.items() if i not in leaking}


def test_pipeline_equals_plain_stages(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    texts = expected(spark, rows)
    found = corpus_pipeline.run(spark, SMALL)
    back = found.select("doc_id", "lossless", "ids", pieces.decode(F.col("ids"), public_tokenizers.path(corpus_pipeline.MODEL)).alias("text")).collect()
    assert 0 < len(texts) < len(rows)
    assert {r["doc_id"]: r["text"] for r in back} == texts and len(back) == len(texts)
    assert all(r["lossless"] for r in back)
    keys = {r["doc_id"]: r["k"] for r in found.select("doc_id", F.xxhash64("doc_id").alias("k")).collect()}
    short = [r for r in back if len(r["text"]) < 600][:10]
    assert short and all(r["ids"] == plain_encode(r["text"], keys[r["doc_id"]]) for r in short)


def test_stages_keep_columns_and_take_odd_rows(spark):
    docs = documents(spark)
    columns = [*docs.columns, "TEXT", "__key"]
    docs = docs.withColumn("more", F.lit("x")).withColumn("__key", F.lit(1)).toDF(*columns)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns or k == 4
        assert docs.count() > 0
    empty = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SMALL)
        assert empty.count() == 0
