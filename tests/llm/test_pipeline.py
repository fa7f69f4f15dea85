"""The pipeline's stages against plain versions of their rules, and the queries' columns."""

import plain
import pytest
from pyspark.sql import functions as F
from test_dedup import SCHEMA, corpus

import corpus_pipeline
from tidewatch.llm import catalog, language, simhash
from tidewatch.llm.frames import stored

SMALL = "/root/testdata/sf0.001"
CONTRACT = {
    "op1_quality_rules": {"doc_id": "long", "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
                          "n_repeat_words": "long", "base_failed": "boolean", "kept": "boolean"},
    "op2_bpe": {"doc_id": "long", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"},
    "op3_language_id": {"doc_id": "long", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op4_simhash_near_dedup": {"doc_id": "long", "fingerprint": "string", "component_id": "long"},
    "op5_line_dedup": {"doc_id": "long", "n_lines": "long", "n_removed": "long", "kept_sha256": "string"},
    "op6_token_records": {"doc_id": "long", "start": "long", "n_tokens": "long", "ids_crc32": "long"},
    "op7_exact_dedup": {"doc_id": "long", "keep_id": "long", "group_size": "long", "kept": "boolean", "text_sha256": "string"},
    "op8_packing": {"doc_id": "long", "start": "long", "length": "long", "ids_crc32": "long", "doc_tokens": "long", "sequence_id": "long", "offset": "long"},
    "op9_html_extraction": {"page_id": "long", "url": "string", "text": "string", "n_chars": "long"},
    "op10_substring_dedup": {"doc_id": "long", "n_words": "long", "n_removed": "long", "kept_sha256": "string"},
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns_and_rows(spark, name):
    got = catalog.entries()[name].run(spark, SMALL)
    kinds = {f.name: f.dataType.typeName() for f in got.schema.fields}
    assert CONTRACT[name].items() <= kinds.items()
    table = "pages" if name.startswith("op9") else "documents"
    rows = spark.read.parquet(f"{SMALL}/{table}.parquet").count()
    assert got.count() >= rows if name.startswith("op8") else got.count() == rows


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stages_one_by_one(spark):
    """Each stage is judged on what the one before it kept."""
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in corpus(6) if i is not None]
    rows = list({r[0]: r for r in rows}.values()) + [(None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    stages = dict(corpus_pipeline.STAGES)

    known = stored(stages["language ID"](spark, docs, SMALL))
    lettered = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    assert listed(known) == sorted(lettered, key=repr)

    single = stored(stages["exact dedup"](spark, known, SMALL))
    keep = {r[0] for r in plain.exact([r[:2] for r in lettered]) if r[3]}
    rest = [r for r in lettered if r[0] in keep]
    assert listed(single) == sorted(rest, key=repr)

    apart = stored(stages["SimHash near-dedup"](spark, single, SMALL))
    tops = plain.linked([plain.fingerprint(r[1]) for r in rest])
    rest = [min((r for r, t in zip(rest, tops, strict=True) if t == top), key=plain.rank) for top in set(tops)]
    assert listed(apart) == sorted(rest, key=repr)

    cut = stored(stages["substring dedup"](spark, apart, SMALL))
    rest.sort(key=plain.rank)
    shorter = plain.passages([r[:2] for r in rest])
    assert any(n for _, _, n, _ in shorter)
    rest = [(*r[:1], text, *r[2:4], len(text)) if gone else r for r, (_, _, gone, text) in zip(rest, shorter, strict=True)]
    assert listed(cut) == sorted(rest, key=repr)

    packed = stages["packing"](spark, cut, SMALL)
    assert packed.agg(F.sum("length")).first()[0] == sum(len(plain.ids(r[1])) + 1 for r in rest)


def test_stages_of_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.collect() == []
        docs = stored(docs) if "text" in docs.columns else docs


def test_extra_columns_pass_through(spark):
    docs = spark.createDataFrame([(1, "the one text of it", "en", "s", 18), (2, "the other text here", "en", "s", 19)], SCHEMA)
    docs = docs.withColumn("id", F.lit(1)).withColumn("root", F.lit("r")).withColumn("row", F.lit(2.0)).withColumn("doc", F.array(F.lit(1)))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SMALL)
        assert got.schema.simpleString() == docs.schema.simpleString(), name
        assert got.count() == 2


def test_whole_pipeline(spark):
    got = corpus_pipeline.run(spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = simhash.drop_near_copies(corpus_pipeline.drop_exact_copies(spark, language.keep_identified(docs), SMALL))
    assert {r[0] for r in got.select("doc_id").distinct().collect()} == {r[0] for r in kept.select("doc_id").collect()}
