"""Every operator on empty tables, nulls in each column, repeated rows, very long texts, and further columns with its own names."""

import pytest
from pyspark.sql import functions as F

from tracewell.llm import bpe, html_crf, license_scan, line_dedup, media, near_vectors, ngram_join, packing, quality

LONG = "word " * 60_000
ROWS = [(1, "a few words of text here"), (1, "a few words of text here"), (2, "a few words of text here"), (3, None), (4, ""), (None, "no id"), (None, None), (5, LONG)]
#: Names that operators use within or return.
CLASHES = "n_shingles component_id component id key key2 set_id tokens line lines content leaf keys n_lines n_dropped _id _lines _content score piece start length offset sequence_id n_tokens ids n_bytes payload feature license kind directory path_ n size hash part".split()


def _texts(spark, rows=ROWS, clash=False):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs.select("*", *[F.lit("x").alias(c) for c in CLASHES]) if clash else docs


def _scan(docs):
    path = F.concat(F.lit("a/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return license_scan.scan(docs.withColumn("path", path))


def _score(docs):
    return quality.add_score(docs, quality.train(docs, docs.sparkSession.createDataFrame([(1, 1), (4, 0), (None, None)], "doc_id long, quality int")))


def _digest(docs):
    return media.digest(docs, lpc_order=2)


def _pack(docs):
    return packing.pack(packing.token_pieces(docs, bpe.vocabulary()))


def _round_trip(docs):
    return bpe.round_trip(docs, bpe.vocabulary())


OPERATORS = [_pack, ngram_join.near_duplicates, _round_trip, line_dedup.dedup_lines, _score, _scan, _digest]


@pytest.mark.parametrize("operator", OPERATORS, ids=lambda f: f.__name__)
def test_texts(spark, operator):
    assert operator(_texts(spark, [])).count() == 0
    plain, clash = (operator(_texts(spark, clash=c)).collect() for c in (False, True))
    assert len(plain) == len(clash)
    if operator is _pack:
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["piece"]) for r in plain if r["doc_id"] != 5) == sorted((i is None, i or 0, 0) for i, _ in ROWS if i != 5)
    else:
        assert len(plain) == len(ROWS)
    shared = [c for c in plain[0].asDict() if c not in ("sequence_id", "offset")] if plain else []
    assert sorted(repr([r[c] for c in shared]) for r in plain) == sorted(repr([r[c] for c in shared]) for r in clash)
    seen = {}
    for r in plain:  # repeated rows get one result
        seen.setdefault(r["doc_id"], set()).add(repr([r[c] for c in shared]))
    assert len(seen[1]) == 1


def test_pages(spark):
    schema = "page_id long, url string, html string"
    assert html_crf.extract(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "u", "<p>x"), (1, None, None), (2, "u", ""), (3, "u", "<b>x y<br>" * 20_000), (3, "u", "<b>x y<br>" * 20_000)]
    pages = spark.createDataFrame(rows, schema)
    clash = pages.select("*", F.lit(1).alias("text"), F.lit("x").alias("n_chars"))
    plain, other = ([tuple(r) for r in html_crf.extract(p).orderBy(F.col("page_id").asc_nulls_first()).collect()] for p in (pages, clash))
    assert plain == other and len(plain) == len(rows) and plain[3] == plain[4]
    assert all(r[3] == len(r[2]) for r in plain)


def test_vectors(spark):
    schema = "vec_id long, vector array<float>, label int"
    names = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").schema
    value = next(f.name for f in names if f.dataType.typeName() == "array")
    none = spark.createDataFrame([], schema).withColumnRenamed("vector", value)
    assert near_vectors.near_duplicates(none).count() == 0
    same = [1.0, 2.0, 3.0, 4.0]
    rows = [(1, same, 1), (1, same, 1), (2, same, None), (None, same, 0), (3, None, 1), (4, [0.0] * 4, 1), (5, [1.0, None, 3.0, 4.0], 1)]
    vectors = spark.createDataFrame(rows, schema).withColumnRenamed("vector", value)
    got = near_vectors.near_duplicates(vectors.select("*", *[F.lit("x").alias(c) for c in ("n_links", "component_id", "kept", "id", "key", "values", "hash")])).collect()
    assert len(got) == len(rows)
    assert {(r["n_links"], r["component_id"]) for r in got if r["vec_id"] == 1} == {(2, 1)}
    assert all(r["n_links"] == 0 and r["component_id"] == r["vec_id"] and r["kept"] for r in got if r["vec_id"] in (3, 4, 5))
