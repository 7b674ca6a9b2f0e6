"""The registered queries on the given tables: against their SQL where there is one, else whole and without a crash."""

import duckdb
import pytest

from surgeline.llm import queries


def plain(rows, names):
    return sorted((tuple(str(r[n]) for n in names) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_its_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    found = con.execute(queries.ORACLES[name])
    names = [d[0] for d in found.description]
    want = [dict(zip(names, r)) for r in found.fetchall()]
    got = queries.QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(names)
    floats = {c for c, kind in got.dtypes if kind == "double"}
    tidy = lambda r: {n: round(r[n], 6) if n in floats and r[n] is not None else r[n] for n in names}
    assert plain([tidy(r) for r in got.collect()], names) == plain([tidy(r) for r in want], names)


@pytest.mark.parametrize("name", ["op1_sentencepiece", "op2_sharding", "op10_near_dedup", "op12_alignment"])
def test_has_a_row_for_each_document(spark, sf, name):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = queries.QUERIES[name](spark, sf)
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_passages_and_neighbours(spark, sf):
    assert queries.QUERIES["op3_substring_dedup"](spark, sf).filter("equal_words >= 40").count() > 0
    asked = spark.read.parquet(f"{sf}/embeddings.parquet").filter("vec_id % 50 = 0").count()
    assert queries.QUERIES["op5_ann"](spark, sf).count() == 5 * asked
