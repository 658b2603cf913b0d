"""The pipeline against brute force of its stages, and the registered queries' shapes."""
import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from wattgrid.llm import queries
from wattgrid.llm.common import table, written

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    names = sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_twins(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLE_SQL[name])
    r = queries.QUERIES[name](spark, SF)
    assert sorted(want.columns) == sorted(r.columns)
    assert sorted(map(str, r.select(*want.columns).toPandas().astype(object).where(lambda x: x.notna(), None).itertuples(index=False, name=None))) == \
        sorted(map(str, want.df().astype(object).where(lambda x: x.notna(), None).itertuples(index=False, name=None)))


def test_stages_take_effect(spark):
    """Each stage on what the one before it kept: rejected, duplicate and near-duplicate rows go, texts change."""
    from tests_llm_brute import exact_keep, near_keep
    docs = table(spark, SF, "documents")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SF), "test-stage")
        steps[name] = (before, docs)
        if name != "best-fit packing":
            assert docs.columns == table(spark, SF, "documents").columns

    def rows(df):
        return {r["doc_id"]: r["text"] for r in df.collect()}
    a, b = map(rows, steps["exact dedup"])
    assert set(b) == exact_keep(a) and all(a[i] == b[i] for i in b)
    a, b = map(rows, steps["simhash near-dedup"])
    assert set(b) == near_keep(a)
    a, b = map(rows, steps["pii"])
    assert set(a) == set(b) and any(a[i] != b[i] for i in a)
    assert {r["doc_id"] for r in steps["best-fit packing"][1].collect()} == set(b)
    assert len(rows(steps["toxicity"][1])) <= len(rows(steps["toxicity"][0]))
