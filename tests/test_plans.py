"""Driver contract, oracle agreement on the smallest tables, and plan checks."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from quire.plans.oracles import ORACLES
from quire.plans.registry import QUERIES

TABLES = ["documents", "pages", "conversations", "labels", "benchmark"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) >= {"book_id", "text", "md"}


def test_every_query_has_an_oracle():
    # of this part of the library; some training-data operators cannot be put in SQL
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def _norm(rows):
    return sorted(tuple("\x00" if v is None else repr(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", ["A4_text_to_markdown", "E2_split_chapters", "W5_last_slug_wins",
                                  "A2_pages_to_text_range", "A2b_pages_to_markdown", "A3_entries_to_text",
                                  "A5_items_to_markdown", "W2_reflow_lines", "M2_extractive_summary",
                                  "L1_identify_language", "P10_decode_entities"])
def test_oracle_agrees(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    got = df.select(*cols).collect()
    assert _norm(got) == _norm(res.fetchall())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_and_partitioned_windows(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert not _unpartitioned(plan)


def _unpartitioned(plan):
    """Window definitions whose first argument is an order or a frame, not a partition key."""
    first = [d.split(",")[0] for d in plan.split("windowspecdefinition(")[1:]]
    return [d for d in first if " ASC" in d or " DESC" in d or d.startswith("specifiedwindowframe")]


def test_the_window_check_finds_an_unpartitioned_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.range(5)
    assert _unpartitioned(_plan(df.withColumn("n", F.row_number().over(Window.orderBy("id")))))
    assert not _unpartitioned(_plan(df.withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy("id")))))


def test_result_independent_of_partitioning(spark):
    q = E.queries()["A2_pages_to_text"]
    base = _norm(q(spark, SF_SMALL).collect())
    for n in (1, 13):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            assert _norm(q(spark, SF_SMALL).collect()) == base
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_concat_length_invariant(spark):
    from pyspark.sql import functions as F
    from quire.operators import assemble as AS
    from quire.sources import tables as TB
    docs = TB.read_table(spark, SF_SMALL, "documents").withColumn("g", F.col("doc_id") % 7)
    out = AS.concat_docs(docs, "g", "doc_id", "text").select("g", F.length("text").alias("n"))
    exp = docs.groupBy("g").agg((F.sum(F.length("text")) + 2 * F.count("*")).alias("n"))
    assert sorted(out.collect()) == sorted(exp.collect())


def test_filter_and_pruning_reach_the_scan(spark):
    from pyspark.sql import functions as F
    from quire.sources import tables as TB
    df = TB.read_table(spark, SF_SMALL, "documents").where(F.col("lang") == "de").select("doc_id", "text")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,de)]" in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in plan


def test_markdown_conversion_is_narrow(spark):
    plan = _plan(E.queries()["A4_documents_to_markdown"](spark, SF_SMALL))
    # only the spread of the single-row-group scan; no shuffle for the conversion
    assert plan.count("Exchange") <= 1 and "SortMergeJoin" not in plan and "Window" not in plan
