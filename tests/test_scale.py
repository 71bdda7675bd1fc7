"""What queries do over larger tables: rows are dealt over all cores, plans stay small, repeated rows stay."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import names as N
from ledgerloom.operators import contacts as C
from ledgerloom.plans import catalogue

SF = "/root/testdata/sf0.001"


DEALT = "names_in_text udtf_extract_page pair_people udtf_email_occurrences page_links browser_targets page_flags udtf_profile_inventory portal_lookup identity_score_classic identity_signals_batch".split()


@pytest.mark.parametrize("name", DEALT)
def test_rows_of_a_narrow_table_are_dealt_over_all_cores(spark, name):
    plan = catalogue.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"RoundRobinPartitioning\((\d+)\), REPARTITION_BY_NUM", plan)
    assert dealt and int(dealt[0]) >= 4 * spark.sparkContext.defaultParallelism


def test_names_of_a_text_are_computed_once(spark):
    text = "Mgr. Jan Novák a Eva Malá\nNovák Jan\nEva MALÁ, Škola Praha"
    rows = spark.createDataFrame([(text,), (None,), ("",)], "t string").select(N.names_in(F.col("t")).alias("n"))
    assert [[tuple(p) for p in r["n"]] for r in rows.collect()] == [[("Jan", "Novák", "Novák Jan"), ("Eva", "MALÁ", "Eva MALÁ")], [], []]
    # split_name stands twice in the plan, once for whole lines and once for runs
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("split(") <= 4


def test_pages_captured_twice_and_references_cut_off_equal_the_sql(spark, tmp_path):
    html = '<!DOCTYPE html><html><head><title>token = &quot</title></head><body><h1>a &lt b &amp</h1><p>x &gt</p><a href="/a">a</a><a href="/b">b</a></body></html>'
    rows = [(1, "https://zs.example.org/x", html), (2, "https://zs.example.org/x", html), (3, "https://zs.example.org/y", html.replace("&quot", "&quot;"))]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    with duckdb.connect() as duck:
        duck.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
        for name in ("link_admission", "page_outline"):
            got = catalogue.queries()[name](spark, str(tmp_path))
            want = duck.sql(catalogue.oracle_sql()[name])
            assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall()), name


def test_unions_shuffle_each_column_once(spark):
    plan = catalogue.queries()["dedupe_first_union"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_shipdate" in plan and "observed_at" not in plan and "confidence" not in plan
    columns = "mailbox string, person int, source string, role string, pos int, school int"
    rows = spark.createDataFrame([("a", 1, "y", "r", 2, 7), ("a", 1, "x", None, 1, 8), ("a", 1, "y", "s", 3, 9), ("b", 1, "x", "r", 1, 7), ("b", 2, "x", "r", 2, 7)], columns)
    (got,) = C.first_with_unions(rows).collect()
    assert got.asDict() == {"mailbox": "a", "person": 1, "source": "x", "role": None, "pos": 1, "school": 8, "sources": ["x", "y"], "roles": ["r", "s"]}


def test_sightings_are_dealt_by_what_is_counted(spark):
    rows = spark.createDataFrame([("a", "x", "T"), ("a", "x", "T"), ("a", "y", "T"), ("a", None, "T"), ("b", "x", None)], "mailbox string, source string, kind string")
    got = C.sightings(rows)
    assert sorted(map(tuple, got.collect())) == [("a", 4, 2, 2), ("b", 1, 0, 1)]
    assert "hashpartitioning(mailbox, source, kind" in re.sub(r"#\d+", "", got._jdf.queryExecution().executedPlan().toString())
    assert "REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString()
