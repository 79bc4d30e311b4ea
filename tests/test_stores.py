"""Every query that writes and reads back gives its SQL's rows, and leaves no table or setting behind."""

import sys
from pathlib import Path

import duckdb
import pytest

from sparkmart.sources import readers

from sparkmart.plans import registry
from tests.conftest import SF001

STORES = ["silver_from_csv", "legacy_customers", "bulk_csv_load", "orders_by_sql_file", "country_product",
          "customers_as_json", "catalog_loads", "order_reviews", "holiday_flags", "customers_without_returns"]


@pytest.mark.parametrize("name", STORES)
def test_rows_match_sql(spark, name):
    before = {t.name for t in spark.catalog.listTables()}, spark.conf.get("spark.sql.legacy.javaCharsets", None)
    df = registry.queries()[name](spark, SF001)
    con = duckdb.connect()
    for f in Path(SF001).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    cols = sorted(df.columns)
    sql = registry.oracle_sql()[name]
    theirs = con.execute("SELECT " + ", ".join(f'"{c}"' for c in cols) + f" FROM ({sql})").fetchall()
    ours = [tuple(r[c] for c in cols) for r in df.collect()]
    key = repr
    assert sorted(map(key, map(tuple, ours))) == sorted(map(key, theirs))
    assert ({t.name for t in spark.catalog.listTables()}, spark.conf.get("spark.sql.legacy.javaCharsets", None)) == before
    assert "sparkmart.plans.stores" in sys.modules


def test_partition_reload_replaces_only_its_year(spark):
    df = registry.queries()["silver_from_csv"](spark, SF001)
    by_year = {r[0]: r[1] for r in df.groupBy("ptn_yyyy").agg({"_ingestion_date": "max"}).collect()}
    assert [y for y, d in by_year.items() if str(d) == "2024-11-10"] == [1997]


def test_a_typed_load_checks_the_header(spark, tmp_path):
    """Columns in another order are an error, not swapped values."""
    (tmp_path / "x.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_typed_csv(spark, str(tmp_path / "x.csv"), "a int, b int").collect()
    assert [tuple(r) for r in readers.read_typed_csv(spark, str(tmp_path / "x.csv"), "b int, a int").collect()] == [(1, 2)]
    (tmp_path / "y.csv").write_text("1,2\n")
    assert [tuple(r) for r in readers.read_typed_csv(spark, str(tmp_path / "y.csv"), "a int, b int", header=False).collect()] == [(1, 2)]
