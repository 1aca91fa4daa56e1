"""Queries and their SQL agree where keys outgrow the widths that they are padded to."""

import duckdb

from ledgerloom.plans import catalog
from test_queries import rows


def test_permit_details_of_long_page_numbers(spark, sf, tmp_path):
    con = duckdb.connect()
    con.execute(f"COPY (SELECT page_id + 99990 AS page_id, url, html FROM '{sf}/pages.parquet' ORDER BY page_id LIMIT 20) TO '{tmp_path}/pages.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet'")
    ours, theirs = catalog.QUERIES["permit_details"](spark, str(tmp_path)).toPandas(), con.sql(catalog.ORACLE_SQL["permit_details"]).df()
    assert len(ours) == 20 and "ROF2024-100001" in set(ours.record_number)
    assert rows(ours) == rows(theirs)
