"""The integrate job on CSV files: every table is written once, a period may be empty."""

from datetime import date, datetime

import pytest

from sevlab.plans import registry
from sevlab.sources import files

LINES = [(1, 1, 5.0, "A", "F", 0.01), (1, 2, 50.0, "N", "O", 0.02), (2, 1, None, "R", "F", None), (4, 3, 7.0, None, None, 0.08), (None, 1, 1.0, "A", "F", 0.0), (9, 1, 1.0, "A", "F", 0.0), (1, 1, 5.0, "A", "F", 0.01)]
LINE_SCHEMA = "l_orderkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, l_tax double"
ORDER_SCHEMA = "o_orderkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string, o_totalprice double, o_custkey long"


@pytest.mark.parametrize("years", [(1999, 2003), (1999, 1998), (2004, 2003)])
def test_one_join_and_one_write_a_table(spark, tmp_path, monkeypatch, years):
    orders = [(1, "O", datetime(years[0], 3, 4), "1-URGENT", 10.5, 7), (2, "P", datetime(years[1], 12, 31), None, None, 8), (4, None, None, "x, \"y\"", 1.0, None), (None, "F", datetime(2000, 1, 1), "z", 2.0, 9)]
    if years[0] > 2000:
        orders = orders[:2]  # no row is in the archive
    sf = str(tmp_path / "sf")
    spark.createDataFrame(LINES, LINE_SCHEMA).write.parquet(f"{sf}/lineitem.parquet")
    spark.createDataFrame(orders, ORDER_SCHEMA).write.parquet(f"{sf}/orders.parquet")
    written, write = [], files.write_csv
    monkeypatch.setattr(files, "write_csv", lambda df, path, *a, **b: written.append(path.rsplit("/", 1)[1]) or write(df, path, *a, **b))
    got = registry.q_integrate_csv(spark, sf)
    assert written == ["casualty", "collision"]
    severity = {"A": 1, "N": 2, "R": 3, None: None}
    want = [(k, n, None if q is None else int(q), severity[f], s, t, o[1], o[2].date() if o[2] else None, 0 if o[2] else None, (o[2].isoweekday() % 7 + 1) if o[2] else None, o[3], o[4])
            for k, n, q, f, s, t in LINES for o in orders if k is not None and o[0] == k]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert all(r.o_orderdate is None or isinstance(r.o_orderdate, date) for r in got.collect())


def test_a_folder_without_files_is_an_empty_table(spark, tmp_path):
    df = spark.createDataFrame([("1", "a", "x")], "k string, v string, p string")
    path = files.write_csv(df.limit(0), str(tmp_path / "none"), partition_by=["p"])
    empty = files.read_csv(spark, path, df.columns)
    assert empty.columns == df.columns and empty.filter("p = 'x'").count() == 0
    path = files.write_csv(df, str(tmp_path / "one"), partition_by=["p"])
    assert [tuple(r) for r in files.read_csv(spark, path, df.columns).filter("p = 'x'").collect()] == [("1", "a", "x")]
