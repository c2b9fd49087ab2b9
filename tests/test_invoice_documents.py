"""The invoice documents that the header query parses, on tables of its own."""

import datetime
from collections import Counter

import __spark_entry__ as E

DAY = datetime.date(1996, 1, 5)


def test_every_line_brings_its_header_along(spark, tmp_path):
    tables = {
        "nation": ([(1, 1)], "n_nationkey int, n_regionkey int"),
        "customer": ([(1, "Customer#1", 1)], "c_custkey long, c_name string, c_nationkey int"),
        "part": ([(1, "p", "Brand#1", "T", 5.0)], "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double"),
        "orders": ([(101, 1, "O", 10.0, DAY, "5-LOW"), (102, 1, "P", 10.0, DAY, "5-LOW"), (103, 1, "O", 10.0, DAY, "5-LOW")],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"),
        # order 101: four lines, one number twice; 102 (two runs): two lines; 103: none
        "lineitem": ([(101, 1, n, 1.0, 2.0) for n in (1, 2, 2, 60)] + [(102, 1, n, 1.0, 2.0) for n in (1, 2)],
                     "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = Counter(r.fileName for r in E.queries()["json_invoice_header"](spark, str(tmp_path)).collect())
    assert got == {"invoice-101.pdf": 4, "invoice-102.pdf": 4, "invoice-103.pdf": 1}
