"""Write an N-times larger copy of a scale-factor folder for scaling runs.

Each of the N copies shifts every key (orders, parts, customers, documents)
by a per-copy offset, so the copies are disjoint and joins keep their
cardinality; nation and region are shared.  Usage:

    python tools/scale_up.py SRC_DIR OUT_DIR N
"""

from __future__ import annotations

import os
import sys
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tessera.session import local_session  # noqa: E402
from tessera.sources.tables import load  # noqa: E402

SHIFTED = {  # table -> {column: key family}
    "lineitem": {"l_orderkey": "order", "l_partkey": "part"},
    "orders": {"o_orderkey": "order", "o_custkey": "cust"},
    "part": {"p_partkey": "part"},
    "customer": {"c_custkey": "cust"},
    "documents": {"doc_id": "doc"},
    "labels": {"doc_id": "doc"},
}
SHARED = ("nation", "region", "supplier")


def main(src: str, out: str, n: int) -> None:
    spark = local_session("local[8]", 8)
    span = {"order": load(spark, src, "orders").agg(F.max("o_orderkey")).first()[0] + 1,
            "part": load(spark, src, "part").agg(F.max("p_partkey")).first()[0] + 1,
            "cust": load(spark, src, "customer").agg(F.max("c_custkey")).first()[0] + 1,
            "doc": load(spark, src, "documents").agg(F.max("doc_id")).first()[0] + 1}
    for table, cols in SHIFTED.items():
        base = load(spark, src, table)
        copies: list[DataFrame] = []
        for i in range(n):
            exprs = [(F.col(c) + F.lit(i * span[cols[c]])).cast(dict(base.dtypes)[c]).alias(c)
                     if c in cols else F.col(c) for c in base.columns]
            copies.append(base.select(*exprs))
        reduce(DataFrame.unionByName, copies).write.parquet(f"{out}/{table}.parquet")
    for table in SHARED:
        load(spark, src, table).write.parquet(f"{out}/{table}.parquet")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], int(sys.argv[3]))
