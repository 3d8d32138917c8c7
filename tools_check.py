"""Run registered queries on Spark and DuckDB and report matches (dev helper)."""
import json
import sys
import time

from pitwall.plans.catalog import oracle_sql, queries
from pitwall.plans.compare import compare, duckdb_connect
from pitwall.session import build_session

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or sorted(queries())
spark = build_session()
spark.sparkContext.setLogLevel("ERROR")
con = duckdb_connect(sf)
sqls = oracle_sql()
for n in names:
    t = time.time()
    try:
        df = queries()[n](spark, sf)
        if n in sqls:
            rep = compare(df, con, sqls[n])
        else:
            rep = {"rows": df.count(), "ok": None}
    except Exception as e:  # noqa: BLE001
        rep = {"error": repr(e)[:2000]}
    rep["sec"] = round(time.time() - t, 2)
    print(n, json.dumps(rep, default=str), flush=True)
