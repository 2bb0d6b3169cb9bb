"""Compare Spark output types of every SQL-twinned query with DuckDB result types."""
import sys; import os
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from tidewatch.session import get_session
from oracle_check import duck
import __spark_entry__ as E
spark = get_session("local[4]", shuffle_partitions=4)
con = duck("/root/testdata/sf0.001")
M = {"bigint":"BIGINT","double":"DOUBLE","string":"VARCHAR","timestamp_ntz":"TIMESTAMP","date":"DATE","int":"INTEGER","boolean":"BOOLEAN"}
qs, sql = E.queries(), E.oracle_sql()
for n in sorted(sql):
    s = {f.name: f.dataType.simpleString() for f in qs[n](spark, "/root/testdata/sf0.001").schema.fields}
    d = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql[n]}").fetchall()}
    bad = {c: (s[c], d.get(c)) for c in s if M.get(s[c], s[c]) != d.get(c)}
    if bad: print(n, bad, flush=True)
print("audit done")
