"""Compare registered queries with their oracles: python -m tests.check [sf] [name ...]"""

import sys
import time

import __spark_entry__ as entry
from affinia.session import local_session
from tests.oracle import compare

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = local_session(8)
    sf_dir = f"/root/testdata/sf{sf}"
    for name in names:
        begin = time.time()
        try:
            if name in entry.oracle_sql():
                n = compare(spark, sf_dir, entry.queries()[name], entry.oracle_sql()[name])
                verdict = f"equal, {n} rows"
            else:
                verdict = f"no oracle, {len(entry.queries()[name](spark, sf_dir).collect())} rows"
        except Exception as error:
            verdict = f"FAILED {type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:28s} {time.time() - begin:6.1f}s  {verdict}", flush=True)
