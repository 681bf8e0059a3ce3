"""Compare all queries (or the named ones) with their SQL and print the times.

    python tests/check_all.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

import __spark_entry__ as entry  # noqa: E402
from tests.compare import connect, differences  # noqa: E402
from tidemark.session import local_session  # noqa: E402


def main() -> None:
    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session(8, memory="10g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql = entry.oracle_sql()
    failed = []
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            frame = fn(spark, folder)
            if name in sql:
                found = differences(frame, con, sql[name])
                note = "; ".join(found) or "same"
                if found:
                    failed.append(name)
            else:
                note = f"{len(frame.collect())} rows, no SQL"
        except Exception as error:  # report and go on
            note = "ERROR " + str(error).split("JVM stacktrace")[0][:700]
            if os.environ.get("TRACE"):
                traceback.print_exc()
            failed.append(name)
        print(f"{name:26s} {time.time() - start:6.2f}s {note[:900]}", flush=True)
    print("FAILED:", failed)
    spark.stop()


if __name__ == "__main__":
    main()
