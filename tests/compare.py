"""Run registered queries and their SQL side by side: python tests/compare.py [folder] [name ...]"""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def oracle(folder):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return db


def normal(value):
    if isinstance(value, float):
        return round(value, 6) + 0.0
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(spark, folder, name):
    df = entry.queries()[name](spark, folder)
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(db, name):
    result = db.execute(entry.oracle_sql()[name])
    return rows_of([d[0] for d in result.description], result.fetchall())


def main(folder, names):
    from leafmill.session import local_session

    spark, db, bad = local_session(8, spark__ui__showConsoleProgress="false"), oracle(folder), []
    for name in names or entry.queries():
        start = time.time()
        try:
            found = spark_rows(spark, folder, name)
            middle = time.time()
            if name not in entry.oracle_sql():
                print(f"{name}: {len(found[1])} rows in {middle - start:.1f}s, no SQL", flush=True)
                continue
            expected = sql_rows(db, name)
        except Exception as error:
            bad.append(name)
            print(f"{name}: ERROR {str(error)[:700]}", flush=True)
            continue
        same = found == expected
        print(f"{name}: {len(found[1])} rows in {middle - start:.1f}s, SQL {time.time() - middle:.1f}s "
              f"{'same' if same else 'DIFFERENT'}", flush=True)
        if not same:
            bad.append(name)
            print("  columns", found[0], expected[0], len(found[1]), len(expected[1]))
            ours, theirs = set(map(repr, found[1])), set(map(repr, expected[1]))
            print("  only here", [r[:300] for r in sorted(ours - theirs)[:2]])
            print("  only there", [r[:300] for r in sorted(theirs - ours)[:2]])
    print("all same" if not bad else f"bad: {bad}")


if __name__ == "__main__":
    arguments = sys.argv[1:] or ["/root/testdata/sf0.001"]
    main(arguments[0], arguments[1:])
