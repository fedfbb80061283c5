"""Compare a registered query with its SQL form on the same parquet files."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    """A value in a form both engines share."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(float(value) + 0.0)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in sorted(value.items())}
    if hasattr(value, "asDict"):
        return plain(value.asDict())
    return value


def rows_of(columns: list[str], rows: list) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(row[i]) for i in order]) for row in rows)


def kinds(types: dict[str, str]) -> dict[str, str]:
    """Column types by family, so that names of the two engines can be set side by side."""
    names = {
        "bigint": "int64", "int": "int32", "integer": "int32", "double": "float64", "string": "text",
        "varchar": "text", "timestamp_ntz": "time", "timestamp": "time", "boolean": "bool", "float": "float32",
    }
    return {c: names.get(t.lower(), t.lower()) for c, t in types.items()}


def compare(spark, build, sql: str, sf_dir: str) -> list[str]:
    """Differences found, none when the two agree."""
    df = build(spark, sf_dir)
    spark_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    relation = connect(sf_dir).sql(sql)
    names = list(relation.columns)
    duck_types = {c: str(t) for c, t in zip(names, relation.types)}
    duck_rows = rows_of(names, relation.fetchall())
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns: spark {sorted(df.columns)} / sql {sorted(names)}"]
    ours, theirs = kinds(dict(df.dtypes)), kinds(duck_types)
    different = {c: (ours[c], theirs[c]) for c in ours if ours[c] != theirs[c] and "<" not in ours[c]}
    if different:
        problems.append(f"types: {different}")
    if len(spark_rows) != len(duck_rows):
        problems.append(f"rows: spark {len(spark_rows)} / sql {len(duck_rows)}")
    if spark_rows != duck_rows:
        only_spark = sorted(set(spark_rows) - set(duck_rows))
        only_sql = sorted(set(duck_rows) - set(spark_rows))
        problems.append(f"values: {len(only_spark)} only in spark, {len(only_sql)} only in sql")
        for a, b in list(zip(only_spark, only_sql))[:3]:
            problems += [f"   spark {a[:700]}", f"   sql   {b[:700]}"]
        problems.append(f"   columns {sorted(df.columns)}")
    return problems


def main(sf_dir: str, wanted: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from tidewheel.session import build_session

    spark = build_session("check")
    known, oracle, failed = entry.queries(), entry.oracle_sql(), []
    for name in wanted or list(known):
        start = time.time()
        try:
            if name in oracle:
                problems = compare(spark, known[name], oracle[name], sf_dir)
                label = "ok" if not problems else "DIFF"
            else:
                n = known[name](spark, sf_dir).count()
                problems, label = ([] if n else ["no rows"]), f"rows {n}"
        except Exception as error:  # report and go on with the next query
            problems, label = [f"{type(error).__name__}: {str(error)[:1500]}"], "ERROR"
        print(f"{label:8} {name} {time.time() - start:.1f}s", flush=True)
        for p in problems:
            print("   ", p, flush=True)
        if problems:
            failed.append(name)
    print("failed:", failed)
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
