"""Compare a registered Spark query with its DuckDB oracle (names, types, values)."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v == 0 and math.copysign(1.0, v) < 0:
            return "-0.0"  # a text hash would tell -0.0 from 0.0
        return float(v)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0) for x in row)


DUCK_TO_SPARK = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "FLOAT": "float",
    "HUGEINT": "decimal",
}


def type_mismatches(spark_df, con, sql: str) -> list[str]:
    rel = con.sql(sql)
    duck = {n: DUCK_TO_SPARK.get(str(t), str(t)) for n, t in zip(rel.columns, rel.types)}
    out = []
    for f in spark_df.schema.fields:
        st = f.dataType.simpleString()
        if f.name in duck and duck[f.name] != st:
            out.append(f"{f.name}: spark {st} vs oracle {duck[f.name]}")
    return out


def compare(spark_df, con, sql: str):
    """Return (ok, message). Columns compared by sorted name and type, rows as multisets."""
    bad_types = type_mismatches(spark_df, con, sql)
    if bad_types:
        return False, "types differ: " + "; ".join(bad_types)
    sdf = spark_df.toPandas()
    odf = con.execute(sql).df()
    s_cols = sorted(sdf.columns)
    o_cols = sorted(odf.columns)
    if s_cols != o_cols:
        return False, f"columns differ: spark={s_cols} oracle={o_cols}"
    if len(sdf) != len(odf):
        return False, f"row count differs: spark={len(sdf)} oracle={len(odf)}"
    s_rows = sorted((tuple(_norm(v) for v in r) for r in sdf[s_cols].astype(object).where(sdf[s_cols].notna(), None).itertuples(index=False)), key=_key)
    o_rows = sorted((tuple(_norm(v) for v in r) for r in odf[o_cols].astype(object).where(odf[o_cols].notna(), None).itertuples(index=False)), key=_key)
    bad = [(a, b) for a, b in zip(s_rows, o_rows) if a != b]
    if bad:
        return False, f"{len(bad)} rows differ, e.g. spark={bad[0][0]} oracle={bad[0][1]}"
    return True, f"{len(sdf)} rows equal"
