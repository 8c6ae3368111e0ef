"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import hashlib
import math

import duckdb

from splitlens.sources.tables import DRIVER_TABLES


def norm(v) -> str:
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9) + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return repr(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()[:12], lines


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(df, con, sql: str) -> tuple[bool, str]:
    """(equal, message) for a Spark frame and an oracle statement."""
    scols = df.columns
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    hs, ls = digest(scols, srows)
    hd, ld = digest(dcols, drows)
    ok = sorted(scols) == sorted(dcols) and len(srows) == len(drows) and hs == hd
    if ok:
        return True, f"rows={len(srows)}"
    only_s = [x for x in ls if x not in set(ld)][:3]
    only_d = [x for x in ld if x not in set(ls)][:3]
    return False, (f"cols {sorted(scols)} vs {sorted(dcols)}; rows {len(srows)}/{len(drows)}; "
                   f"only spark {only_s}; only duckdb {only_d}")
