
from __future__ import annotations


def queries():
    from finlake.checks import marts
    out = dict(marts.QUERIES)
    from finlake.checks import ingest, ops
    out.update(ops.QUERIES)
    out.update(ingest.QUERIES)
    return out


def oracle_sql():
    from finlake.checks.oracle import oracle_sql as _o
    q = queries()
    return {k: v for k, v in _o().items() if k in q}
