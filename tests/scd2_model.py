"""Brute-force restatement of one SCD2 load, literally as the warehouse SQL does it:
INSERT (left join ... IS NULL) UNION (join ... content !=), then
UPDATE ... FROM (rank() = 1 over (partition by key order by efft) where count > 1)."""

from __future__ import annotations

import datetime as dt

OPEN = dt.date(9999, 12, 31)


def content(spec, r):
    vals = [r[a] for a in spec.attrs]
    if spec.hash_style == "concat_ws_dash":
        return "-".join(v for v in vals if v is not None)
    return "_" + "".join(v for v in vals if v is not None)


def _eq(spec, a, b):
    return all(a[k] is not None and b[k] is not None and a[k] == b[k] for k in spec.keys)


def load(spec, dim, stage, as_of, offset=None):
    offset = spec.expire_offset_days if offset is None else offset
    dim = [dict(r) for r in dim]
    cur = [r for r in dim if r["efft_date"] <= as_of <= r["expy_date"]]
    new = [s for s in stage if not any(_eq(spec, s, d) for d in cur)]
    chg = [s for s in stage if any(_eq(spec, s, d) and content(spec, s) != content(spec, d) for d in cur)]
    ins = []
    for s in new + chg:
        if s not in ins:
            ins.append(s)
    nxt = max([r["skey"] for r in dim], default=0)
    for i, s in enumerate(ins, start=1):
        dim.append(dict(s, skey=nxt + i, current_flag="Y", efft_date=as_of, expy_date=OPEN))
    cur = [r for r in dim if r["efft_date"] <= as_of <= r["expy_date"]]
    groups = {}
    for r in cur:  # PARTITION BY groups NULLs together
        groups.setdefault(tuple(r[k] for k in spec.keys), []).append(r)
    exp = []
    for rows in groups.values():
        if len(rows) > 1:
            m = min(r["efft_date"] for r in rows)
            exp += [r for r in rows if r["efft_date"] == m]
    for r in dim:  # UPDATE ... WHERE base.key = exp.key AND base.efft = exp.efft
        if any(_eq(spec, r, e) and r["efft_date"] == e["efft_date"] for e in exp):
            r["expy_date"] = as_of - dt.timedelta(days=offset)
            r["current_flag"] = "N"
    return dim
