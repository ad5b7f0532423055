"""Brute-force model of the match-range semantics (pure Python, no Spark),
written from the specification, for randomized comparisons."""

from __future__ import annotations

from matchspan.config import EndReason, OptionalFilter, UpdatePolicy

COLS = ["a", "b", "status", "t", "o1", "o2", "v"]


def _nl(x):  # ascending, nulls last
    return (x is None, x if x is not None else 0)


def _desc_nl(x):  # descending, nulls last
    return (x is None, -x if x is not None else 0)


def _pass(rows, key, match):
    groups = {}
    for r in rows:
        groups.setdefault(tuple(r[k] for k in key), []).append(r)
    out = []
    for g in groups.values():
        sets = {c: {r[c] for r in g if r[c] is not None} for c in match}
        for r in g:
            r = dict(r)
            for c in match:
                if r["status"] == 1 and r["v"] and len(sets[c]) > 1:
                    r["v"] = False
                if r["status"] == 1 and r["v"] and len(sets[c]) == 1:
                    r[c] = next(iter(sets[c]))
            out.append(r)
    seen, res = set(), []
    for r in out:
        k = tuple(r[c] for c in COLS)
        if k not in seen:
            seen.add(k)
            res.append(r)
    return res


def _direction(rows, k, c, others, allowed):
    cands = {}
    groups = {}
    for i, r in enumerate(rows):
        if r[k] is not None:
            groups.setdefault(r[k], []).append(i)
    for idx in groups.values():
        idx.sort(key=lambda i: (rows[i]["t"], _desc_nl(rows[i]["status"]), _nl(rows[i][c]),
                                *[_nl(rows[i][o]) for o in others]))
        for j in range(len(idx) - 1):
            r, n = rows[idx[j]], rows[idx[j + 1]]
            if not (r["status"] == 1 and r["v"]):
                continue
            if n["status"] == 3:
                reason = 3 if n[c] is None else (1 if n[c] == r[c] else 2)
            elif n["status"] == 1:
                reason = 6 if n[c] is None else (5 if n[c] == r[c] else 4)
            else:
                continue
            if reason in allowed:
                cands[idx[j]] = (n["t"], reason)
    return cands


def model(rows, cfg):
    """rows: dicts with a, b, status (user value), t, o1, o2 -> set of output tuples
    (a, b, status, t, o1, o2, v, start_time, final_end_time, final_end_reason)."""
    others = list(cfg.other_matches)
    rs = []
    for r in rows:
        r = dict(r)
        r["status"] = cfg.status_names.get(r["status"]) if r["status"] is not None else None
        rs.append(r)
    rs = [r for r in rs if r["a"] is not None and r["t"] is not None]
    rs = [r for r in rs if r["a"] is not None or r["b"] is not None]
    for f in cfg.filters_in_order:
        if f is OptionalFilter.IGNORE_UPDATES:
            rs = [r for r in rs if r["status"] in (1, 3)]
        elif f is OptionalFilter.NULL_A:
            rs = [r for r in rs if r["a"] is not None]
        elif f is OptionalFilter.NULL_B_ON_START:
            rs = [r for r in rs if r["b"] is not None or (r["status"] is not None and r["status"] != 1)]
    if cfg.update_policy is UpdatePolicy.ASSUME_START:
        for r in rs:
            if r["status"] == 2:
                r["status"] = 1
    for r in rs:
        r["v"] = r["status"] == 1 and r["a"] is not None and r["b"] is not None
    rs = _pass(rs, ["a", "t"], others + ["b"])
    rs = _pass(rs, ["b", "t"], others + ["a"])
    allowed = {r.value for r in cfg.allowed_reasons}
    ca = _direction(rs, "a", "b", others, allowed)
    cb = _direction(rs, "b", "a", others, allowed)
    ranges = []
    for i, r in enumerate(rs):
        cs = [x for x in (ca.get(i), cb.get(i)) if x is not None]
        if cs:
            end, reason = min(cs)
            ranges.append(dict(r, start_time=r["t"], end=end, reason=reason))
    out = set()
    by_pair = {}
    for r in ranges:
        by_pair.setdefault((r["a"], r["b"]), []).append(r)
    for rr in by_pair.values():
        rr.sort(key=lambda r: r["start_time"])
        i = 0
        while i < len(rr):
            head, j = rr[i], i
            while j + 1 < len(rr) and rr[j]["end"] == rr[j + 1]["start_time"]:
                j += 1
            tail = rr[j]
            out.add((head["a"], head["b"], head["status"], head["t"], head["o1"], head["o2"], head["v"],
                     head["start_time"], tail["end"], EndReason(tail["reason"]).name))
            i = j + 1
    return out
