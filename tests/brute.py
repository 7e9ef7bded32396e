"""Plain-Python reference implementations for small fixtures."""

from __future__ import annotations

import datetime as dt

H = dt.date(9999, 12, 31)


def _ne(a, b):  # SQL "<>": unknown (None) when either side is null
    return None if a is None or b is None else a != b


def scd2_compat(target, staging):
    """target rows: (key, attr, mod, cd, cur, start, end); staging: (key, attr, mod)."""
    joined = []
    for t in target:
        matches = [s for s in staging if t[0] is not None and s[0] == t[0]]
        joined += [(t, s) for s in matches] or [(t, None)]
    for s in staging:
        if not any(t[0] is not None and t[0] == s[0] for t in target):
            joined.append((None, s))
    out = []
    for t, s in joined:
        tk, ta, tm, tcd, tcur, tst, ten = t or (None,) * 7
        sk, sa, sm = s or (None,) * 3
        if _ne(ta, sa):
            out.append((tk, ta, tm, tcd, False, tst, sm))
            out.append((tk, sa, sm, tcd, True, sm, ten))
        elif sa is None and tcur is True:
            pass                                        # DELETE rows vanish
        elif tk is None:
            out.append((sk, sa, sm, "bronze_data", True, sm, H))
        else:
            out.append(t)
    return out


def _latest(staging):
    best = {}
    for s in staging:                       # a null key is one more key value
        rank = ((s[2] is not None, s[2]), (s[1] is not None, s[1] or ""))
        if s[0] not in best or rank > best[s[0]][0]:
            best[s[0]] = (rank, s)
    return {k: v[1] for k, v in best.items()}


def scd2_default(target, staging, feed, as_of):
    current = [t for t in target if t[4] is True]
    out = [t for t in target if t[4] is not True]
    ended = {}
    for t in out:
        if t[6] is not None:
            ended[t[0]] = max(t[6], ended.get(t[0], t[6]))
    stg = _latest(staging)
    cur_keys = {t[0] for t in current}
    for t in current:
        if t[0] not in stg:
            gone = feed == "full" and not (t[5] is not None and t[5] > as_of)
            out.append((t[0], t[1], t[2], t[3], False, t[5], as_of) if gone else t)
            continue
        s = stg[t[0]]
        late = s[2] is None or (t[5] is not None and s[2] < t[5])
        if late or t[1] == s[1]:
            out.append(t)
        else:
            out.append((t[0], t[1], t[2], t[3], False, t[5], s[2]))
            out.append((t[0], s[1], s[2], t[3], True, s[2], H))
    for k, s in stg.items():
        if k not in cur_keys and s[2] is not None and not (k in ended and s[2] < ended[k]):
            out.append((k, s[1], s[2], "bronze_data", True, s[2], H))
    return out


def spliced(target, changes):
    """The timeline of every key, rebuilt from versions and changes."""
    rank = lambda a: (a is not None, a or "")
    out, lines = [], {}
    for t in target:
        if t[5] is None or t[6] is None or t[5] >= t[6]:
            out.append(t)
            continue
        line = lines.setdefault(t[0], {})
        line.setdefault(t[5], []).append((rank(t[1]), 1, t))
        if t[6] < H:
            line.setdefault(t[6], []).append(None)
    for c in changes:
        if c[2] is not None:
            lines.setdefault(c[0], {}).setdefault(c[2], []).append((rank(c[1]), 0, c))
    for key, line in lines.items():
        dates, code = sorted(line), None
        for i, d in enumerate(dates):
            best = max((x for x in line[d] if x is not None), default=None, key=lambda x: x[:2])
            if None in line[d]:
                code = "bronze_data"
            if best is None:
                continue
            until = dates[i + 1] if i + 1 < len(dates) else H
            if best[1]:
                _, attr, mod, code = best[2][:4]
            else:
                attr, mod, code = best[2][1], best[2][2], code or "bronze_data"
            out.append((key, attr, mod, code, i + 1 == len(dates), d, until))
    return out


def _first(rows, keyf, orderf):
    best = {}
    for r in rows:
        k = keyf(r)
        if k not in best or orderf(r) < orderf(best[k]):
            best[k] = r
    return list(best.values())


def merge_insert_only(target, source, lower, upper, mode):
    """rows: (k, d, v); key k, window [lower, upper) on d, first by (d, v)."""
    def inside(r):
        return r[1] is not None and lower <= r[1] < upper
    src = [r for r in source if inside(r)] if mode == "default" else list(source)
    order = lambda r: ((r[1] is not None, r[1]), (r[2] is not None, r[2]))
    src = _first(src, lambda r: r[0], order)
    tkeys = {t[0] for t in target if inside(t)}
    if mode == "default":
        added = [r for r in src if r[0] not in tkeys]
    else:
        added = [r for r in src if not (inside(r) and r[0] is not None and r[0] in tkeys)]
    return list(target) + added
