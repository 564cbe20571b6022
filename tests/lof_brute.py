"""Brute-force LOF by its definition (test oracle), with the library's tie rule:
neighbours ordered by (distance rounded to 9 decimals, representative id, id)."""

import numpy as np


def _reps(X, ids, grp):
    rep = {}
    for i in range(len(X)):
        key = (grp[i], tuple(X[i]))
        rep[key] = min(rep.get(key, ids[i]), ids[i])
    return np.array([rep[(grp[i], tuple(X[i]))] for i in range(len(X))])


def _order(d, rep, ids, cand):
    return sorted(cand, key=lambda j: (round(float(d[j]), 9), rep[j], ids[j]))


def lof(X, ids, k, grp=None):
    X = np.asarray(X, float)
    ids = np.asarray(ids)
    grp = np.zeros(len(X), int) if grp is None else np.asarray(grp)
    rep = _reps(X, ids, grp)
    n = len(X)
    nbrs, kd = [], np.zeros(n)
    for i in range(n):
        same = [j for j in range(n) if grp[j] == grp[i] and j != i]
        kk = min(k, len(same))
        d = np.sqrt(((X - X[i]) ** 2).sum(1))
        nb = _order(d, rep, ids, same)[:kk]
        nbrs.append((nb, d))
        kd[i] = max(d[j] for j in nb) if nb else np.nan
    lrd = np.array([1.0 / (np.mean([max(d[j], kd[j]) for j in nb]) + 1e-10) if nb else np.nan
                    for nb, d in nbrs])
    out = np.array([np.mean([lrd[j] for j in nb]) / lrd[i] if nb else np.nan for i, (nb, _) in enumerate(nbrs)])
    return out, kd, lrd


def novelty(Xr, idr, Xq, k, gr=None, gq=None):
    Xr, Xq = np.asarray(Xr, float), np.asarray(Xq, float)
    idr = np.asarray(idr)
    gr = np.zeros(len(Xr), int) if gr is None else np.asarray(gr)
    gq = np.zeros(len(Xq), int) if gq is None else np.asarray(gq)
    _, kd, lrd = lof(Xr, idr, k, gr)
    rep = _reps(Xr, idr, gr)
    out = []
    for i in range(len(Xq)):
        cand = [j for j in range(len(Xr)) if gr[j] == gq[i]]
        kk = min(k, len(cand) - 1)
        if kk < 1:
            out.append(np.nan)
            continue
        d = np.sqrt(((Xr - Xq[i]) ** 2).sum(1))
        nb = _order(d, rep, idr, cand)[:kk]
        lq = 1.0 / (np.mean([max(d[j], kd[j]) for j in nb]) + 1e-10)
        out.append(np.mean([lrd[j] for j in nb]) / lq)
    return np.array(out)
