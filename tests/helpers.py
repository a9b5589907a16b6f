"""Independent plain-Python versions of the sequential rules, written from
the rule text (not from the Spark code), used as brute-force references."""


def scan_loop(vals, minimum, maximum, lo, hi, tol=0.001, jump=41):
    """Greedy yaw-return scan over one ordered group; returns (i, j) pairs."""
    out, n, i = [], len(vals), 0
    while i < n:
        found = None
        for j in range(i + 1, min(i + maximum, n - 1) + 1):
            m = round((i + j) / 2)          # Python rounds halves to even
            d = abs(vals[m] - vals[i])
            if abs(vals[j] - vals[i]) <= tol and d > lo and (hi is None or d < hi):
                found = j
                break
        if found is None:
            i += 1
        elif found >= i + minimum:
            out.append((i, found))
            i += jump
        else:
            i += 2
    return out


def stitch_loop(xs, ys, zs, jump=20.0):
    """Position stitching: offsets from row k on when X or Y jumps."""
    X, Y, Z = list(xs), list(ys), list(zs)
    for k in range(2, len(xs)):
        if abs(xs[k] - xs[k - 1]) > jump or abs(ys[k] - ys[k - 1]) > jump:
            dx = xs[k - 1] * 1.5 - xs[k - 2] * 0.5
            dy = ys[k - 1] * 1.5 - ys[k - 2] * 0.5
            dz = zs[k - 1] * 1.5 - zs[k - 2] * 0.5
            for r in range(k, len(xs)):
                X[r] += dx
                Y[r] += dy
                Z[r] += dz
    return X, Y, Z


def overlap_loop(tags, include, exclude):
    """Merged [start, end) pieces covered by all include and no exclude tag.
    ``tags`` is a list of (tag, start, end) for one recording."""
    names = set(include) | set(exclude)
    tags = [t for t in tags if t[0] in names]
    cuts = sorted({t[1] for t in tags} | {t[2] for t in tags})
    kept = []
    for a, b in zip(cuts, cuts[1:]):
        cover = {t[0] for t in tags if t[1] <= a and t[2] >= b}
        if all(n in cover for n in include) and not any(n in cover for n in exclude):
            if kept and kept[-1][1] == a:
                kept[-1] = (kept[-1][0], b)
            else:
                kept.append((a, b))
    return kept
