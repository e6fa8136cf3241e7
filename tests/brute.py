"""Plain-Python versions of the rules and scores, straight from their definitions."""


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def ratio(a, b):
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def partial_ratio(a, b):
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    short, long = sorted((a, b), key=len)
    roles = [(short, long)] + ([(long, short)] if len(a) == len(b) else [])
    best = 0.0
    for s, t in roles:
        windows = {t[max(k, 0) : k + len(s)] for k in range(1 - len(s), len(t))}
        best = max([best] + [ratio(s, w) for w in windows if w])
    return best


def token_set_ratio(a, b):
    ta, tb = set(a.split()), set(b.split())
    if not ta or not tb:
        return 0.0
    shared, x, y = (" ".join(sorted(s)) for s in (ta & tb, ta - tb, tb - ta))
    if shared and (not x or not y):
        return 1.0
    if not shared:
        return ratio(x, y)
    with_x, with_y = (f"{shared} {rest}" for rest in (x, y))
    # x and y are compared behind the shared prefix, which matches itself in full.
    same = len(shared) + 1
    r0 = 2 * (same + lcs(x, y)) / (len(with_x) + len(with_y))
    return max(r0, ratio(shared, with_x), ratio(shared, with_y))


def pairs(s1, targets, same):
    return {(a["entity_id"], b["entity_id"]) for a in s1 for b in targets if a["name_norm"] and b["name_norm"] and same(a, b)}


def key(row, n):
    return row["country_norm"], row["name_norm"][:n]


def exact(s1, targets):
    return pairs(s1, targets, lambda a, b: a["name_norm"] == b["name_norm"])


def prefix(s1, targets, n, cap=None):
    sizes = {}
    for t in targets:
        if t["name_norm"]:
            k = t["source"], *key(t, n)
            sizes[k] = sizes.get(k, 0) + 1
    rare = lambda b: cap is None or sizes[b["source"], *key(b, n)] <= cap
    return pairs(s1, targets, lambda a, b: key(a, n) == key(b, n) and rare(b))


def tokens(row):
    return [w for w in row["name_norm"].split() if len(w) >= 3]


def token(s1, targets):
    return pairs(s1, targets, lambda a, b: set(tokens(a)) & set(tokens(b)))


def token_cap(s1, targets, cap):
    out = set()
    for a in s1:
        mine = list(dict.fromkeys(tokens(a)))
        hits = []
        for b in targets:
            shared = [i for i, w in enumerate(mine) if w in tokens(b)]
            if shared:
                hits.append((b["source"], min(shared), b["entity_id"]))
        out |= {(a["entity_id"], h[2]) for h in sorted(hits)[:cap]}
    return out


def capped(s1, targets, cap4, cap6):
    return exact(s1, targets) | prefix(s1, targets, 4, cap4) | prefix(s1, targets, 6, cap6)
