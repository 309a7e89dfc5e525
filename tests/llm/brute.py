"""Plain Python versions of what the operators compute."""

import hashlib
import math
import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text, n=3):
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def near(fps, bits=3):
    a = np.array(fps, np.uint64)
    return [(i, i + 1 + int(j)) for i in range(len(a)) for j in np.nonzero(np.bitwise_count(a[i] ^ a[i + 1:]) <= bits)[0]]


def groups(rows, bits=3):
    """Component id (smallest non-null id) of each (doc_id, text)."""
    comp = components(len(rows), near([fingerprint(t) for _, t in rows], bits))
    first = {}
    for c, (d, _) in zip(comp, rows, strict=True):
        if d is not None:
            first[c] = min(d, first.get(c, d))
    return [first.get(c) for c in comp]


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(ASCII_LOWER)


def dedup_lines(rows, min_chars=20, min_docs=3):
    """(lines, dropped, kept text) of each (doc_id, text); a null id orders first."""
    order = lambda d: (d is not None, d or 0)
    holders = {}
    for d, t in rows:
        for k in map(line_key, (t or "").split("\n")):
            if len(k) >= min_chars:
                holders.setdefault(k, set()).add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if not (len(h := holders.get(line_key(x), ())) >= min_docs and d != max(h, key=order))]
        out.append((len(lines), len(lines) - len(left), "\n".join(left)))
    return out


def targets(sizes, weights=(5, 2, 1), repeat=3):
    """Shares by weight, cut at ``repeat`` times the size and shared again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, free, left = {}, set(names), sum(sizes.values())
    while free:
        all_w = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / all_w > repeat * sizes[s]}
        if not over:
            out |= {s: left * weight[s] / all_w for s in free}
            break
        out |= {s: float(repeat * sizes[s]) for s in over}
        left -= sum(repeat * sizes[s] for s in over)
        free -= over
    return out


def copies(rows, seed=0, repeat=3):
    """Copies of each (doc_id, text, source) by systematic sampling in order of size and id."""
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    total = {}
    for n, (_, _, s) in zip(size, rows, strict=True):
        total[s] = total.get(s, 0) + n
    want, out = targets(total), [0] * len(rows)
    for s, whole in total.items():
        mine = sorted((i for i, r in enumerate(rows) if r[2] == s), key=lambda i: (size[i], rows[i][0] is not None, rows[i][0] or 0))
        name = f"{seed}:" + ("" if s is None else "=" + s)
        u, e = int(hashlib.md5(name.encode()).hexdigest()[:8], 16) / 2**32, want[s] / whole if whole else 0.0
        for k, i in enumerate(mine):
            out[i] = math.floor(u + e * (k + 1)) - math.floor(u + e * k)
    return out, size, total, want


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def swap_distance(a, b):
    """Edits between two words, two neighbours that change places being one."""
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def toxic_score(model, text, context, edits, window=48, misspelt=0.8, quoted=0.25):
    """The score of a text by a model's terms, words and weights: every word against every term."""
    text, spots = (text or "").lower(), []
    words = [(m.start(), m.end(), m.group()) for m in re.finditer(r"[^\W_]+", text)]
    for start, end, word in words:
        best = min(((len(t), i, 0) for i, (t, prefix, _) in enumerate(model.terms) if prefix and word.startswith(t)), default=None)
        if best is None:
            best = min(((k, i, k) for i, (t, prefix, _) in enumerate(model.terms) if not prefix
                        and (k := swap_distance(t, word)) <= (0 if word in model.clean or t in model.strict else edits(t))), default=None)
        if best is not None:
            spots.append((start, end, model.terms[best[1]][2], best[2]))
    sums = [0.0, 0.0, 0.0, 0.0]
    for i, (start, end, weight, spent) in enumerate(spots):
        inside, address = context(text, start, end)
        near = any(abs(spots[k][0] - start) <= window for k in (i - 1, i + 1) if 0 <= k < len(spots))
        share = misspelt ** spent
        sums[2 if inside and not near else bool(spent)] += weight if inside and not near or not spent else share * weight
        sums[3] += 0 if inside and not near else share * (near or address)
    whole = sums[0] + sums[1] + quoted * sums[2]
    density = 100 * whole / (len(words) + 20)
    x = (np.array([math.log1p(whole), density, math.log1p(sums[3])]) - model.mean) / model.scale
    return 1 / (1 + math.exp(-min(max(model.weights[0] + float(x @ model.weights[1:]), -50), 50))) if model.trained else 0.0
