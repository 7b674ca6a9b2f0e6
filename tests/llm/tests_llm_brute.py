"""Brute-force versions that several tests share."""

import re


def lcs_step(row, x, b):
    new = [0]
    for j, y in enumerate(b):
        new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
    return new


def labelled_runs(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    k = [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []
    seen, out = {}, []
    for x in k:
        out.append((x, seen.get(x, 0)))
        seen[x] = seen.get(x, 0) + 1
    return out


def brute_similarity(a, b):
    """Longest common subsequence of labelled five-word runs, on plain lists; 0 where lengths rule 0.8 out."""
    a, b = labelled_runs(a), labelled_runs(b)
    if not a or not b or min(len(a), len(b)) < 0.8 * max(len(a), len(b)):
        return 0.0
    row = [0] * (len(b) + 1)
    for x in a:
        row = lcs_step(row, x, b)
    return row[-1] / (len(a) + len(b) - row[-1])


def brute_classes(texts):
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if brute_similarity(texts[i], texts[j]) >= 0.8:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(texts))]


def water(sizes, weights, most=3.0):
    """Targets by repeated clamping, on plain numbers."""
    total, fixed = sum(sizes), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        if not free:
            return [fixed[i] for i in range(len(sizes))]
        rest = total - sum(fixed.values())
        share = {i: rest * weights[i] / sum(weights[j] for j in free) for i in free}
        over = [i for i in free if share[i] > most * sizes[i] + 1e-9]
        if not over:
            return [fixed.get(i, share.get(i)) for i in range(len(sizes))]
        fixed.update({i: most * sizes[i] for i in over})
