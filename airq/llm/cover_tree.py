"""Cover trees over unit vectors and their dual traversal.

A node is a vector and all within its covering radius; the level below halves the level's radius
and starts with the node's own vector (levels are nested), further centres are more than that radius apart. Two nodes
whose centres are farther apart than both covering radii and the threshold hold no pair;
two that together lie within the threshold are all pairs; what remains is split or, at leaves, compared.
"""

from __future__ import annotations

import numpy as np

#: Rows of a leaf, of a tile of distances; room for rounding when nodes are pruned or taken whole.
LEAF, TILE, SLACK = 24, 1024, 1e-6


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (x @ y.T), 0))


def cover(x: np.ndarray, radius: float) -> np.ndarray:
    """For each row the row that covers it: the first row, or one more than ``radius`` from every earlier centre."""
    owner = np.full(len(x), -1)
    owner[distances(x[:1], x)[0] <= radius] = 0
    owner[0] = 0
    rest = np.flatnonzero(owner < 0)
    while len(rest):
        part = rest[: TILE // 2]
        near = distances(x[part], x[part]) <= radius
        new = []
        open_ = np.ones(len(part), dtype=bool)
        for k in range(len(part)):
            if open_[k]:
                new.append(k)
                open_ &= ~near[k]
        centres = part[new]
        for low in range(0, len(rest), TILE):
            rows = rest[low : low + TILE]
            d = distances(x[rows], x[centres])
            at = d.argmin(axis=1)
            hit = d[np.arange(len(rows)), at] <= radius
            owner[rows[hit]] = centres[at[hit]]
        owner[centres] = centres
        rest = rest[owner[rest] < 0]
    return owner


class CoverTree:
    """Nodes as arrays: ``centre`` (a row), ``radius`` (to its farthest row), ``first, end`` (its rows, in ``rows``), ``children`` (empty for leaves)."""

    def __init__(self, x: np.ndarray, weights: np.ndarray):
        self.x, self.rows = x, np.arange(len(x))
        self.centre, self.radius, self.first, self.end, self.children = [], [], [], [], []
        self._add(np.arange(len(x)), 0)
        todo = [(0, None)]
        while todo:
            node, level = todo.pop()
            size, r = self.end[node] - self.first[node], self.radius[node]
            if size <= LEAF or r <= SLACK:
                continue
            level = 2.0 ** np.ceil(np.log2(r)) if level is None else level
            while level / 2 >= r:
                level /= 2
            own = self.rows[self.first[node] : self.end[node]].copy()  # starts with the node's centre
            owner = cover(x[own], level / 2)
            order = np.lexsort([np.arange(len(own)) != owner, owner])
            cuts = np.append(np.flatnonzero(np.diff(owner[order], prepend=-1)), len(own))
            for i, j in zip(cuts, cuts[1:]):
                self.children[node].append(self._add(own[order[i:j]], self.first[node] + i))
                todo.append((len(self.centre) - 1, level / 2))
        self.centre, self.radius = np.array(self.centre), np.array(self.radius)
        self.children = [np.array(c, dtype=np.int64) for c in self.children]
        self.size = np.array(self.end) - np.array(self.first)
        self.weights = weights[self.rows]
        self.sums = np.concatenate([[0], np.cumsum(self.weights)])

    def _add(self, rows: np.ndarray, first: int) -> int:
        self.rows[first : first + len(rows)] = rows
        self.centre.append(rows[0])
        self.radius.append(float(distances(self.x[rows[:1]], self.x[rows]).max()) if len(rows) > 1 else 0.0)
        self.first.append(first)
        self.end.append(first + len(rows))
        self.children.append([])
        return len(self.centre) - 1


def roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least row that each of ``n`` rows reaches by the links."""
    label = np.arange(n)
    while len(u):
        a, b = label[u], label[v]
        open_ = a != b
        if not open_.any():
            break
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


class Links:
    """Links found between two sets of rows (or within one): per row the weight of its partners, and links that connect the same rows."""

    ROOM = 1_000_000

    def __init__(self, n: int, m: int):
        self.left, self.right = np.zeros(n, np.int64), np.zeros(m, np.int64)
        self.n, self.u, self.v, self.held = n + m, [], [], 0

    def connect(self, u: np.ndarray, v: np.ndarray) -> None:
        self.u.append(u)
        self.v.append(v)
        self.held += len(u)
        if self.held > self.ROOM:
            u, v = self.spanning()
            self.u, self.v, self.held = [u], [v], len(u)

    def spanning(self) -> tuple[np.ndarray, np.ndarray]:
        """At most one link per row, to the least row it reaches."""
        if not self.u:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        label = roots(self.n, np.concatenate(self.u), np.concatenate(self.v))
        at = np.flatnonzero(label != np.arange(self.n))
        return at, label[at]


def traverse(p: CoverTree, q: CoverTree, cosine: float) -> Links:
    """All pairs of cosine at least ``cosine`` between the rows of two trees, or within one tree (``q is p``), each once."""
    reach, same = float(np.sqrt(2 - 2 * cosine)), p is q
    found = Links(len(p.x), 0 if same else len(q.x))
    shift = 0 if same else len(p.x)
    right = found.left if same else found.right

    def whole(i, j):
        a, b = p.rows[p.first[i] : p.end[i]], q.rows[q.first[j] : q.end[j]]
        found.left[a] += q.sums[q.end[j]] - q.sums[q.first[j]]
        if same and i == j:
            found.left[a] -= p.weights[p.first[i] : p.end[i]]
        else:
            right[b] += p.sums[p.end[i]] - p.sums[p.first[i]]
        found.connect(a, np.full(len(a), b[0] + shift))
        found.connect(np.full(len(b), a[0]), b + shift)

    def compare(i, j):
        for low in range(p.first[i], p.end[i], TILE):
            high = min(low + TILE, p.end[i])
            a, wa = p.rows[low:high], p.weights[low:high]
            for k in range(q.first[j], q.end[j], TILE):
                stop = min(k + TILE, q.end[j])
                b, wb = q.rows[k:stop], q.weights[k:stop]
                hit = p.x[a] @ q.x[b].T >= cosine
                if same and i == j:
                    hit &= np.arange(low, high)[:, None] < np.arange(k, stop)
                if hit.any():
                    found.left[a] += hit @ wb
                    right[b] += wa @ hit
                    s, t = np.nonzero(hit)
                    found.connect(a[s], b[t] + shift)

    todo = [(0, 0)]
    while todo:
        i, j = todo.pop()
        ri, rj = p.radius[i], q.radius[j]
        d = 0.0 if same and i == j else float(distances(p.x[p.centre[i]][None], q.x[q.centre[j]][None])[0, 0])
        if d + ri + rj <= reach - SLACK and not (same and i == j and 2 * ri > reach - SLACK):
            whole(i, j)
            continue
        ci, cj = p.children[i], q.children[j]
        if not len(ci) and not len(cj):
            compare(i, j)
            continue
        if same and i == j:
            cj = ci
        elif not len(ci) or (len(cj) and rj > 2 * ri):
            ci = np.array([i])
        elif not len(cj) or ri > 2 * rj:
            cj = np.array([j])
        for low in range(0, len(ci), TILE):
            a = ci[low : low + TILE]
            for k in range(low if same and i == j else 0, len(cj), TILE):
                b = cj[k : k + TILE]
                open_ = distances(p.x[p.centre[a]], q.x[q.centre[b]]) <= p.radius[a][:, None] + q.radius[b] + (reach + SLACK)
                if same and i == j:
                    open_ &= np.arange(low, low + len(a))[:, None] <= np.arange(k, k + len(b))
                s, t = np.nonzero(open_)
                single = (same and i == j) & (a[s] == b[t]) & (p.size[a[s]] == 1)
                todo.extend(zip(a[s[~single]].tolist(), b[t[~single]].tolist()))
    return found
