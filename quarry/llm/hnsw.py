"""A hierarchical navigable small-world graph over the vectors of one shard (Malkov and Yashunin), in numpy.

Vectors are inserted, and queries answered, many at a time in lockstep: one step of all beams is a few array
operations. Similarity is the dot product of vectors of unit length.
"""

from __future__ import annotations

import numpy as np

NEIGHBOURS = 32              # links of a node on the lowest layer; half of it above
BEAM = 64
BATCH = 256
EXPAND = 4                   # beam entries expanded in a step


class Graph:
    def __init__(self, x: np.ndarray, links: list[np.ndarray] | None = None, neighbours: int = NEIGHBOURS,
                 seed: int = 5):
        self.x = np.ascontiguousarray(x, np.float32)
        self.m = neighbours
        n = len(x)
        level = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(neighbours / 2)).astype(int)
        self.level = np.minimum(level, 6)
        if n:
            self.level[0] = self.level.max()                   # the first node is where every search starts
        layers = int(self.level.max()) + 1 if n else 1
        if links is None:
            self.links = [np.full((n, neighbours if k == 0 else neighbours // 2), -1, np.int32) for k in range(layers)]
            at = 0
            while at < n:                                      # batches double, so few are placed against few
                end = min(n, max(at + 1, min(at * 2, at + BATCH)))
                self._insert(np.arange(at, end))
                at = end
        else:
            self.links = links
        # who links to a node: crowds of like vectors drop links to some of their own, which still link to them
        low = self.links[0]
        frm, to = np.nonzero(low >= 0)
        to = low[frm, to]
        self.back = frm[np.argsort(to, kind="stable")]
        self.back_at = np.concatenate([[0], np.cumsum(np.bincount(to, minlength=n))]) if n else np.zeros(1, int)

    def _insert(self, new: np.ndarray) -> None:
        start = int(new[0])
        entry = np.zeros((len(new), 1), np.int64)
        for layer in range(len(self.links) - 1, -1, -1):
            here = new[self.level[new] >= layer]
            if start:
                ids, sims = self.search_layer(self.x[new], entry, BEAM if len(here) else 1, layer)
                entry = ids[:, :1] if not len(here) else ids
            else:
                ids, sims = np.full((len(new), 1), -1, np.int64), np.full((len(new), 1), -np.inf, np.float32)
            if not len(here):
                continue
            row = here - start
            each = self.x[here] @ self.x[here].T               # the batch's own members are candidates too
            np.fill_diagonal(each, -np.inf)
            k = min(len(here), BEAM)
            near = np.argpartition(-each, k - 1, axis=1)[:, :k]
            more = np.take_along_axis(each, near, 1)
            ids_ = np.concatenate([ids[row], np.where(np.isfinite(more), here[near], -1)], 1)
            sims_ = np.concatenate([sims[row], more], 1)
            chosen = self._choose(ids_, sims_, self.links[layer].shape[1])
            self.links[layer][here] = chosen
            self._link_back(here, chosen, layer)

    def _choose(self, ids: np.ndarray, sims: np.ndarray, m: int) -> np.ndarray:
        """The nearest candidates that are closer to the node than to any chosen one; then the nearest others."""
        order = np.argsort(-sims, axis=1, kind="stable")[:, :3 * m]
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        v = self.x[np.maximum(ids, 0)]
        between = np.matmul(v, v.transpose(0, 2, 1))
        chosen = np.zeros(ids.shape, bool)
        for j in range(ids.shape[1]):
            closer = (chosen & (between[:, j] > sims[:, j, None])).any(1)
            chosen[:, j] = (ids[:, j] >= 0) & ~closer & (chosen.sum(1) < m)
        rank = np.where(chosen, 0, np.where(ids >= 0, 1, 2))
        first = np.argsort(rank, axis=1, kind="stable")[:, :m]
        out = np.take_along_axis(ids, first, 1)
        if out.shape[1] < m:
            out = np.pad(out, ((0, 0), (0, m - out.shape[1])), constant_values=-1)
        return out.astype(np.int32)

    def _link_back(self, here: np.ndarray, chosen: np.ndarray, layer: int) -> None:
        links = self.links[layer]
        m = links.shape[1]
        to, frm = chosen.reshape(-1), np.repeat(here, m)
        frm, to = frm[to >= 0], to[to >= 0]
        sim = np.einsum("ij,ij->i", self.x[frm], self.x[to])
        order = np.lexsort((-sim, to))
        to, frm, sim = to[order], frm[order], sim[order]
        nodes, first, count = np.unique(to, return_index=True, return_counts=True)
        place = np.arange(len(to)) - np.repeat(first, count)
        near = place < m                                       # more than m new links of a node: its nearest m
        new = np.full((len(nodes), min(int(count.max(initial=0)), m)), -1, np.int64)
        row = np.repeat(np.arange(len(nodes)), count)
        new[row[near], place[near]] = frm[near]
        new[(new[:, :, None] == links[nodes][:, None, :]).any(2)] = -1
        for lo in range(0, len(nodes), BATCH):
            part = nodes[lo:lo + BATCH]
            ids = np.concatenate([links[part].astype(np.int64), new[lo:lo + BATCH]], 1)
            sims = np.einsum("ijk,ik->ij", self.x[np.maximum(ids, 0)], self.x[part])
            sims[ids < 0] = -np.inf
            links[part] = self._choose(ids, sims, m)

    def search_layer(self, q: np.ndarray, entry: np.ndarray, beam: int, layer: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` best nodes that a best-first search from ``entry`` finds, best first; -1 where there are
        fewer."""
        n, links = len(self.x), self.links[layer]
        ids = np.full((len(q), beam), -1, np.int64)
        sims = np.full((len(q), beam), -np.inf, np.float32)
        done = np.zeros((len(q), beam), bool)
        seen = np.zeros((len(q), n), bool)
        e = entry[:, :beam]
        ids[:, :e.shape[1]] = e
        got = np.einsum("ijk,ik->ij", self.x[np.maximum(e, 0)], q)
        got[e < 0] = -np.inf
        sims[:, :e.shape[1]] = got
        r, c = np.nonzero(e >= 0)
        seen[r, e[r, c]] = True
        active = np.arange(len(q))
        while len(active):
            a_ids, a_sims, a_done = ids[active], sims[active], done[active]
            open_ = np.where((a_ids >= 0) & ~a_done, a_sims, -np.inf)
            k = min(EXPAND, beam)
            pick = np.argpartition(-open_, k - 1, axis=1)[:, :k]
            ok = np.isfinite(np.take_along_axis(open_, pick, 1))
            r, c = np.nonzero(ok)
            if not len(r):
                break
            a_done[r, pick[r, c]] = True
            nb = links[a_ids[r, pick[r, c]]].astype(np.int64)
            flat = (active[r][:, None] * n + nb)[nb >= 0]
            flat = np.unique(flat[~seen.reshape(-1)[flat]])
            seen.reshape(-1)[flat] = True
            row, node = flat // n, flat % n
            found = np.einsum("ij,ij->i", q[row], self.x[node])
            local = np.searchsorted(active, row)
            count = np.bincount(local, minlength=len(active))
            width = int(count.max(initial=0))
            if width:
                place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                add = np.full((len(active), width), -1, np.int64)
                add_s = np.full((len(active), width), -np.inf, np.float32)
                add[local, place], add_s[local, place] = node, found
                a_ids, a_sims = np.concatenate([a_ids, add], 1), np.concatenate([a_sims, add_s], 1)
                a_done = np.concatenate([a_done, np.zeros(add.shape, bool)], 1)
                best = np.argpartition(-a_sims, beam - 1, axis=1)[:, :beam]
                a_ids, a_sims, a_done = (np.take_along_axis(z, best, 1) for z in (a_ids, a_sims, a_done))
            ids[active], sims[active], done[active] = a_ids, a_sims, a_done
            active = active[((a_ids >= 0) & ~a_done).any(1)]
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def near(self, q: np.ndarray, least: float, beam: int) -> list[np.ndarray]:
        """For each query the nodes of similarity ``least`` or more that are found: a beam search finds the
        neighbourhood, and from what is near enough all links, either way, are followed as long as they lead to more."""
        if not len(self.x):
            return [np.zeros(0, np.int64)] * len(q)
        entry = np.zeros((len(q), 1), np.int64)
        for layer in range(len(self.links) - 1, 0, -1):
            entry = self.search_layer(q, entry, 4, layer)[0]
        ids, sims = self.search_layer(q, entry, beam, 0)
        out = []
        for i in range(len(q)):
            found = ids[i][sims[i] >= least]
            if len(found):
                seen = np.zeros(len(self.x), bool)
                seen[ids[i][ids[i] >= 0]] = True
                front, all_ = found, [found]
                while len(front):
                    nb = np.concatenate([self.links[0][front].reshape(-1),
                                         *[self.back[self.back_at[f]:self.back_at[f + 1]] for f in front]])
                    nb = np.unique(nb[nb >= 0])
                    nb = nb[~seen[nb]]
                    seen[nb] = True
                    front = nb[self.x[nb] @ q[i] >= least]
                    all_.append(front)
                found = np.concatenate(all_)
            out.append(found)
        return out
