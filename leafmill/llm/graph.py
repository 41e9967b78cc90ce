"""Hierarchical navigable small-world graphs in flat arrays, built in bulk and searched for many vectors in step."""

from __future__ import annotations

import numpy as np

#: Links a node keeps above the ground layer and on it; one node in LINKS goes up a layer.
LINKS, GROUND_LINKS = 12, 32
#: The highest layer has at most so many nodes; it is entered by comparing with all of them.
TOP_NODES = 192
#: While a layer is linked, nodes lie in groups around the nodes of each layer above that has one for GROUP of them or more, and each is compared with the NEAR nearest groups, or as many as hold COMPARED nodes.
GROUP, NEAR, COMPARED = 150, 8, 400
#: In the smallest groups, each node is also compared with the nodes that have one of its SHARED nearest upper nodes among theirs, and links to the best ALIKE of them: nodes almost alike can lie in distant groups.
SHARED, ALIKE = 3, 6
#: Nodes opened at a time in a search, and queries searched for in step.
WIDE, STEP = 4, 512
_SEED = 20_240_501


class SmallWorld:
    """A graph over the rows of `x` (unit vectors, float32) by inner product.

    `layers[h]` is a flat array of neighbour positions, one row of links a node, -1 where free; a layer's nodes are the first `sizes[h]` of `order`,
    so every layer is a prefix of the one below. Layers are linked from the top down: the nodes of a layer are put into groups around those
    of a layer above, groups are compared with the groups nearest to them by matrix products, and each node keeps its best links and, as far
    as there is room, those back to it. Exact copies should be put in once only.
    """

    def __init__(self, x: np.ndarray) -> None:
        x = np.ascontiguousarray(x, np.float32)
        n = len(x)
        draw = np.random.default_rng(_SEED).random(n)
        top = (-np.log(np.maximum(draw, 1e-12)) / np.log(LINKS)).astype(int)
        heights = range(int(top.max(initial=0)) + 1)
        highest = next((h for h in heights if (top >= h).sum() <= TOP_NODES), 0)
        top = np.minimum(top, highest)
        self.order = np.argsort(-top, kind="stable")  # positions below refer to this order
        self.xo = x[self.order]
        self.sizes = [int((top >= h).sum()) for h in range(highest + 1)]
        #: Nodes by the upper nodes near to them, and where each upper node's begin.
        self.shared: tuple[np.ndarray, np.ndarray] | None = None
        self.layers: list[np.ndarray] = [np.zeros((0, 0), np.int32)] * (highest + 1)
        for h in range(highest, -1, -1):
            self.layers[h] = self._linked(h, LINKS if h else GROUND_LINKS)

    def _linked(self, h: int, links: int) -> np.ndarray:
        """The flat array of a layer whose upper layers are ready; groups are made around the nodes of each layer above that has some, small groups and large."""
        n = self.sizes[h]
        x, every = self.xo[:n], np.arange(n)
        found = []
        for guides in (s for s in self.sizes[h + 1 :] if 2 <= s and s * GROUP <= 32 * n):
            g = self.xo[:guides]
            if not found:
                several = np.concatenate([_largest(x[i : i + 2048] @ g.T, min(SHARED, guides)) for i in range(0, n, 2048)])
                group = several[every, np.einsum("nd,nkd->nk", x, g[several]).argmax(1)]
                who = np.argsort(several.ravel(), kind="stable")
                ends = np.searchsorted(several.ravel()[who], np.arange(guides + 1))
                who //= several.shape[1]
                if not h:
                    self.shared = who, ends
                for j in range(guides):
                    mine = who[ends[j] : ends[j + 1]]
                    found += [self._block(mine[i : i + 512], mine, ALIKE) for i in range(0, len(mine), 512)]
            else:
                group = np.concatenate([(x[i : i + 8192] @ g.T).argmax(1) for i in range(0, n, 8192)])
            by = np.argsort(group, kind="stable")
            ends = np.searchsorted(group[by], np.arange(guides + 1))
            middle = np.zeros_like(g)
            np.add.at(middle, group, x)
            near = _largest(middle @ g.T, min(guides, max(NEAR, COMPARED * guides // n)))
            for j in range(guides):
                mine = by[ends[j] : ends[j + 1]]
                others = np.concatenate([by[ends[i] : ends[i + 1]] for i in {j, *near[j].tolist()}])
                found += [self._block(mine[i : i + 512], others, links * 3 // 4) for i in range(0, len(mine), 512)]
            if guides * GROUP <= 2 * n:
                break
        else:
            found = [self._block(every[i : i + 512], every, links) for i in range(0, n, 512)]
        if not found:
            return np.full((n, links), -1, np.int32)
        return _best_links(*(np.concatenate(part) for part in zip(*found, strict=True)), n, links)

    def _block(self, rows: np.ndarray, cols: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(node, other, similarity) of the k nearest of `cols` to each of `rows`."""
        s = self.xo[rows] @ self.xo[cols].T
        s[rows[:, None] == cols[None, :]] = -2
        k = min(k, len(cols))
        at = _largest(s, k)
        sim = np.take_along_axis(s, at, 1).ravel()
        ok = sim > -2
        return np.repeat(rows, k)[ok], cols[at].ravel()[ok], sim[ok]

    def _enter(self, q: np.ndarray, few: int = 4) -> np.ndarray:
        """Where each query enters the ground layer: the best nodes of the top layer, then down the layers between, the best of each."""
        s = q @ self.xo[: self.sizes[-1]].T
        few = min(few, s.shape[1])
        at = _largest(s, few)
        for nbr in self.layers[-2:0:-1]:
            at = self._walk(nbr, q, at, few, None)[0]
        return at

    def _alike(self, q: np.ndarray, few: int = 2) -> np.ndarray:
        """Where each query may enter the ground layer besides, -1 where free: the best nodes that share each of its nearest upper nodes."""
        if self.shared is None:
            return np.full((len(q), 0), -1)
        who, ends = self.shared
        g = self.xo[: len(ends) - 1]
        near = np.concatenate([_largest(q[i : i + 2048] @ g.T, min(SHARED, len(g))) for i in range(0, len(q), 2048)])
        at = np.full((near.size, few), -1)
        by = np.argsort(near.ravel(), kind="stable")
        cuts = np.searchsorted(near.ravel()[by], np.arange(len(ends)))
        for j in np.flatnonzero(np.diff(cuts)):
            rows, mine = by[cuts[j] : cuts[j + 1]], who[ends[j] : ends[j + 1]]
            best = _largest(q[rows // near.shape[1]] @ self.xo[mine].T, few)
            at[rows, : best.shape[1]] = mine[best]
        return at.reshape(len(q), -1)

    def _walk(self, nbr: np.ndarray, q: np.ndarray, entry: np.ndarray, width: int, floor: float | None) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search of one layer for all queries in step, from `entry` (-1 where free): (positions, similarities), `width` each, best first, -1 and -2 where there are fewer.

        At most WIDE nodes a query are opened at a time. With a `floor`, after the first time only nodes at least so similar are opened: what a search by range needs.
        """
        b, (n, m) = len(q), nbr.shape
        width, xo, rows = min(width, n), self.xo, np.arange(b)
        entry = np.sort(np.where(entry < 0, n, entry), axis=1)
        entry[:, 1:][entry[:, 1:] == entry[:, :-1]] = n
        seen = np.zeros((b, n + 1), bool)
        seen[:, n] = True
        seen[rows[:, None], entry] = True
        s = np.matmul(xo[np.minimum(entry, n - 1)], q[:, :, None])[:, :, 0]
        s[entry == n] = -2
        ids, sims = np.full((b, width), n, np.int32), np.full((b, width), -2, np.float32)
        k = min(width, entry.shape[1])
        by = np.argsort(-s, axis=1)[:, :k]
        ids[:, :k], sims[:, :k] = np.take_along_axis(entry, by, 1), np.take_along_axis(s, by, 1)
        fresh, live, first = ids < n, rows, True
        while True:
            f = fresh[live]
            if floor is not None and not first:
                f &= sims[live] >= floor
            first = False
            go = f.any(1)
            live, f = live[go], f[go]
            if not len(live):
                break
            nth = np.cumsum(f, axis=1)  # lists are sorted: the first fresh ones are the best
            r, c = np.nonzero(f & (nth <= WIDE))
            fresh[live[r], c] = False
            cand = np.full((len(live), WIDE, m), n, np.int32)
            cand[r, nth[r, c] - 1] = nbr[ids[live[r], c]]
            cand = cand.reshape(len(live), WIDE * m)
            cand[cand < 0] = n
            cand.sort(axis=1)
            new = np.ones(cand.shape, bool)
            np.not_equal(cand[:, 1:], cand[:, :-1], out=new[:, 1:])
            new &= ~seen[live[:, None], cand]
            r, c = np.nonzero(new)
            v, g = cand[r, c], live[r]
            seen[g, v] = True
            sim = np.einsum("ij,ij->i", q[g], xo[v])
            better = sim > sims[g, -1]
            r, v, sim = r[better], v[better], sim[better]
            if not len(v):
                continue
            count = np.bincount(r, minlength=len(live))
            slot = width + np.arange(len(r)) - (np.cumsum(count) - count)[r]
            has = np.flatnonzero(count)
            r = np.searchsorted(has, r)
            lr = live[has]
            all_s, all_i = np.full((len(has), width + int(count.max())), -2, np.float32), np.full((len(has), width + int(count.max())), n, np.int32)
            all_f = np.ones(all_s.shape, bool)
            all_s[:, :width], all_i[:, :width], all_f[:, :width] = sims[lr], ids[lr], fresh[lr]
            all_s[r, slot], all_i[r, slot] = sim, v
            by = np.argsort(-all_s, axis=1)[:, :width]
            sims[lr], ids[lr] = np.take_along_axis(all_s, by, 1), np.take_along_axis(all_i, by, 1)
            fresh[lr] = np.take_along_axis(all_f, by, 1) & (ids[lr] < n)
        return np.where(sims > -2, ids, -1), sims

    def search(self, q: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows of x, similarities) of about the k nearest of each query, best first; -1 where there are fewer. `width` candidates are followed."""
        out = self._empty(len(q), k)
        if not len(self.xo):
            return out
        q = np.ascontiguousarray(q, np.float32)
        alike = self._alike(q)
        for i in range(0, len(q), STEP):
            part = q[i : i + STEP]
            ids, sims = self._walk(self.layers[0], part, np.concatenate([self._enter(part), alike[i : i + STEP]], 1), max(width, k), None)
            self._put(out, slice(i, i + len(part)), ids, sims)
        return out

    def around(self, rows: np.ndarray, k: int, width: int, floor: float | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The same for vectors that are nodes, rows of x, each starting from its own links; itself is left out. With a `floor`, the walk goes on only among nodes at least so similar."""
        out = self._empty(len(rows), k)
        place = np.empty(len(self.xo), np.int64)
        place[self.order] = np.arange(len(self.xo))
        for i in range(0, len(rows), STEP):
            at = place[rows[i : i + STEP]]
            ids, sims = self._walk(self.layers[0], self.xo[at], np.concatenate([at[:, None], self.layers[0][at]], 1), max(width, k) + 1, floor)
            own = ids == at[:, None]
            sims = np.where(own, -2, sims)
            by = np.argsort(-sims, axis=1, kind="stable")
            ids, sims = np.take_along_axis(np.where(own, -1, ids), by, 1), np.take_along_axis(sims, by, 1)
            self._put(out, slice(i, i + len(at)), ids, sims)
        return out

    def _empty(self, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        return np.full((n, k), -1, np.int64), np.full((n, k), -2, np.float32)

    def _put(self, out: tuple[np.ndarray, np.ndarray], where: slice, ids: np.ndarray, sims: np.ndarray) -> None:
        w = min(out[0].shape[1], ids.shape[1])
        out[0][where, :w] = np.where(ids[:, :w] >= 0, self.order[ids[:, :w]], -1)
        out[1][where, :w] = sims[:, :w]


def _largest(s: np.ndarray, k: int) -> np.ndarray:
    """Where each row's k largest values are, in any order."""
    return np.argpartition(-s, k - 1, axis=1)[:, :k] if 0 < k < s.shape[1] else np.broadcast_to(np.arange(s.shape[1]), s.shape)


def _best_links(src: np.ndarray, dst: np.ndarray, sim: np.ndarray, n: int, m: int) -> np.ndarray:
    """Flat array of the m most similar others of each of n nodes among the given links and their opposites."""
    src, dst, sim = np.concatenate([src, dst]).astype(np.int64), np.concatenate([dst, src]), np.concatenate([sim, sim])
    _, once = np.unique(src * n + dst, return_index=True)
    src, dst, sim = src[once], dst[once], sim[once]
    by = np.argsort((src << 32) + ((1 - np.clip(sim, -1, 1)) * (1 << 30)).astype(np.int64), kind="stable")
    src, dst = src[by], dst[by]
    rank = np.arange(len(src)) - np.searchsorted(src, np.arange(n))[src]
    keep = rank < m
    nbr = np.full((n, m), -1, np.int32)
    nbr[src[keep], rank[keep]] = dst[keep]
    return nbr
