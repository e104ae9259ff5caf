"""The best products of many users' factors with a block of items' factors, without a
product for each pair.

Which items are best for a user depends on the direction of the user's factors alone, and
on items' factors up to a common shift.  So users of like directions are searched together:
they are halved along their widest axis down to some ``LEAF`` users.  On the way down, an item w (shifted)
is given up for a node whose users lie within an angle of its centre if it cannot reach the
least score that each of them is known to have enough items for: at an angle p from the centre it scores at
most |w| cos(max(0, p - angle)) for a user's unit vector.  Such a least score comes from
the products with a few items near the centre of a leaf.  Whatever the factors are, each
item left out is proved to be none of the best; if nothing can be proved, all are compared.
"""

from __future__ import annotations

LEAF = 64           # users whose products are made together
PRODUCT = 1 << 20   # products held at once (or one user's)
CHUNK = 1 << 15     # users sorted by direction together


def best_unrated(top_of, leaf: int = LEAF, product: int = PRODUCT):
    """``prepared(matrix)`` for the factors of a block of items, which gives a function of
    users' factors, the number wanted, and what is rated, as sorted, distinct ``user * len(matrix) + item``
    (both by place): it yields (users' places, items' places, scores, ranks) with the best unrated items of
    each user, ties by place.  (Made here, so that it travels to executors by value;
    ``top_of`` gives the places of the best scores of one user.)"""
    import numpy as np

    def prepared(matrix):
        size, rank = matrix.shape
        mean = matrix.mean(0, dtype=np.float64)
        moved = (matrix - mean).astype(np.float32)
        squares = np.einsum("ij,ij->i", moved, moved)
        lengths = np.sqrt(squares)
        # products of single precision are off by less than this, for unit vectors
        slack = 1e-6 * (rank + 8) * (float(lengths.max()) + float(np.sqrt(mean @ mean)))

        def ranked(users, items, scores, n, rated):
            """The best n of each user among these, without the rated."""
            pairs = users * size + items
            at = np.minimum(np.searchsorted(rated, pairs), max(0, len(rated) - 1))
            keep = rated[at] != pairs if len(rated) else np.ones(len(pairs), bool)
            users, items, scores = users[keep], items[keep], scores[keep]
            order = np.lexsort((items, -scores, users))
            users, items, scores = users[order], items[order], scores[order]
            place = np.arange(len(users)) - np.searchsorted(users, users)
            keep = place < n
            return users[keep], items[keep], scores[keep], place[keep] + 1

        def plainly(factors, users, most, n, rated):
            """All products of these users."""
            step = max(1, product // size)
            for at in range(0, len(users), step):
                some = users[at:at + step]
                scores = factors[some] @ matrix.T
                tops = [top_of(row, m) for row, m in zip(scores, most[some].tolist())]
                owners = np.repeat(np.arange(len(some)), [len(top) for top in tops])
                tops = np.concatenate(tops)
                yield ranked(some[owners], tops, scores[owners, tops], n, rated)

        def nodes(users, units, near, pool, reach):
            """The tree of these users, each node (centre, cosine and sine of its angle, least score, users or
            its two parts); ``near`` are places of items towards them, ``reach`` finds least scores."""
            own = units[users]
            centre = own.mean(0)
            length = np.sqrt(centre @ centre)
            centre = centre / length if length > 1e-6 else own[0]
            cosine = min(1.0, max(-1.0, float((own @ centre).min()) - 1e-9))
            wanted = pool if len(users) <= leaf else max(pool, len(near) // 2)
            if wanted < len(near):
                near = near[np.argpartition(moved[near] @ centre.astype(np.float32), len(near) - wanted)[-wanted:]]
            if len(users) <= leaf:
                return centre, cosine, reach(users, near), users, None
            some = own[::max(1, len(own) // 1024)]
            some = some - some.mean(0)
            along = own @ np.linalg.eigh(some.T @ some)[1][:, -1]
            halves = np.argpartition(along, len(along) // 2)
            parts = [nodes(users[half], units, near, pool, reach) for half in (halves[:len(along) // 2], halves[len(along) // 2:])]
            return centre, cosine, min(p[2] for p in parts), None, parts

        def leaves(node, places, factors, squared, long):
            """The leaves below a node, each with the places of the items that may be among its best."""
            centre, cosine, least, users, parts = node
            along = factors @ centre.astype(np.float32)
            across = np.sqrt(np.maximum(squared - along * along, 0))
            most = np.float32(cosine) * along + np.float32(np.sqrt(1 - cosine * cosine)) * across
            keep = (along >= np.float32(cosine) * long) | (most >= np.float32(least))
            keep &= long >= np.float32(least)
            # copies only where they are much smaller, so all those on the way are bounded
            if users is not None or 2 * np.count_nonzero(keep) <= len(places):
                keep = np.flatnonzero(keep)
                places, factors, squared, long = places[keep], factors[keep], squared[keep], long[keep]
            if users is not None:
                yield users, places
            else:
                for part in parts:
                    yield from leaves(part, places, factors, squared, long)

        def best(factors, n, rated):
            count = len(factors)
            most = n + np.bincount(rated // size, minlength=count)
            norms = np.sqrt(np.einsum("ij,ij->i", factors, factors, dtype=np.float64))
            pools = 8 << np.ceil(np.log2(most)).astype(np.int64)
            odd = ~((norms > 1e-30) & (norms < 1e30) & (4 * pools < size)) | (not np.isfinite(slack))
            yield from plainly(factors, np.flatnonzero(odd), most, n, rated)
            units = factors / np.where(odd, 1, norms)[:, None]
            shifts = factors @ mean
            least = np.full(count, -np.inf)

            def reach(users, near):
                scores = factors[users] @ matrix[near].T
                scores.sort(axis=1)
                least[users] = scores[np.arange(len(users)), len(near) - most[users]] - slack * norms[users]
                return float(((least[users] - shifts[users]) / norms[users]).min()) - slack

            for pool in np.unique(pools[~odd]).tolist():
                tree = nodes(np.flatnonzero(~odd & (pools == pool)), units, np.arange(size), pool, reach)
                for users, places in leaves(tree, np.arange(size), moved, squares, lengths):
                    step = max(1, product // max(1, len(places)))
                    them = matrix[places].T
                    for at in range(0, len(users), step):
                        some = users[at:at + step]
                        scores = factors[some] @ them
                        found = np.flatnonzero(scores >= least[some][:, None].astype(np.float32))
                        own, item = np.divmod(found, max(1, len(places)))
                        yield ranked(some[own], places[item], scores.ravel()[found], n, rated)

        return best

    return prepared
