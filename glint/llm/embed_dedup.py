"""Embedding near-dedup by hierarchical navigable small-world graphs.

Equal vectors of a group are one class first (map-side combine), so copies
are counted and never compared. The classes of a group are dealt into shards
of about `SHARD` by a hash; a task builds one shard's graph, in batches of
insertions, and every class of the group queries it, in blocks of
`QUERIES`, so neither a hot group nor its queries are one task's work.

A query descends the layers and searches the lowest with a beam. From every
link found it goes on along the graph's edges while they lead to further
links, so a crowd of near copies larger than the beam is still found whole.
Audits compare links found with brute force, a vector's match with itself
left out: of the shard's own vectors, drawn until `AUDIT` with links are seen
or all have been, and then of the queries from other shards, block by block
until `AUDIT` with links are seen there, too. While less than `RECALL` of a
vector's links is found on average, so that a crowd does not outvote rare
pairs, the beam is doubled, up to an exhaustive search. Cosines are verified
in double precision.

Links of a shard are united inside the task; only one edge per query and
component found leaves it, and the components of these edges are the result.

Defined cases: a vector that is null, empty, zero or holds null or
non-finite components, or whose label is null, links with nothing; vectors
of different length do not link; repeated rows are separate vectors that
link with each other; a null id names a component only if all its ids are
null."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, n_partitions, save_table, skew_lookup

SHARD = 8_192
QUERIES = 65_536
RECALL = 0.995
AUDIT = 256
BLOCK = 256


class Graph:
    """A navigable small-world graph over unit vectors (by inner product)."""

    def __init__(self, x: np.ndarray, links: int = 12, beam: int = 48, seed: int = 1):
        self.x, self.m, self.beam = x, links, beam
        n, rng = len(x), np.random.default_rng(seed)
        level = np.minimum((-np.log(1 - rng.random(n)) / np.log(links)).astype(int), 6)
        level[0] = max(level.max(initial=0), 0)  # the entry
        self.level = level
        self.next = [np.full((n, links * (1 + (i == 0))), -1, np.int32) for i in range(level[0] + 1)]
        at = 1
        while at < n:  # each batch at most as large as what is there
            size = min(256, max(1, at), n - at)
            self._insert(np.arange(at, at + size))
            at += size

    def _merge(self, ids, sims, new, new_sims, width):
        """Keep the `width` most similar of both, without repeats."""
        both, s = np.concatenate((ids, new), 1), np.concatenate((sims, new_sims), 1)
        order = np.argsort(-s, axis=1, kind="stable")[:, :width]
        return np.take_along_axis(both, order, 1), np.take_along_axis(s, order, 1)

    def _search(self, q: np.ndarray, start: np.ndarray, layer: int, width: int):
        """Beam search: (ids, similarities) per query, most similar first,
        id -1 where there are fewer."""
        nq, nbr, rows = len(q), self.next[layer], np.arange(len(q))
        seen = np.zeros((nq, len(self.x) + 1), bool)
        seen[:, -1] = True  # id -1
        ids = np.full((nq, width), -1, np.int64)
        sims = np.full((nq, width), -np.inf)
        np.put_along_axis(seen, start, True, 1)
        seen[:, -1] = True
        s0 = np.where(start >= 0, np.einsum("qmd,qd->qm", self.x[start], q), -np.inf)
        ids, sims = self._merge(ids, sims, start, s0, width)
        open_ = ids >= 0
        live = rows
        while len(live):
            take = min(4, width)
            rank = np.where(open_[live], sims[live], -np.inf)
            pick = np.argsort(-rank, axis=1)[:, :take]
            ok = np.take_along_axis(rank, pick, 1) > -np.inf
            some = ok[:, 0]
            live, pick, ok = live[some], pick[some], ok[some]
            if not len(live):
                break
            o = open_[live]
            np.put_along_axis(o, pick, False, 1)
            open_[live] = o
            to = np.where(ok[:, :, None], nbr[np.take_along_axis(ids[live], pick, 1)], -1).reshape(len(live), -1).astype(np.int64)
            to.sort(axis=1)
            to[:, 1:][to[:, 1:] == to[:, :-1]] = -1
            to[np.take_along_axis(seen[live], to, 1)] = -1
            np.put_along_axis(sub := seen[live], to, True, 1)
            sub[:, -1] = True
            seen[live] = sub
            s = np.where(to >= 0, np.einsum("qmd,qd->qm", self.x[to], q[live]), -np.inf)
            both, bs = np.concatenate((ids[live], to), 1), np.concatenate((sims[live], s), 1)
            bo = np.concatenate((open_[live], to >= 0), 1)
            order = np.argsort(-bs, axis=1, kind="stable")[:, :width]
            ids[live], sims[live] = np.take_along_axis(both, order, 1), np.take_along_axis(bs, order, 1)
            open_[live] = np.take_along_axis(bo, order, 1)
        return ids, sims

    def _choose(self, ids, sims, width):
        """Of candidates in order of similarity, those nearer to the query
        than to any chosen one; free places go to the nearest others."""
        x = self.x[ids]
        between = np.matmul(x, x.transpose(0, 2, 1))
        n, c = ids.shape
        chosen, near = np.zeros((n, c), bool), np.full((n, c), -np.inf)
        for j in range(c):
            ok = (ids[:, j] >= 0) & (near[:, j] < sims[:, j]) & (chosen.sum(1) < width)
            chosen[:, j] = ok
            near = np.where(ok[:, None], np.maximum(near, between[:, j]), near)
        order = np.argsort(np.where(chosen, 0, np.where(ids >= 0, 1, 2)), axis=1, kind="stable")[:, :width]
        return np.take_along_axis(ids, order, 1)

    def _insert(self, new: np.ndarray) -> None:
        q = self.x[new]
        start = np.zeros((len(new), 1), np.int64)
        for layer in range(len(self.next) - 1, -1, -1):
            here = self.level[new] >= layer
            width = self.beam if here.any() else 1
            ids, sims = self._search(q, start, layer, width)
            start = ids[:, : min(4, width)].copy()
            if not here.any():
                continue
            own, oi, os = new[here], ids[here], sims[here]
            # members of the same batch see each other directly
            s = self.x[own] @ self.x[own].T
            s[np.arange(len(own)), np.arange(len(own))] = -np.inf
            k = min(len(own), self.beam // 2)
            top = np.argpartition(-s, k - 1, axis=1)[:, :k]
            oi, os = self._merge(oi, os, np.where(np.take_along_axis(s, top, 1) > -np.inf, own[top], -1), np.take_along_axis(s, top, 1), self.beam)
            nbr = self._choose(oi, os, self.m)
            self.next[layer][own, : nbr.shape[1]] = nbr
            self._back(layer, np.repeat(own, nbr.shape[1]), nbr.ravel())

    def _back(self, layer: int, source: np.ndarray, target: np.ndarray) -> None:
        """Edges target -> source; a full node keeps the best of its edges."""
        ok = target >= 0
        source, target = source[ok], target[ok].astype(np.int64)
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        first = np.concatenate(([True], target[1:] != target[:-1])) if len(target) else np.zeros(0, bool)
        rank = np.arange(len(target)) - np.repeat(np.flatnonzero(first), np.diff(np.append(np.flatnonzero(first), len(target))))
        adj, add = self.next[layer], 32
        for r in range(0, int(rank.max(initial=-1)) + 1, add):
            sel = (rank >= r) & (rank < r + add)
            t, s, k = target[sel], source[sel], rank[sel] - r
            nodes, at = np.unique(t, return_inverse=True)
            extra = np.full((len(nodes), add), -1, np.int64)
            extra[at, k] = s
            for a in range(0, len(nodes), 512):
                part = nodes[a: a + 512]
                both = np.concatenate((adj[part].astype(np.int64), extra[a: a + 512]), 1)
                both.sort(axis=1)
                both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
                sims = np.where(both >= 0, np.einsum("qmd,qd->qm", self.x[both], self.x[part]), -np.inf)
                order = np.argsort(-sims, axis=1, kind="stable")
                both, sims = np.take_along_axis(both, order, 1), np.take_along_axis(sims, order, 1)
                width = adj.shape[1]
                small = (both >= 0).sum(1) <= width
                out = both[:, :width]
                if not small.all():
                    out[~small] = self._choose(both[~small], sims[~small], width)
                adj[part] = out

    def links(self, q: np.ndarray, least: float, width: int) -> list[np.ndarray]:
        """Per query the ids with similarity >= least, by a beam of `width`
        and then along edges from link to link."""
        if len(self.x) <= width:
            hits = q @ self.x.T >= least
            return [np.flatnonzero(h) for h in hits]
        start = np.zeros((len(q), 1), np.int64)
        for layer in range(len(self.next) - 1, 0, -1):
            start = self._search(q, start, layer, 8)[0]
        ids, sims = self._search(q, start, 0, width)
        out = []
        for i in range(len(q)):
            found = ids[i][(sims[i] >= least) & (ids[i] >= 0)]
            edge = found
            while len(edge):
                to = np.unique(self.next[0][edge])
                to = np.setdiff1d(to[to >= 0], found, assume_unique=False)
                edge = to[self.x[to] @ q[i] >= least]
                found = np.concatenate((found, edge))
            out.append(found)
        return out


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each node's component."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (nxt := root[root]).tolist() != root.tolist():
            root = nxt
        keep = root[a] != root[b]
        a, b = a[keep], b[keep]
    return root


def _shard_links(least: float):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (grp, own, cid, n, vec) sorted by grp and own first."""
        grp, build, graph, state = None, [], None, None

        def finish():
            """Build the graph, choose the beam by audits, link the own rows."""
            cid = np.array([r[0] for r in build], np.int64)
            n = np.array([r[1] for r in build], np.int64)
            x = np.array([r[2] for r in build])
            order = np.random.default_rng(1).permutation(len(x))
            cid, n, x = cid[order], n[order], x[order]
            g = Graph(x)
            return {"g": g, "width": widened(g, 32, *own_audit(x)), "cid": cid, "n": n, "seen": 0}

        def own_audit(x):
            """Places of vectors with links to others, and these links."""
            order, places, truth = np.random.default_rng(2).permutation(len(x)), [], []
            for at in range(0, len(x), BLOCK):
                some = order[at: at + BLOCK]
                near = x[some] @ x.T >= least
                near[np.arange(len(some)), some] = False
                hit = np.flatnonzero(near.any(1))[: AUDIT - len(places)]
                places += some[hit].tolist()
                truth += [np.flatnonzero(near[i]) for i in hit]
                if len(places) == AUDIT:
                    break
            return x[places], truth

        def widened(g, width, q, truth):
            """The beam, doubled until it finds these links."""
            while width < len(g.x) and truth:
                if np.mean([np.isin(t, f).mean() for t, f in zip(truth, g.links(q, least, width))]) >= RECALL:
                    break
                width *= 2
            return width

        def own_links(s):
            g, width, cid, n = s["g"], s["width"], s["cid"], s["n"]
            a, b, count = [], [], np.zeros(len(cid), np.int64)
            for at in range(0, len(cid), 256):
                for i, f in enumerate(g.links(g.x[at: at + 256], least, width)):
                    f = f[f != at + i]
                    a.append(np.full(len(f), at + i))
                    b.append(f)
                    count[at + i] += n[f].sum()
                if sum(map(len, a)) > 2_000_000:  # keep a forest only
                    r = _roots(len(cid), np.concatenate(a), np.concatenate(b))
                    a, b = [np.arange(len(cid))], [r]
            r = _roots(len(cid), np.concatenate(a or [np.zeros(0, int)]), np.concatenate(b or [np.zeros(0, int)]))
            return r, count

        def out(cid, count, to):
            return pa.RecordBatch.from_arrays(
                [pa.array(cid, pa.int64()), pa.array(count, pa.int64()), pa.array(to, pa.list_(pa.int64()))], ["cid", "links", "to"])

        def ask(s, root, rows):
            g, cid, n = s["g"], s["cid"], s["n"]
            q = np.array([r[2] for r in rows])
            if s["seen"] < AUDIT:
                near = q @ g.x.T >= least
                some = np.flatnonzero(near.any(1))
                truth = [np.flatnonzero(near[i]) for i in some]
                s["seen"] += len(truth)
                s["width"] = widened(g, s["width"], q[some], truth)
            res = g.links(q, least, s["width"])
            return out([r[0] for r in rows], [int(n[f].sum()) for f in res], [cid[np.unique(root[f])].tolist() for f in res])

        asked: list = []
        for batch in it:
            cols = [batch.column(i) for i in range(4)]
            vecs = batch.column(4)
            for i, (gr, own, cid, n) in enumerate(zip(*(c.to_pylist() for c in cols))):
                if gr != grp:
                    if state is None and build:
                        state = finish()
                        root, count = own_links(state)
                        if emit_own:
                            yield out(state["cid"], count, [[int(c)] for c in state["cid"][root]])
                    if asked:
                        yield ask(state, root, asked)
                    grp, build, state, asked = gr, [], None, []
                v = np.asarray(vecs[i].values.to_numpy(zero_copy_only=False), np.float64)
                v = v / np.abs(v).max()
                v /= np.sqrt(v @ v)
                if own != 2:
                    emit_own = own == 0
                    build.append((cid, n, v))
                    continue
                if state is None:
                    state = finish()
                    root, count = own_links(state)
                    if emit_own:
                        yield out(state["cid"], count, [[int(c)] for c in state["cid"][root]])
                asked.append((cid, n, v))
                if len(asked) >= 256:
                    yield ask(state, root, asked)
                    asked = []
        if build and state is None:
            state = finish()
            root, count = own_links(state)
            if emit_own:
                yield out(state["cid"], count, [[int(c)] for c in state["cid"][root]])
        if asked:
            yield ask(state, root, asked)

    return run


def embedding_dedup(
    vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding", group_col: str = "label",
) -> DataFrame:
    """One row per row of `vectors`: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    v = F.col(vec_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall(v, lambda x: x == 0)
    ok = F.coalesce(F.col(group_col).isNotNull() & v.isNotNull() & ~bad & ~zero & (F.size(v) > 0), F.lit(False))
    group = F.concat_ws(":", F.size(v), F.col(group_col).cast("string"))
    hashed = F.concat(*[F.hex(F.xxhash64(F.lit(s), group, v)) for s in (1, 2)])
    rows = vectors.select(
        F.col(id_col).alias("vec_id"), F.when(ok, hashed).alias("key"), F.when(ok, group).alias("grp"), F.when(ok, v).alias("v"))
    total = rows.count()
    classes = rows.where("key is not null").groupBy("key", "grp", "v").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
    classes = save_table(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    sizes = classes.groupBy("grp").agg(F.count(F.lit(1)).alias("g"))
    shards = sizes.select(
        "grp", F.col("g").alias("w"), F.ceil(F.col("g") / SHARD).cast("int").alias("shards"),
        F.ceil(F.col("g") / QUERIES).cast("int").alias("blocks"))
    c = skew_lookup(classes.select("grp", "cid", "n", "v"), shards, "grp", "w", total, "inner")
    home = F.pmod(F.xxhash64("cid"), F.col("shards")).cast("int")
    block = F.pmod(F.xxhash64(F.lit(3), "cid"), F.col("blocks")).cast("int")
    c = c.withColumn("home", home).withColumn("block", block)
    # own = 0: builds the graph and reports its links; 1: builds it for
    # another block of queries; 2: queries only
    builds = c.select("grp", F.col("home").alias("shard"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"), "cid", "n", "v")
    builds = builds.select("grp", "shard", "b", F.when(F.col("b") == 0, 0).otherwise(1).alias("own"), "cid", "n", "v")
    asks = c.select("grp", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "home", F.col("block").alias("b"), "cid", "n", "v")
    asks = asks.where("shard <> home").select("grp", "shard", "b", F.lit(2).alias("own"), "cid", "n", "v")
    work = builds.unionByName(asks).select(F.concat_ws("|", "grp", "shard", "b").alias("grp"), "own", "cid", "n", "v")
    found = work.repartition(n_partitions(spark), "grp").sortWithinPartitions("grp", "own").mapInArrow(
        _shard_links(least), "cid long, links long, to array<long>")
    found = save_table(found, "links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    edges = found.select(F.col("cid").alias("a"), F.explode("to").alias("b")).where("a <> b")
    roots = components(edges).withColumnRenamed("node", "cid")
    named = (
        classes.select("cid", "key", "least", "n").join(links, "cid", "left").join(roots, "cid", "left")
        .withColumn("root", F.coalesce("root", "cid")))
    per = named.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("m"))
    named = skew_lookup(named, per, "root", "m", total, "inner")
    named = save_table(named.select("key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "n"), "named")
    linked = skew_lookup(rows.where("key is not null").select("vec_id", "key"), named, "key", "n", total, "inner")
    alone = rows.where("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op3_embed_dedup(spark, sf_dir) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    return embedding_dedup(rows, least=0.98)
