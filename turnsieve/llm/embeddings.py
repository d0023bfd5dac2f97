"""Near-duplicate vectors by navigable small-world graphs, one per shard.

Vectors of a label are dealt into shards of about ``SHARD`` vectors. A task builds the layered graph of a shard
and writes it as one row. Every block of a label's vectors is then sent to each shard's graph: descent
through the upper layers, beam search on the lowest, and the beam is widened as long as its worst
entry is still above the threshold. Each graph is audited: for a sample of its queries the links are compared
with brute force over the shard, and the beam doubled for all of them until the recall is ``RECALL``.
Found pairs count only if their cosine in double precision is at least the threshold.

Equal vectors are one node with a weight. A block reports how many vectors each of its own is linked to, and a
spanning forest of the links, never the pairs; the forests' components are the classes.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .components import components

THRESHOLD, SHARD, BLOCK, PART = 0.93, 8192, 2048, 4
NEIGHBOURS, BUILD_BEAM, BEAM, AUDIT, RECALL = 12, 48, 32, 64, 0.99
#: The beam also keeps what lies this much below the threshold, since a path may lead through it.
MARGIN = 0.05


def _unit(vectors: list) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # neither overflows nor vanishes when squared
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Graph:
    """A hierarchical navigable small world over unit vectors."""

    def __init__(self, x: np.ndarray, layers: list[dict[int, np.ndarray]] | None = None, entry: int = 0):
        self.x, self.layers, self.entry = x, layers or [{}], entry
        self.seen, self.turn = np.zeros(len(x), dtype=np.int64), 0

    @staticmethod
    def built(x: np.ndarray, neighbours: int = NEIGHBOURS, beam: int = BUILD_BEAM) -> Graph:
        graph = Graph(x)
        levels = (-np.log(1 - np.random.default_rng(5).random(len(x))) / np.log(neighbours)).astype(int)
        for i in range(len(x)):
            graph._insert(i, int(levels[i]), neighbours, beam)
        graph._both_ways()
        return graph

    def _both_ways(self) -> None:
        """Give each link of the lowest layer its way back, so that every node is reached from its neighbours."""
        links = self.layers[0]
        back: dict[int, list[int]] = {}
        for a, near in links.items():
            for b in near.tolist():
                back.setdefault(b, []).append(a)
        for b, sources in back.items():
            links[b] = np.union1d(links[b], sources)

    def _insert(self, i: int, level: int, neighbours: int, beam: int) -> None:
        if i == 0:
            self.layers = [{0: np.zeros(0, dtype=np.int64)} for _ in range(level + 1)]
            return
        q, at = self.x[i], self.entry
        for layer in range(len(self.layers) - 1, level, -1):
            at = self._descend(q, at, layer)
        starts = [at]
        for layer in range(min(level, len(self.layers) - 1), -1, -1):
            sims, found = self.search(q, starts, beam, layer)
            near = self._diverse(found, sims, neighbours)
            self.layers[layer][i] = near
            most = 2 * neighbours if layer == 0 else neighbours
            for n in near.tolist():
                own = np.append(self.layers[layer][n], i)
                if len(own) > most:
                    s = self.x[own] @ self.x[n]
                    order = np.argsort(-s, kind="stable")
                    own = self._diverse(own[order], s[order], most)
                self.layers[layer][n] = own
            starts = found[:8].tolist()
        for layer in range(len(self.layers), level + 1):
            self.layers.append({i: np.zeros(0, dtype=np.int64)})
            self.entry = i

    def _diverse(self, nodes: np.ndarray, sims: np.ndarray, n: int) -> np.ndarray:
        """Of nodes by falling similarity, those that are nearer to the new one than to any taken before; then the rest."""
        if len(nodes) <= n:
            return nodes
        between = self.x[nodes] @ self.x[nodes].T
        taken: list[int] = []
        for j in range(len(nodes)):
            if not taken or between[j, taken].max() < sims[j]:
                taken.append(j)
                if len(taken) == n:
                    break
        rest = [j for j in range(len(nodes)) if j not in set(taken)]
        return nodes[taken + rest[: n - len(taken)]]

    def _descend(self, q: np.ndarray, at: int, layer: int) -> int:
        best = self.x[at] @ q
        while len(near := self.layers[layer][at]):
            sims = self.x[near] @ q
            j = int(sims.argmax())
            if sims[j] <= best:
                break
            at, best = int(near[j]), sims[j]
        return at

    def search(self, q: np.ndarray, starts: list[int], beam: int, layer: int = 0, above: float = 2.0) -> tuple[np.ndarray, np.ndarray]:
        """Similarities and nodes by falling similarity: the best ``beam``, and all that are reached at ``above`` or more."""
        self.turn += 1
        seen, turn, x, links = self.seen, self.turn, self.x, self.layers[layer]
        seen[starts] = turn
        first = [(float(x[s] @ q), s) for s in dict.fromkeys(starts)]
        todo, best, sure = [(-s, n) for s, n in first], list(first), []
        heapq.heapify(todo)
        heapq.heapify(best)
        while todo:
            s, n = heapq.heappop(todo)
            if len(best) >= beam and -s < best[0][0] and -s < above:
                break
            near = links[n]
            near = near[seen[near] != turn]
            if not len(near):
                continue
            seen[near] = turn
            for t, m in zip((x[near] @ q).tolist(), near.tolist(), strict=True):
                if len(best) < beam or t > best[0][0] or t >= above:
                    heapq.heappush(todo, (-t, m))
                    heapq.heappush(best, (t, m))
                    if len(best) > beam:
                        out = heapq.heappop(best)
                        if out[0] >= above:
                            sure.append(out)
        found = sorted(best + sure, reverse=True)
        return np.array([f[0] for f in found]), np.array([f[1] for f in found], dtype=np.int64)

    def linked(self, q: np.ndarray, own: int | None, beam: int, threshold: float) -> np.ndarray:
        """Nodes found at ``threshold`` or more; everything above it (less a margin) is walked through. Without a beam
        every vector is compared."""
        if not beam:
            return np.flatnonzero(self.x @ q >= threshold)
        at = self.entry
        for layer in range(len(self.layers) - 1, 0, -1):
            at = self._descend(q, at, layer)
        sims, nodes = self.search(q, [at] if own is None else [at, own], beam, 0, threshold - MARGIN)
        found = nodes[sims >= threshold]
        return found if own is None or own in found else np.append(found, own)  # a unit vector's own product may round below 1

    def audited_beam(self, threshold: float, beam: int = BEAM, sample: int = AUDIT, recall: float = RECALL) -> tuple[int, float]:
        """A beam at which a sample's links, searched from the top alone, are found; with the recall measured.

        Where a beam as wide as the shard falls short, the graph has parts that cannot be reached: 0, no beam, and
        the shard is compared whole.
        """
        chosen = np.unique(np.linspace(0, len(self.x) - 1, min(sample, len(self.x))).astype(int))
        truth = [np.flatnonzero(self.x @ self.x[i] >= threshold) for i in chosen]
        total = sum(map(len, truth))
        while True:
            hit = sum(len(np.intersect1d(t, self.linked(self.x[i], None, beam, threshold))) for i, t in zip(chosen, truth, strict=True))
            if hit >= recall * total:
                return beam, hit / max(1, total)
            if beam >= len(self.x):
                return 0, 1.0
            beam *= 2

    def packed(self) -> tuple[bytes, bytes, bytes]:
        """The layers as flat arrays: layer, node, number of neighbours; then the neighbours."""
        head = [(k, n, len(v)) for k, layer in enumerate(self.layers) for n, v in layer.items()]
        tail = [v for layer in self.layers for v in layer.values()]
        return self.x.tobytes(), np.array(head, dtype=np.int32).tobytes(), np.concatenate([*tail, np.zeros(0, dtype=np.int64)]).astype(np.int32).tobytes()

    @staticmethod
    def unpacked(x: bytes, head: bytes, tail: bytes, entry: int, dim: int) -> Graph:
        rows = np.frombuffer(head, dtype=np.int32).reshape(-1, 3)
        ends = np.cumsum(rows[:, 2])
        near = np.frombuffer(tail, dtype=np.int32).astype(np.int64)
        layers: list[dict[int, np.ndarray]] = [{} for _ in range(int(rows[:, 0].max()) + 1)]
        for (k, n, size), end in zip(rows.tolist(), ends.tolist(), strict=True):
            layers[k][n] = near[end - size : end]
        return Graph(np.frombuffer(x).reshape(-1, dim), layers, entry)


def _distinct(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows with the node of their vector, and the nodes: ``(label, dim, node, v, weight)``; a node is its smallest id."""
    wide = F.col(vector_col).cast("array<double>")
    usable = (
        F.col(label_col).isNotNull()
        & F.col(id_col).isNotNull()
        & (F.size(wide) > 0)
        & F.forall(wide, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
        & F.exists(wide, lambda x: x != 0)
    )
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.when(usable, wide).alias("v"))
    nodes = (
        rows.where("v IS NOT NULL").groupBy("label", "v").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("weight"))
    ).withColumn("dim", F.size("v"))
    return rows, written(nodes, "vectors")


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    shard: int = SHARD,
    block: int = BLOCK,
) -> DataFrame:
    """Per row ``(id, n_links, component)``: how many other rows it is linked with, and the smallest id reachable.

    Rows whose vector, label or id is null, or whose vector is empty, zero or has a null or non-finite
    component, link with nothing and are their own component. Only vectors of one length are compared.
    Repeated rows count as vectors of their own. Ids are BIGINT; other columns may have any name; an empty table gives
    no rows.
    """
    rows, nodes = _distinct(vectors, id_col, vector_col, label_col)
    kind = dict(rows.dtypes)["label"]
    sizes = nodes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("shards"))
    spread = F.pmod(F.xxhash64("node"), F.col("shards")).cast("int")
    # independent of the shard's number, so that a block has vectors of all shards
    blocks = F.ceil(F.lit(shard / block) * F.col("shards")).cast("int")
    dealt = nodes.join(sizes, ["label", "dim"]).select(
        "label", "dim", "node", "v", "weight", "shards", blocks.alias("blocks"), spread.alias("shard"),
        F.pmod(F.xxhash64(F.lit(3), "node"), blocks).cast("int").alias("block"),
    )

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        graph = Graph.built(_unit(group["v"].tolist()))
        beam, recall = graph.audited_beam(threshold)
        x, head, tail = graph.packed()
        return pd.DataFrame(
            {
                "label": group["label"].iloc[:1].tolist(), "dim": group["dim"].iloc[:1].tolist(), "shard": group["shard"].iloc[:1].tolist(),
                "nodes": [group["node"].to_numpy(dtype="<i8").tobytes()], "weights": [group["weight"].to_numpy(dtype="<i8").tobytes()],
                "x": [x], "head": [head], "tail": [tail], "entry": [graph.entry], "beam": [beam], "recall": [recall],
                "blocks": group["blocks"].iloc[:1].tolist(),
            }
        )

    graph_kinds = (
        f"label {kind}, dim int, shard int, nodes binary, weights binary, x binary, head binary, tail binary, entry int, "
        "beam int, recall double, blocks int"
    )
    graphs = written(dealt.groupBy("label", "dim", "shard").applyInPandas(build, graph_kinds), "graphs")

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        return pd.DataFrame(
            {
                "label": group["label"].iloc[:1].tolist(), "dim": group["dim"].iloc[:1].tolist(), "block": group["block"].iloc[:1].tolist(),
                "q_nodes": [group["node"].to_numpy(dtype="<i8").tobytes()], "q": [_unit(group["v"].tolist()).tobytes()],
                "shards": group["shards"].iloc[:1].tolist(),
            }
        )

    query_kinds = f"label {kind}, dim int, block int, q_nodes binary, q binary, shards int"
    queries = dealt.groupBy("label", "dim", "block").applyInPandas(gather, query_kinds)

    def search(asking: pd.DataFrame, graphs: pd.DataFrame) -> pd.DataFrame:
        out = []
        g = next(graphs.itertuples(index=False))
        graph = Graph.unpacked(g.x, g.head, g.tail, g.entry, g.dim)
        nodes, weights = np.frombuffer(g.nodes, dtype="<i8"), np.frombuffer(g.weights, dtype="<i8")
        for r in asking.itertuples(index=False):
            asked, q = np.frombuffer(r.q_nodes, dtype="<i8"), np.frombuffer(r.q).reshape(-1, r.dim)
            at = np.searchsorted(nodes, asked)
            root: dict[int, int] = {}

            def top(n: int, root: dict[int, int] = root) -> int:
                while root.setdefault(n, n) != n:
                    root[n] = n = root[root[n]]
                return n

            for i, (node, j) in enumerate(zip(asked.tolist(), at.tolist(), strict=True)):
                own = j if j < len(nodes) and nodes[j] == node else None
                found = graph.linked(q[i], own, g.beam, threshold)
                links = int(weights[found].sum()) - (own is not None)  # itself is one of its vector's rows
                if links:
                    out.append((node, links, None))
                for other in nodes[found].tolist():
                    a, b = top(node), top(other)
                    if a != b:
                        root[max(a, b)] = min(a, b)
                        out.append((node, 0, other))
        return pd.DataFrame(out, columns=["node", "links", "other"]).astype({"other": "Int64"})

    # a group is one graph and PART blocks of queries, however many shards and blocks its label has
    part = F.floor(F.col("block") / PART).cast("int")
    asking = queries.select("*", part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    last = F.floor((F.col("blocks") - 1) / PART).cast("int")
    asked = graphs.select("*", F.explode(F.sequence(F.lit(0), last)).alias("part"))
    keys = ["label", "dim", "shard", "part"]
    pairs = asking.groupBy(*keys).cogroup(asked.groupBy(*keys))
    found = written(pairs.applyInPandas(search, "node bigint, links bigint, other bigint"), "found")
    counts = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    classes = components(found.where("other IS NOT NULL"), "node", "other")
    known = nodes.select("label", "v", "node").join(counts, "node", "left").join(classes, "node", "left")
    return (
        rows.join(known, ["label", "v"], "left")
        .select("id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), F.coalesce("root", "node", "id").alias("component"))
    )
