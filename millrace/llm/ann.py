"""Approximate nearest neighbours: an NN-descent graph built by iterative joins, searched greedily.

1. Equal vectors collapse to one node, whose name is the smallest vec_id; a node keeps its eleven smallest ids, which is
   all that a list of ten neighbours can show.
2. Nodes are dealt to parts of about ``PART`` that lie near each other, by the hyperplanes of a random-projection tree.
   A node's code is its part and its place there. All that follows passes messages between parts, each with the
   arrays of many nodes, so a vector that many nodes of a part want travels to it once.
3. A few random-projection trees, with thresholds from a bounded sample, deal every node to small blocks; the exact
   neighbours inside the blocks start the graph.
4. NN-descent: a node's members are its neighbours and a sample of the nodes that list it. Members of one node are
   neighbours of a neighbour; every pair with a member new since the last round is compared there, and the distance goes
   back to both where it improves their lists. Rounds go on until one changes less than ``SETTLED`` of all entries.
5. Queries walk the graph: a query visits the unvisited of its ``beam`` nearest candidates, and with them those of twice as
   many, until the beam has none left; then it doubles, until that no longer changes the nearest ten. So the effort is each
   query's own, with no limit on it.
6. The best candidates are scored again on the original vectors, by differences of components.

Vectors keep the precision they come in, and distances are computed in double precision. A node that very many list is
sampled by the sender first; parts that very many queries ask are copied, so none is one task's work.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.grouped import by_group, flushed
from millrace.llm.storage import Stash

NEIGHBOURS = 10
#: Graph degree, trees, nodes of a block and of a part.
DEGREE, TREES, BLOCK, PART = 24, 8, 320, 2048
#: Vectors that set the trees' thresholds, and how many of them a threshold rests on at least: deeper ones use those of
#: the last level that has so many.
SAMPLE, LEAST_SAMPLE = 20_000, 8
#: Share of changed entries below which descent ends.
SETTLED = 0.05
#: Candidates that a query's first walk settles.
FIRST_BEAM = 128
#: Least number of candidates scored on original vectors; all whose squared distance is within rounding of the eleventh
#: are scored too.
RESCORED, ROUNDING = 48, 1e-6
#: Questions to a part that one task answers.
ASKED = 20_000
#: Bits of a code that hold the place in a part, and as many for the split of a zone.
PLACE = 20
BATCH = "4m"

STATE = "part long, n int, vecs binary, ids binary, dist binary, fresh binary, changed long"
NEWS = "part long, a binary, b binary, d binary"


def matrix(raw: bytes, dim: int, n: int) -> np.ndarray:
    """n packed vectors, of four or eight bytes a component."""
    return np.frombuffer(raw, dtype=f"f{len(raw) // (n * dim)}" if n else "f8").reshape(n, dim)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared, between all rows; about one of them, as near copies differ in the last digits of their lengths."""
    if len(y):
        x, y = x - y[:1], y - y[:1]
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * x @ y.T, 0)


def ints(raw: bytes | None) -> np.ndarray:
    return np.frombuffer(raw or b"", dtype=np.int64)


def floats(raw: bytes | None) -> np.ndarray:
    return np.frombuffer(raw or b"", dtype=np.float64)


def flags(raw: bytes | None) -> np.ndarray:
    return np.frombuffer(raw or b"", dtype=bool)


def gathered(column: pd.Series, read: Callable[[bytes], np.ndarray]) -> np.ndarray:
    return read(b"".join(x for x in column if x is not None))


def by_part(codes: np.ndarray, *others: np.ndarray) -> Iterator[tuple]:
    """(part, codes, others...) as bytes, for each part that has a code."""
    order = np.argsort(codes >> PLACE, kind="stable")
    codes, others = codes[order], [x[order] for x in others]
    parts, first = np.unique(codes >> PLACE, return_index=True)
    for part, a, b in zip(parts.tolist(), first, [*first[1:], len(codes)]):
        yield (part, codes[a:b].tobytes(), *(x[a:b].tobytes() for x in others))


def nearest_first(v: np.ndarray, w: np.ndarray, d: np.ndarray, k: int) -> np.ndarray:
    """Places of each v's k nearest distinct w, nearest first; ties to the smaller, of equal pairs the first given."""
    order = np.lexsort((np.arange(len(v)), w, v))
    same = np.zeros(len(v), dtype=bool)
    same[1:] = (v[order[1:]] == v[order[:-1]]) & (w[order[1:]] == w[order[:-1]])
    order = order[~same]
    order = order[np.lexsort((w[order], d[order], v[order]))]
    _, first, number = np.unique(v[order], return_index=True, return_counts=True)
    return order[np.arange(len(order)) - np.repeat(first, number) < k]


def usable(embedding: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(embedding.isNotNull() & fine & F.exists(embedding, lambda x: x != 0), F.lit(False))


def clean(vectors: DataFrame, stash: Stash) -> tuple[DataFrame, int]:
    """Distinct usable vectors as (v, e: double array, copies: up to eleven smallest ids), and their length."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("e")).where(F.col("vec_id").isNotNull() & usable(F.col("e")))
    sizes = rows.groupBy(F.size("e").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
    if not sizes:
        return stash.keep(rows.select(F.col("vec_id").alias("v"), "e", F.array("vec_id").alias("copies")), "nodes"), 0
    dim = sizes[0]["dim"]
    first = rows.where(F.size("e") == dim).withColumn("r", F.row_number().over(Window.partitionBy("e").orderBy("vec_id"))).where(F.col("r") <= NEIGHBOURS + 1)
    nodes = first.groupBy("e").agg(F.array_sort(F.collect_list("vec_id")).alias("copies")).select(F.col("copies")[0].alias("v"), "e", "copies")
    return stash.keep(nodes, "nodes"), dim


class Trees(NamedTuple):
    """For each tree a random direction for each level, and the thresholds of the level's nodes, down to the level that
    the sample supports; below it, those of the last such node's sample."""

    depth: int
    fitted: int
    directions: np.ndarray
    cuts: list[list[np.ndarray]]

    @classmethod
    def fit(cls, x: np.ndarray, total: int, dim: int) -> Trees:
        depth = max(0, int(np.ceil(np.log2(max(1, total) / BLOCK))))
        fitted = min(depth, max(0, int(np.log2(max(1, len(x)) / LEAST_SAMPLE))))
        rng, cuts = np.random.default_rng(20_240_503), []
        directions = rng.normal(size=(TREES, depth, dim))
        for t in range(TREES):
            node, own = np.zeros(len(x), dtype=np.int64), []
            for level in range(depth):
                p = x @ directions[t, level]
                order = np.lexsort((p, node))
                keys, first, number = np.unique(node[order], return_index=True, return_counts=True)
                cut = np.zeros(1 << min(level, fitted))
                cut[keys] = p[order][first + number // 2]
                own.append(cut)
                if level < fitted:
                    node = node * 2 + (p > cut[node])
            cuts.append(own)
        return cls(depth, fitted, directions, cuts)

    def leaf(self, tree: int, x: np.ndarray, depth: int | None = None) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64)
        for level in range(self.depth if depth is None else depth):
            known = node >> max(0, level - self.fitted)
            node = node * 2 + (x @ self.directions[tree, level] > self.cuts[tree][level][known])
        return node


def sampled_trees(nodes: DataFrame, total: int, dim: int) -> Trees:
    share = F.pmod(F.xxhash64("v", F.lit(3)), F.lit(1_000_003)) / 1_000_003.0
    rows = nodes.where(share < SAMPLE / max(1, total)).select("e").collect()  # about SAMPLE short rows
    return Trees.fit(np.array([r["e"] for r in rows], dtype=np.float64).reshape(-1, dim), total, dim)


def dealt_to_parts(nodes: DataFrame, total: int, dim: int, kind: str, trees: Trees, stash: Stash) -> DataFrame:
    """(part, n, vecs, names): the vectors of each part, and their v."""
    shipped, depth = nodes.sparkSession.sparkContext.broadcast(trees), max(0, int(np.ceil(np.log2(max(1, total) / PART))))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array(batch["e"].tolist(), dtype=kind).reshape(-1, dim)
            yield pd.DataFrame({"zone": shipped.value.leaf(0, x.astype(np.float64), depth), "v": batch["v"], "vec": [r.tobytes() for r in x]})

    zoned = stash.keep(nodes.select("v", "e").mapInPandas(route, "zone long, v long, vec binary"), "zones")
    splits = zoned.groupBy("zone").agg(F.ceil(F.count("*") / PART).alias("splits"))
    dealt = zoned.join(splits, "zone").select("zone", F.pmod(F.xxhash64("v"), "splits").alias("split"), "v", "vec")

    def block(group: pd.DataFrame) -> list[tuple]:
        part = (int(group["zone"].iloc[0]) << PLACE) | int(group["split"].iloc[0])
        return [(part, len(group), b"".join(group["vec"]), group["v"].to_numpy(dtype=np.int64).tobytes())]

    out = stash.keep(by_group(dealt, ["zone", "split"], block, "part long, n int, vecs binary, names binary", order=["v"]), "parts", BATCH)
    stash.drop(zoned)
    return out


def names_of(parts: DataFrame) -> DataFrame:
    """(code, v) of every node."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, names in zip(batch["part"], batch["names"]):
                v = ints(names)
                yield pd.DataFrame({"code": (int(part) << PLACE) + np.arange(len(v)), "v": v})

    return parts.select("part", "names").mapInPandas(each, "code long, v long")


def first_graph(parts: DataFrame, dim: int, trees: Trees, stash: Stash) -> DataFrame:
    """News of the exact neighbours within each tree's blocks."""
    shipped = parts.sparkSession.sparkContext.broadcast(trees)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for part, n, vecs in zip(batch["part"], batch["n"], batch["vecs"]):
                    x = matrix(vecs, dim, n)
                    wide = x.astype(np.float64)
                    for tree in range(TREES):
                        leaf = shipped.value.leaf(tree, wide)
                        order = np.argsort(leaf, kind="stable")
                        leaves, first = np.unique(leaf[order], return_index=True)
                        for at, members in zip(leaves.tolist(), np.split(order, first[1:])):
                            yield tree, at, int(part), len(members), ((int(part) << PLACE) + members).tobytes(), x[members].tobytes()

        yield from flushed(rows(), ["tree", "leaf", "part", "n", "codes", "vecs"])

    dealt = stash.keep(parts.mapInPandas(route, "tree int, leaf long, part long, n int, codes binary, vecs binary"), "leaves", BATCH)
    sizes = dealt.groupBy("tree", "leaf").agg(F.ceil(F.sum("n") / (2 * BLOCK)).alias("blocks"))
    dealt = dealt.join(sizes, ["tree", "leaf"]).withColumn("block", F.pmod(F.xxhash64("part"), F.col("blocks")))

    def nearest(group: pd.DataFrame) -> Iterator[tuple]:
        codes = gathered(group["codes"], ints)
        x = matrix(b"".join(group["vecs"]), dim, len(codes)).astype(np.float64)
        # leaves that are still too large are cut along one more direction
        along = np.argsort(x @ np.random.default_rng(int(codes[0]) & 0xFFFF).normal(size=dim), kind="stable")
        found = []
        for at in np.array_split(along, -(-len(codes) // (3 * BLOCK // 2))):
            d = distances(x[at], x[at])
            np.fill_diagonal(d, np.inf)
            k = min(DEGREE, len(at) - 1)
            if k > 0:
                near = np.argpartition(d, k - 1, axis=1)[:, :k]
                found.append((np.repeat(codes[at], k), codes[at][near].ravel(), np.take_along_axis(d, near, 1).ravel()))
        if found:
            yield from by_part(*(np.concatenate(x) for x in zip(*found)))

    return by_group(dealt.select("tree", "leaf", "block", "codes", "vecs"), ["tree", "leaf", "block"], nearest, NEWS)


def merged(state: DataFrame, news: DataFrame) -> DataFrame:
    """State with each node's neighbours improved by the news; fresh marks what was not there before."""
    rows = state.drop("changed").unionByName(news, allowMissingColumns=True)

    def merge(group: pd.DataFrame) -> list[tuple]:
        old = group[group["n"].notna()].iloc[0]
        n, part = int(old["n"]), int(old["part"])
        a, b, d = gathered(group["a"], ints), gathered(group["b"], ints), gathered(group["d"], floats)
        ids, dist = (ints(old["ids"]), floats(old["dist"])) if old["ids"] is not None else (np.full(n * DEGREE, -1), np.full(n * DEGREE, np.inf))
        held = np.flatnonzero(ids >= 0)
        v, w = np.concatenate([held // DEGREE, a & ((1 << PLACE) - 1)]), np.concatenate([ids[held], b])
        s, new = np.concatenate([dist[held], d]), np.arange(len(held) + len(a)) >= len(held)
        keep = nearest_first(v, w, s, DEGREE)
        _, first, number = np.unique(v[keep], return_index=True, return_counts=True)
        at = v[keep] * DEGREE + np.arange(len(keep)) - np.repeat(first, number)
        ids, dist, fresh = np.full(n * DEGREE, -1), np.full(n * DEGREE, np.inf), np.zeros(n * DEGREE, dtype=bool)
        ids[at], dist[at], fresh[at] = w[keep], s[keep], new[keep]
        return [(part, n, old["vecs"], ids.tobytes(), dist.tobytes(), fresh.tobytes(), int(fresh.sum()))]

    return by_group(rows, ["part"], merge, STATE)


def member_lists(state: DataFrame, *more: str) -> DataFrame:
    """(part, n, members, fresh, and more binary columns of the state): for each node its neighbours and up to as many of
    those that list it, fresh ones first; -1 where there is none."""

    def tell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for part, n, ids, fresh in zip(batch["part"], batch["n"], batch["ids"], batch["fresh"]):
                    to, new = ints(ids), flags(fresh)
                    held = np.flatnonzero(to >= 0)
                    if len(held):
                        keep = _chosen(to[held], (int(part) << PLACE) + held // DEGREE, new[held])
                        yield from by_part(to[held][keep], ((int(part) << PLACE) + held // DEGREE)[keep], new[held][keep])

        yield from flushed(rows(), ["part", "a", "b", "d"])

    rows = state.select("part", "n", "ids", "fresh", *more).unionByName(state.select("part", "n", "ids", "fresh").mapInPandas(tell, NEWS), allowMissingColumns=True)

    def collect(group: pd.DataFrame) -> list[tuple]:
        own = group[group["n"].notna()].iloc[0]
        n = int(own["n"])
        members, fresh = np.full((n, 2 * DEGREE), -1), np.zeros((n, 2 * DEGREE), dtype=bool)
        members[:, :DEGREE], fresh[:, :DEGREE] = ints(own["ids"]).reshape(n, DEGREE), flags(own["fresh"]).reshape(n, DEGREE)
        to, who, new = gathered(group["a"], ints), gathered(group["b"], ints), gathered(group["d"], flags)
        if len(to):
            other = ~(members[to & ((1 << PLACE) - 1), :DEGREE] == who[:, None]).any(1)
            to, who, new = to[other], who[other], new[other]
            keep = _chosen(to, who, new)
            at = to[keep] & ((1 << PLACE) - 1)
            _, first, number = np.unique(at, return_index=True, return_counts=True)
            place = DEGREE + np.arange(len(at)) - np.repeat(first, number)
            members[at, place], fresh[at, place] = who[keep], new[keep]
        return [(int(own["part"]), n, members.tobytes(), fresh.tobytes(), *(own[x] for x in more))]

    return by_group(rows, ["part"], collect, ", ".join(["part long, n int, members binary, fresh binary", *(f"{x} binary" for x in more)]))


def _chosen(to: np.ndarray, who: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Places of DEGREE at most for each ``to``, by a hash, fresh ones first; in order of ``to``."""
    mixed = (who * np.int64(-7046029254386353131)) ^ (to * np.int64(-4417276706812531889))
    order = np.lexsort((mixed, ~new, to))
    _, first, number = np.unique(to[order], return_index=True, return_counts=True)
    return order[np.arange(len(order)) - np.repeat(first, number) < DEGREE]


def asked(static: DataFrame, questions: DataFrame, reply: Callable[[tuple, tuple], Iterator[tuple]], schema: str, most: int = 0) -> DataFrame:
    """What reply(static row, question) gives for the questions to each part; ``most`` bounds a part's questions.

    Questions come one after another to the one static row of their part. If a part may get more than ASKED of them,
    they are counted, and its row is copied for each so many.
    """
    names = [x.split()[0] for x in schema.split(", ")]
    if most > ASKED:
        copies = questions.groupBy("part").agg(F.ceil(F.count("*") / ASKED).alias("copies"))
        questions = questions.join(copies, "part").withColumn("salt", F.pmod(F.xxhash64("home", "q"), F.col("copies"))).drop("copies")
        static = static.join(copies, "part").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).drop("copies")
    else:
        questions, static = questions.withColumn("salt", F.lit(0).cast("long")), static.withColumn("salt", F.lit(0).cast("long"))
    rows = static.withColumn("turn", F.lit(0)).unionByName(questions.withColumn("turn", F.lit(1)), allowMissingColumns=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            held = None
            for batch in batches:
                for row in batch.itertuples(index=False):
                    if row.turn == 0:
                        held = row
                    else:
                        yield from reply(held, row)

        yield from flushed(rows(), names)

    return rows.repartition("part", "salt").sortWithinPartitions("part", "salt", "turn").mapInPandas(run, schema)


def descended(state: DataFrame, dim: int, stash: Stash) -> tuple[DataFrame, DataFrame]:
    """News of one round of NN-descent, and the member lists that it compared."""
    lists = stash.keep(member_lists(state), "members", BATCH)

    def wants(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for part, n, members, fresh in zip(batch["part"], batch["n"], batch["members"], batch["fresh"]):
                    m = ints(members).reshape(n, -1)[flags(fresh).reshape(n, -1).any(1)]
                    m = np.unique(m[m >= 0])
                    for to, codes in by_part(m):
                        yield to, int(part), codes

        yield from flushed(rows(), ["part", "home", "codes"])

    def vectors(own, question) -> Iterator[tuple]:
        at = ints(question.codes) & ((1 << PLACE) - 1)
        n = int(own.n)
        yield int(question.home), question.codes, matrix(own.vecs, dim, n)[at].tobytes(), floats(own.dist).reshape(n, DEGREE)[at, -1].tobytes()

    answers = asked(state.select("part", "n", "vecs", "dist"), lists.mapInPandas(wants, "part long, home long, codes binary"), vectors, "part long, codes binary, vecs binary, radius binary")

    def meet(group: pd.DataFrame) -> Iterator[tuple]:
        own = group[group["n"].notna()].iloc[0]
        n = int(own["n"])
        codes, radius = gathered(group["codes"], ints), gathered(group["radius"], floats)
        if not len(codes):
            return
        x, order = matrix(b"".join(v for v in group["vecs"] if v is not None), dim, len(codes)), np.argsort(codes)
        sorted_codes = codes[order]
        members, fresh = ints(own["members"]).reshape(n, -1), flags(own["fresh"]).reshape(n, -1)
        active = fresh.any(1)
        members, fresh, found, size = members[active], fresh[active], [], 0
        for i in range(0, len(members), 64):
            m, f = members[i : i + 64], fresh[i : i + 64]
            at = order[np.minimum(np.searchsorted(sorted_codes, m), len(codes) - 1)]
            near = x[at].astype(np.float64)
            near -= near[:, :1]  # about the nearest neighbour: near copies differ in the last digits of their lengths
            s = (near * near).sum(2)
            d = np.maximum(s[:, :, None] + s[:, None, :] - 2 * np.matmul(near, near.transpose(0, 2, 1)), 0)
            there = m >= 0
            good = (f[:, :, None] | f[:, None, :]) & there[:, :, None] & there[:, None, :] & (m[:, :, None] != m[:, None, :]) & (d < radius[at][:, :, None])
            u, a, b = np.nonzero(good)
            found.append((m[u, a], m[u, b], d[u, a, b]))
            size += len(u)
            if size > 400_000:
                found, size = [_best(found)], 0
        if found:
            yield from by_part(*_best(found))

    rows = lists.unionByName(answers, allowMissingColumns=True)
    return by_group(rows, ["part"], meet, NEWS), lists


def _best(found: list[tuple]) -> tuple[np.ndarray, ...]:
    """Each node's best improvements."""
    v, w, d = (np.concatenate(x) for x in zip(*found))
    keep = nearest_first(v, w, d, DEGREE)
    return v[keep], w[keep], d[keep]


def build_graph(parts: DataFrame, total: int, dim: int, trees: Trees, stash: Stash, settled: float = SETTLED) -> DataFrame:
    none = {"ids": F.lit(None).cast("binary"), "dist": F.lit(None).cast("binary"), "fresh": F.lit(None).cast("binary"), "changed": F.lit(0).cast("long")}
    state = stash.keep(merged(parts.drop("names").withColumns(none), first_graph(parts, dim, trees, stash)), "graph", BATCH)
    while trees.depth:  # a table of one block has its exact graph already
        news, lists = descended(state, dim, stash)
        old, state = state, stash.keep(merged(state, news), "graph", BATCH)
        stash.drop(old)
        stash.drop(lists)
        if state.agg(F.sum("changed")).head()[0] <= settled * total * DEGREE:
            break
    return state


WALK = "home long, q long, qvec binary, ids binary, dist binary, seen binary, lists binary, todo binary, reach double, beam int, best binary"


def next_visits(ids: np.ndarray, seen: np.ndarray, beam: int, best: bytes) -> tuple[np.ndarray, int, bytes]:
    """What to visit next, with the beam and the nearest that it began with; nothing if a doubled beam changed nothing.

    The beam that would come next is visited along with an unsettled one, which saves rounds of messages.
    """
    while True:
        now, none = ids[: NEIGHBOURS + 1].tobytes(), seen[:beam].all()
        if not none:
            return ids[: 2 * beam][~seen[: 2 * beam]], beam, best
        if beam >= len(ids) or now == best:
            return ids[:0], beam, best
        beam, best = 2 * beam, now


def next_questions(ids: np.ndarray, seen: np.ndarray, lists: np.ndarray, beam: int, best: bytes) -> tuple[np.ndarray, bool, np.ndarray, int, bytes]:
    """What to ask for, and whether some of it was met before but without its list; then seen, beam and best of ``next_visits``.

    lists has a row for each node whose members are known: its code, then theirs. A node of those to visit is visited if
    its list is here, else asked for. Visits go on while they meet nothing new.
    """
    while True:
        todo, beam, best = next_visits(ids, seen, beam, best)
        here = np.isin(todo, lists[:, 0])
        seen = seen | np.isin(ids, todo[here])
        members = lists[np.isin(lists[:, 0], todo[here]), 1:]
        wanted = np.concatenate([np.setdiff1d(members[members >= 0], ids), todo[~here]])
        if len(wanted) or not len(todo):
            return wanted, not here.all(), seen, beam, best


def search(state: DataFrame, queries: DataFrame, dim: int, stash: Stash, first_beam: int = FIRST_BEAM) -> DataFrame:
    """(q, c, visited): candidates for each query code (q), from a greedy walk that starts at its own node.

    A round asks parts for the distances of nodes, and settles the answers at the query. A node that may come to be visited
    (it is among the four beams nearest) answers with its member list too, so that a visit needs no question of its own.
    """
    static = stash.keep(member_lists(state, "vecs").select("part", "n", "vecs", "members"), "adjacency", BATCH)
    places = queries.select(F.shiftright("code", PLACE).alias("part"), F.col("code").alias("q"))

    def begin(own, question) -> Iterator[tuple]:
        n, at = int(own.n), int(question.q) & ((1 << PLACE) - 1)
        ids, dist = ints(own.ids).reshape(n, DEGREE)[at], floats(own.dist).reshape(n, DEGREE)[at]
        ids, dist = np.concatenate([[question.q], ids[ids >= 0]]).astype(np.int64), np.concatenate([[0.0], dist[ids >= 0]])
        todo = ids[:first_beam]
        yield int(own.part), int(question.q), matrix(own.vecs, dim, n)[at].tobytes(), ids.tobytes(), dist.tobytes(), np.zeros(len(ids), dtype=bool).tobytes(), b"", todo.tobytes(), np.inf, first_beam, b""

    walk = stash.keep(asked(state.select("part", "n", "vecs", "ids", "dist"), places.withColumn("home", F.lit(0).cast("long")), begin, WALK, most=PART), "walk", BATCH)

    def to_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for row in batch.itertuples(index=False):
                    for part, codes in by_part(ints(row.todo)):
                        yield part, codes, row.home, row.q, row.qvec, row.reach

        yield from flushed(rows(), ["part", "codes", "home", "q", "qvec", "reach"])

    def compare(own, question) -> Iterator[tuple]:
        n, codes = int(own.n), ints(question.codes)
        at = codes & ((1 << PLACE) - 1)
        gap = matrix(own.vecs, dim, n)[at].astype(np.float64) - matrix(question.qvec, dim, 1).astype(np.float64)
        far = (gap * gap).sum(1)
        near = far <= question.reach
        lists = np.column_stack([codes[near], ints(own.members).reshape(n, -1)[at[near]]])
        yield int(question.home), int(question.q), question.codes, far.tobytes(), lists.tobytes()

    def settle(group: pd.DataFrame) -> list[tuple]:
        own = group[group["qvec"].notna()].iloc[0]
        found, ids = gathered(group["found"], ints), ints(own["ids"])
        other = ~np.isin(ids, found)  # a node asked for its list comes with its distance again
        ids, dist = np.concatenate([ids[other], found]), np.concatenate([floats(own["dist"])[other], gathered(group["far"], floats)])
        seen = np.concatenate([flags(own["seen"])[other], np.zeros(len(found), dtype=bool)])
        order = np.lexsort((ids, dist))
        ids, dist, seen = ids[order], dist[order], seen[order]
        lists = gathered(group["lists"], ints).reshape(-1, 1 + 2 * DEGREE)
        todo, again, seen, beam, best = next_questions(ids, seen, lists, int(own["beam"]), own["best"])
        most = 4 * beam
        reach = np.inf if again or len(ids) <= most else dist[most]
        lists = lists[np.isin(lists[:, 0], ids[:most][~seen[:most]])] if len(todo) else lists[:0]
        return [(int(own["home"]), int(own["q"]), own["qvec"], ids.tobytes(), dist.tobytes(), seen.tobytes(), lists.tobytes(), todo.tobytes(), reach, beam, best)]

    def pool(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for q, raw, dist, seen in zip(batch["q"], batch["ids"], batch["dist"], batch["seen"]):
                ids, d = ints(raw), floats(dist)
                ids = ids[: max(RESCORED, within(d))]
                yield pd.DataFrame({"q": q, "c": ids, "visited": int(flags(seen).sum())})

    schema, open_walk = "q long, c long, visited long", F.octet_length("todo") > 0
    done = []
    while True:
        active, over = walk.agg(F.count(F.when(open_walk, 1)), F.count(F.when(~open_walk, 1))).head()
        if over or not active:
            done.append(stash.keep(walk.where(~open_walk).select("q", "ids", "dist", "seen").mapInPandas(pool, schema), "pool"))
        if not active:
            return functools.reduce(DataFrame.unionByName, done)
        going = walk.where(open_walk)
        questions = going.select("todo", "home", "q", "qvec", "reach").mapInPandas(to_parts, "part long, codes binary, home long, q long, qvec binary, reach double")
        answers = asked(static, questions, compare, "home long, q long, found binary, far binary, lists binary", most=active)
        old, walk = walk, stash.keep(by_group(going.unionByName(answers, allowMissingColumns=True), ["home", "q"], settle, WALK), "walk", BATCH)
        stash.drop(old)


def within(dist: np.ndarray) -> int:
    """How many of the ascending squared distances, the query's own among them, can't be told from the eleventh, or are less."""
    return int(np.searchsorted(dist, dist[NEIGHBOURS + 1] * (1 + ROUNDING), "right")) if len(dist) > NEIGHBOURS + 1 else len(dist)


def nearest(vectors: DataFrame, is_query: Column, k: int = NEIGHBOURS) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k nearest other rows that the search finds, and visited, the nodes it
    visited for that.

    vectors has vec_id and embedding (array of float or double). Vectors that are null, zero, or hold null or
    non-finite components take no part, nor do rows with a null vec_id or another length than the commonest. Ties go
    to the smaller vec_id. Fewer candidates than k are all returned; an empty table gives an empty result. k is at
    most ten. is_query is a condition on vec_id. Repeated vec_ids are separate rows to the index but name one id.
    """
    if not 1 <= k <= NEIGHBOURS:
        raise ValueError(f"k must be from 1 to {NEIGHBOURS}")
    stash = Stash(vectors.sparkSession, "ann")
    nodes, dim = clean(vectors, stash)
    asking = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("e")).where(is_query & F.col("vec_id").isNotNull() & usable(F.col("e")))
    kind = "f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "f8"
    total = nodes.count()
    trees = sampled_trees(nodes, total, dim) if total else Trees(0, 0, np.zeros((TREES, 0, 1)), [[]] * TREES)
    parts = dealt_to_parts(nodes, total, max(1, dim), kind, trees, stash)
    coded = stash.keep(nodes.join(names_of(parts), "v").select("code", "e", "copies"), "coded")
    asking = stash.keep(asking.join(coded.select("e", "code"), "e").select("vec_id", "code").distinct(), "queries")
    state = build_graph(parts, total, max(1, dim), trees, stash)
    pairs = search(state, asking.select("code").distinct(), max(1, dim), stash)
    side = lambda c, e: coded.select(F.col("code").alias(c), F.col("e").alias(e))
    squared = F.aggregate(F.zip_with("qe", "ce", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    scored = pairs.join(side("q", "qe"), "q").join(coded.select(F.col("code").alias("c"), F.col("e").alias("ce"), "copies"), "c").select("q", "visited", F.sqrt(squared).alias("score"), F.explode("copies").alias("vec_id"))
    near = Window.partitionBy("q").orderBy("score", "vec_id")
    # one more than k, as a query that is itself among them steps aside
    scored = stash.keep(scored.withColumn("r", F.row_number().over(near)).where(F.col("r") <= k + 1).drop("r"), "scored")
    hits = asking.select(F.col("vec_id").alias("query_id"), F.col("code").alias("q")).join(scored, "q").where("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    out = stash.keep(hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "visited"), "found")
    stash.drop_others(out)
    return out
