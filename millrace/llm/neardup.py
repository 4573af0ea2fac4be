"""MinHash near-duplicates: one-permutation hashing, optimal densification, banded buckets, star-shaped candidates.

Each document gets six one-permutation signatures of 64 bins. An empty bin takes the value of the first non-empty
bin in a fixed random order of its own. Band j joins bin j of the six signatures, so two documents of similarity
0.75 share a given band with a chance of 0.18 and none of the 64 with a chance of a few in a million; six separate
permutations keep that true for short texts, whose bins repeat few values.

Equal shingle sets are collapsed first. In each bucket every set is compared with the bucket's smallest id only.
Buckets whose members then lie in more than one component are taken up twice more, to compare members of different
components: first each with its two likeliest partners, by the share of the 384 signature values that agree, then
with all whose share is not nearly six standard deviations below that of a link. A pair is taken up in the first band it
shares. The last comparisons are made where the members meet, on full sets that travel with them, and only links that
join two components come out; pairs with a very long set go on to be confirmed one by one. So a bucket of copies costs
its size, and no pair of a bucket is left that is neither connected nor compared nor ruled out by its signature.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.grouped import by_group
from millrace.llm.shingles import U, from_bytes, mix, shingle_sets, to_bytes
from millrace.llm.storage import BATCH, Stash, give_back

SIMILARITY_PERCENT = 75
BANDS, ROWS = 64, 6
BIN_BITS = 6  # 64 bins, one for each band
#: Members that meet one copy of a centre's set in a task.
STAR = 64
#: Share of agreeing signature values below which a pair is not compared: a link's is 0.75 give or take 0.022, so one in a
#: billion is lost.
LIKELY = 0.62
#: Members of a bucket that meet in a task, and likeliest partners in the first of the two further rounds.
BLOCK, PARTNERS = 1024, 2
#: Shingles of the largest set that travels with its member in the last round, and sets that one is compared with at once.
CARRIED, AT_ONCE = 1024, 128
#: Rows of each class in the last join, so that the copies of one text are the work of as many tasks.
SALTS = 8


def _orders() -> np.ndarray:
    """For each permutation and bin, the order in which an empty bin looks at the others."""
    rng = np.random.default_rng(20_240_501)
    return np.stack([[rng.permutation(BANDS) for _ in range(BANDS)] for _ in range(ROWS)])


ORDERS = _orders()
SEEDS = mix(np.arange(1, ROWS + 1, dtype=U) * U(0x9E3779B97F4A7C15))
LOWEST = np.arange(BANDS, dtype=U) << U(64 - BIN_BITS)
BAND_SALT = mix(np.arange(101, 101 + BANDS, dtype=U))


def band_keys(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 64 bucket keys of a non-empty set, and a byte of each of its 6 x 64 signature values."""
    keys, sketch = BAND_SALT.copy(), np.empty((ROWS, BANDS), dtype=np.uint8)
    for row in range(ROWS):
        values = np.sort(mix(shingles ^ SEEDS[row]))
        at = np.searchsorted(values, LOWEST)
        found = values[np.minimum(at, len(values) - 1)]
        full = (at < len(values)) & ((found >> U(64 - BIN_BITS)) == np.arange(BANDS, dtype=U))
        if not full.all():
            bins = np.where(full, np.arange(BANDS), ORDERS[row][np.arange(BANDS), full[ORDERS[row]].argmax(axis=1)])
            found = found[bins]
        keys = mix(keys ^ found) + U(row)
        sketch[row] = found & U(0xFF)
    return keys, sketch


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, a 128-bit id of the shingle set (h1, h2), its band keys and sketch (null for an empty set)."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes, h1, h2, bands, sketches = [], [], [], [], []
            with np.errstate(over="ignore"):
                for s in shingle_sets(batch["text"].tolist()):
                    sizes.append(len(s))
                    h1.append(int(mix(s ^ U(0x5851F42D4C957F2D)).sum(dtype=U).astype(np.int64)))
                    h2.append(int(mix(s ^ U(0x14057B7EF767814F)).sum(dtype=U).astype(np.int64)))
                    keys, sketch = band_keys(s) if len(s) else (None, None)
                    bands.append(None if keys is None else keys.view(np.int64))
                    sketches.append(None if sketch is None else sketch.tobytes())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text_key": batch["text_key"], "n_shingles": sizes, "h1": h1, "h2": h2, "bands": bands, "sketch": sketches})
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    # ids travel as text: beside a null, pandas would hold whole numbers as floating ones
    named = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", text_key(F.col("text")).alias("text_key"))
    return named.mapInPandas(sign, f"doc_id string, text_key string, n_shingles long, h1 long, h2 long, bands array<long>, sketch binary").withColumn("doc_id", F.col("doc_id").cast(kind))


def text_key(text: Column) -> Column:
    """Tells apart texts of rows that share a doc_id."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def shingle_table(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and its set as bytes, for the documents in ids."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "set": [to_bytes(s) for s in shingle_sets(batch["text"].tolist())]})
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").join(ids.select("doc_id"), "doc_id", "left_semi").mapInPandas(cut, f"doc_id {kind}, set binary")


def _similar(n: str, m: str, percent: int):
    """Sizes that allow the similarity at all."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have that similarity. A centre with many partners is dealt to many tasks."""
    copies = pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR).alias("copies"))
    pairs = pairs.join(copies, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("copies")))
    members = pairs.select("a", "b", "part").join(sets.select(F.col("doc_id").alias("b"), F.col("set").alias("set_b")), "b")
    centres = copies.join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("set_a")), "a").select("a", "set_a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("part"))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["set_a"], batch["set_b"]):
                x, y = from_bytes(x), from_bytes(y)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.loc[np.array(keep, dtype=bool), ["a", "b"]]
        give_back()

    kind = pairs.schema["a"].dataType.simpleString()
    return members.join(centres, ["a", "part"]).select("a", "b", "set_a", "set_b").mapInPandas(check, f"a {kind}, b {kind}").distinct()


def components(edges: DataFrame, stash: Stash) -> DataFrame:
    """node and component (its smallest reachable node) for all nodes of the edges (a, b).

    Every node points to its smallest neighbour, edges are contracted along the pointers, and so on until none is
    left; each round at least halves what a component still holds.
    """
    left = stash.keep(edges.select("a", "b").where("a <> b"), "edges")
    labels = None
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = stash.keep(both.groupBy("a").agg(F.min("b").alias("to")).select(F.col("a").alias("node"), F.least("a", "to").alias("to")), "pointers")
        if labels is None:
            labels = point.withColumnRenamed("to", "component")
        else:
            step = point.select(F.col("node").alias("component"), "to")
            labels = labels.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        old, old_labels = left, labels
        to = lambda c: point.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to"))
        moved = left.join(to("a"), "a").join(to("b"), "b").select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b"))
        left = stash.keep(moved.where("a <> b").distinct(), "edges")
        labels = stash.keep(labels, "labels")
        stash.drop(old)
        stash.drop(old_labels)
    if labels is None:
        labels = left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels


def _tasks(entries: DataFrame) -> DataFrame:
    """Deals the members of open buckets to tasks (key, i, j) so that all pairs of different components meet.

    The members outside a bucket's largest component are few after the first round. They meet the largest
    component's blocks, each of which is in as many tasks as they have blocks, and each other. role: m and s meet,
    x and y meet, x alone meets itself.
    """
    sizes = entries.groupBy("key", "component").agg(F.count("*").alias("n"))
    plan = sizes.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("most"), F.max("n").alias("m"), (F.sum("n") - F.max("n")).alias("s"))
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    plan = plan.where("s > 0").select("key", "most", blocks("m").alias("bm"), blocks("s").alias("bs"))
    met = entries.join(plan, "key").withColumn("h", F.xxhash64("rep"))
    own = F.pmod(F.col("h"), F.col("bs")).cast("int")
    role = lambda i, j, r: F.struct(i.alias("i"), j.alias("j"), r.alias("role"))
    all_of = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    largest = F.transform(all_of("bs"), lambda j: role(F.pmod(F.col("h"), F.col("bm")).cast("int"), j, F.lit("m")))
    others = F.concat(
        F.transform(all_of("bm"), lambda i: role(i, own, F.lit("s"))),
        F.transform(all_of("bs"), lambda j: role(F.col("bm") + F.least(j, own), F.greatest(j, own), F.when(j >= own, F.lit("x")).otherwise(F.lit("y")))),
    )
    task = F.explode(F.when(F.col("component") == F.col("most"), largest).otherwise(others)).alias("t")
    columns = [c for c in entries.columns if c != "key"]
    return met.select("key", *columns, task).select("key", "t.i", "t.j", "t.role", *columns)


class Groups:
    """Which nodes have been linked so far: each points to another of its group, the last to itself."""

    def __init__(self, nodes: np.ndarray):
        self.to = {x: x for x in nodes.tolist()}

    def top(self, x):
        while self.to[x] != x:
            self.to[x] = x = self.to[self.to[x]]
        return x

    def join(self, x, y) -> bool:
        """False if they are in one group already."""
        x, y = self.top(x), self.top(y)
        self.to[max(x, y)] = min(x, y)
        return x != y


def similar_sets(one: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the sorted, non-empty sets have that similarity to one."""
    every = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, every), len(one) - 1)
    sizes = np.fromiter(map(len, others), dtype=np.int64, count=len(others))
    common = np.add.reduceat((one[at] == every).astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * common >= percent * (len(one) + sizes - common)


def _sides(group: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame, bool]:
    """The members of a task that meet, and whether they are one side that meets itself."""
    role = group["role"].to_numpy()
    first = group[(role == "s") | (role == "x")]
    second = group[(role == "m") | (role == "y")]
    alone = not len(second) and bool((role == "x").any())
    return first, first if alone else second, alone


def _likely(first: pd.DataFrame, second: pd.DataFrame, alone: bool, percent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each row of the first side, the rows of the second whose size, component and signature allow a link, and the
    shares of their signatures that agree."""
    (ra, na, ca, xa), (rb, nb, cb, xb) = ((f["rep"].to_numpy(), f["n"].to_numpy(), f["component"].to_numpy(), np.frombuffer(b"".join(f["sketch"]), dtype=np.uint8).reshape(-1, ROWS * BANDS)) for f in (first, second))
    for at in range(len(ra)):
        fits = (cb != ca[at]) & (100 * np.minimum(nb, na[at]) >= percent * np.maximum(nb, na[at]))
        fits = np.flatnonzero(fits & (rb > ra[at]) if alone else fits)
        if len(fits):
            share = (xb[fits] == xa[at]).mean(axis=1)
            good = share >= LIKELY
            if good.any():
                yield at, fits[good], share[good]


def likely_pairs(entries: DataFrame, percent: int, partners: int | None, signs: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of different components in the open buckets whose signatures allow a link, in the first band whose
    key they share; with partners, only the likeliest so many of each member. bands is read without partners only. sketch and bands
    are in entries, or by rep in signs: large columns join when the members have been dealt, and travel to their task only."""

    def pair(group: pd.DataFrame) -> Iterator[tuple]:
        first, second, alone = _sides(group)
        if not len(first) or not len(second):
            return
        ra, rb, band = first["rep"].to_numpy(), second["rep"].to_numpy(), int(group["band"].iloc[0])
        # the keys themselves: bytes of a signature can agree in a band whose bucket the two do not share
        ka, kb = (None, None) if partners else (np.stack(f["bands"].to_list()) for f in (first, second))
        for at, fits, share in _likely(first, second, alone and not partners, percent):
            keep = np.argsort(-share, kind="stable")[:partners] if partners else np.flatnonzero((kb[fits] == ka[at]).argmax(axis=1) == band)
            yield from ((min(ra[at], r), max(ra[at], r)) for r in rb[fits[keep]])

    kind = entries.schema["rep"].dataType.simpleString()
    dealt = _tasks(entries) if signs is None else _tasks(entries).join(signs, "rep")
    return by_group(dealt, ["key", "i", "j"], pair, f"a {kind}, b {kind}").distinct()


def settled_links(entries: DataFrame, percent: int, signs: DataFrame, carried: DataFrame) -> DataFrame:
    """Links (a, b, sure) that join different components of the open buckets, from all pairs that likely_pairs gives.

    carried has the sets, by rep and size, that travel with their members: those of at most CARRIED shingles. Pairs of two
    such members are compared here, and those that earlier links of the task connect already are left out, so a task returns
    fewer sure links than it has members. Pairs with another are returned to be confirmed (sure is false).
    """

    def settle(group: pd.DataFrame) -> Iterator[tuple]:
        first, second, alone = _sides(group)
        if not len(first) or not len(second):
            return
        ra, rb, band = first["rep"].to_numpy(), second["rep"].to_numpy(), int(group["band"].iloc[0])
        ka, kb = (np.stack(f["bands"].to_list()) for f in (first, second))
        ca, cb = first["component"].to_numpy(), second["component"].to_numpy()
        sa, sb = ([None if raw is None else from_bytes(raw) for raw in f["set"]] for f in (first, second))
        met = Groups(np.unique(np.concatenate([ca, cb])))
        for at, fits, _ in _likely(first, second, alone, percent):
            fits = fits[(kb[fits] == ka[at]).argmax(axis=1) == band]
            here = [b for b in fits.tolist() if sa[at] is not None and sb[b] is not None and met.top(ca[at]) != met.top(cb[b])]
            for k in range(0, len(here), AT_ONCE):
                some = here[k : k + AT_ONCE]
                for b in np.array(some)[similar_sets(sa[at], [sb[b] for b in some], percent)]:
                    if met.join(ca[at], cb[b]):
                        yield min(ra[at], rb[b]), max(ra[at], rb[b]), True
            yield from ((min(ra[at], rb[b]), max(ra[at], rb[b]), False) for b in fits.tolist() if sa[at] is None or sb[b] is None)

    kind = entries.schema["rep"].dataType.simpleString()
    dealt = _tasks(entries).join(signs, "rep").join(carried, ["rep", "n"], "left")
    return by_group(dealt, ["key", "i", "j"], settle, f"a {kind}, b {kind}, sure boolean").distinct()


def near_duplicates(docs: DataFrame, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and text_key for every row of docs.

    Texts null, empty or without words have an empty set and are their own component. A row whose doc_id is null
    has the component of its shingle set (null if no other row has that set) and is not kept unless it stands
    alone: kept is then true. Rows that repeat a doc_id are one document to the links. Other columns are ignored.
    """
    stash = Stash(docs.sparkSession, "neardup")
    full = stash.keep(signatures(docs), "signatures", BATCH)
    reps = (
        full.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("h1", "h2")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    )
    reps = stash.keep(reps, "classes")
    sig = stash.keep(full.select("doc_id", "text_key", "n_shingles", "h1", "h2"), "sizes")
    stash.drop(full)

    entries = reps.select("rep", "n", F.posexplode("bands").alias("band", "key"))
    buckets = entries.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("centre"), F.count("*").alias("size")).where("size > 1").select("key", "centre")
    entries = stash.keep(entries.join(buckets, "key").select("key", "band", "rep", "n", F.col("centre.rep").alias("a"), F.col("centre.n").alias("a_n")), "entries")

    sets = stash.keep(shingle_table(docs, entries.select(F.col("rep").alias("doc_id")).distinct()), "sets", BATCH)
    pairs = stash.keep(entries.where(F.col("rep") != F.col("a")).where(_similar("n", "a_n", percent)).select("a", F.col("rep").alias("b")).distinct(), "pairs")
    done, links = pairs, stash.keep(confirm(pairs, sets, percent), "links", BATCH)
    label = components(links, stash)

    left = entries.select("key", "band", "rep", "n")
    for partners in (PARTNERS, None):
        named = left.join(label, F.col("rep") == F.col("node"), "left").select("key", "band", "rep", "n", F.coalesce("component", "rep").alias("component"))
        mixed = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
        met = stash.keep(named.join(mixed, "key", "left_semi"), "open")
        left = met.select("key", "band", "rep", "n")
        if partners:
            new = likely_pairs(met, percent, partners, reps.select("rep", "sketch"))
            new = stash.keep(new.join(done, ["a", "b"], "left_anti"), "pairs")
            done = done.union(new)
            found = confirm(new, sets, percent)
        else:
            # by size as well: rows that share an id can have sets of different sizes
            carried = sets.where(F.octet_length("set") <= 8 * CARRIED).select(F.col("doc_id").alias("rep"), (F.octet_length("set") / 8).cast("long").alias("n"), "set")
            new = stash.keep(settled_links(met, percent, reps.select("rep", "sketch", "bands"), carried), "pairs", BATCH)
            found, unsure = new.where("sure").select("a", "b"), new.where("NOT sure").select("a", "b").join(done, ["a", "b"], "left_anti")
            if not unsure.isEmpty():
                large = unsure.select("a").union(unsure.select(F.col("b").alias("a"))).distinct()
                found = found.union(confirm(unsure, sets.join(large.withColumnRenamed("a", "doc_id"), "doc_id", "left_semi"), percent))
        found = stash.keep(found, "links", BATCH)
        if not found.isEmpty():
            links = links.union(found)
            label = components(links, stash)

    classes = stash.keep(reps.join(label, F.col("rep") == F.col("node"), "left").select("h1", "h2", F.coalesce("component", "rep").alias("component")), "named")
    stash.drop_others(sig, classes)
    # Empty sets have no class, and equal texts one: copies of a text are dealt by a salt to as many rows of their class.
    salted = sig.where("n_shingles > 0").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    classes = classes.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    found = salted.join(classes, ["h1", "h2", "salt"], "left").select("doc_id", "n_shingles", F.col("component").alias("component_id"), "text_key")
    out = found.unionByName(sig.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "text_key"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_key")
