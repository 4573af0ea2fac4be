"""Packing, token output, near-duplicates, decontamination, URL rules and licences against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import decontam, licenses, neardup, packing, queries, sql, tokenize, tokenout, url_rules

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} x{i * i % 1009}" for i in range(6000))
ODD_TEXTS = [None, "", " \t\n", "one", "Two words", LONG, LONG, "é ü 東京 \U0001f600 <|endoftext|> tail", "same line\nsame line\nsame line"]


def frame(spark, texts, ids=None):
    ids = list(range(1, len(texts) + 1)) if ids is None else ids
    return spark.createDataFrame([(i, t, None, None, None) for i, t in zip(ids, texts)], DOCS)


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], schema)


def clashing(df, names):
    return df.select("*", *(F.lit("clash").alias(n) for n in names))


# --- packing --------------------------------------------------------------------------------------------------------


def test_solver_uses_every_piece_once_and_packs_well():
    rng = np.random.default_rng(1)
    for counts in ({700: 10, 600: 5}, {1: 3000}, {1024: 7}, dict(Counter(rng.integers(1, 1025, 5000).tolist())), dict(Counter(rng.integers(1, 200, 5000).tolist()))):
        patterns = packing.solve(dict(counts))
        used = Counter()
        for times, members in patterns:
            assert times > 0 and sum(k * n for k, n in members.items()) <= 1024
            for k, n in members.items():
                used[k] += times * n
        assert used == Counter(counts)
        least = max(math.ceil(sum(k * n for k, n in counts.items()) / 1024), sum(n for k, n in counts.items() if k > 512))
        assert sum(t for t, _ in patterns) <= math.ceil(1.02 * least) + 1


def test_exact_sums_are_found():
    index = packing.SumIndex({500: 2, 300: 1, 200: 1, 24: 1}, 1024)
    none = Counter()
    assert index.single(500, none) == (500,) and index.pair(524, none) == (500, 24) and index.pair(1000, none) == (500, 500) and index.triple(1000, none) == (500, 300, 200)
    assert index.pair(400, none) == () and index.pair(600, none) == ()


def check_pieces(rows, texts_by_id, width, eos, group, offset):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenize.default_path())
    by_doc, by_row = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_row[group(r)].append(r)
    assert set(by_doc) == set(texts_by_id)
    for doc_id, texts in texts_by_id.items():
        ids = [[*own.encode(t or "", add_special_tokens=False).ids, eos] for t in texts]
        want = []
        for x in ids:
            first = len(x) % width or width
            cuts = [0, len(x)] if len(x) <= width else [0, *range(first, len(x) + 1, width)]
            want += [(k, a, b - a, zlib.crc32(np.array(x[a:b], dtype="<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_doc[doc_id]) == sorted(want)
    for members in by_row.values():
        at = 0
        for r in sorted(members, key=offset):
            assert offset(r) == at
            at += r["length"]
        assert at <= width
    return len(by_row)


def test_pack_against_the_tokenizer(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(frame(spark, ODD_TEXTS, [-i for i in range(1, 10)]).select("doc_id", "text"))
    docs = docs.union(frame(spark, ["twice", "twice", "no id"], [-50, -50, None]).select("doc_id", "text")).cache()
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r["doc_id"]].append(r["text"])
    rows = packing.pack(clashing(docs, ["piece", "length", "__salt"]), tokenize.default_path()).collect()
    n = check_pieces(rows, texts, 1024, 2, lambda r: r["sequence_id"], lambda r: r["offset"])
    assert n <= math.ceil(1.02 * sum(r["length"] for r in rows) / 1024) + 1
    assert packing.pack(empty(spark), tokenize.default_path()).count() == 0


def test_token_rows_round_trip(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(frame(spark, [*ODD_TEXTS, "a", "a"], [-i for i in range(1, 10)] + [-50, -50]).select("doc_id", "text"))
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r["doc_id"]].append(r["text"])
    made = tokenout.write(tokenout.packed_rows(docs, tokenize.default_path(), width=512), f"file://{tmp_path}/rows")
    rows = tokenout.unpack(made).collect()
    check_pieces(rows, texts, 512, tokenout.EOS, lambda r: (r["shard"], r["row"]), lambda r: r["offset"])
    huge = [(1 << 62) + 1, None, (1 << 62) + 3, (1 << 62) + 3]
    odd = clashing(frame(spark, ["big id", "no id", "twice", "twice"], huge), ["row", "shard", "ids", "piece"])
    back = tokenout.unpack(tokenout.write(tokenout.packed_rows(odd, tokenize.default_path()), f"file://{tmp_path}/odd")).collect()
    assert Counter(r["doc_id"] for r in back) == Counter(huge) and Counter(r["doc_id"] for r in packing.pack(odd, tokenize.default_path()).collect()) == Counter(huge)
    one = made.head()
    assert len(one["input_ids"]) == 2 * 512 and one["cu_seqlens"][0] == 0 and one["cu_seqlens"][-1] == one["n_tokens"]
    assert tokenout.packed_rows(empty(spark), tokenize.default_path()).count() == 0


RUNS = [" " * 1_000_000 + "x", "\n" * 1_000_000 + "x", "a" * 1_000_000, "7" * 1_000_000, "!" * 1_000_000, "one" + "\u3000" * 1999 + "x", "one" + "\t" * 2000 + "x"]


def test_million_character_runs(spark, tmp_path):
    """Runs on which the faster library overflows its stack, through both operators and the pipeline's last stage."""
    import corpus_pipeline

    docs, texts = frame(spark, RUNS), {i + 1: [t] for i, t in enumerate(RUNS)}
    for rows in (packing.pack(docs, tokenize.default_path()).collect(), corpus_pipeline.pack(spark, docs, "").collect()):
        check_pieces(rows, texts, 1024, 2, lambda r: r["sequence_id"], lambda r: r["offset"])
    made = tokenout.write(tokenout.packed_rows(docs, tokenize.default_path()), f"file://{tmp_path}/rows")
    check_pieces(tokenout.unpack(made).collect(), texts, tokenout.WIDTH, tokenout.EOS, lambda r: (r["shard"], r["row"]), lambda r: r["offset"])


def test_sum_tables_hold_every_combination():
    import itertools

    rng = np.random.default_rng(4)
    for _ in range(20):
        counts = dict(Counter(rng.integers(1, 41, 12).tolist()))
        index = packing.SumIndex(counts, 40)
        have = [k for k, n in counts.items() for _ in range(min(n, 3))]
        for size, find in ((2, index.pair), (3, index.triple)):
            sums = {sum(c) for c in itertools.combinations(have, size)}
            for gap in range(1, 41):
                got = find(gap, Counter())
                assert bool(got) == (gap in sums) and (not got or sum(got) == gap and not Counter(got) - Counter(counts))


def test_capacity_tree_is_best_fit():
    rng = np.random.default_rng(2)
    for _ in range(30):
        lengths = rng.integers(1, 101, 60).tolist()
        open_rows: list[list[int]] = []
        room: list[int] = []
        for k in sorted(range(60), key=lambda k: -lengths[k]):
            fits = [r for r in room if r >= lengths[k]]
            if fits:
                at = room.index(min(fits))
                room[at] -= lengths[k]
                open_rows[at].append(k)
            else:
                open_rows.append([k])
                room.append(100 - lengths[k])
        got = tokenout.best_fit_decreasing(lengths, 100)
        assert len(got) == len(open_rows) and sorted(100 - sum(lengths[k] for k in r) for r in got) == sorted(room)


def test_fast_encoder_equals_the_files_own(sf):
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer

    own, fast = Tokenizer.from_file(tokenize.default_path()), tokenize.encoder(tokenize.default_path())
    texts = pq.read_table(f"{sf}/documents.parquet")["text"].to_pylist() + [t or "" for t in ODD_TEXTS] + [tokenize.PROBE, "a" * 5000, "   x", "<|endoftext|><|endoftext|>"]
    for t in texts:
        assert list(fast(t)) == own.encode(t, add_special_tokens=False).ids
    assert tokenize.pieces_of(1, 4) == [(0, 1)] and tokenize.pieces_of(8, 4) == [(0, 4), (4, 4)] and tokenize.pieces_of(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_python_workers_take_bounded_batches_and_give_memory_back(spark, monkeypatch):
    """Texts go to tokenizers some megabytes at once, and what a worker has freed does not stay with it."""
    from pathlib import Path

    from millrace.llm import storage

    kept, keep = {}, storage.Stash.keep
    monkeypatch.setattr(storage.Stash, "keep", lambda self, df, name, batch=None: kept.update({name: batch}) or keep(self, df, name, batch))
    assert packing.pack(frame(spark, ["one", None]), tokenize.default_path()).count() == 2 and kept == {"pieces": storage.BATCH}
    held = lambda: int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1])
    some = [bytes(2000) for _ in range(60_000)]
    last, some[:-1] = some[-1], []  # what lies above keeps the C library from shrinking its heap by itself
    before = held()
    storage.give_back()
    assert len(last) == 2000 and before - held() > 50_000


# --- near-duplicates ------------------------------------------------------------------------------------------------


def brute_components(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def variants(n, seed):
    rng = np.random.default_rng(seed)
    base = [f"w{rng.integers(0, 5000)}" for _ in range(120)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(int(rng.integers(0, 8))):
            words[int(rng.integers(0, 120))] = f"v{rng.integers(0, 10**6)}"
        out.append(" ".join(words))
    return out


def test_near_duplicates_against_brute_force(spark, sf):
    odd = [*ODD_TEXTS, "Two  WORDS", "a b c d e f g h", "a b c d e f g", "a b c d e f g h i", "short one here", "SHORT one\there"]
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + [(10_000 + i, t) for i, t in enumerate(odd + variants(60, 1) + variants(60, 2))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: r for r in neardup.near_duplicates(clashing(docs, ["n", "rep", "key", "component_id"])).collect()}
    want = brute_components(texts)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_near_duplicates_odd_rows(spark):
    assert neardup.near_duplicates(empty(spark)).count() == 0
    rows = neardup.near_duplicates(frame(spark, ["a b c d e f", "a b c d e f", "a b c d e f", None, "alone here"], [None, 3, 3, None, None])).collect()
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows)
    big = (1 << 62) + 1
    near = neardup.near_duplicates(frame(spark, ["a b c d e f", "x y z", None], [big, big + 2, None])).collect()
    assert {(r["doc_id"], r["component_id"]) for r in near} == {(big, big), (big + 2, big + 2), (None, None)}
    assert got == Counter({(3, 2, 3, True): 2, (None, 2, 3, False): 1, (None, 0, None, True): 1, (None, 1, None, True): 1})


def test_first_shared_band_is_that_of_the_keys(spark):
    """Signature bytes that agree in an earlier band whose key differs do not lose the pair, nor make it come twice."""
    sketch = bytes(neardup.ROWS * neardup.BANDS)
    keys = {r: [1000 * r + j for j in range(neardup.BANDS)] for r in (1, 2, 3)}
    for r, j in ((1, 5), (2, 5), (1, 9), (2, 9), (2, 30), (3, 30)):
        keys[r][j] = j
    rows = [(j, j, r, 10, r, sketch, keys[r]) for j, pair in ((5, (1, 2)), (9, (1, 2)), (30, (2, 3))) for r in pair]
    entries = spark.createDataFrame(rows, "key long, band int, rep long, n long, component long, sketch binary, bands array<long>")
    assert sorted(tuple(r) for r in neardup.likely_pairs(entries, 75, None).collect()) == [(1, 2), (2, 3)]


def test_last_comparisons_return_links_and_not_pairs(spark):
    """Of n sets of one bucket whose signatures all agree, only links come out, fewer than sets; a very long set's pairs go on."""
    common, small, sketch = np.arange(100, dtype="<u8"), 40, bytes(neardup.ROWS * neardup.BANDS)
    sets = {r: np.concatenate([common, np.arange(1000 * r, 1000 * r + 30, dtype="<u8")]) for r in range(1, small + 1)}  # 100 of 160 are shared
    like = {51: 1, 52: 2, 53: 3, 60: 1, 61: 1}  # with one shingle of their own
    sets |= {r: np.concatenate([sets[x][:-1], [10**6 + r]]).astype("<u8") for r, x in like.items()}
    keys = lambda r: [1000 * r + j for j in range(neardup.BANDS - 1)] + [7]
    rows = [(7, neardup.BANDS - 1, r, len(s), r) for r, s in sets.items()]
    signs = spark.createDataFrame([(r, sketch, keys(r)) for r in (*sets, 99)], "rep long, sketch binary, bands array<long>")
    carried = spark.createDataFrame([(r, len(s), s.tobytes()) for r, s in sets.items()], "rep long, n long, set binary")
    settled = lambda rows: [tuple(r) for r in neardup.settled_links(spark.createDataFrame(rows, "key long, band int, rep long, n long, component long"), 75, signs, carried).collect()]
    got = settled(rows)
    assert len(got) < len(sets) and all(sure for *_, sure in got)
    groups = neardup.Groups(np.array(list(sets)))
    for a, b, _ in got:
        groups.join(a, b)
    assert {r: groups.top(r) for r in sets if groups.top(r) != r} == like
    assert sorted(settled([*rows[:3], (7, neardup.BANDS - 1, 99, 140, 99)])) == [(1, 99, False), (2, 99, False), (3, 99, False)]


def test_components_of_a_path_and_a_star(spark):
    from millrace.llm.storage import Stash

    edges = [(i, i + 1) for i in range(100, 130)] + [(7, i) for i in range(8, 60)] + [(200, 150), (150, 300)]
    got = dict(neardup.components(spark.createDataFrame(edges, "a long, b long"), Stash(spark, "t")).select("node", "component").collect())
    assert all(got[i] == 100 for i in range(100, 131)) and all(got[i] == 7 for i in range(7, 60)) and {got[150], got[200], got[300]} == {150}


# --- decontamination ------------------------------------------------------------------------------------------------


def brute_contamination(docs, items):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower))
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        if w:
            k = min(10, len(w))
            for a in range(len(w) - k + 1):
                windows[tuple(w[a : a + k])].add(i)
    sizes = {len(x) for x in windows}
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for k in sizes:
            for a in range(len(w) - k + 1):
                if own := windows.get(tuple(w[a : a + k])):
                    hit.update(range(a, a + k))
                    found |= own
        found = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def test_contamination_against_brute_force(spark, sf):
    rng = np.random.default_rng(5)
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    few = [" ".join(f"q{x}" for x in rng.integers(0, 3, n)) for n in (40, 12, 10, 9, 7, 5, 4, 3, 2, 1)]  # repeating words: many overlaps
    items += [(900 + i, t) for i, t in enumerate(few)] + [(950, few[0]), (951, None), (952, " ... "), (None, "q1 q2 q1"), (None, "nobody names this item but its eleven words leak all the same"), (953, few[3].upper())]
    odd = [*ODD_TEXTS, *few, " ".join(few), "Q1,q2;q1... " * 30, " ".join(f"q{x}" for x in rng.integers(0, 3, 300)), f"{LONG} {few[0]} {LONG}"]
    docs += [(10_000 + i, t) for i, t in enumerate(odd)] + [(10_000, few[1]), (None, few[0]), (None, few[0]), (None, None), (10_500, "see: Nobody names THIS item but its eleven words leak all the same!")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    out = decontam.contamination(clashing(d, ["k", "pos", "item_id"]), clashing(b, ["doc_id"]))
    got = [tuple(r) for r in out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()]
    assert sorted(got, key=repr) == brute_contamination(docs, items)


def test_contamination_with_a_shuffled_join(spark, sf, monkeypatch):
    d, b = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    want = sorted(map(repr, decontam.contamination(d, b).drop("spans").collect()))
    monkeypatch.setattr(decontam, "BROADCAST_FINGERPRINTS", 0)
    assert sorted(map(repr, decontam.contamination(d, b).drop("spans").collect())) == want
    assert decontam.contamination(empty(spark), b).count() == 0
    none = decontam.contamination(d, b.limit(0))
    assert none.where("contaminated OR n_items > 0 OR n_hit > 0").count() == 0 and none.count() == d.count()


def test_long_and_repeating_leaks_cost_their_length(spark):
    """An item of one word 5,000 times, and long items, against themselves."""
    import time

    rng, took = np.random.default_rng(6), {}
    long = {n: " ".join(f"t{x}" for x in rng.integers(0, 50_000, n)) for n in (4000, 16_000)}
    for name, text in (("warm", long[4000]), *long.items(), ("x", "x " * 5000)):
        docs, items = [(1, text), (2, f"{text} and more")], [(7, text)]
        began = time.time()
        got = decontam.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
        rows = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"]) for r in got.collect())
        took[name] = time.time() - began
        n = len(text.split())
        assert rows == [(1, n, n, 1), (2, n + 2, n, 1)]
    assert took[16_000] < 2 * 4 * took[4000] and took["x"] < 60


def test_native_plans_run_no_python(spark, sf):
    d, b = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    for df in (decontam.contamination(d, b), queries.op9_license_scan(spark, sf)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())


# --- URLs -----------------------------------------------------------------------------------------------------------


def brute_verdict(rules, url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if host and ("." + host).endswith("." + r.host) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.text), r.host.count("."), r.verdict == "allow"), default=None)
    return host, path, best.text if best else None, best.verdict if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://com/en/", "https://EXAMPLE.com/en/77?x=1", "https://a.example.com/en/6", "https://x.com/en", "https://x.com/en/", "http://a.example.net/de/8#t", "http://a.example.net/de/9", "http://notnet/de/",
    "ftp://org/es/x", "http://a.org?x=/es/", "http://a.org#/es/", "http://é.com/en/1", "http://a.com/en/1://b.net/de/8", "http://.com/en/", "HTTP://A.COM/EN/", "http://u@x.com:80/en/", "http://com./en/", "http://x.com/en/\n/z", "http://a.b/" + "p/" * 20000,
]


def test_url_rules_against_brute_force(spark):
    extra = [url_rules.Rule.parse(v, t) for v, t in (("block", "b/p/p/"), ("allow", "b/p/p/"), ("block", "x.com/"), ("block", "Com"), ("allow", "a.com/en/1:"))]
    for rules in (queries.URL_RULES, [*queries.URL_RULES, *extra], []):
        df = spark.createDataFrame([(i, u, "keep", "clash") for i, u in enumerate([*URLS, URLS[5]])], "page_id long, url string, other string, verdict string")
        got = [(r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judge_urls(df, rules).orderBy("page_id").collect()]
        assert got == [brute_verdict(rules, u) for u in [*URLS, URLS[5]]]
    assert url_rules.judge_urls(df.limit(0), queries.URL_RULES).count() == 0
    with pytest.raises(ValueError):
        url_rules.Rule.parse("maybe", "x")


# --- licences -------------------------------------------------------------------------------------------------------

FILES = [
    (1, "LICENSE", "Licensed under the Apache License, Version 2.0."), (2, "a.py", "code"), (3, "lib/b.py", None), (4, "lib/deep/COPYING.txt", "Released under the MIT License."), (5, "lib/deep/c.py", "x = 1"),
    (6, "lib/deep/er/d.py", ""), (7, "lib/e.py", "# All rights reserved.\ncode"), (8, None, "no path"), (9, None, "licensed under CC BY 4.0"), (10, "lib/deep/er/LICENSE", "nothing known"), (5, "lib/deep/c.py", "x = 1"), (11, "lib/" + "w/" * 60 + "f.py", LONG),
]


def test_terms_are_cut_by_one_expression(spark):
    """Without a function that is interpreted for each word; and none is lost, however the dots lie."""
    odd = [*ODD_TEXTS, ".", "...", ". .", ".a.", "a.b..c", "..a . .b.", "x\n.y", "1.2.3. ", "a-.b", "a.-b", "a.-.b", "a" * 5000 + "." * 3000 + "b", "a." * 20_000, ". " * 20_000 + "z", "Naïve.É i.K"]
    df = spark.createDataFrame(list(enumerate(odd)), "id long, text string").select("id", licenses.terms_of(F.col("text")).alias("terms"))
    want = [[x.strip(".") for x in re.split(r"[^a-z0-9.]+", (t or "").lower()) if x.strip(".")] for t in odd]
    assert [r["terms"] for r in df.orderBy("id").collect()] == want
    assert "lambdafunction" not in df._jdf.queryExecution().executedPlan().toString()


def test_licences_and_inheritance(spark):
    df = spark.createDataFrame(FILES, "id long, path string, text string")
    got = {(r["id"], r["path"]): (r["licence"], r["found_in"], r["depth"]) for r in licenses.scan(clashing(df, ["unit", "term", "dir", "licence"])).collect()}
    assert len(got) == 11
    want = {1: ("Apache-2.0", "file", None), 2: ("Apache-2.0", "directory", 0), 3: ("Apache-2.0", "directory", 1), 4: ("MIT", "file", None), 5: ("MIT", "directory", 0), 6: ("MIT", "directory", 1)}
    want |= {7: ("LicenseRef-Proprietary", "file", None), 8: (None, None, None), 9: ("CC-BY-4.0", "file", None), 10: ("MIT", "directory", 1), 11: ("Apache-2.0", "directory", 61)}
    assert {k[0]: v for k, v in got.items()} == want
    assert licenses.scan(spark.createDataFrame([], "id long, path string, text string")).count() == 0


def test_whole_licence_texts_and_what_lies_below_them(spark):
    """Whole texts, rewrapped and under other names and holders, and files below them; other prose is none of them."""
    texts = {}
    for licence, text in licenses.whole_texts():
        texts.setdefault(licence, text)
    genuine = ["Apache-2.0", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "MIT", "CC0-1.0"]
    names = ["LICENSE", "COPYING", "licence.txt", "LICENSE.md"]
    rows, want = [], {}
    for i, licence in enumerate(genuine):
        words = texts[licence].split()
        lines = [" ".join(words[at : at + 14]) for at in range(0, len(words), 14)]
        rows += [(2 * i, f"p{i}/{names[i % 4]}", "\r\n".join(["Copyright (c) 2021 Jane Example and others", *lines])), (2 * i + 1, f"p{i}/src/a/b.py", "x = 1")]
        want |= {2 * i: (licence, "file", None), 2 * i + 1: (licence, "directory", 2)}
    rows += [(100, "q/NOTICE", LONG), (101, "q/b.py", "x = 1")]
    want |= {100: (None, None, None), 101: (None, None, None)}
    got = {r["id"]: (r["licence"], r["found_in"], r["depth"]) for r in licenses.scan(spark.createDataFrame(rows, "id long, path string, text string")).collect()}
    assert got == want


def test_headers_are_read_as_blocks(spark):
    """BSD, Apache and MIT headers over several comment lines, each with a line that would say All rights reserved by itself."""
    text = {}
    for licence, whole in licenses.whole_texts():
        text.setdefault(licence, whole)
    wrap = lambda t, lead: "\n".join(lead + " ".join(t.split()[i : i + 11]) for i in range(0, len(t.split()), 11))
    apache = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    rows = [
        (1, "a/bsd.c", "/* Copyright (c) 2019, A. Nother\n * All rights reserved.\n *\n" + wrap(text["BSD-3-Clause"], " * ") + "\n */\nint main(void) { return 0; }\n"),
        (2, "a/apache.py", "#!/usr/bin/env python\n# Copyright 2020 B. Else\n# All rights reserved.\n#\n" + wrap(apache, "# ") + "\nimport os\n"),
        (3, "a/mit.js", "// Copyright (c) C. Third\n// All rights reserved.\n" + wrap(text["MIT"], "// ") + "\n\nlet x = 1;\n"),
        (4, "a/plain.html", "<!--\nCopyright D. Fourth\nAll rights reserved.\n-->\n<p>x</p>"),
        (5, "a/none.py", "# a tool\n# that sorts lines\nimport sys\n"), (6, "a/open.c", "/* never closed\n" + wrap(text["MIT"], "")), (7, "a/b.c", "int x;\n// All rights reserved.\n// Released under the MIT License.\n"),
    ]
    got = {r["id"]: (r["licence"], r["unit"]) for r in licenses.scan(spark.createDataFrame(rows, "id long, path string, text string")).collect()}
    # the second file's line 4 holds the shortest notice and little else, so it is nearer to a template than the header
    assert got == {1: ("BSD-3-Clause", -1), 2: ("Apache-2.0", 4), 3: ("MIT", -1), 4: ("LicenseRef-Proprietary", 2), 5: (None, None), 6: ("MIT", -1), 7: ("MIT", 2)}


def test_telling_terms_lose_nothing(spark, sf):
    """Cosines of all lines with all templates, computed plainly."""
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    terms = lambda t: [w.strip(".") for w in re.split(r"[^a-z0-9.]+", (t or "").lower()) if w.strip(".")]
    templates = [(name, Counter(terms(t))) for name, t in licenses.TEMPLATES]
    vocabulary = set().union(*(c for _, c in templates), *(terms(t) for _, t in licenses.whole_texts()))
    n, df = len(docs), Counter()
    for _, t in docs:
        df.update(set(terms(t)) & vocabulary)
    idf = lambda w: math.log((1 + n) / (1 + df.get(w, 0))) + 1
    weigh = lambda c: {w: k * idf(w) for w, k in c.items()}
    size = lambda v: math.sqrt(sum(x * x for x in v.values()))
    sides = [(name, weigh(c)) for name, c in templates]
    want = {}
    for i, t in docs:
        for line in re.split(r"\r\n|\r|\n", t or ""):
            v = weigh(Counter(terms(line)))
            for name, s in sides:
                dot = sum(x * s[w] for w, x in v.items() if w in s)
                if dot and round(dot / size(v) / size(s), 6) >= licenses.THRESHOLD:
                    want.setdefault(i, set()).add(name)
    got = {r["doc_id"]: r["licence"] for r in queries.op9_license_scan(spark, sf).where("found_in = 'file'").collect()}
    assert got.keys() == want.keys() and all(got[i] in want[i] for i in got)


# --- SQL ------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_query_matches_sql(spark, sf, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = queries.queries()[name](spark, sf)
    want = con.execute(sql.oracle_sql()[name])
    cols = [d[0] for d in want.description]
    assert sorted(map(repr, (tuple(r) for r in df.select(*cols).collect()))) == sorted(map(repr, want.fetchall()))
