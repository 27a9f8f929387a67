"""Resampling, search and SimHash against plain Python on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from hydrolap.llm import importance, partenum, queries, search, simhash
from hydrolap.llm.common import without_rows, work_table
from tools.check import compare, connect

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, score string, rank string, node string, query string, ids string, source string"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
LOWER = str.maketrans(LETTERS.upper(), LETTERS)


def prose(rng, n):
    return " ".join(rng.choice(["The", "cat", "SAT", "on", "mat", "river", "stone", "été", "Haus", "日本", "x-1", "n°5"]) + rng.choice(["", "s", ",", ".", "\n"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    texts = [None, "", " \n ", "-- !!", "cat", "Cat cat", "x" * 5000, "İI ı K", "a\x00b\x1cc d　e"]
    texts += [prose(rng, n) for n in [3, 5, 19, 20, 21, 40, 80, 200, 900, 30_000] + [25] * 60]
    texts += [texts[15]] * 3 + [texts[16] + " end"]
    found = [(i, t, "1", "2", "3", "4", "5", "6") for i, t in enumerate(texts)]
    return found + [found[20], found[20], (None, texts[16], *"abcdef"), (None, None, *"abcdef")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return work_table(spark.createDataFrame(rows, SCHEMA), "test-docs")


@pytest.fixture(scope="module")
def items(spark):
    texts = ["the cat", "river river stone", "nothing-of-this qqq", None, "", "été 日本 haus on the mat", "cat", "sats"]
    return spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)] + [(0, "the cat", "x", "y"), (6, "stone", "x", "y"), (None, "cat", "x", "y")],
                                 "item_id long, text string, score string, query string")


def plain_features(text, longest, buckets):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("longest, buckets, least, percent", [(1, 10_000, 20, 10), (3, 50, 3, 100), (2, 7, 1, 37), (1, 10, 10**9, 10)])
def test_resampling(docs, rows, items, longest, buckets, least, percent):
    aims = [r["text"] for r in items.collect()]
    raw, target = Counter(), Counter()
    for texts, counts in (([r[1] for r in rows], raw), (aims, target)):
        for t in texts:
            counts.update(plain_features(t, longest, buckets)[1])
    s_all, t_all = sum(raw.values()), sum(target.values())
    want = []
    for doc_id, text, *_ in rows:
        n_words, found = plain_features(text, longest, buckets)
        gains = [math.floor(1000 * math.log((target[b] + 1) * (s_all + buckets) / ((raw[b] + 1) * (t_all + buckets)))) for b in found]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        want.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words])
    able = sorted((w for w in want if w[4] >= least), key=lambda w: (-w[3], w[0] is None, w[0]))
    drawn = able[: percent * len(able) // 100]
    got = importance.resample(docs, items, longest, buckets, least, percent)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    got = got.collect()
    key = lambda w: tuple((x is None, x) for x in w)
    assert sorted(([r.doc_id, r.n_features, r.weight, r.score, r.n_words] for r in got), key=key) == sorted(want, key=key)
    assert [(r.rank, r.doc_id) for r in sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])] == [(n, w[0]) for n, w in enumerate(drawn, 1)]


def test_resampling_of_empty_tables(docs, items, rows):
    assert importance.resample(docs.limit(0), items).count() == 0
    assert importance.resample(docs, items.limit(0)).count() == len(rows)


def test_overlapped_scanning_gives_every_run_of_words():
    plain = importance.collapsed("-- A b,c\n d ")
    assert plain == b" a b c d "
    assert [m.group() for m in importance.run_pattern(3).finditer(plain, overlapped=True)] == [b"a b c", b"b c d"]
    assert not list(importance.run_pattern(5).finditer(plain, overlapped=True))


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_search(rows, items, k):
    bags = [(r[0], Counter(plain_terms(r[1]))) for r in rows]
    lengths = [sum(b.values()) for _, b in bags]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item_id, text in sorted({(i["item_id"], i["text"] or "") for i in items}, key=lambda x: (x[0] is None, x)):
        asked = plain_terms(text)
        scored = []
        for (doc_id, bag), length in zip(bags, lengths):
            m = 25 + 75 * length * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in asked if bag[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        out += [(item_id, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(sorted(scored)[:k], 1)]
    return out


def sortable(found):
    return sorted(found, key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("k", [1, 10, 1000])
@pytest.mark.parametrize("settings", [{}, {"SEGMENT_BYTES": 300, "WINDOW": 2, "SHORT_SHARE": 2}, {"BLOCK_TERMS": 3, "VOCABULARY": 2, "SHORT_SHARE": 1}, {"WINDOW": 5, "SHORT_SHARE": 1000}])
def test_search(docs, rows, items, monkeypatch, settings, k):
    for name, value in settings.items():
        monkeypatch.setattr(search, name, value)
    got = [tuple(r) for r in search.search(docs, items, k).collect()]
    assert sortable(got) == sortable(plain_search(rows, items.collect(), k))


def test_search_of_empty_tables(docs, items):
    assert search.search(docs.limit(0), items).count() == 0
    assert search.search(docs, items.limit(0)).count() == 0


def test_search_skips_documents_that_cannot_enter():
    """Once the best are known, documents of the long list alone are not looked at."""
    ids = list(range(10_000))
    row = {"ids": ids, "lengths": [10] * 10_000, "terms": [b"often", b"rare"], "starts": [0, 10_000], "places": ids + [3, 9_000], "times": [1] * 10_002}
    import pyarrow as pa

    part = search.Segment({c: pa.scalar(v) for c, v in row.items()}, 10_000, 100_000)
    seen, sought = [], search.Postings.between
    best = search.Best(1)
    part.rank([(b"often", 5), (b"rare", 5000)], best)
    assert best.ids.tolist() == [3]
    try:
        search.Postings.between = lambda self, low, high: seen.append(low) or sought(self, low, high)
        part.rank([(b"often", 5), (b"rare", 5000)], best)
    finally:
        search.Postings.between = sought
    assert seen == [3, 9_000] and best.ids.tolist() == [3]


def plain_fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, ids, bits=3):
    label = list(range(len(prints)))
    links = [0] * len(prints)
    moved = True
    near = [[j for j in range(len(prints)) if j != i and (prints[i] ^ prints[j]).bit_count() <= bits] for i in range(len(prints))]
    while moved:
        moved = False
        for i, others in enumerate(near):
            links[i] = len(others)
            low = min([label[i], *(label[j] for j in others)])
            moved |= low != label[i]
            label[i] = low
    least = {}
    for i, lab in enumerate(label):
        if ids[i] is not None:
            least[lab] = min(least.get(lab, ids[i]), ids[i])
    return [least.get(lab) for lab in label], links


def test_simhash(docs, rows):
    prints = [plain_fingerprint(r[1]) for r in rows]
    classes, links = plain_classes(prints, [r[0] for r in rows])
    want = [(r[0], f"{p:016x}", c, n) for r, p, c, n in zip(rows, prints, classes, links)]
    got = simhash.near_duplicates(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id", "n_links"]
    assert sortable([tuple(r) for r in got.collect()]) == sortable(want)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_spark_hash_is_the_shingles_hash(spark):
    text = "Été über\tthe  Moon"
    want = [r[0] & (1 << 64) - 1 for r in spark.createDataFrame([("Été über the".replace("T", "t"),), ("über the moon",)], "s string").select(F.xxhash64("s")).collect()]
    assert simhash.shingle_hashes(text, 3).tolist() == want


@pytest.mark.parametrize("cell_rows, slice_shingles, pairs", [(4096, 1 << 17, 1 << 21), (5, 7, 11), (1, 1, 1)])
def test_close_fingerprints_are_linked(spark, monkeypatch, cell_rows, slice_shingles, pairs):
    """Clusters, chains and strangers: every link is found, counted once, and no other."""
    monkeypatch.setattr(simhash, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(simhash, "SLICE_SHINGLES", slice_shingles)
    monkeypatch.setattr(simhash, "PAIRS_AT_ONCE", pairs)
    rng = random.Random(5)
    prints = [0, 7, 15, (1 << 64) - 1] + [rng.getrandbits(64) for _ in range(20)]
    for base in prints[4:10]:
        for _ in range(12):  # chains of one to four bits at a time
            base ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            prints.append(base)
    for _ in range(60):  # a ball round one fingerprint
        prints.append(prints[12] ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))))
    prints += prints[:9]
    ids = list(range(len(prints)))
    given = spark.createDataFrame([(i, int(np.uint64(p).astype(np.int64))) for i, p in zip(ids, prints)], "doc_id long, node long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, size: given)
    classes, links = plain_classes(prints, ids)
    got = {r.doc_id: r for r in simhash.near_duplicates(given).collect()}
    assert [(got[i].fingerprint, got[i].component_id, got[i].n_links) for i in ids] == [(f"{p:016x}", c, n) for p, c, n in zip(prints, classes, links)]


def test_majority_in_parts(monkeypatch):
    rng = np.random.default_rng(3)
    hashes = [rng.integers(0, 1 << 64, n, np.uint64) for n in (0, 1, 2, 3, 50, 1000)]
    want = simhash.majority(hashes).tolist()
    assert want == [sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in hs) > len(hs)) for hs in hashes]
    monkeypatch.setattr(simhash, "SLICE_SHINGLES", 13)
    assert simhash.majority(hashes).tolist() == want


def test_verification_finds_exactly_the_similar_sets():
    """Also the filter before it: sets that share only what many share are not compared."""
    rng = random.Random(1)
    for _ in range(150):
        universe, sets = rng.choice([20, 60, 400]), []
        for _ in range(rng.randint(1, 12)):
            some = set(rng.choice(sets).tolist()) if sets and rng.random() < 0.5 else set(rng.sample(range(universe), rng.randint(1, min(universe, 40))))
            for _ in range(rng.randint(0, 3)):
                some ^= {rng.randrange(universe)}
            sets.append(np.asarray(sorted(some or {1}), np.uint64))
        left = np.asarray([rng.random() < 0.5 for _ in sets]) if rng.random() < 0.5 else np.ones(len(sets), bool)
        for percent in (80, 85, 100):
            got = partenum.linked(sets, left, percent)
            for i, a in enumerate(sets):
                for j, b in enumerate(sets):
                    both = len(np.intersect1d(a, b))
                    close = i != j and 100 * both >= percent * (len(a) + len(b) - both) and (left.all() or left[i] != left[j])
                    assert got[i, j] == close
    passage = np.arange(50, dtype=np.uint64)
    others = [np.concatenate([passage, rng.randrange(1 << 40) + np.arange(200, dtype=np.uint64) * 7919]).astype(np.uint64) for _ in range(2000)]
    assert partenum.may_link(others, 80).sum() < 20


def test_near_duplicate_stage_keeps_clashing_columns(spark):
    rows = [(1, "a b c d e f g h", "x", "y", "z"), (1, "a b c d e f g h", "x", "y", "w"), (2, "a b c d e f g h", "x", "y", "z"), (3, "other words of another text", "x", "y", "z"), (4, None, "x", "y", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone_key string, again_key string, row_key string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]
    gone = spark.createDataFrame([(3, "other words of another text")], "doc_id long, text string").select("doc_id", F.xxhash64("text").alias("text_hash"))
    left = without_rows(docs, gone)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 1, 2, 4]


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op12_ranked_search"])
def test_queries_equal_their_twins(spark, name):
    assert compare(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.ORACLES[name]) is None


def test_simhash_query(spark):
    found = {r.doc_id: r for r in queries.QUERIES["op13_simhash_pivots"](spark, FOLDER).collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    ids = sorted(texts)
    prints = [plain_fingerprint(texts[i]) for i in ids]
    classes, links = plain_classes(prints, ids)
    assert [(found[i].fingerprint, found[i].component_id, found[i].n_links) for i in ids] == [(f"{p:016x}", c, n) for p, c, n in zip(prints, classes, links)]
