"""Each operator on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns, against plain Python."""

import gc
import hashlib
import math
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from hydrolap.llm import bpe, chat, ctw, huffman, lines, packing, partenum, queries, rules, syncmers, tokens, toxicity
from hydrolap.llm.components import components
from hydrolap.llm.common import work_table
from hydrolap.session import new_folder, release_shuffles, shared_dir
from tools.check import compare, connect

FOLDER = "/root/testdata/sf0.001"
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, row string, ids string, source string"

ODD = [
    None, "", "  ", "a  b \n\n c", "foo  <|endoftext|> bar<|startoftext|>x", "don't we'll  İstanbul ΣΑΣ ΟΔΟΣ é", "\x1c a\x1db \x85c　d",
    "日本語 テスト 123４５ ½ ²", "a" * 3000, "\U0001F600 !! 'S", "ﬁ ǅ K Å", "one\ntwo\n\n\nthree \n", "x y z", "the of and",
]


def words(rng, n):
    return " ".join(rng.choice(["the", "cat", "sat", "on", "mat", "river", "stone", "cloud", "north", "été", "Haus"]) + rng.choice(["", "", "s", ","]) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    long = [words(rng, n) for n in (3, 8, 30, 60, 120, 700, 9000)]
    near = [" ".join(w if i % 40 else w + "x" for i, w in enumerate(long[4].split())), long[4] + " end", long[3], long[3].upper()]
    lined = ["\n".join(words(rng, 9) for _ in range(6)) for _ in range(4)]
    return ODD + long + near + lined + [lined[0], lined[1].replace("cat", "cot", 1), lined[2] + "\n" + lined[3], long[2] + " " + long[2]]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "x", "y", "s") for i, t in enumerate(texts)]
    return work_table(spark.createDataFrame(rows + [rows[16], rows[16]], SCHEMA), "test-docs")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_bpe_round_trip_equals_the_library(docs, texts, empty):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    got = bpe.round_trip(docs, WORD_BPE).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        ids = tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["ids"] == " ".join(map(str, ids)) and r["n_tokens"] == len(ids)
        assert r["decoded"] == tokenizer.decode(ids, skip_special_tokens=False)
        assert r["ids_sha256"] == hashlib.sha256(r["ids"].encode()).hexdigest()
    assert bpe.round_trip(empty, WORD_BPE).count() == 0


def library_ids(texts):
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_token_files_round_trip(spark, docs, texts, empty):
    want = library_ids(texts)
    path = new_folder(spark, "test-files")
    huffman.write_files(work_table(tokens.token_rows(docs, BYTE_BPE, 2), "test-ids"), "<u2", path)
    got = huffman.read_files(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted([*range(len(texts)), 16, 16])
    at = 0
    for r in got:
        assert r["start"] == at
        assert np.frombuffer(r["ids"], "<u4").tolist() == [*want[r["doc_id"]], 2]
        at += r["n_tokens"]
    path = new_folder(spark, "test-files")
    huffman.write_files(work_table(tokens.token_rows(empty, BYTE_BPE, 2), "test-ids"), "<u2", path)
    assert huffman.read_files(spark, path).count() == 0


def test_encoder_with_full_memos_and_uneven_white_space(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_ENTRIES", 5)
    encoder = tokens.ChunkEncoder(tokens.tokenizer_json(public_tokenizers.path("byte_bpe_50k.json")))
    parts = ["a", "Wort", "été", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x1c", "\x85", "\u3000", "'s", "12", "don't", "<|endoftext|>", ",", "x."]
    draw = random.Random(5)
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 12)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert max(len(encoder.bare), len(encoder.after_blank), len(encoder.after_blank.older)) <= 5


def test_encoder_keeps_frequent_words_only(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_ENTRIES", 80)
    encoder = tokens.ChunkEncoder(tokens.tokenizer_json(public_tokenizers.path("byte_bpe_50k.json")))
    frequent = [f"word{chr(97 + i)}" for i in range(20)]
    for k in range(30):
        rare = ["rare" + chr(97 + k % 26) * (1 + k // 26) + chr(97 + i) for i in range(15)]
        text = " ".join(["a", *frequent, *rare])
        assert encoder.encode(text) == encoder.whole(text)
    for memo in (encoder.bare, encoder.after_blank):
        assert len(memo) + len(memo.older) <= len(frequent) + 1
        assert len(memo.once) + len(memo.once_older) <= 2 * 80 // 4
    assert set(frequent) <= set(encoder.after_blank)


@pytest.mark.parametrize("text", ["one&&& two%%%, three*** é$$ it's (x) a'b!! don't,", "a&&&'s b!'ll", "x<|> y|>z <|endoftext|>&&& q", "\na!! b\n\nc&& d"])
def test_encoder_cuts_marks_behind_letters(text):
    encoder = tokens.ChunkEncoder(tokens.tokenizer_json(public_tokenizers.path("byte_bpe_50k.json")))
    assert encoder.encode(text) == encoder.whole(text)


@pytest.mark.parametrize("entries, at_once", [(5, 16), (40, 1), (100_000, 16)])
def test_encoder_of_many_texts_equals_the_library(monkeypatch, entries, at_once):
    """Also with a full table, uneven white space, added tokens and marks; each different part of a slice is worked out once."""
    monkeypatch.setattr(tokens, "PART_ENTRIES", entries)
    monkeypatch.setattr(tokens, "WORDS_AT_ONCE", at_once)
    encoder = tokens.ChunkEncoder(tokens.tokenizer_json(public_tokenizers.path("byte_bpe_50k.json")))
    assert encoder.words_at_once == at_once
    parts = ["a", "Wort", "été", "à", "ł", "\xc2", " ", " ", "  ", "\n", "\t", "\x85", "\xa0", "\u3000", "'s", "12", "don't", "<|endoftext|>", ",", "x.", "&&&", "日本"]
    draw = random.Random(7)
    texts = ["".join(draw.choice(parts[: draw.choice([8, len(parts)])]) for _ in range(draw.randint(0, 12))) for _ in range(2000)] + ODD[1:]
    worked, work = Counter(), encoder.table.work
    for k in range(0, len(texts), 500):
        asked: Counter = Counter()
        monkeypatch.setattr(encoder.table, "work", lambda new: asked.update(new.to_pylist()) or work(new))
        ids, bounds = encoder.encode_all(pa.array(["skipped", *texts[k : k + 500]])[1:], tokens.packed([7]))
        for text, a, b in zip(texts[k : k + 500], bounds, bounds[1:]):
            assert ids[a:b].tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 7], text
        assert max(asked.values(), default=1) == 1 and len(encoder.table.keys) <= entries
        worked += asked
    assert entries < 100_000 or max(worked.values()) == 1


def test_token_rows_in_slices(monkeypatch):
    """Slices cut between texts; a slice has one text at least, and empty texts and an empty batch pass."""
    monkeypatch.setattr(tokens, "SLICE_BYTES", 40)
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["", "a" * 100, "b", "c" * 30, "", "d" * 60])], names=["doc_id", "text"])
    cut = [part.column(0).to_pylist() for part in tokens.text_slices(batch)]
    assert [i for part in cut for i in part] == [*range(6)] and len(cut) > 2 and all(cut)
    assert not list(tokens.text_slices(batch.slice(0, 0)))
    encoder = tokens.ChunkEncoder(tokens.tokenizer_json(BYTE_BPE))
    for part in tokens.text_slices(batch):
        ids, bounds = encoder.encode_all(part.column(1), b"")
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == library_ids(part.column(1).to_pylist())


def test_codec_with_full_memos(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 5)
    definition = bpe.tokenizer_json(public_tokenizers.path("word_bpe_49k.json"))
    codec, library = bpe.TextCodec(definition), Tokenizer.from_str(definition)
    library.no_truncation()
    library.no_padding()
    draw = random.Random(6)
    texts = [" ".join("".join(draw.choice("aeinrst,.'É1") for _ in range(draw.randint(1, 6))) for _ in range(draw.randint(0, 9))) for _ in range(300)]
    for text, (n, ids, decoded) in zip(texts, codec.digest(texts)):
        found = library.encode(text, add_special_tokens=False).ids
        assert (n, ids, decoded) == (len(found), " ".join(map(str, found)), library.decode(found, skip_special_tokens=False))


def test_codec_pauses_the_collector_for_a_trie(monkeypatch):
    definition = bpe.tokenizer_json(WORD_BPE)
    codec, library = bpe.TextCodec(definition), Tokenizer.from_str(definition)
    seen, walk = [], codec.bpe.encode_words
    monkeypatch.setattr(codec.bpe, "encode_words", lambda words: seen.append(gc.isenabled()) or walk(words))
    text = "river&&& éÉß-haus don't été! x</w> <|endoftext|> 'S a</w>b ńŕ"
    found = library.encode(text, add_special_tokens=False).ids
    assert list(codec.digest([text, "", " \n"])) == [(len(found), " ".join(map(str, found)), library.decode(found, skip_special_tokens=False)), (0, "", ""), (0, "", "")]
    assert seen and not any(seen) and gc.isenabled()
    assert set(codec.bpe._whole) == set(codec.bpe.vocab)


def test_length_limited_codes():
    rng = np.random.default_rng(2)
    for n, limit in ((1, 20), (2, 20), (300, 9), (5000, 13), (50_000, 20)):
        counts = (rng.pareto(0.7, n) * 10).astype(int) + 1
        lengths = huffman.code_lengths(counts, limit)
        assert lengths.max() <= limit and (n == 1 or abs((2.0 ** -lengths.astype(float)).sum() - 1) < 1e-9)
        for size in (1, 127, 128, 129, 5000):
            ids = rng.integers(0, n, size)
            assert (huffman.Decoder(lengths).block(*huffman.Encoder(lengths).block(ids), size) == ids).all()


def sequential_best_fit(counts, capacity):
    rest = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fitting = [r for r in rest if r >= length]
            if fitting:
                rest[rest.index(min(fitting))] -= length
            else:
                rest.append(capacity - length)
    return sorted(rest)


def test_best_fit_equals_one_by_one():
    rng = random.Random(7)
    for _ in range(200):
        capacity = rng.choice([7, 16, 50])
        counts = {rng.randint(1, capacity): rng.randint(1, 30) for _ in range(rng.randint(1, 12))}
        filled = defaultdict(list)
        for r in packing.best_fit_decreasing(counts, capacity):
            for k in range(r.n):
                filled[r.sequence + k].append((r.offset, r.length))
        rest = []
        for places in filled.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            rest.append(capacity - at)
        assert sorted(rest) == sequential_best_fit(counts, capacity)


def test_packing(docs, texts, empty):
    want = [[*ids, 0] for ids in library_ids(texts)]
    got = packing.pack_documents(docs, BYTE_BPE).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        ids = want[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.asarray(ids, "<u4").tobytes()) and len(ids) == r["length"]
        assert r["length"] == 2048 or r["piece"] == 0
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r["length"])
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert all(sum(pieces[i]) == len(want[i]) * (3 if i == 16 else 1) for i in range(len(texts)))
    assert packing.pack_documents(empty, BYTE_BPE).count() == 0


def test_quality_rules(spark, docs, texts, empty):
    got = by_id(rules.judge(docs))
    for i, t in enumerate(texts):
        found = [w for w in re.split("[\x20\x09-\x0d]+", t or "") if w]
        windows = Counter(tuple(found[k : k + 8]) for k in range(len(found) - 7))
        covered = {j for k in range(len(found) - 7) if windows[tuple(found[k : k + 8])] > 1 for j in range(k, k + 8)}
        worded = [x for x in (t or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"], r["n_dup_lines"]) == (
            len(found), sum(map(len, found)), len(covered), len(worded) - len(set(worded)))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in t or "")
        assert r["base_failed"] == (len(found) < 20 or 100 * len(covered) > 30 * len(found)) and not (r["base_failed"] and r["kept"])
    assert rules.judge(empty).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_twins(spark, name):
    assert compare(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.ORACLES[name]) is None


def test_syncmers(docs, texts, empty):
    unique = docs.dropDuplicates(["doc_id"])
    got = by_id(syncmers.compare_with_next(unique))
    for i, t in enumerate(texts):
        t, following = t or "", texts[(i + 1) % len(texts)] or ""
        cut = len(t) // 4
        edited = t[: len(t) - cut] + following[:cut]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    same = [i for i, t in enumerate(texts) if t == texts[17]]
    assert len({got[i]["fingerprint"] for i in same}) == 1 < len(same)
    assert got[1]["fingerprint"] == "" and got[19]["near_edited"] > 0.4
    assert syncmers.compare_with_next(empty).count() == 0
    assert syncmers.compare_with_next(unique.where("doc_id = 19")).first()["near_next"] == 1.0
    assert len(syncmers.compare_with_next(docs).collect()) == len(texts) + 2


def test_syncmers_do_not_depend_on_what_stands_around(spark):
    rng = random.Random(1)
    passage = " ".join(f"w{rng.randrange(900)}" for _ in range(80))
    rows = [(0, passage), (1, "some other words first " * 3 + passage + " and more behind")]
    found = [set(r["a"]) for r in spark.createDataFrame(rows, "doc_id long, text string").select(syncmers.anchors("text").alias("a")).collect()]
    assert found[0] <= found[1] and 10 < len(found[0]) < 73


def test_syncmer_buckets_follow_the_ids(spark, monkeypatch):
    """One far id does not put all others into one bucket, and neighbours are the same whatever the buckets."""
    monkeypatch.setattr(syncmers, "BUCKET_ROWS", 16)
    monkeypatch.setattr(syncmers, "FULL", 64)
    ids = [*range(3000), *(-(5**k) for k in range(20)), 2**63 - 1, -(2**63)]
    table = spark.createDataFrame([(i, f"text {i}") for i in ids] + [(None, "none")], "doc_id long, text string").repartition(4)
    assert syncmers.with_buckets(table).groupBy("bucket").count().agg(F.max("count")).first()[0] <= 65
    order = sorted(ids)
    got = {r["doc_id"]: r["next_text"] for r in syncmers.with_next(table).collect()}
    assert got == {None: f"text {order[0]}", order[-1]: "none", **{a: f"text {b}" for a, b in zip(order, order[1:])}}


def brute_anchors(text):
    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    def folded(parts):
        h = 42
        for part in parts:
            h = xxhash.xxh64_intdigest(part, seed=h)
        return signed(h)

    def chosen(units):
        k, s = syncmers.K, syncmers.S
        runs = [folded(x.encode() for x in units[i : i + s]) for i in range(len(units) - s + 1)]
        for i in range(len(units) - k + 1):
            window = runs[i : i + k - s + 1]
            if min(window) in (window[0], window[-1]):
                yield folded(x.to_bytes(8, "little", signed=True) for x in (window[0], window[s], window[-1])) >> 32

    found = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    units = [u for w in found for u in (w if len(w) > syncmers.LONG_WORD else [w])]
    out = list(chosen(units))
    if 0 < len(units) < syncmers.SHORT_WORDS:
        out += chosen([""] * (syncmers.K - 1) + list(" ".join(found)) + [""] * (syncmers.K - 1))
    return out


def test_syncmers_of_short_texts(spark):
    """Texts of 0 to 12 words, and texts without blanks: never an empty fingerprint for words, 1.0 for different texts or 0 for an edited one."""
    rng = random.Random(14)
    letters = "abcdefgh\u00e9\u00f6\u65e5\U0001F600"
    texts = ["".join(rng.choice(letters) for _ in range(n)) for n in (1, 2, 3, 4, 7, 11, 12, 31, 32, 33, 34, 45, 300)]
    texts += [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(n)) for n in range(13) for _ in range(12)]
    texts += [" ".join("w%d" % rng.randrange(99) for _ in range(n)) + " " + "x".join(letters * 4) for n in (3, 22, 23, 24, 30)]
    texts += ["\t ".join("w%d" % rng.randrange(99) for _ in range(n)) + "\n" for n in (22, 23, 24, 25)]
    rows = list(enumerate(texts))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for r in table.select("doc_id", syncmers.anchors("text").alias("a")).collect():
        assert r["a"] == brute_anchors(texts[r["doc_id"]]) and bool(r["a"]) == bool(texts[r["doc_id"]].split())
    got = by_id(syncmers.compare_with_next(table))
    for i, t in rows:
        following = texts[(i + 1) % len(texts)]
        assert (got[i]["near_next"] == 1) == (t == following or not t.split() and not following.split()), (t, following)
        assert got[i]["near_edited"] > 0 or len(t) > 3 and not t.split()


def test_context_tree_scores(spark, docs, texts, empty):
    training = F.col("doc_id") % 3 != 1
    got = by_id(ctw.score(docs.dropDuplicates(["doc_id"]), training))
    raw = [(t or "").encode().lower() for t in texts]
    counts = Counter(w for i, r in enumerate(raw) if i % 3 != 1 for w in r.split())
    ends = sum(i % 3 != 1 for i in range(len(raw)))
    n, v = sum(counts.values()) + ends, len(counts) + 1
    for i, r in enumerate(raw):
        want = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in r.split()) + math.log10((ends + 1) / (n + v + 1))
        assert got[i]["n_tokens"] == len(r.split()) + 1 and got[i]["train_tokens"] == n
        assert got[i]["n_known"] == sum(counts[w] > 0 for w in r.split()) + 1
        assert math.isclose(got[i]["base_score"], want, rel_tol=1e-9) and got[i]["score"] < 0
    assert ctw.score(empty, F.lit(True)).count() == 0
    none = by_id(ctw.score(docs.limit(3), F.lit(False)))
    assert all(math.isclose(r["score"], -8 * math.log10(2) * (len(raw[i]) + 1), rel_tol=1e-6) for i, r in none.items())


def test_context_tree_mixture_by_recursion():
    """The conditional probability of the next byte equals the ratio of weighted probabilities over the whole tree."""
    text = b"abracadabra abracadabra"
    strings, _ = ctw.grams([text])

    def weighted(strings):
        def block(seen):
            n1 = sum(b for _, b in seen)
            return float(ctw.log_kt(np.array([len(seen) - n1]), np.array([n1]))[0])

        def node(seen, depth):
            own = block(seen)
            if depth == ctw.DEPTH or not seen:
                return own
            children = defaultdict(list)
            for c, b in seen:
                children[c >> 8 * depth & 255].append((c, b))
            return np.logaddexp(own, sum(node(x, depth + 1) for x in children.values())) - math.log(2)

        total = 0.0
        for j in range(8):
            paths = defaultdict(list)
            for s in strings:
                paths[(s & 255) >> (8 - j)].append((s >> 8, s >> (7 - j) & 1))
            total += sum(node(seen, 0) for seen in paths.values())
        return total

    strings = [int(s) for s in strings]
    rows = Counter((d, (s >> 8) & ctw.mask(d), s & 255) for s in strings for d in range(ctw.DEPTH + 1))
    tree = ctw.Tree(*(np.asarray(x, np.int64) for x in zip(*((*k, n) for k, n in rows.items()))))
    for s in strings[3:9]:
        want = (weighted([*strings, s]) - weighted(strings)) / math.log(10)
        assert math.isclose(float(tree.log10(np.asarray([s], np.uint64))[0]), want, rel_tol=1e-4)


@pytest.mark.parametrize("hot", [0, 2000, 1 << 21])
def test_context_tree_holds_every_context(spark, monkeypatch, hot):
    """Scores equal those of the whole tree, also where the training texts have more than 65,536 contexts."""
    monkeypatch.setattr(ctw, "HOT_STRINGS", hot)
    monkeypatch.setattr(ctw, "SUBTREE_ROWS", 3000)
    rng = random.Random(12)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz \u00e9") for _ in range(700)) for _ in range(60)]
    texts += [None, "", texts[3], texts[4][:300] + " " + texts[5][:300]]
    raw = [(t or "").encode().lower() for t in texts]
    trained = Counter(int(s) for i, r in enumerate(raw) if i % 3 != 1 for s in ctw.grams([r])[0])
    assert sum(len({s >> 8 & ctw.mask(d) for s in trained}) for d in range(ctw.DEPTH + 1)) > 1 << 16
    rows = Counter()
    for s, n in trained.items():
        for d in range(ctw.DEPTH + 1):
            rows[d, s >> 8 & ctw.mask(d), s & 255] += n
    tree = ctw.Tree(*(np.asarray(x, np.int64) for x in zip(*((*k, n) for k, n in rows.items()))))
    got = by_id(ctw.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), F.col("doc_id") % 3 != 1))
    for i, r in enumerate(raw):
        assert math.isclose(got[i]["score"], tree.log10(ctw.grams([r])[0]).sum(), rel_tol=1e-5)


def test_context_tree_tasks_hold_little_memory(spark, docs, monkeypatch):
    """Two tasks share an executor with the JVM; what a task holds at once must not exceed a fraction of its memory."""
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: run)
    monkeypatch.setattr(ctw, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh\u00e9") for _ in range(6)) for _ in range(2000)]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(3000)]
    keys = np.unique(ctw.nearest_first(ctw.grams([t.encode() for t in texts[:1500]])[0]))[::2]
    count = ctw.corpus_counts(docs, F.lit(True))
    score = ctw.score_rows(docs, (keys, -np.ones(len(keys))), {}, 1)
    for run, first in ((count, [True] * len(texts)), (score, list(range(len(texts))))):
        batch = pa.RecordBatch.from_arrays([pa.array(first), pa.array(texts)], names=["first", "text"])
        tracemalloc.start()
        rows = sum(out.num_rows for out in run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows >= len(texts) and peak < 150e6, peak


def test_context_tree_slices_are_bounded_by_texts(monkeypatch):
    """The index of a text in its slice has a fixed number of bits, however short the texts are."""
    monkeypatch.setattr(ctw, "OWNER_BITS", 3)
    batch = pa.RecordBatch.from_arrays([pa.array(range(21)), pa.array(["", "ab", "\u00e9"] * 7)], names=["doc_id", "text"])
    slices = list(ctw.raw_slices(iter([batch])))
    assert [len(ids) for ids, _ in slices] == [8, 8, 5]
    held = np.unique(ctw.nearest_first(ctw.grams([b"ab", b""])[0]))
    for _, raws in slices:
        scores, n_rare, rare = ctw.text_scores(raws, (held, -np.arange(1.0, len(held) + 1)))
        for raw, score, at, n in zip(raws, scores, np.cumsum(n_rare), n_rare):
            strings = ctw.nearest_first(ctw.grams([raw])[0])
            known = np.isin(strings, held)
            assert score == -(np.searchsorted(held, strings[known]) + 1.0).sum() and sorted(rare[at - n : at]) == sorted(strings[~known])


def cheapest(roles):
    costs = {chat.START: 0}
    for role in roles:
        after = {}
        for before, c in costs.items():
            for b, a, more, _ in chat.MOVES[chat.role_no(role)]:
                if b == before:
                    after[a] = min(after.get(a, 1 << 40), c + more)
        costs = after
    return min(c + int(chat.END[s]) for s, c in costs.items())


def test_role_repair(spark, monkeypatch):
    monkeypatch.setattr(chat, "CHUNK_ROWS", 3)
    rng = random.Random(9)
    rows, want = [], {}
    for conv in range(25):
        roles = [rng.choice(["user", "assistant", "system", None, "tool"]) for _ in range(rng.choice([1, 2, 3, 5, 17]))]
        want[conv] = cheapest(roles)
        rows += [(conv, k, r, rng.choice([None, "", "hi", "long " * 50]), 0) for k, r in enumerate(roles)]
    rows += [(None, 0, "user", "q", 0), (None, None, "assistant", "a", 0)]
    got = chat.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part int").repartition(3)).collect()
    assert len(got) == len(rows)
    for conv in range(25):
        turns = sorted((r for r in got if r["conv_id"] == conv), key=lambda r: r["turn"])
        assert sum(r["cost"] for r in turns) == want[conv]
        text = "".join(r["fragment"] for r in turns)
        order = [x.split("\n")[0] for x in text.split("<|im_start|>")[1:]]
        assert order[0] in ("system", "user") and order[-1] == "assistant" and text.endswith("<|im_end|>\n")
        assert all((a, b) in {("system", "user"), ("user", "assistant"), ("assistant", "user")} for a, b in zip(order, order[1:]))
    assert chat.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_word_hashes_tell_words_apart_across_chunks(monkeypatch):
    monkeypatch.setattr(partenum, "CHUNK_BYTES", 97)
    partenum.byte_powers.cache_clear()
    rng = random.Random(5)
    words = ["".join(rng.choice("ab\u00e9") for _ in range(rng.randint(1, 12))) for _ in range(900)] + ["a" * 63, "a" * 64, "a" * 65, "b" * 400, "a" * 97]
    rng.shuffle(words)
    raw = ("\t " + "".join(w + rng.choice([" ", "\n", "\x0b\r", "  "]) for w in words)).encode()
    hashes, starts = partenum.word_hashes(raw)
    assert [raw[s:].split(None, 1)[0].decode() for s in starts] == words
    known = {}
    assert all(known.setdefault(w, h) == h for w, h in zip(words, hashes.tolist()))
    assert len(set(known.values())) == len(known)
    assert all(len(x) == 0 for x in partenum.word_hashes(b"")) and all(len(x) == 0 for x in partenum.word_hashes(b" \n" * 200))
    partenum.byte_powers.cache_clear()


def shingle_sets(texts, size):
    out = {}
    for i, t in enumerate(texts):
        w = (t or "").encode().lower().split()
        out[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    return out


def brute_components(sets, percent):
    label = {i: i for i in sets}
    degree = Counter()
    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                degree[i] += 1
                degree[j] += 1
                low, high = sorted((label[i], label[j]))
                label = {k: low if x == high else x for k, x in label.items()}
    return label, degree


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_jaccard_join(spark, docs, texts, empty, size, percent):
    got = by_id(partenum.join(docs.dropDuplicates(["doc_id"]), size, percent))
    sets = shingle_sets(texts, size)
    label, degree = brute_components(sets, percent)
    assert {i: (r["n_shingles"], r["component_id"], r["n_links"]) for i, r in got.items()} == {i: (len(sets[i]), label[i], degree[i]) for i in sets}
    assert len(set(label.values())) < len(texts)
    assert partenum.join(empty, size, percent).count() == 0


def test_jaccard_join_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(partenum, "BLOCK_SETS", 6)
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(90)]
    texts = [" ".join(w if rng.random() > 0.02 else f"v{rng.randrange(99)}" for w in base) for _ in range(40)]
    sets = shingle_sets(texts, 4)
    label, degree = brute_components(sets, 85)
    got = by_id(partenum.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 4, 85))
    assert {i: (r["component_id"], r["n_links"]) for i, r in got.items()} == {i: (label[i], degree[i]) for i in sets}


def test_jaccard_join_of_few_large_sets(spark, monkeypatch):
    """Where blocks follow the shingles, some blocks have no set; no pair is counted twice."""
    monkeypatch.setattr(partenum, "BLOCK_SHINGLES", 100)
    rng = random.Random(8)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(90)]
        texts += [" ".join([*base, f"v{rng.randrange(99)}{k}"]) for k in range(3)]
    sets = shingle_sets(texts, 4)
    label, degree = brute_components(sets, 85)
    got = by_id(partenum.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 4, 85))
    assert {i: (r["component_id"], r["n_links"]) for i, r in got.items()} == {i: (label[i], degree[i]) for i in sets}


def test_near_duplicates_with_repeated_and_null_ids(spark):
    rng = random.Random(10)
    a, b, c, d = ([f"w{rng.randrange(5000)}" for _ in range(90)] for _ in range(4))

    def near(base, k):
        return " ".join([*base, f"end{k}"])

    rows = [(1, near(a, 1)), (5, near(a, 2)), (5, near(b, 1)), (9, near(b, 2)), (None, near(b, 3)), (None, near(c, 1)), (None, near(c, 1)), (None, near(c, 2)),
            (7, near(d, 1)), (7, near(d, 2)), (11, None), (12, ""), (None, None)]
    left = Counter((r[0], (r[1] or "").split(" ")[0]) for r in corpus_pipeline.drop_near_duplicates(
        spark, spark.createDataFrame(rows, "doc_id long, text string"), FOLDER).collect())
    assert left == Counter([(1, a[0]), (5, b[0]), (None, c[0]), (7, d[0]), (11, ""), (12, ""), (None, "")])


def test_jaccard_join_links_through_null_ids(spark):
    base = [f"w{k}" for k in range(43)]  # 40 shingles; the cut ones have 37 and 36, 33 of them in common
    rows = [(1, " ".join(base[3:])), (None, " ".join(base)), (2, " ".join(base[:-4])), (None, "quite another text of seven words")]
    got = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["n_links"]) for r in partenum.join(
        spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()}
    assert got == {(1, 37): (1, 1), (None, 40): (1, 2), (2, 36): (1, 1), (None, 3): (None, 0)}


@pytest.mark.parametrize("percent", [85, 80])
def test_similar_sets_share_signatures_in_enough_parts(percent):
    rng = np.random.default_rng(5)
    needed = {b.no: b.needed for b in partenum.bands(percent, 4096)}
    for _ in range(1500):
        a = np.unique(rng.integers(0, 2**63, rng.choice([7, 8, 9, 12, 20, 50, 300])).astype(np.uint64))
        keep = rng.permutation(len(a))[: len(a) - rng.integers(0, max(1, len(a) // 6) + 1)]
        b = np.unique(np.concatenate([a[keep], rng.integers(0, 2**63, rng.integers(0, max(1, len(a) // 10) + 1)).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if both and 100 * both >= percent * (len(a) + len(b) - both) and both < len(a) + len(b) - both:
            (x, parts), (y, _) = partenum.signatures(a, percent), partenum.signatures(b, percent)
            shared = np.unique(parts[np.intersect1d(x, y, return_indices=True)[1]])
            assert any((shared >> 32 == no).sum() >= n for no, n in needed.items())


def test_signatures_hold_their_parts(spark, monkeypatch):
    part = np.asarray([0, 5, 3 << 32 | 7, 127 << 32 | 65535, 128 << 32, 1 << 32 | 65536, 900 << 32 | 70000], np.int64)
    signature = np.asarray([-1, 1, -(1 << 63), (1 << 63) - 1, -5, 12345678901, 7], np.int64)
    held, beside = partenum.with_part(signature, part)
    assert partenum.part_of(held, beside).tolist() == part.tolist()
    assert (beside[:4] == 0).all() and ((held[:4] ^ signature[:4]) << 64 - partenum.HASH_BITS == 0).all() and (held[4:] == signature[4:]).all()
    rows = [(i, words(random.Random(i // 2), 60) + f" w{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = partenum.shingle_sets([t.encode().lower() for _, t in rows], 3)
    want = Counter()
    for s in sets:
        sig, place = partenum.signatures(s, 70)
        want.update({(int(x), int(p)) for x, p in zip(sig.view(np.int64), place)})
    want = sum(n for n in want.values() if n > 1)
    rows_of = lambda: partenum.shared_signatures(docs, 3, 70).distinct().collect()
    narrow = rows_of()
    monkeypatch.setattr(partenum, "with_part", lambda signature, part: (signature, part + 1))
    wide = rows_of()
    assert len(narrow) == len(wide) == want
    assert sorted((r["node"], r["part"]) for r in narrow) == sorted((r["node"], r["part"]) for r in wide)


def shuffle_files(spark) -> int:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def work_tables_of(spark) -> set[str]:
    return {p.name.rsplit("-", 1)[0] for p in (Path(shared_dir(spark).removeprefix("file:")) / "hydrolap").glob("*")}


def test_signatures_in_turns(spark):
    rows = [(i, words(random.Random(i // 2), 60) + f" w{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for s in partenum.shingle_sets([t.encode().lower() for _, t in rows] + [b"one two three four"], 3):
        every, place = partenum.signatures(s, 70)
        turns = [partenum.signatures(s, 70, turn, 3) for turn in range(3)]
        assert sorted(zip(every, place)) == sorted(x for t in turns for x in zip(*t))
    whole = {tuple(r) for r in partenum.shared_signatures(docs, 3, 70).collect()}
    parts = [{tuple(r) for r in partenum.shared_signatures(docs, 3, 70, turn, 2).collect()} for turn in range(2)]
    assert min(len(p) for p in parts) > len(whole) // 4 and parts[0] | parts[1] == whole and not parts[0] & parts[1]


def test_joins_leave_no_work(spark, monkeypatch):
    """What a join made on its way is gone before its result is read: tables and shuffle files of both turns."""
    rows = [(i, "\n".join(words(random.Random(i // 2 * 100 + k), 30) for k in range(3)) + f" w{i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted(map(tuple, partenum.join(docs, 3, 70).collect()))
    monkeypatch.setattr(partenum, "TURN_SHINGLES", 0)
    seen, made = [], partenum.shared_signatures

    def counted(*args):
        seen.append(args[3:])
        return made(*args)

    monkeypatch.setattr(partenum, "shared_signatures", counted)
    monkeypatch.setattr("hydrolap.session.new_folder", lambda spark, name, given=new_folder: given(spark, f"kept-{name}"))
    monkeypatch.setattr("hydrolap.llm.common.new_folder", lambda spark, name, given=new_folder: given(spark, f"kept-{name}"))
    joined = partenum.join(docs, 3, 70)
    assert seen == [(0, 2), (1, 2)] and max(r[3] for r in want) == 1
    assert sorted(map(tuple, joined.collect())) == want
    lines.dedup(docs).collect()
    assert {t for t in work_tables_of(spark) if t.startswith("kept-")} == {f"kept-llm-{t}" for t in ("digests", "classes", "links", "concerned", "places", "verdicts")}


def test_shuffle_files_go(spark):
    docs = spark.createDataFrame([(i, "\n".join(words(random.Random(i // 2 * 100 + k), 30) for k in range(3)) + f" w{i}") for i in range(60)], "doc_id long, text string")
    release_shuffles(spark)
    time.sleep(1)
    before = shuffle_files(spark)
    docs.groupBy("text").count().collect()
    assert shuffle_files(spark) > before
    assert lines.links(docs).count()
    for _ in range(50):
        if shuffle_files(spark) <= before + 4:  # those of the count
            return
        time.sleep(0.2)
    assert shuffle_files(spark) <= before + 4


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100)], "a long, b long")
    assert {r["node"]: r["label"] for r in components(edges).collect()} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_banded_edit_distance(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(400):
        a = [rng.choice("abé ") for _ in range(rng.choice([1, 2, 3, 5, 16, 40, 90]))]
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            i = rng.randrange(len(b) + 1)
            b[i : i + rng.randint(0, 1)] = rng.choice([[], ["b"], ["é"]])
        rows.append(("".join(a), "".join(b)))
    pairs = spark.createDataFrame(rows, "a string, b string")
    for edits in (1, 2):
        assert pairs.where(lines.within(F.col("a"), F.col("b"), edits) != (F.levenshtein("a", "b") <= edits)).count() == 0


def test_line_dedup(spark, docs, texts, empty):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            row = _next(row, i, c, b)
        return row[-1]

    def _next(row, i, c, b):
        out = [i]
        for j, d in enumerate(b, 1):
            out.append(min(row[j - 1] + (c != d), row[j] + 1, out[-1] + 1))
        return out

    first = {}
    for i, t in enumerate(texts):
        for p, line in enumerate((t or "").split("\n")):
            if len(line) >= lines.MIN_CHARS:
                first.setdefault(line, (i, p))
    known = [x for x in first if len(x) < 400]
    near = {(a, b) for a in known for b in known if a != b and abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2}
    late = {a for a, b in near if first[b] < first[a]}
    got = by_id(lines.dedup(docs.dropDuplicates(["doc_id"])))
    for i, t in enumerate(texts):
        kept = [x for p, x in enumerate((t or "").split("\n")) if len(x) < lines.MIN_CHARS or (x not in late and first[x] == (i, p))]
        assert got[i]["text"] == "\n".join(kept) and got[i]["n_lines"] == len((t or "").split("\n"))
    assert near and lines.dedup(empty).count() == 0


def test_line_dedup_of_short_lines(spark):
    """Equal lines of any length go if they hold a word; no exact copy of a document stays behind as a stub."""
    rng = random.Random(6)
    rows = [(i, "\n".join(rng.choice(["Les.", "}", " ", "", "\t\r", "ab\u00e9", words(rng, 9), words(rng, 2)]) for _ in range(rng.randint(1, 9)))) for i in range(40)]
    rows += [(100 + i, t) for i, t in rows]
    first = {}
    for i, t in rows:
        for p, line in enumerate(t.split("\n")):
            first.setdefault(line, (i, p))
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    got = by_id(lines.dedup(table))
    for i, t in rows:
        def short(x):
            return len(x) < lines.MIN_CHARS
        kept = [x for p, x in enumerate(t.split("\n")) if short(x) and (not x.strip() or first[x] == (i, p))]
        assert [x for x in got[i]["text"].split("\n") if short(x)] == (kept if kept or got[i]["text"] else [""])
    left = by_id(corpus_pipeline.drop_repeated_lines(spark, table, FOLDER))
    assert not any(i >= 100 and t.strip() for i, t in rows if i in left) and 0 in left


def test_line_links_in_cells(spark, monkeypatch):
    """Verdicts and numbers of links against brute force: a group of near copies in several cells, lines of 400 code points and more, repeated lines."""
    monkeypatch.setattr(lines, "CELL", 3)
    monkeypatch.setattr(lines, "TEXT_CELL", 2)
    rng = random.Random(12)

    def edited(line, n):
        line = list(line)
        for _ in range(n):
            at = rng.randrange(len(line))
            line[at : at + rng.randint(0, 1)] = rng.choice([[], ["q"], ["\u00e9"]])
        return "".join(line)

    base, long = words(rng, 9), words(rng, 90)
    assert len(long) > 400
    pool = [base, *(edited(base, rng.randint(1, 2)) for _ in range(24)), long, *(edited(long, rng.randint(1, 3)) for _ in range(4)), *(words(rng, 6) for _ in range(12))]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(1, 5)))) for i in range(40)]
    places = [((i, p), x) for i, t in rows for p, x in enumerate(t.split("\n"))]
    first = {}
    for place, x in places:
        first.setdefault(x, place)
    pairs = spark.createDataFrame([(a, b) for a in first for b in first if a != b and abs(len(a) - len(b)) <= 2], "a string, b string")
    near = {(r["a"], r["b"]) for r in pairs.where(F.levenshtein("a", "b") <= 2).collect()}
    linked = {a: [b for x, b in near if x == a] for a in first}
    assert sum(len(a) > 400 for a, _ in near) and max(map(len, linked.values())) > 10
    got = by_id(lines.dedup(spark.createDataFrame(rows, "doc_id long, text string")))
    for i, t in rows:
        mine = t.split("\n")
        kept = [x for p, x in enumerate(mine) if first[x] == (i, p) and not any(first[y] < first[x] for y in linked[x])]
        assert got[i]["text"] == "\n".join(kept) and got[i]["n_links"] == sum(len(linked[x]) for x in mine)


def test_toxicity(spark, empty):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        found = words(rng, 60).split()
        if toxic:
            for bad in rng.sample(["zurkface", "zurkling", "blargh", "stupid", "vomork"], 3):
                found.insert(rng.randrange(60), bad)
        rows.append((i, " ".join(found), "en", "x", "y", "s"))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    docs = spark.createDataFrame([*rows, (1000, None, None, None, None, None), (1001, "", "", "", "", ""), rows[0]], SCHEMA)
    given = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity.score(docs, given).collect()
    assert len(got) == 603 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    held = [r for r in got if r["doc_id"] < 600 and r["doc_id"] % 2]
    assert not any(r["predicted"] for r in held) and not any(r["predicted"] for r in got if r["doc_id"] >= 1000)
    assert sum(r["predicted"] for r in got if r["doc_id"] < 600 and r["doc_id"] % 6 == 0) > 95
    none = toxicity.score(docs, given.limit(0)).collect()
    assert len(none) == 603 and all(r["score"] == 0 for r in none)
    assert toxicity.score(empty, given).count() == 0


def test_label_model_finds_the_better_voters():
    rng = np.random.default_rng(0)
    patterns, known = Counter(), {}
    for i in range(6000):
        y = rng.random() < 0.2
        bits = [rng.random() < (0.8 if y else 0.02) if j < 6 else rng.random() < 0.3 for j in range(toxicity.VOTERS)]
        bits[5] = bits[4]  # one voter copies another
        mask = sum(b << j for j, b in enumerate(bits))
        patterns[mask] += 1
        if i < 300:
            clean, toxic = known.get(mask, (0, 0))
            known[mask] = (clean + (not y), toxic + y)
    model = toxicity.fit_label_model({k: float(v) for k, v in patterns.items()}, known)
    assert abs(model.prior - 0.2) < 0.05
    assert (model.accuracy[1, :5] > 0.6).all() and (model.accuracy[0, :5] < 0.1).all()
    assert model.correlation[4, 5] > 0.9 and model.weight[4] < 0.7 * model.weight[0]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = work_table(stage(spark, docs, FOLDER), "test-stage")
        assert after.columns == names and 0 < after.count() <= docs.count(), name
        docs = after
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    label, _ = brute_components(shingle_sets_of(texts), corpus_pipeline.SIMILAR_PERCENT)
    assert len(set(label.values())) == len(texts)
    assert corpus_pipeline.run(spark, FOLDER).select("doc_id").distinct().count() == len(texts)


def shingle_sets_of(texts):
    ids = sorted(texts)
    sets = shingle_sets([texts[i] for i in ids], corpus_pipeline.SHINGLE_WORDS)
    return {i: sets[k] for k, i in enumerate(ids)}
