"""Line dedup by a segment-partition edit join.

A line goes if an earlier line of the corpus is equal to it or within ``EDITS`` edits; earlier means a smaller (doc_id, position).
Lines of fewer than ``MIN_CHARS`` code points go only if an earlier one is equal; without a word they always stay.

Join. A line of length L is split into EDITS + 1 segments of almost equal length. Two lines within EDITS edits have a segment of
the shorter one unchanged in the longer one, near its place; which places must be probed follows from the difference in
length and from the edits left on either side. Segments and probed substrings meet by their 64-bit hash with length and
segment number. Only hashes that two different lines have are looked at again; their lines meet in cells of bounded
size, where a parity mask of symbol counts (an edit flips two bits at most) sorts out most pairs. Lines that have a candidate left
meet again with their texts, and a banded bit-parallel edit distance verifies them there: a cell gives one row per line,
the first place of a linked line and the number of links, never one per pair. All on Spark expressions.

Equal lines are one node from the start, so repeated lines cost one row; every occurrence finds its verdict by the hash of the line.

Edge cases: null text counts as empty and stays; rows with equal doc_id and text are one document, repeated in the result;
equal doc_ids with different text are ordered by the hash of their text; a null doc_id sorts first; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import release_shuffles, work_folder
from .common import WORD_PATTERN, checked_broadcast, id_text, work_table

EDITS = 2
MIN_CHARS = 16
CELL = 512  # lines of either kind in a cell, by their masks
TEXT_CELL, CELL_CHARS = 128, 1 << 22  # the same with texts, and their code points on average
SYMBOLS = " etaonirshdlcumwfgypbvk.,"  # one bit of the mask each
WORD = 32  # bits of the band's word


def exploded(docs: DataFrame) -> DataFrame:
    """doc_id, row, pos, rid, chars, line of every line but short ones without a word."""
    rows = id_text(docs).withColumn("row", F.xxhash64("doc_id", "text"))
    lines = rows.select("doc_id", "row", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return lines.withColumn("chars", F.length("line")).where((F.col("chars") >= MIN_CHARS) | F.col("line").rlike(WORD_PATTERN)).withColumn(
        "rid", F.xxhash64("line"))


def mask(line: Column) -> Column:
    """Bit k: whether the line has an odd number of the k-th symbol."""
    odd = [F.length(F.replace(line, F.lit(s), F.lit(""))) for s in SYMBOLS]
    return reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft((F.length(line) - n).bitwiseAND(1).cast("long"), k) for k, n in enumerate(odd)])


def probes() -> list[tuple[int, int, int]]:
    """(difference in length, segment, shift): the line's own segments come first of their kind, then what is to be probed."""
    return [(shorter, i, shift) for shorter in range(EDITS + 1) for i in range(EDITS + 1)
            for shift in range(max(-i, shorter - (EDITS - i)), min(i, shorter + (EDITS - i)) + 1)]


def key_rows(lines: DataFrame) -> DataFrame:
    """``lines`` (rid, chars, line) with key and indexed: a row for each own segment and each substring to probe.

    The probes are rows of a literal array rather than so many expressions: one expression over them stays small enough to be compiled.
    """
    table = F.array(*(F.struct(F.lit(a).alias("shorter"), F.lit(b).alias("i"), F.lit(c).alias("shift")) for a, b, c in probes()))
    rows = lines.select("rid", "chars", "line", F.inline(table))
    n, length = EDITS + 1, F.col("chars") - F.col("shorter")
    longer = length % n  # the last segments are longer by one where the length does not divide
    size = F.floor(length / n).cast("int") + F.when(F.col("i") >= n - longer, 1).otherwise(0)
    at = F.floor(length / n).cast("int") * F.col("i") + F.greatest(F.lit(0), F.col("i") - (n - longer)) + F.col("shift")
    return rows.where((at >= 0) & (at + size <= F.col("chars"))).select(
        "rid", "chars", "line", F.xxhash64(length, "i", F.substring(F.col("line"), at + 1, size)).alias("key"),
        ((F.col("shorter") == 0) & (F.col("shift") == 0)).alias("indexed"))


def within(a: Column, b: Column, edits: int = EDITS) -> Column:
    """Whether two lines are at most ``edits`` apart: the bit-vector algorithm of Hyyrö (2003) on a diagonal band.

    ``long`` has at least as many characters as ``short``. The highest bit of a word stands for the lowest row of the band, each
    column moves the band one row on. Words have 32 bits inside a 64-bit integer, so sums cannot overflow. What both lines begin or
    end with is cut off first, which does not change the distance.
    """
    full = (1 << WORD) - 1
    top = WORD - 1

    def invert(x: Column) -> Column:
        return x.bitwiseXOR(F.lit(full))

    def compare(pair: Column) -> Column:
        long, short = pair["long"], pair["short"]
        n, m = F.size(long), F.size(short)

        def column(state: Column, i: Column) -> Column:
            c = F.get(short, i)
            equal = reduce(lambda x, y: x.bitwiseOR(y), [
                F.when(F.get(long, i + k) == c, F.lit(1 << (top - edits + k))).otherwise(F.lit(0)).cast("long")
                for k in range(-edits, edits + 1)])
            # bound once each: the bits of this column from the vertical differences of the one before
            return F.get(F.transform(F.array(F.struct(equal.alias("x"), state["vp"].alias("vp"), state["vn"].alias("vn"), state["d"].alias("d"))), lambda s: step(s, i)), F.lit(0))

        def step(s: Column, i: Column) -> Column:
            d0 = ((s["x"].bitwiseAND(s["vp"]) + s["vp"]).bitwiseAND(F.lit(full)).bitwiseXOR(s["vp"])).bitwiseOR(s["x"]).bitwiseOR(s["vn"])
            return F.get(F.transform(F.array(F.struct(d0.alias("d0"), s["vp"].alias("vp"), s["vn"].alias("vn"), s["d"].alias("d"))), lambda t: finish(t, i)), F.lit(0))

        def finish(t: Column, i: Column) -> Column:
            hp = t["vn"].bitwiseOR(invert(t["d0"].bitwiseOR(t["vp"])))
            hn = t["d0"].bitwiseAND(t["vp"])
            half = F.shiftrightunsigned(t["d0"], 1)
            on_diagonal = i < n - edits
            row = F.greatest(F.lit(0), top - 1 - (i - (n - edits)))  # place of the last row once the band has reached it
            down = F.expr("1L").cast("long")
            bit = lambda word: F.call_function("shiftrightunsigned", word, row).bitwiseAND(down)
            diagonal = 1 - F.shiftrightunsigned(t["d0"], top).bitwiseAND(F.lit(1))
            d = t["d"] + F.when(on_diagonal, diagonal).otherwise(bit(hp) - bit(hn))
            return F.struct(hn.bitwiseOR(invert(half.bitwiseOR(hp))).alias("vp"), half.bitwiseAND(hp).alias("vn"), d.cast("long").alias("d"))

        start = F.struct(F.lit(full << (WORD - edits - 1) & full).cast("long").alias("vp"), F.lit(0).cast("long").alias("vn"), F.lit(edits).cast("long").alias("d"))
        distance = F.aggregate(F.sequence(F.lit(0), m - 1), start, column, lambda s: s["d"])
        return F.when(n - m > edits, F.lit(False)).when(m == 0, F.lit(True)).otherwise(distance <= edits)

    def cut(pair: Column) -> Column:
        """The lines reversed, without what both begin with; done twice they are the right way round and lack what both end with, too."""
        at = same_start(pair["long"], pair["short"])
        return F.struct(*(F.reverse(F.substring(pair[c], at + 1, F.length(pair[c]))).alias(c) for c in ("long", "short")))

    a_long = F.length(a) >= F.length(b)
    pair = F.struct(F.when(a_long, a).otherwise(b).alias("long"), F.when(a_long, b).otherwise(a).alias("short"))
    middle = F.transform(F.transform(F.array(pair), cut), cut)
    return F.get(F.transform(F.transform(middle, lambda x: F.struct(F.split(x["long"], "").alias("long"), F.split(x["short"], "").alias("short"))), compare), F.lit(0))


def same_start(a: Column, b: Column) -> Column:
    """How many code points two lines have in common at their start, by halving steps."""
    n = F.least(F.length(a), F.length(b))
    steps = F.transform(F.sequence(F.floor(F.log2(n + 1)).cast("int"), F.lit(0)), lambda k: F.call_function("shiftleft", F.lit(1), k))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= n) & (F.substring(a, at + 1, step) == F.substring(b, at + 1, step)), at + step).otherwise(at))


def close(r: Column, p: Column) -> Column:
    """Whether an indexed line and a probing one can be linked: lengths differ by at most EDITS, masks in at most 2 * EDITS bits."""
    return (r["rid"] != p["rid"]) & (p["chars"] - r["chars"]).between(0, EDITS) & (F.bit_count(r["mask"].bitwiseXOR(p["mask"])) <= 2 * EDITS)


def cells(members: DataFrame, side: Column, folder: str, name: str) -> DataFrame:
    """(key, index, probes): the members of a key in two arrays; every indexed one meets every other one in exactly one row.

    ``side``: into how many parts an aggregate over a key's members cuts them; a row holds one part of either kind. Keys of several parts
    are stored in the work folder under ``name``.
    """
    crowded = work_table(members.groupBy("key").agg(side.cast("int").alias("side")).where("side > 1"), name, folder)
    line = F.struct(*(c for c in members.columns if c != "key"))
    placed = members.join(checked_broadcast(crowded), "key", "left").select(
        "key", line.alias("line"), "indexed", F.coalesce("side", F.lit(1)).alias("side")).withColumn("own", F.pmod(F.xxhash64("line.rid"), "side").cast("int"))

    def spot(i: Column, j: Column, index: Column, probe: Column) -> Column:
        return F.struct(i.alias("i"), j.alias("j"), index.alias("index"), probe.alias("probe"))

    own, yes, no = F.col("own"), F.lit(True), F.lit(False)
    others = F.filter(F.sequence(F.lit(0), F.col("side") - 1), lambda o: o != own)
    away = F.flatten(F.transform(others, lambda o: F.array(spot(own, o, F.col("indexed"), no), spot(o, own, no, yes))))
    at_home = F.array(spot(own, own, F.col("indexed"), yes))
    spots = placed.select("key", "line", F.inline(F.when(F.col("side") == 1, at_home).otherwise(F.concat(at_home, away)))).where("index OR probe")
    met = spots.groupBy("key", "i", "j").agg(
        F.collect_list(F.when(F.col("index"), F.col("line"))).alias("index"), F.collect_list(F.when(F.col("probe"), F.col("line"))).alias("probes"))
    return met.where((F.size("index") > 0) & (F.size("probes") > 0)).select("key", "index", "probes")


def links(docs: DataFrame) -> DataFrame:
    """``compared_links`` as a table; what led to it is removed, with the shuffle files."""
    with work_folder(docs.sparkSession, "line-links") as folder:
        found = work_table(compared_links(docs, folder), "links")
    release_shuffles(docs.sparkSession)
    return found


def compared_links(docs: DataFrame, folder: str) -> DataFrame:
    """(rid, least, links) of the lines with another line within EDITS edits: the first place (doc_id, row, pos) where one stands, and how many there are.

    Lines are compared inside the cells and counted there, so no row is made for a pair. Two lines that meet under several keys
    are compared under the least of them only: each line brings all keys it has. Texts join in for lines with a shared key, and
    go into cells for those that are ``close`` to another one under it.
    """
    with work_folder(docs.sparkSession, "line-keys") as keys_folder:  # the largest of the tables
        rows = work_table(key_rows(exploded(docs).where(F.col("chars") >= MIN_CHARS)).select("key", "rid", "indexed"), "key-rows", keys_folder)
        met = rows.groupBy("key").agg(F.min("rid").alias("low"), F.max("rid").alias("high"), F.max("indexed").alias("indexed"))
        shared = work_table(met.where("low < high AND indexed").select("key"), "shared-keys", keys_folder)
        release_shuffles(docs.sparkSession)
        sharing = work_table(rows.join(checked_broadcast(shared), "key").groupBy("key", "rid").agg(F.max("indexed").alias("indexed")), "sharing", folder)
    wanted = work_table(sharing.select("rid").distinct(), "wanted", folder)
    release_shuffles(docs.sparkSession)
    texts = exploded(docs).join(checked_broadcast(wanted), "rid").groupBy("rid").agg(
        F.min("line").alias("line"), F.min("chars").alias("chars"), F.min(F.struct("doc_id", "row", "pos")).alias("first"))
    texts = work_table(texts.withColumn("mask", mask(F.col("line"))), "texts", folder)
    members = work_table(sharing.join(texts.select("rid", "chars", "mask"), "rid"), "members", folder)
    release_shuffles(docs.sparkSession)
    probing = F.filter("probes", lambda p: F.exists("index", lambda r: close(r, p)))
    indexed = F.filter("index", lambda r: F.exists("probes", lambda p: close(r, p)))
    near = cells(members, F.ceil(F.count(F.lit(1)) / CELL), folder, "crowded-masks").select("key", F.explode(F.concat(probing, indexed)).alias("line"))
    near = work_table(near.select("key", "line.rid", "line.indexed").distinct(), "candidates", folder)
    release_shuffles(docs.sparkSession)

    compared = texts.join(near.select("rid").distinct(), "rid", "left_semi")
    keys = key_rows(compared).groupBy("rid").agg(F.collect_set("key").alias("keys"), F.collect_set(F.when(F.col("indexed"), F.col("key"))).alias("own"))
    members = near.join(texts, "rid").join(keys, "rid").withColumn("before", F.filter("own", lambda k: k < F.col("key"))).drop("own")
    side = F.ceil(F.greatest(F.count(F.lit(1)) / TEXT_CELL, F.sum("chars") / CELL_CHARS))

    def linked(r: Column, p: Column) -> Column:
        return F.when(close(r, p) & ~F.arrays_overlap(r["before"], p["keys"]), within(r["line"], p["line"])).otherwise(False)

    def verdict(line: Column, hits: Column) -> Column:
        return F.struct(line["rid"].alias("rid"), F.array_min(F.transform(hits, lambda x: x["first"])).alias("least"), F.size(hits).cast("long").alias("links"))

    # a probing line with the indexed ones that are linked to it
    hits = F.transform("probes", lambda p: F.struct(p.alias("line"), F.filter("index", lambda r: linked(r, p)).alias("hits")))
    judged = cells(work_table(members, "compared-members", folder), side, folder, "crowded-texts").select("index", F.filter(hits, lambda h: F.size(h["hits"]) > 0).alias("found"))
    judged = work_table(judged.where(F.size("found") > 0).select(
        F.transform("index", lambda r: F.struct(r["rid"].alias("rid"), r["chars"].alias("chars"))).alias("index"),
        F.transform("found", lambda h: verdict(h["line"], h["hits"])).alias("by_probe"),
        F.transform("found", lambda h: F.struct(h["line"]["chars"].alias("chars"), h["line"]["first"].alias("first"), F.transform(h["hits"], lambda r: r["rid"]).alias("rids"))).alias("found")), "judged", folder)
    # lines of one length meet twice, once in either role; a longer line only probes, so the shorter one takes its verdict from there
    by_index = F.transform("index", lambda r: verdict(r, F.filter("found", lambda h: (h["chars"] > r["chars"]) & F.array_contains(h["rids"], r["rid"]))))
    verdicts = judged.select(F.inline(F.filter(F.concat("by_probe", by_index), lambda v: v["links"] > 0)))
    return verdicts.groupBy("rid").agg(F.min("least").alias("least"), F.sum("links").alias("links"))


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, text without its repeated lines, n_lines, n_removed, n_links (lines linked to the document's lines), and ``source``, the row as it came."""
    lines = exploded(docs)
    repeated = lines.groupBy("rid").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("rid")
    linked = links(docs)
    concerned = work_table(repeated.unionByName(linked.select("rid")).distinct(), "concerned")
    places = work_table(lines.select("doc_id", "row", "pos", "rid").join(checked_broadcast(concerned), "rid"), "places")
    release_shuffles(docs.sparkSession)
    judged = places.groupBy("rid").agg(F.min(F.struct("doc_id", "row", "pos")).alias("first")).join(linked, "rid", "left").select(
        "rid", "first", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce(F.col("least") < F.col("first"), F.lit(False)).alias("late"))
    hits = places.join(checked_broadcast(work_table(judged, "verdicts")), "rid")
    gone = F.col("late") | ~F.struct("doc_id", "row", "pos").eqNullSafe(F.col("first"))
    by_row = hits.groupBy("row", "pos").agg(F.max(gone).alias("gone"), F.max("links").alias("links")).groupBy("row").agg(
        F.collect_list(F.when(F.col("gone"), F.col("pos"))).alias("removed"), F.sum("links").alias("n_links"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.struct("*").alias("source"))
    rows = given.withColumn("row", F.xxhash64("doc_id", "text")).join(by_row, "row", "left").select(
        "doc_id", "text", "source", F.split("text", "\n", -1).alias("lines"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "removed")
    return rows.select(
        "doc_id", F.when(F.size("removed") == 0, F.col("text")).otherwise(F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")).alias("text"),
        F.size("lines").cast("long").alias("n_lines"), F.size("removed").cast("long").alias("n_removed"), "n_links", "source")
