"""Document fingerprints from closed syncmers over words.

A window of ``K`` words is a closed syncmer if the least hash among its inner runs of ``S`` words stands at its first or its
last place. Whether a window is chosen depends on its own words alone, so the same passage has the same anchors in every
text and at every position. A word of more than ``LONG_WORD`` code points counts as so many words of one code point, so text
without blanks has anchors all along too. Among ``K`` - ``S`` windows in a row at least one is chosen, so 2 * ``K`` - ``S`` - 1
words always have an anchor; texts of fewer than ``SHORT_WORDS`` words have the syncmers of their code
points as well (blanks as one, ``K`` - 1 empty places on either side, so that the first code point alone makes an anchor).
The fingerprint is the anchors' 32-bit hashes in text order, those of words first, as hexadecimal; it is empty for a text without
words only. The likeness of two fingerprints is the share of anchors that both have among all that either has; 1 for two empty ones.

All on Spark expressions. Documents in ascending doc_id are neighbours inside buckets of consecutive ids (a window
function per bucket); a bucket of more than ``FULL`` rows is cut into equal widths of its own ids until none is left, or
all its ids are equal. Only the first document of each bucket travels to the bucket before.

Edge cases: null text counts as empty; a single document is its own next; equal doc_ids are ordered by text; a null
doc_id sorts before all others; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import SPACE_CLASS, checked_broadcast, id_text, work_table

K, S = 8, 3
LONG_WORD = 32
SHORT_WORDS = 24
BUCKET_ROWS = 4096
FULL = 4 * BUCKET_ROWS
LOWEST = -(1 << 63)


def short(hashed: Column) -> Column:
    """The upper 32 bits: half the size on the way to the neighbour."""
    return F.shiftright(hashed, 32).cast("int")


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def units(text: Column | str) -> Column:
    """The words of a text, long ones as their code points."""
    def cut(words: Column) -> Column:
        pieces = F.flatten(F.transform(words, lambda w: F.when(F.length(w) > LONG_WORD, F.split(w, "")).otherwise(F.array(w))))
        return F.when(F.exists(words, lambda w: F.length(w) > LONG_WORD), pieces).otherwise(words)

    return bound(F.array_remove(F.split(text, SPACE_CLASS), ""), cut)


def syncmers(w: Column) -> Column:
    """Hashes of the chosen windows of an array of strings, in order."""
    runs = F.transform(F.sequence(F.lit(1), F.size(w) - (S - 1)), lambda i: F.xxhash64(F.slice(w, i, S)))
    places = K - S + 1

    def chosen(h: Column) -> Column:
        def edge(i: Column) -> Column:
            return F.least(*(F.get(h, i + k) for k in range(places))) == F.least(F.get(h, i), F.get(h, i + places - 1))

        starts = F.filter(F.sequence(F.lit(0), F.size(w) - K), edge)
        return F.transform(starts, lambda i: short(F.xxhash64(F.get(h, i), F.get(h, i + S), F.get(h, i + places - 1))))

    return F.when(F.size(w) < K, F.array().cast("array<int>")).otherwise(bound(runs, chosen))


def anchors(text: Column | str) -> Column:
    """Anchor hashes in text order: those of the words, then for short texts those of the code points."""
    beside = F.array_repeat(F.lit(""), K - 1)

    def pick(w: Column) -> Column:
        letters = bound(F.concat(beside, F.split(F.array_join(w, " "), ""), beside), syncmers)
        return F.concat(syncmers(w), F.when(F.size(w).between(1, SHORT_WORDS - 1), letters).otherwise(F.array().cast("array<int>")))

    return bound(units(text), pick)


def fingerprint(found: Column | str) -> Column:
    return F.array_join(F.transform(found, lambda h: F.lpad(F.lower(F.hex(h.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: str, b: str) -> Column:
    """Shared anchors among all anchors of two distinct-anchor arrays."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def with_buckets(docs: DataFrame) -> DataFrame:
    """``docs`` with the number of their bucket, which is not above any doc_id in it; null doc_ids are in the lowest one."""
    rows = docs.withColumn("bucket", F.lit(LOWEST))
    while True:
        spans = rows.groupBy("bucket").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("doc_id").alias("n"))
        width = F.floor((F.col("high").cast("decimal(20,0)") - F.col("low")) / F.ceil(F.col("n") / BUCKET_ROWS)).cast("long") + 1
        cuts = work_table(spans.where((F.col("n") > FULL) & (F.col("low") < F.col("high"))).select("bucket", "low", width.alias("width")), "buckets")
        if not cuts.limit(1).count():
            return rows
        # remainders first, so that differences of far ids cannot overflow
        offset = F.pmod(F.pmod("doc_id", "width") - F.pmod("low", "width"), F.col("width"))
        rows = rows.join(checked_broadcast(cuts), "bucket", "left").withColumn(
            "bucket", F.coalesce(F.col("doc_id") - offset, F.col("bucket"))).drop("low", "width")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, anchors and the same of the document with the next doc_id; the last one's next is the first."""
    docs = with_buckets(docs)
    bucket = F.col("bucket")
    rows = docs.select(bucket.alias("bucket"), F.lit(0).alias("sentinel"), "doc_id", "text", anchors("text").alias("anchors"))
    heads = docs.groupBy(bucket.alias("bucket")).agg(F.min(F.struct("doc_id", "text")).alias("head"))
    order = Window.orderBy("next_bucket")  # one row per bucket
    before = heads.select(F.col("bucket").alias("next_bucket")).withColumn("bucket", F.coalesce(
        F.lag("next_bucket").over(order), F.max("next_bucket").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    sentinels = before.join(heads.withColumnRenamed("bucket", "next_bucket"), "next_bucket").select(
        "bucket", F.lit(1).alias("sentinel"), "head.doc_id", "head.text", anchors("head.text").alias("anchors"))
    inside = Window.partitionBy("bucket").orderBy("sentinel", "doc_id", "text")
    following = F.lead(F.struct("text", "anchors")).over(inside)
    return rows.unionByName(sentinels).withColumn("following", following).where("sentinel = 0").select(
        "doc_id", "text", "anchors", F.col("following.text").alias("next_text"), F.col("following.anchors").alias("next_anchors"))


def edited(text: str, following: str) -> Column:
    """The last quarter of the code points replaced by as many of the following text's first ones, or all it has."""
    cut = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.expr(f"substring({text}, 1, length({text}) - int(floor(length({text}) / 4)))"),
                    F.when(cut > 0, F.substring(following, F.lit(1), cut)).otherwise(""))


def compare_with_next(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = with_next(id_text(docs)).withColumn("edited", edited("text", "next_text"))
    rows = rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "anchors", "next_anchors", anchors("edited").alias("edited_anchors"))
    sets = rows.select("*", *(F.array_distinct(c).alias(f"set_{c}") for c in ("anchors", "edited_anchors", "next_anchors")))
    return sets.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint("anchors").alias("fingerprint"),
        fingerprint("edited_anchors").alias("edited_fingerprint"),
        likeness("set_anchors", "set_edited_anchors").alias("near_edited"), likeness("set_anchors", "set_next_anchors").alias("near_next"))
