"""Token ids of whole texts with a public tokenizer, encoding each distinct run between blanks once per worker."""

from __future__ import annotations

import codecs
import functools
import json
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import id_text

# Unicode white space as the split pattern of byte-level BPE sees it.
BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CHUNK = re.compile(f"[{BLANK}]+(?![^{BLANK}])| ?[^{BLANK}]+|[{BLANK}]+")
WHITE = re.compile(r"\s")

LETTERS = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]+")
LETTERS_MARKS = re.compile(f"({LETTERS.pattern})([!-&(-/:-@[-`{{-~]+)")  # no apostrophe: the split pattern ties some letters to it
MARKS = "".join(c for c in map(chr, range(128)) if LETTERS_MARKS.fullmatch("a" + c))

MEMO_ENTRIES = 200_000  # a generation
PART_ENTRIES = 500_000
SLICE_BYTES = 8_000_000
WORDS_AT_ONCE = 16


def tokenizer_json(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


class Memo(dict):
    """Key -> ``work(key)`` in two generations of ``entries`` each, so a worker's memory is bounded.

    When the younger is full it becomes the older and the older goes; what is asked for again moves back, so frequent keys stay.
    """

    def __init__(self, work, entries: int):
        self.work, self.entries, self.older = work, entries, {}

    def __missing__(self, key):
        value = self.older.get(key)
        self.put(key, self.work(key) if value is None else value)
        return self[key]

    def put(self, key, value) -> None:
        if len(self) >= self.entries:
            self.older = dict(self)
            self.clear()
        self[key] = value


class SeenTwice(Memo):
    """Keeps what is asked for twice. What was asked for once waits in two generations of a quarter of the entries, so rare keys, of
    which texts have most, drive out no frequent ones and hold little memory."""

    def __init__(self, work, entries: int):
        super().__init__(work, entries)
        self.once, self.once_older = {}, {}

    def __missing__(self, key):
        for held in (self.older, self.once, self.once_older):
            value = held.get(key)
            if value is not None:
                self.put(key, value)
                return value
        value = self.work(key)
        if len(self.once) >= self.entries // 4:
            self.once, self.once_older = {}, self.once
        self.once[key] = value
        return value


class PartTable:
    """Part -> ids as Arrow columns, for many parts at once; of more than ``entries`` those seen most stay, what was seen long ago counts less."""

    def __init__(self, work, entries: int):
        self.work, self.entries = work, entries
        self.keys, self.values, self.seen = pa.array([], pa.string()), pa.array([], pa.binary()), np.zeros(0)

    def look_up(self, keys: pa.Array, n: np.ndarray) -> pa.Array:
        """Values of different ``keys``, each seen ``n`` times."""
        at = pc.index_in(keys, value_set=self.keys)
        missing = at.is_null().to_numpy(zero_copy_only=False)
        new = keys.filter(pa.array(missing))
        place = at.fill_null(0).to_numpy().astype(np.int64)
        place[missing] = len(self.keys) + np.arange(len(new))
        self.keys, self.values = pa.concat_arrays([self.keys, new]), pa.concat_arrays([self.values, self.work(new)])
        self.seen = np.concatenate([self.seen, np.zeros(len(new))])
        self.seen[place] += n
        found = self.values.take(pa.array(place))
        if len(self.keys) > self.entries:
            kept = np.sort(np.argpartition(-self.seen, self.entries)[: self.entries])
            self.keys, self.values, self.seen = self.keys.take(pa.array(kept)), self.values.take(pa.array(kept)), self.seen[kept] / 2
        return found


@functools.lru_cache(maxsize=64)
def packer(n: int) -> struct.Struct:
    return struct.Struct(f"<{n}I")


def packed(ids: list[int]) -> bytes:
    return packer(len(ids)).pack(*ids)


class ChunkEncoder:
    """The library encodes each distinct chunk once.

    The split pattern of byte-level BPE never joins text across the border of a chunk (a run of other characters with
    the one blank before it, or the rest of a run of white space), so the chunks' ids in order are the text's ids.
    Added tokens can reach across borders; texts that hold one go to the library whole.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # fixed values: bytes that stand for themselves
        hidden = [b for b in range(256) if b not in visible]
        byte_names = {b: 256 + i for i, b in enumerate(hidden)}
        self.byte_names = "".join(chr(byte_names.get(b, b)) for b in range(256))
        self.bare = SeenTwice(self.chunk, MEMO_ENTRIES)
        self.after_blank = SeenTwice(self.part, MEMO_ENTRIES)
        self.table = PartTable(self.parts, PART_ENTRIES)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens_word[[i for token, i in vocabulary.items() if token.startswith(self.byte_names[32])]] = True
        letters = "".join(c for c in map(chr, range(0x250)) if LETTERS.fullmatch(c))
        of_words = set(self.named(letters + " "))
        merges = (m.split(" ") if isinstance(m, str) else m for m in json.loads(definition)["model"]["merges"])
        joining = any(self.byte_names[32] in right and of_words.issuperset(left + right) for left, right in merges)
        self.words_at_once = 1 if joining else WORDS_AT_ONCE

    def named(self, text: str) -> str:
        return codecs.charmap_decode(text.encode(), "strict", self.byte_names)[0]

    def word(self, text: str) -> bytes:
        """A run of letters, with the blank before it or not, is one word of the split: the library's model takes it as it is."""
        return packed([t.id for t in self.model.tokenize(self.named(text))])

    def words(self, texts: list[str]) -> pa.Array:
        """Runs of letters, each behind a blank. No merge leads from one to the next, so the model takes some at once; only first ids have the blank."""
        named = self.named("".join(f" {text}\n" for text in texts)).split(self.byte_names[10])
        ids: list[int] = []
        for k in range(0, len(texts), self.words_at_once):
            ids += [t.id for t in self.model.tokenize("".join(named[k : k + self.words_at_once]))]
        data = np.array(ids, "<u4")
        return binary_rows(data, np.append(np.flatnonzero(self.opens_word[data]), len(data)))

    def parts(self, texts: pa.Array) -> pa.Array:
        """As ``part`` for each text."""
        is_word = letters_only(texts)
        order = np.argsort(~is_word, kind="stable")
        others = [self.part(text) for text in strings(texts.filter(pa.array(~is_word)))]
        found = pa.concat_arrays([self.words(strings(texts.filter(pa.array(is_word)))), pa.array(others, pa.binary())])
        return found.take(pa.array(np.argsort(order)))

    def chunk(self, text: str) -> bytes:
        if LETTERS.fullmatch(text):
            return self.word(text)
        if found := LETTERS_MARKS.fullmatch(text):
            return self.bare[found[1]] + self.bare[found[2]]
        return self.whole(text)

    def part(self, text: str) -> bytes | None:
        """What stands behind a blank, or a line end and what follows it; None if white space is not single blanks and line ends."""
        if LETTERS.fullmatch(text):
            return self.word(" " + text)
        if found := LETTERS_MARKS.fullmatch(text):
            return self.after_blank[found[1]] + self.bare[found[2]]
        if WHITE.search(text, 1) or text in ("", "\n"):
            return None
        if text[0] == "\n":
            return self.bare["\n"] + self.bare[text[1:]]
        return None if text[0].isspace() else self.whole(" " + text)

    def whole(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self.whole(text)
        first, *rest = text.replace("\n", " \n").split(" ")
        if first and not WHITE.search(first):
            found = [self.bare[first], *map(self.after_blank.__getitem__, rest)]
            try:
                return b"".join(found)
            except TypeError:  # None: white space is uneven
                pass
        return b"".join(map(self.bare.__getitem__, CHUNK.findall(text)))

    def look_up(self, parts: pa.Array, n: np.ndarray) -> pa.Array:
        """Ids of different parts, each seen ``n`` times; marks behind letters apart from these. Null where ``part`` gives None."""
        stems = pc.utf8_rtrim(parts, MARKS)
        marked = np.flatnonzero(pc.binary_length(stems).to_numpy() < pc.binary_length(parts).to_numpy())
        marked = marked[letters_only(stems.take(pa.array(marked)))]
        is_marked = np.zeros(len(parts), bool)
        is_marked[marked] = True
        keys = pc.if_else(pa.array(is_marked), stems, parts).dictionary_encode()
        found = self.table.look_up(keys.dictionary, np.bincount(keys.indices.to_numpy(), n, len(keys.dictionary))).take(keys.indices)
        tails = np.full(len(parts), b"", object)
        tails[marked] = [self.bare[part[len(stem):]] for part, stem in zip(strings(parts.take(pa.array(marked))), strings(stems.take(pa.array(marked))))]
        return pc.binary_join_element_wise(found, pa.array(tails, pa.binary()), b"")

    def encode_all(self, texts: pa.Array, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, ``end`` behind each, and where each text's begin (and the last one's end).

        Arrow splits the texts and tells the parts apart, so the table is asked once for each different part and not for every one.
        """
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        sizes = pc.list_value_length(parts).to_numpy()  # at least one part a text
        flat, starts = parts.flatten(), np.cumsum(sizes) - sizes
        behind_blank = np.ones(len(flat), bool)
        behind_blank[starts] = False
        found = flat.filter(pa.array(behind_blank)).dictionary_encode()
        codes, owner = found.indices.to_numpy(), np.repeat(np.arange(len(texts)), sizes - 1)
        values = self.look_up(found.dictionary, np.bincount(codes, minlength=len(found.dictionary)))
        one_by_one = np.zeros(len(texts), bool)
        one_by_one[owner[values.is_null().to_numpy(zero_copy_only=False)[codes]]] = True  # white space is uneven
        for special in self.special:
            one_by_one |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        heads = strings(flat.take(pa.array(starts)))
        for i, head in enumerate(heads):
            one_by_one[i] |= not head or WHITE.search(head) is not None
            heads[i] = self.encode(texts[i].as_py()) if one_by_one[i] else self.bare[head]
        sizes = np.where(one_by_one, 2, sizes + 1)  # the head, the other parts, the end
        ends = np.cumsum(sizes)
        order = np.full(ends[-1], len(values) + len(heads))
        behind_blank = np.ones(len(order), bool)
        behind_blank[ends - 1] = behind_blank[ends - sizes] = False
        order[ends - sizes] = len(values) + np.arange(len(heads))
        order[behind_blank] = codes[~one_by_one[owner]]
        pool = pa.concat_arrays([values, pa.array([*heads, end], pa.binary())])
        return flat_binary(pool.take(pa.array(order)), "<u4", np.concatenate([[0], ends]))


def letters_only(column: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(column, rf"\A(?:{LETTERS.pattern})\z").to_numpy(zero_copy_only=False)


def strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def flat_binary(column: pa.Array, width: str, rows: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The integers of ``width`` in all rows one after the other, and where those of ``rows`` (each one, and the end) begin."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    size = np.dtype(width).itemsize
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].view(width)
    return data, (offsets if rows is None else offsets[rows]) // size - offsets[0] // size


def binary_rows(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Rows of integers one after the other as binary values."""
    offsets = (bounds * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def text_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in runs of about SLICE_BYTES of text (second column)."""
    which = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(), dtype=np.int64) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(which)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield batch.slice(a, b - a)


@functools.lru_cache(maxsize=2)
def worker_encoder(definition: str) -> ChunkEncoder:
    """One encoder a worker process: its memo is kept from task to task."""
    return ChunkEncoder(definition)


def encode_batches(batches: Iterator[pa.RecordBatch], definition: str, end_id: int) -> Iterator[tuple[int | None, np.ndarray]]:
    encoder = worker_encoder(definition)
    end = np.asarray([end_id], "<u4").tobytes()
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            yield doc_id.as_py(), np.frombuffer(encoder.encode(text.as_py()) + end, "<u4")


def token_rows(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """doc_id, n_tokens, ids: the document's ids and ``end_id`` as little-endian integers, 16 bits wide if the vocabulary allows, else 32.

    A null or empty text has the end id alone. Repeated rows stay repeated.
    """
    spark = docs.sparkSession
    definition = tokenizer_json(tokenizer_path)
    width = id_width(definition)
    shared = spark.sparkContext.broadcast(definition)

    def run(batches):
        encoder, end = worker_encoder(shared.value), packed([end_id])
        for batch in batches:
            for part in text_slices(batch):
                ids, bounds = encoder.encode_all(part.column(1), end)
                columns = [part.column(0), pa.array(np.diff(bounds), pa.int64()), binary_rows(ids.astype(width), bounds)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids"])

    return id_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def id_width(definition: str) -> str:
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_str(definition).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
