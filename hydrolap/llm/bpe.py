"""BPE encoding by prefix-sharing trie traversal, and decoding.

Byte-pair encoding has a local form: tokens t1..tn are the encoding of a word exactly if every neighbouring pair
(ti, ti+1) is the encoding of its own two strings. So the encoding of a prefix is known by its last token, and by
the last token of the prefix before that. The distinct words of a slice of texts go into a trie; a depth-first walk
gives every node its last token from those of its ancestors, so a shared prefix is worked out once. A word is read
off backwards from its end node.

Words end in the model's end-of-word mark, so a word's last character is a symbol of its own ("x</w>").

Edge cases: null text counts as empty and has no tokens (0, and the digests of the empty string); repeated rows
are encoded each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import codecs
import functools
import gc
import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text
from .tokens import BLANK, Memo, tokenizer_json

SLICE_CHARS = 4_000_000
MEMO_ENTRIES = 350_000  # a generation


class TrieBpe:
    """Merge rules and the pair test; ``encode_words`` walks one trie."""

    def __init__(self, model: dict):
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {pair: i for i, pair in enumerate(pairs)}
        self.longest = max(len(t) for t in self.vocab)
        self._whole: dict[str, bool | None] = dict.fromkeys(self.vocab)  # None: not asked for yet
        self.size = functools.cache(lambda token: len(self.symbols(token)))  # of tokens of the vocabulary only
        self._pair = Memo(lambda pair: self.merge(self.symbols(pair[0]) + self.symbols(pair[1])) == [*pair], MEMO_ENTRIES)

    def symbols(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def merge(self, symbols: list[str]) -> list[str]:
        """Merges by rank, leftmost first: only for single tokens and pairs, which are short."""
        parts = list(symbols)
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def is_token(self, text: str) -> bool:
        """In the vocabulary and the encoding of its own string."""
        known = self._whole.get(text, False)
        if known is None:
            known = self._whole[text] = self.merge(self.symbols(text)) == [text]
        return known

    def last_token(self, path: str, mark: str, lasts: list[str]) -> str:
        """Last token of the prefix ``path`` (closed by ``mark``); ``lasts[d]`` is that of its first d symbols."""
        n, whole, closed = len(path), self._whole, path + mark
        for k in range(max(0, n - self.longest), n):
            token = closed[k:]
            known = whole.get(token, False)
            if known is not False and (known or self.is_token(token)) and (k == 0 or self._pair[lasts[k], token]):
                return token
        raise ValueError(f"no token ends {path!r}")

    def encode_words(self, words: set[str]) -> dict[str, list[str]]:
        root: dict = {}
        for word in words:
            node = root
            for c in word[:-1]:
                below = node.get(c)
                if below is None:
                    below = node[c] = {}
                node = below
            node.setdefault(word[-1] + self.end, True) if self.end else node.setdefault(word[-1], {}).setdefault("", True)
        out: dict[str, list[str]] = {}
        lasts = [""]
        stack = [("", root, 0)]
        while stack:
            path, node, depth = stack.pop()
            del lasts[depth + (depth == 0):]
            if depth:
                lasts.append(self.last_token(path, "", lasts))
            for edge, child in node.items():
                if child is not True:
                    stack.append((path + edge, child, depth + 1))
                    continue
                word = path + (edge[: -len(self.end)] if self.end else "")
                token = self.last_token(word, self.end, lasts) if self.end else lasts[-1]
                tokens, at = [token], len(word) - self.size(token)
                while at > 0:
                    tokens.append(lasts[at])
                    at -= self.size(lasts[at])
                out[word] = tokens[::-1]
        return out


class TextCodec:
    """Texts to ids and back: added tokens, the definition's normalizer and word split, then the trie."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.parts = Tokenizer.from_str(definition)
        spec = json.loads(definition)
        self.bpe = TrieBpe(spec["model"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.names = {i: t for t, i in (*self.bpe.vocab.items(), *self.special.items())}
        visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # fixed values: bytes that stand for themselves
        hidden = [b for b in range(256) if b not in visible]
        byte_names = {b: 256 + i for i, b in enumerate(hidden)}
        self.byte_names = "".join(chr(byte_names.get(b, b)) for b in range(256))
        self.words = Memo(lambda word: self.encoded([word])[word], MEMO_ENTRIES)  # number of ids, ids as text, decoded text
        self.chunks = Memo(lambda chunk: self.joined(map(self.words.__getitem__, self.words_of(chunk))), MEMO_ENTRIES)

    def bytes_of(self, word: str) -> str:
        """A character for each byte, as byte-level tokenizers write them."""
        return word if word.isascii() else codecs.charmap_decode(word.encode(), "strict", self.byte_names)[0]

    def words_of(self, chunk: str) -> list[str]:
        """Added tokens stay as they are; the rest is normalized and split into byte-level words."""
        if PLAIN.fullmatch(chunk):
            if chunk.isalpha():
                return [self.bytes_of(chunk.lower())]
            if chunk[:-1].isalpha() and chunk[-1] in ",.!?:;":
                return [self.bytes_of(chunk[:-1].lower()), chunk[-1]]
        out = []
        for piece in self.cut.split(chunk) if self.cut else [chunk]:
            if piece in self.special:
                out.append(piece)
            elif piece:
                out += [w for w, _ in self.parts.pre_tokenizer.pre_tokenize_str(self.parts.normalizer.normalize_str(piece))]
        return out

    def encoded(self, words: Iterable[str]) -> dict[str, tuple[int, str, str]]:
        """One trie over ``words``."""
        collecting = gc.isenabled()
        gc.disable()  # a trie is many objects and no cycles: the collector would go through all of them again and again
        try:
            known = self.bpe.encode_words({w for w in words if w not in self.special})
        finally:
            if collecting:
                gc.enable()
        out = {w: [self.bpe.vocab[t] for t in tokens] for w, tokens in known.items()} | {w: [self.special[w]] for w in words if w in self.special}
        return {w: (len(ids), " ".join(map(str, ids)), self.decode(ids)) for w, ids in out.items()}

    @staticmethod
    def joined(parts: Iterable[tuple[int, str, str]]) -> tuple[int, str, str]:
        found = [x for x in parts if x[0]]
        if len(found) < 2:
            return found[0] if found else (0, "", "")
        n, ids, texts = zip(*found)
        return sum(n), " ".join(ids), " ".join(texts)

    def learn(self, chunks: set[str]) -> None:
        """Words that no memo holds are encoded together, so that they share a trie."""
        fresh = {c: self.words_of(c) for c in chunks if c not in self.chunks and c not in self.chunks.older}
        unknown = {w for words in fresh.values() for w in words if w not in self.words and w not in self.words.older}
        for word, value in self.encoded(unknown).items():
            self.words.put(word, value)
        for chunk, words in fresh.items():
            self.chunks.put(chunk, self.words[words[0]] if len(words) == 1 else self.joined(map(self.words.__getitem__, words)))

    def decode(self, ids: list[int]) -> str:
        """The definition names no decoder: tokens in order, one blank between."""
        return " ".join(self.names[i] for i in ids)

    def digest(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """(number of ids, ids as text, decoded text) of each text; white space only separates words."""
        self.learn({c for t in texts for c in blanks(t)})
        for t in texts:
            yield self.joined(map(self.chunks.__getitem__, blanks(t)))


@functools.lru_cache(maxsize=2)
def worker_codec(definition: str) -> TextCodec:
    """One codec a worker process: its memos are kept from task to task."""
    return TextCodec(definition)


ODD = re.compile("[\x1c-\x1f]")
PLAIN = re.compile(r"[\x21-\x26\x28-\u012f\u0131-\u02ff]+")  # no apostrophe, no combining mark: lower case is all there is to normalize


def blanks(text: str) -> list[str]:
    """Split at Unicode white space; the four separators that only Python counts as white space stay in their words."""
    return text.split() if not ODD.search(text) else [x for x in re.split(f"[{BLANK}]+", text) if x]


def slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Rows of a batch in runs of about SLICE_CHARS characters, so that what is held at once is bounded."""
    ids, texts, size = [], [], 0
    for doc_id, text in zip(batch.column(0), batch.column(1)):
        t = text.as_py()
        ids.append(doc_id.as_py())
        texts.append(t)
        size += len(t)
        if size > SLICE_CHARS:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def round_trip(docs: DataFrame, tokenizer_path: str, keep_text: bool = True) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text; with ``keep_text`` also both texts themselves."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json(tokenizer_path))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids string, decoded string" * keep_text

    def run(batches):
        codec = worker_codec(shared.value)
        for batch in batches:
            for ids, texts in slices(batch):
                rows = [(n, sha256(a), sha256(b), *((a, b) if keep_text else ())) for n, a, b in codec.digest(texts)]
                columns = [pa.array(ids, pa.int64()), *(pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), *[pa.string()] * 4]))]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    return id_text(docs).mapInArrow(run, schema)
