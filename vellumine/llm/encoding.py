"""Problem 6: a corpus encoded by a public byte-level BPE vocabulary, with exact merges in linear time."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumine.llm.chars import WHITE_SPACE, blocks

#: Where the vocabulary files are; byte_bpe_50k.json lies in it.
TOKENIZERS = os.environ.get("VELLUMINE_TOKENIZERS", "/opt/tokenizers")
#: Distinct words a worker remembers before it forgets them all; nothing depends on it but speed.
CACHE = 400_000
_S = "".join(f"\\u{c:04x}" for c in WHITE_SPACE)
#: Fixed value: the pattern that cuts a text into words, with white space written out.
WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+")

# The standard library's engine is twice as fast but knows no \\p{L}. It serves texts of plain letters (Latin, Cyrillic,
# Japanese), digits 0-9, white space and the punctuation below, for which its pattern says the same.
_L = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u02af\u0400-\u0481\u048a-\u0527\u3041-\u3096\u30a1-\u30fa\u30fc\u4e00-\u9fa5\u3005\u3006"
_P = r"\xa1-\xa9\xab\xac\xae-\xb1\xb4\xb6-\xb8\xbb\xbf\xd7\xf7\u2010-\u2027\u2030-\u205e\u2500-\u257f\u3001-\u3003\u3008-\u3011\uff01-\uff0f\ufffd"
_PLAIN = re.compile(rf" ?[{_L}]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^{_S}{_L}0-9]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_ASCII = re.compile(r" ?[A-Za-z]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
_OTHER = re.compile(rf"[^\x00-\x7f{_S}{_L}{_P}]")


def cut_words(text: str) -> list[str]:
    """The matches of WORDS in a text."""
    if text.isascii():
        return _ASCII.findall(text)
    return (WORDS if _OTHER.search(text) else _PLAIN).findall(text)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 stands for itself, the rest follow from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    out = {chr(b): b for b in plain}
    return out | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in out.values())}


class Encoder:
    """Backtracking BPE encoder over byte strings.

    A segmentation of a word is the one BPE makes if and only if each two neighbours in it could stay apart, that
    is, merging the bytes of both gives just these two tokens. So the longest token that matches at a place is
    tried first; if it can't follow the token before it, its next shorter prefix is, and where none can, the token
    before is taken back. Each place is left for good once, which keeps the work linear.
    """

    def __init__(self, vocabulary: bytes):
        model = json.loads(vocabulary)["model"]
        letters = byte_letters()
        raw = lambda t: bytes(letters[c] for c in t)
        special = {t["content"] for t in json.loads(vocabulary)["added_tokens"]}
        ids = {raw(t): i for t, i in model["vocab"].items() if t not in special}
        self.tokens = [b""] * (max(ids.values()) + 1)
        for t, i in ids.items():
            self.tokens[i] = t
        self.parts: dict[int, tuple[int, int]] = {}  # the two tokens that a token is merged of
        self.pairs: dict[tuple[int, int], int] = {}  # rank of the merge of two tokens
        self.rank: dict[int, int] = {}
        for r, m in enumerate(model["merges"]):
            a, b = (raw(x) for x in (m if isinstance(m, list) else m.split(" ")))
            x, y, z = ids[a], ids[b], ids[a + b]
            self.pairs[x, y] = r
            self.parts.setdefault(z, (x, y))
            self.rank.setdefault(z, r)
        self.trie = ahocorasick.Automaton()
        for t, i in ids.items():
            self.trie.add_word(t.decode("latin-1"), (len(t), i))
        self.trie.make_automaton()
        self.shorter: dict[int, int] = {}  # the longest token that is a proper prefix of a token
        for t, i in ids.items():
            for n in range(len(t) - 1, 0, -1):
                if t[:n] in ids:
                    self.shorter[i] = ids[t[:n]]
                    break
        self.ids = ids
        self.may_meet: dict[tuple[int, int], bool] = {}
        self.cache: dict[str, list[int]] = {}
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in self.tokens])])

    def compatible(self, a: int, b: int) -> bool:
        """Would BPE, given the bytes of a then b, end with just a and b? Kept in a table.

        Undoing the merges of both, latest first, shows the states that merging goes through. At each, the two
        tokens that meet at the border must not be mergeable before the later of the merges that are undone.
        """
        known = self.may_meet.get((a, b))
        if known is not None:
            return known
        x, y, before, answer = a, b, len(self.pairs), True  # merges of a rank below `before` have been done
        while True:
            r = self.pairs.get((x, y))
            if r is not None and r < before:
                answer = False
                break
            rx, ry = self.rank.get(x, -1), self.rank.get(y, -1)
            if rx < 0 and ry < 0:
                break
            # The later merge is undone. Of equal ranks the left one was done first, so the right one is undone first.
            if rx > ry:
                before, x = rx, self.parts[x][1]  # a merge at the border of rank rx would have come later, being further right
            else:
                before, y = ry + 1, self.parts[y][0]  # one of the same rank, being further left, would have come first
        if len(self.may_meet) > 2_000_000:
            self.may_meet.clear()
        self.may_meet[a, b] = answer
        return answer

    def encode_word(self, word: bytes) -> list[int]:
        n = len(word)
        whole = self.ids.get(word)
        if whole is not None and n == 1:
            return [whole]
        longest: list[int] = [-1] * n
        size = [0] * n
        for end, (k, i) in self.trie.iter(word.decode("latin-1")):
            at = end - k + 1
            if k > size[at]:
                size[at], longest[at] = k, i
        dead = bytearray(n + 1)  # places from which no way leads on
        out: list[int] = []
        at, token = 0, longest[0]
        tokens, shorter, compatible = self.tokens, self.shorter, self.compatible
        while True:
            k = len(tokens[token])
            if not dead[at + k] and (not out or compatible(out[-1], token)):
                out.append(token)
                at += k
                if at == n:
                    return out
                token = longest[at]
                continue
            token = shorter.get(token, -1)
            while token < 0:  # nothing fits here
                dead[at] = 1
                last = out.pop()
                at -= len(tokens[last])
                token = shorter.get(last, -1)

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for w in cut_words(text):
            out += self.word(w)
        return out

    def word(self, w: str) -> list[int]:
        got = self.cache.get(w)
        if got is None:
            got = self.encode_word(w.encode("utf-8"))
            if len(self.cache) >= CACHE:
                self.cache.clear()
            if len(w) <= 64:
                self.cache[w] = got
        return got

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, by the offset table."""
        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return b""
        start, size = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(size)
        return self.bytes[np.arange(ends[-1]) + np.repeat(start - (ends - size), size)].tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: bytes) -> Encoder:
    """One encoder per vocabulary and process."""
    k = hashlib.sha256(vocabulary).hexdigest()
    if k not in _encoders:
        _encoders.clear()
        _encoders[k] = Encoder(vocabulary)
    return _encoders[k]


def read_vocabulary(name: str = "byte_bpe_50k", folder: str | None = None) -> bytes:
    with open(os.path.join(folder or TOKENIZERS, f"{name}.json"), "rb") as f:
        return f.read()


def encode_corpus(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: bytes | None = None) -> DataFrame:
    """key and ids (array<int>) of every row of df: its text, unchanged, without special tokens.

    A null and an empty text both give an empty list. Every row gives a row, repeated ones and null keys too; other
    columns are ignored. The vocabulary, some 1.5 MB, is read by the driver and broadcast. No shuffle.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary or read_vocabulary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value)
        get, word, find = enc.cache.get, enc.word, cut_words
        for b in batches:
            keys, texts = b.column(0), b.column(1).to_pylist()
            for lo, hi in blocks([t or "" for t in texts], 1 << 21):
                words = [find(t) if t else () for t in texts[lo:hi]]
                lists = [[get(w) or word(w) for w in ws] for ws in words]
                counts = np.fromiter((sum(map(len, x)) for x in lists), np.int64, hi - lo)
                flat = np.fromiter(chain.from_iterable(chain.from_iterable(lists)), np.int32, int(counts.sum()))
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([keys.slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["key", "ids"])

    kind = dict(df.dtypes)[key]
    return df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode_corpus(df: DataFrame, key: str = "doc_id", ids: str = "ids", vocabulary: bytes | None = None) -> DataFrame:
    """key and text of every row of df(key, ids); bytes that are no UTF-8 become U+FFFD. A null list gives null, an empty one ''."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary or read_vocabulary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value)
        for b in batches:
            texts = [None if x is None else enc.decode(np.array(x, np.int64)).decode("utf-8", "replace") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["key", "text"])

    kind = dict(df.dtypes)[key]
    return df.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)
