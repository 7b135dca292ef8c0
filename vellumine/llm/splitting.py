"""Problem 1: oversized texts cut into pieces at natural boundaries, with overlap."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumine.llm.chars import WHITE_SPACE, WS_CLASS

MAX_TOKENS, MAX_CHARS, OVERLAP = 800, 6000, 60
TOKEN = re.compile("[^" + "".join(map(re.escape, map(chr, WHITE_SPACE))) + "]+")
#: Strongest first; each pattern's match END is a place where a piece may begin.
BOUNDARIES = (
    ("heading", re.compile(r"(?:^|(?<=[\n\r]))(?=#{1,6}\s)")),
    ("paragraph", re.compile(r"(?:\r\n|\n|\r)[^\S\n\r]*(?:\r\n|\n|\r)\s*")),
    ("row", re.compile(r"(?:\r\n|\n|\r)(?=[^\S\n\r]*[|│])|</tr>\s*", re.I)),
    ("sentence", re.compile(r"[.!?…][\"'”»)\]]*\s+|[。！？]+[」』）]*\s*")),
    ("line", re.compile(r"(?:\r\n|\n|\r| | |\x85)\s*")),
)


def oversized(text: Column, max_tokens: int = MAX_TOKENS, max_chars: int = MAX_CHARS) -> Column:
    """True for texts beyond either limit. Tokens are counted only where the length allows too many."""
    many = F.regexp_count(text, F.lit(f"[^{WS_CLASS}]+")) > max_tokens
    return F.when(F.length(text) > max_chars, True).when(F.length(text) > 2 * max_tokens, many).otherwise(False)


def split_text(text: str, max_tokens: int = MAX_TOKENS, max_chars: int = MAX_CHARS, overlap: int = OVERLAP) -> list[tuple[int, int, int, str]]:
    """(char_start, char_end, tokens, strategy) of each piece.

    Token offsets and, for each kind of boundary, the sorted indexes of tokens that follow one are kept as
    arrays. A piece that starts at token i ends at the last boundary, strongest kind first, in its second half
    under the limit, found by binary search; then at any boundary; else by a hard cut between tokens
    ("token-window"), or inside a token longer than the limit ("hard-cut"). The next piece steps back by up to
    `overlap` tokens, to a boundary in that range if there is one. Every token is in some piece.
    """
    if max_tokens < 1 or max_chars < 1 or overlap < 0:
        raise ValueError("limits must be positive")
    spans = [m.span() for m in TOKEN.finditer(text)]
    if not spans:  # only white space
        return [(a, min(a + max_chars, len(text)), 0, "hard-cut") for a in range(0, len(text), max_chars)] if len(text) > max_chars else []
    tokens: list[tuple[int, int, bool]] = []  # tokens longer than the limit come apart
    for a, b in spans:
        for c in range(a, b, max_chars):
            tokens.append((c, min(b, c + max_chars), c > a))
    starts = [t[0] for t in tokens]
    n = len(tokens)
    whole = sum(1 for t in tokens if not t[2])
    if whole <= max_tokens and len(text) <= max_chars:
        return [(0, len(text), whole, "no-split")]
    marks: list[tuple[str, list[int]]] = []
    for kind, pattern in BOUNDARIES:
        at = sorted({bisect_left(starts, m.end()) for m in pattern.finditer(text)})
        marks.append((kind, [i for i in at if 0 < i < n]))
    # Boundaries inside a token (scripts without spaces) are only met by cutting that token.
    inner = sorted({m.end() for m in BOUNDARIES[3][1].finditer(text)})
    out, i, begin, last = [], 0, tokens[0][0], 0  # last: where the piece before ended
    while True:
        # j: first token that can't be in the piece
        j = min(n, i + max_tokens)
        j = min(j, bisect_right(tokens, begin + max_chars, lo=i, key=lambda t: t[1]))
        if j <= last and i < last:  # the overlap leaves no room for anything new
            i, begin = last, tokens[last][0]
            continue
        if j == n:
            out.append((begin, tokens[-1][1], n - i, "tail"))
            return _named(text, out)
        if j <= i or (tokens[j][1] - tokens[j][0] > max_chars // 4 and begin + max_chars - tokens[j][0] > max_chars // 4 and j - i < max_tokens):
            # the next token is very long: fill the piece with a part of it, at a sentence's end if there is one
            limit = begin + max_chars
            k = bisect_right(inner, limit) - 1
            low = max(begin + max_chars // 2, tokens[min(j, n - 1)][0])
            cut = inner[k] if k >= 0 and low < inner[k] < tokens[j][1] else limit
            out.append((begin, cut, j - i + 1, "sentence" if cut != limit else "hard-cut"))
            tokens[j] = (cut, tokens[j][1], True)
            starts[j] = cut
            i, begin, last = j, cut, j
            continue
        end, kind = j, "token-window"
        for low in (max(last + 1, i + (j - i) // 2), max(last, i) + 1):
            for name, at in marks:
                k = bisect_right(at, j) - 1
                if k >= 0 and at[k] >= low:
                    end, kind = at[k], name
                    break
            if kind != "token-window":
                break
        out.append((begin, tokens[end - 1][1], end - i, kind))
        # step back by the overlap, never to where the piece began
        low = max(i + 1, end - overlap)
        nxt = end if low >= end else low
        for name, at in marks[2:]:
            k = bisect_left(at, nxt)
            if k < len(at) and at[k] < end:
                nxt = at[k]
                break
        i, begin, last = nxt, tokens[nxt][0], end


def _named(text: str, out: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """The tail takes the name of the cut before it; parts of one long token count as one."""
    return [(a, b, len(TOKEN.findall(text, a, b)), out[x - 1][3] if s == "tail" and x else "no-split" if s == "tail" else s) for x, (a, b, _, s) in enumerate(out)]


SCHEMA = "key string, piece int, text_md string, token_count int, char_start int, char_end int, split_strategy string"
_ARROW = pa.schema([("key", pa.string()), ("piece", pa.int32()), ("text_md", pa.string()), ("token_count", pa.int32()), ("char_start", pa.int32()), ("char_end", pa.int32()), ("split_strategy", pa.string())])


def split_oversized(df: DataFrame, key: str = "chunk_id", text: str = "text_md", max_tokens: int = MAX_TOKENS, max_chars: int = MAX_CHARS, overlap: int = OVERLAP) -> DataFrame:
    """One row per piece of every text beyond a limit: key, piece (from 0), text_md, token_count, char_start, char_end, split_strategy.

    Sizes are measured on the text itself; stored counts are not read. Null, empty and blank texts within the
    limit give nothing, as do texts within both limits; a null key stays null. Repeated rows of the same key and
    text count once; a key with two different oversized texts gives the pieces of both. Other columns are ignored.
    The size test runs in the JVM, so only oversized texts reach Python.
    """
    rows = df.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).where(oversized(F.col("text"), max_tokens, max_chars))
    rows = rows.groupBy("key", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text")).select("key", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            out: list[tuple] = []
            size = 0
            for k, t in zip(keys, texts):
                pieces = split_text(t, max_tokens, max_chars, overlap)
                out += ((k, x, t[a:z], n, a, z, s) for x, (a, z, n, s) in enumerate(pieces))
                size += len(t)
                if size > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ARROW)], schema=_ARROW)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ARROW)], schema=_ARROW)

    return rows.mapInArrow(cut, SCHEMA)


def found(df: DataFrame) -> DataFrame:
    """Keys that came out in pieces."""
    return split_oversized(df).select(F.col("key").alias("chunk_id")).distinct()
