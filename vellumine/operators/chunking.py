"""Token-bounded chunks of Markdown documents, by layers of boundaries, with spans and a pass that joins small ones."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumine.functions.text import WS

HEADING = re.compile(r"(?m)^(?=#+\s)")
PARAGRAPH = re.compile(r"\n\s*\n")
SENTENCE = re.compile(r"(?<=[.!?])\s+")
WORD = re.compile(r"\s+")
LINE_END = re.compile(r"\r\n?|\n")
LINE_ENDS = re.compile(r"(?:\r\n?|\n){3,}|\r\n")
FENCE = re.compile(r"```(\w*)\n(.*?)\n```\Z", re.S)
#: Single lines that are no content of their own.
BOILERPLATE = frozenset(("references", "see also", "notes", "todo", "tbd"))


@dataclass(frozen=True)
class Limits:
    """Token limits, of four characters each: none above `hard`; joined below `soft`; a tail below `least` is marked."""

    hard: int = 800
    overlap: int = 60
    soft: int = 200
    least: int = 80


@dataclass(frozen=True)
class Piece:
    text: str
    start: int
    end: int
    strategy: str
    tail_small: bool = False


def tokens(text: str) -> int:
    return len(text) // 4


def _units(text: str, start: int, end: int, gap: re.Pattern) -> list[tuple[int, int]]:
    """Spans between the gaps, blank ones left out."""
    out, at = [], start
    for m in [*gap.finditer(text, start, end), None]:
        stop = m.start() if m else end
        if text[at:stop].strip():
            out.append((at, stop))
        if m:
            at = m.end()
    return out


def _packed(text: str, units: list[tuple[int, int]], limits: Limits, keep: int, name: str) -> list[Piece]:
    """Units in a row as long as they fit; each further piece begins up to `keep` units back. A unit beyond the cap stands alone."""
    out, lo = [], 0
    for hi in range(1, len(units) + 1):
        full = hi < len(units) and units[hi][1] - units[lo][0] > 4 * limits.hard + 3
        if hi == len(units) or full:
            a, b = units[lo][0], units[hi - 1][1]
            out.append(Piece(text[a:b], a, b, name))
            if hi < len(units):
                back = hi - min(keep, hi - lo - 1) if limits.overlap else hi
                while back < hi and units[hi][1] - units[back][0] > 4 * limits.hard + 3:
                    back += 1
                lo = back
    return out


def _framed(text: str, start: int, lines: list[tuple[int, int]], before: str, after: str, limits: Limits, keep: int, name: str) -> list[Piece]:
    """As _packed() for lines that need a frame around them, such as a fence or a table's head."""
    room = Limits(max(1, limits.hard - tokens(before + after) - 1), limits.overlap)
    out = []
    for p in _packed(text, lines, room, keep, name):
        framed = replace(p, text=before + p.text + after)
        out += [framed] if tokens(framed.text) <= limits.hard else layered(text, p.start, p.end, limits, False, 1)  # one line beyond the cap
    return out


def layered(text: str, start: int, end: int, limits: Limits, headings: bool = True, level: int = 0) -> list[Piece]:
    """Pieces of text[start:end] under the cap: whole, by headings, code lines, table rows, paragraphs, sentences or words."""
    part = text[start:end]
    if tokens(part) <= limits.hard:
        return [Piece(part, start, end, "no-split")] if part.strip() else []
    if headings:
        cuts = [start, *(m.start() for m in HEADING.finditer(text, start + 1, end)), end]
        sections = [(a, b) for a, b in zip(cuts, cuts[1:]) if text[a:b].strip()]
        if len(sections) > 1:
            out = []
            for a, b in sections:
                inner = layered(text, a, b, limits, False)
                out += [replace(p, strategy="heading") if p.strategy == "no-split" else p for p in inner]
            return out
    fence = None if level else FENCE.match(part.strip())
    if fence:
        at = start + part.index(fence[0][:3]) + 4 + len(fence[1])
        return _framed(text, start, _units(text, at, at + len(fence[2]), re.compile("\n")), f"```{fence[1]}\n", "\n```", limits, max(1, limits.overlap // 20), "code-fence-lines")
    rows = [] if level else [(a, b) for a, b in _units(text, start, end, re.compile("\n")) if "|" in text[a:b]]
    if len(rows) > 3 and sum(b - a for a, b in rows) > 0.5 * len(part):
        head = text[rows[0][0] : rows[1][1]] + "\n"
        if tokens(head) < limits.hard // 2:
            first, last = rows[0][0], rows[-1][1]
            around = layered(text, start, first, limits, False) if first > start else []
            after = layered(text, last, end, limits, False) if last < end else []
            body = _framed(text, start, _units(text, rows[1][1], last, re.compile("\n")), head, "", limits, max(1, limits.overlap // 30), "table-rows")
            if body[0].strategy == "table-rows":
                body[0] = replace(body[0], start=first)  # the head stands in it
            else:
                body.insert(0, Piece(text[first : rows[1][1]], first, rows[1][1], "table-rows"))
            return [*around, *body, *after]
    for gap, keep, name in ((PARAGRAPH, limits.overlap // 100, "paragraph"), (SENTENCE, limits.overlap // 50, "sentence"), (WORD, limits.overlap // 2, "token-window")):
        units = _units(text, start, end, gap)
        if len(units) > 1:
            out = []
            for p in _packed(text, units, limits, max(1, keep), name):
                out += [p] if tokens(p.text) <= limits.hard else layered(text, p.start, p.end, limits, False, level + 1) if level < 4 else _cut(text, p.start, p.end, limits)
            return out
    return _cut(text, start, end, limits)


def _cut(text: str, start: int, end: int, limits: Limits) -> list[Piece]:
    """By characters: what no boundary divides, such as a word longer than the cap, comes apart; nothing is dropped."""
    most = 4 * limits.hard + 3
    return [Piece(text[a : min(a + most, end)], a, min(a + most, end), "token-window") for a in range(start, end, most)]


def lone_heading(text: str) -> bool:
    lines = [x.strip() for x in text.split("\n") if x.strip()]
    return len(lines) <= 1 and (not lines or lines[0].startswith("#") or lines[0].lower() in BOILERPLATE)


def _joined(a: Piece, b: Piece) -> Piece:
    name = a.strategy if a.strategy.endswith("+glue") else a.strategy + "+glue"
    return Piece(a.text + "\n\n" + b.text, a.start, b.end, name)


def glue(pieces: list[tuple[int, Piece]], limits: Limits) -> list[tuple[int, Piece]]:
    """Small pieces and lone headings join the piece after them, else the one before, within the cap. Numbers stay those of the first."""
    out: list[tuple[int, Piece]] = []
    i = 0
    while i < len(pieces):
        n, p = pieces[i]
        if tokens(p.text) < limits.soft or lone_heading(p.text):
            if i + 1 < len(pieces):
                both = _joined(p, pieces[i + 1][1])
                if tokens(both.text) <= limits.hard:
                    out.append((n, both))
                    i += 2
                    continue
            if out:
                both = _joined(out[-1][1], p)
                if tokens(both.text) <= limits.hard:
                    out[-1] = (out[-1][0], both)
                    i += 1
                    continue
            if i + 1 == len(pieces) and tokens(p.text) < limits.least:
                p = replace(p, tail_small=True)
        out.append((n, p))
        i += 1
    return out


def chunk_text(text: str, title: str = "", limits: Limits = Limits(), media: list[str] | None = None) -> list[tuple[int, Piece]]:
    """(number, piece) of a document: normal form, its title as a heading first, media it doesn't show listed at its end.

    Starts and ends are places in that form; source_places() maps them to the text as it was given.
    """
    body = re.sub(r"\n{3,}", "\n\n", re.sub(r"\r\n?", "\n", text or "")).strip()
    if title and title.strip():
        body = f"# {title.strip()}\n\n{body}".rstrip()
    missing = [m for m in media or [] if m and m not in body]
    if missing and body:
        body += "\n\n## Media\n" + "\n".join(f"- {m}" for m in missing)
    if not body:
        return []
    pieces = list(enumerate(layered(body, 0, len(body), limits)))
    return glue(pieces, limits) if limits.soft else pieces


def source_places(text: str, title: str = "") -> Callable[[int], int]:
    """The place in the text given of each character of its normal form; 0 within a title put before it.

    The normal form leaves out characters but adds none besides the title and, at the end, the list of media. Only the
    line ends where something is left out are looked at.
    """
    at, shift = [0], [0]  # from a place of the normal form on, the text is so many characters ahead
    for m in LINE_ENDS.finditer(text):
        ends = LINE_END.findall(m[0])
        place = m.start() - shift[-1]
        for k, e in enumerate(ends):
            if k >= 2 and len(ends) >= 3:  # no more than one empty line in a row
                shift[-1] += len(e)
                continue
            place += 1
            if len(e) == 2 or k == 1:
                at.append(place)
                shift.append(shift[-1] + len(e) - 1)
    head = len(f"# {title.strip()}\n\n") if title and title.strip() else 0
    left = len(text) - len(text.lstrip())  # white space before the text, of which the normal form may have fewer characters
    lead = next((j for j in range(left + 1) if j + shift[bisect_right(at, j) - 1] >= left), left)
    last = max(len(text.rstrip()) - 1, 0)

    def place_of(i: int) -> int:
        j = i - head + lead
        return 0 if i < head else min(j + shift[bisect_right(at, j) - 1], last)

    return place_of


SCHEMA = "doc_id string, chunk_id string, ord int, text_md string, char_count int, token_count int, split_strategy string, char_start int, char_end int, source_start int, source_end int, tail_small boolean"


def body_length(text: Column) -> Column:
    """Characters of the normal form that a text is chunked in, without title and media."""
    body = F.regexp_replace(F.regexp_replace(text, "\r\n?", "\n"), "\n{3,}", "\n\n")
    return F.length(F.regexp_replace(body, rf"\A[{WS}\x1c-\x1f]+|[{WS}\x1c-\x1f]+\z", ""))


def chunk_documents(df: DataFrame, key: str = "doc_id", text: str = "text", title: str | None = None, limits: Limits = Limits()) -> DataFrame:
    """One row per chunk of every document; empty documents and null texts give none. No shuffle; texts are handled whole.

    char_start and char_end are places in the normal form (line ends, empty lines, white space around), source_start and
    source_end the same in the text itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.string()), ("chunk_id", pa.string()), ("ord", pa.int32()), ("text_md", pa.string()), ("char_count", pa.int32()), ("token_count", pa.int32()), ("split_strategy", pa.string()), ("char_start", pa.int32()), ("char_end", pa.int32()), ("source_start", pa.int32()), ("source_end", pa.int32()), ("tail_small", pa.bool_())])
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                rows = []
                for k, t, name in zip(*(part.column(i).to_pylist() for i in range(3))):
                    place = source_places(t, name or "")
                    for n, p in chunk_text(t, name or "", limits):
                        rows.append((k, f"{k}:{n:04d}", n, p.text, len(p.text), tokens(p.text), p.strategy, p.start, p.end, place(p.start), place(p.end - 1) + 1, p.tail_small))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    name = F.col(title) if title else F.lit("")
    return df.where(F.length(text) > 0).select(F.col(key).cast("string").alias("k"), F.col(text).alias("t"), name.alias("n")).mapInArrow(run, SCHEMA)
