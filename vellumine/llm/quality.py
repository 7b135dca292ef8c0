"""Problem 2: text statistics, and prose, list, table or junk by a hidden Markov model over lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumine.llm.chars import BREAK, DIGIT, LETTER, MARKED, PUNCT, SPACE, UPPER, Block, blocks, range_hashes

#: The most common function words of the nine languages of the corpus.
COMMON = """
the of and to in is that it for on with as not be this are from at by or an has but its only so all who when after before
der die das und ist nicht mit auf von zu den dem des ein eine im für sich es an wird nur aus nach bei oder
le la les de des et est un une du que pour dans sur pas au avec qui ne par sans en il ce cette
el los las y es en una por con para del no se su al como lo más que antes
o os as e do da em um uma não com na no dos das ao mais pelo que antes
il di che e la per un una non con del della nel al le i gli da si quando prima
de het een en van is niet met op te voor dat die aan door naar als bij uit om
и в не на что с по из к за от до как это для после пока уже только без у о мы ещё потом если когда наш его их они чтобы потому
""".split()
STATES = ("prose", "list", "table", "junk")
#: What a line can look like; the rows of EMIT follow.
SYMBOLS = ("sentence", "wrapped", "marked", "short", "cells", "rule", "noise", "repeated", "labels", "heading", "code")
#: Starting values of P(symbol | state), P(state | state before) and P(first state), set by hand; fit() makes the model of them.
EMIT = np.array([
    # sent  wrap  mark  short cells rule  noise rep   label head  code
    [0.60, 0.24, 0.03, 0.03, 0.01, 0.005, 0.005, 0.01, 0.005, 0.06, 0.005],
    [0.03, 0.02, 0.52, 0.36, 0.01, 0.005, 0.005, 0.005, 0.005, 0.035, 0.005],
    [0.02, 0.01, 0.01, 0.02, 0.84, 0.06, 0.01, 0.005, 0.005, 0.015, 0.005],
    [0.01, 0.02, 0.01, 0.02, 0.02, 0.01, 0.50, 0.33, 0.06, 0.015, 0.005],
])
MOVE = np.array([
    [0.85, 0.06, 0.05, 0.04],
    [0.06, 0.90, 0.02, 0.02],
    [0.06, 0.02, 0.90, 0.02],
    [0.06, 0.02, 0.02, 0.90],
])
START = np.array([0.55, 0.17, 0.17, 0.11])
#: Texts that the model is fitted on at most, and how many observations each row of the starting values counts for.
SAMPLE, PRIOR = 2000, 200.0
#: Letters of a line, of which random ones have too few vowels for any language in Latin script.
MANY_LETTERS, VOWELS = 40, 0.28
Model = tuple[np.ndarray, np.ndarray, np.ndarray]
MIN_WORDS = 10
BULLETS = "-*+•–—‣◦·▪●○"


def _codes(chars: str) -> np.ndarray:
    return np.array([ord(c) for c in chars], np.uint32)


def _count(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(mask) + 1, np.int32)
    np.cumsum(mask, out=sums[1:])
    return sums[ends] - sums[starts]


_common_hashes: list[np.ndarray] = []


def common_hashes() -> np.ndarray:
    if not _common_hashes:
        b = Block([w for w in dict.fromkeys(COMMON)])
        _common_hashes.append(np.sort(range_hashes(b.codes, b.offsets[:-1], b.offsets[1:])))
    return _common_hashes[0]


def _isin(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[np.minimum(np.searchsorted(table, h), len(table) - 1)] == h


def scan(texts: list[str]) -> dict[str, np.ndarray]:
    """Symbols of the non-blank lines of each text, and the statistics of each text. Texts must not be null."""
    b = Block(texts)
    n, codes, cls, off = b.n, b.codes, b.cls, b.offsets
    lower = Block([t.lower() for t in texts]) if n else b
    same = lower.offsets[-1] == off[-1]
    low = lower.codes if same else codes  # a text whose length changes in lower case: its capitals stay
    word_s, word_e = b.words()
    doc_of_word = b.owner(word_s)
    words = np.bincount(doc_of_word, minlength=n) if len(word_s) else np.zeros(n, np.int64)
    hashes = range_hashes(low, word_s, word_e)
    common = _isin(hashes, common_hashes()) if len(hashes) else np.zeros(0, bool)
    word_len = word_e - word_s
    # lines: runs without a break that hold anything but white space
    line_s, line_e = b.runs((cls & BREAK) == 0)
    solid = np.zeros(len(codes) + 1, np.int32)
    visible = (cls & SPACE) == 0
    np.cumsum(visible, out=solid[1:])
    chars = solid[line_e] - solid[line_s]
    keep = chars > 0
    line_s, line_e, chars = line_s[keep], line_e[keep], chars[keep]
    m = len(line_s)
    doc_of_line = b.owner(line_s)
    out = {"n": n, "doc_of_line": doc_of_line}
    lines = np.bincount(doc_of_line, minlength=n) if m else np.zeros(n, np.int64)
    # first and last visible character of each line
    at = np.flatnonzero(visible)
    first = at[solid[line_s]] if m else line_s
    last = at[solid[line_e] - 1] if m else line_s

    def head(k: int) -> np.ndarray:
        p = np.minimum(first + k, len(codes) - 1) if m else first
        return np.where(first + k < line_e, codes[p], 32) if m else np.zeros(0, np.uint32)

    letters = _count((cls & LETTER) != 0, line_s, line_e)
    digits = _count((cls & DIGIT) != 0, line_s, line_e)
    odd = _count(visible & ((cls & (LETTER | DIGIT | PUNCT | MARKED)) == 0) | (codes == 0xFFFD), line_s, line_e)
    w_lo, w_hi = np.searchsorted(word_s, line_s), np.searchsorted(word_s, line_e)
    line_words = w_hi - w_lo
    csum = np.concatenate([[0], np.cumsum(common)])
    line_common = csum[w_hi] - csum[w_lo]
    lsum = np.concatenate([[0], np.cumsum(word_len)])
    mean_len = (lsum[w_hi] - lsum[w_lo]) / np.maximum(1, line_words)
    kana = _count((codes >= 0x3041) & (codes <= 0x30FF), line_s, line_e)
    cjk = _count((codes >= 0x3041) & (codes <= 0x9FFF), line_s, line_e)
    enders = np.isin(codes, _codes(".!?。！？…")) if len(codes) else np.zeros(0, bool)
    closers = _codes(".!?。！？…:;\"'”’»)]」』")
    lc = codes[last] if m else np.zeros(0, np.uint32)
    back = np.maximum(last - 1, 0)
    ends_sentence = enders[last] | (np.isin(lc, closers[7:]) & enders[back] & (back >= line_s)) if m else np.zeros(0, bool)
    ends_punct = np.isin(lc, closers) if m else np.zeros(0, bool)
    # cells
    nxt = np.empty_like(codes)
    if len(codes):
        nxt[:-1], nxt[-1] = codes[1:], 0
    bars = _count((codes == 124) | (codes == 0x2502), line_s, line_e)
    tabs = _count((codes == 9) | (codes > 27) & (codes < 32) | (codes == 1) | (codes == 0x00A6) | (codes == 0x2551), first, last + 1) if m else bars
    semis = _count(codes == 59, line_s, line_e)
    commas = _count((codes == 44) & (nxt != 32), line_s, line_e)
    tags = _count((codes == 60) & np.isin(nxt, _codes("tT/")), line_s, line_e)
    blank = (codes == 32) | (codes == 0xA0)
    prev_blank = np.concatenate([[False], blank[:-1]]) if len(codes) else blank
    pairs = blank & ~prev_blank & (np.isin(nxt, _codes("  ")))
    wide = pairs.copy()
    if len(codes) > 2:
        wide[:-2] &= blank[2:]
        wide[-2:] = False
    gaps = np.where(_count(wide, first, last + 1) > 0, _count(pairs, first, last + 1), 0) if m else bars
    ruled = _count(np.isin(codes, _codes("-=+|:_─│├┤┼┬┴┌┐└┘━ ")), line_s, line_e)
    # capitals and digits within words, as in encoded data
    alnum = (cls & (LETTER | DIGIT)) != 0
    before_alnum = np.concatenate([[False], alnum[:-1]]) if len(codes) else alnum
    before_cls = np.concatenate([[0], cls[:-1]]).astype(np.uint8) if len(codes) else cls
    jumble = _count(alnum & before_alnum & (((cls ^ before_cls) & (LETTER | DIGIT)) != 0) | ((cls & UPPER) != 0) & before_alnum & ((before_cls & UPPER) == 0), line_s, line_e)
    arrows = _count(np.isin(codes, _codes("»·>/|•«<")) & prev_blank, line_s, line_e)
    capital = _count(((cls & UPPER) != 0) & prev_blank, line_s, line_e)
    # repetition: share of word triples that stand elsewhere in the text too
    distinct3 = np.zeros(n)
    rep_share = np.zeros(n)
    if len(hashes) > 2:
        tri = hashes[:-2] * np.uint64(3) ^ hashes[1:-1] * np.uint64(0x9E3779B97F4A7C15) ^ (hashes[2:] << np.uint64(1))
        ok = doc_of_word[:-2] == doc_of_word[2:]
        td = doc_of_word[:-2][ok]
        key = tri[ok] * np.uint64(0xD6E8FEB86659FD93) ^ td.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
        order = np.argsort(key, kind="stable")
        k2 = key[order]
        new = np.concatenate([[True], k2[1:] != k2[:-1]]) if len(k2) else np.zeros(0, bool)
        counts = np.diff(np.append(np.flatnonzero(new), len(k2)))
        firsts = td[order][new]
        total = np.bincount(td, minlength=n)
        distinct3 = np.bincount(firsts, minlength=n) / np.maximum(1, total)
        rep_share = np.bincount(firsts, weights=counts * (counts >= 3), minlength=n) / np.maximum(1, total)
    h0, h1, h2, h3, h4 = (head(k) for k in range(5))
    cut = lambda c: np.isin(c, _codes(".)"))
    isdig, isalp = (lambda c: (c >= 48) & (c <= 57)), (lambda c: ((c | 32) >= 97) & ((c | 32) <= 122))
    gap = lambda c: np.isin(c, _codes(" \t "))
    bullet = np.isin(h0, _codes(BULLETS)) & gap(h1)
    number = (isdig(h0) & (cut(h1) & gap(h2) | isdig(h1) & (cut(h2) & gap(h3) | isdig(h2) & cut(h3) & gap(h4)))) | (isalp(h0) & cut(h1) & gap(h2) & (h1 == 41)) | ((h0 == 40) & ((isdig(h1) | isalp(h1)) & (h2 == 41) | isdig(h1) & isdig(h2) & (h3 == 41)))
    marked = bullet | number
    heading = (h0 == 35) & ((h1 == 35) | (h1 == 32))
    few = line_words <= 9
    japanese = cjk > 0.4 * chars
    readable = (line_common >= np.maximum(1, 0.10 * line_words)) | (japanese & (kana > 0.2 * cjk))
    shares = letters / np.maximum(1, chars)
    doc_rep = rep_share[doc_of_line] if m else np.zeros(0)
    doc_dis = distinct3[doc_of_line] if m else np.zeros(0)
    repeated = (line_words >= 6) & (doc_rep > 0.75) & (doc_dis < 0.30)
    rule = (ruled >= (line_e - line_s)) & (chars >= 3)
    nav = (arrows >= 4) & (arrows >= 0.5 * line_words) & (capital >= 0.6 * line_words)
    parted = (bars + tabs + semis + tags > 0) | (commas >= 2)
    letters_alone = (line_words >= 8) & (mean_len <= 1.6)
    bytes_in_hex = (line_words >= 5) & ~parted & ((mean_len <= 2.0) | (mean_len <= 3.0) & (digits >= 0.2 * letters) & (line_common <= 0.2 * line_words))
    hexes = (letters_alone | bytes_in_hex) & ~japanese
    # UTF-8 that was read as Latin-1: its lead bytes before other signs beyond ASCII
    broken = _count(np.isin(codes, np.array([0xC2, 0xC3, 0xE2], np.uint32)) & (nxt >= 0x80), line_s, line_e)
    doc_common = (np.bincount(doc_of_word, weights=common, minlength=n) / np.maximum(1, words))[doc_of_line] if m else np.zeros(0)
    ascii_letters = _count((codes < 128) & ((cls & LETTER) != 0), line_s, line_e)
    vowels = _count(np.isin(codes, _codes("aeiouyAEIOUY")), line_s, line_e)
    random_letters = (ascii_letters >= MANY_LETTERS) & (ascii_letters > 0.8 * letters) & (vowels < VOWELS * ascii_letters) & (line_common <= 0.1 * line_words)
    scrawl = (_count(np.isin(codes, _codes("!@#$%^&*~<>{}[]\\?+=;:/_")), line_s, line_e) > 0.5 * chars) & (letters + digits < 0.2 * chars) & (chars >= 12) & ~rule
    noise = (
        random_letters | scrawl | (broken > 0.08 * chars) | (odd > 0.25 * chars) | (jumble > 0.2 * chars) | (letters + digits < 0.5 * chars) | ((line_words >= 8) & (line_common == 0) & (doc_common < 0.05) & ~japanese & (shares > 0.55))
        | ((chars >= 40) & (line_words <= chars / 25)) & ~japanese | hexes
    ) & (chars >= 12) & ~rule
    html_row = tags >= 2
    cell_n = np.maximum.reduce([bars, tabs, semis, commas, gaps])
    cells = html_row | (tags >= 1) & few & (h0 == 60) | (cell_n >= 2) | ((cell_n >= 1) & ~ends_sentence & (line_words <= 8) & (bars + tabs + semis + gaps >= 1))
    # separators within running text aren't cells
    running = readable & (line_common >= 0.25 * line_words) & (line_words >= 12) & (ends_sentence | (line_words > 25))
    cells &= ~running | html_row | (bars >= 3)
    babble = (line_words >= 12) & (line_common == 0) & ~japanese & (bars + tabs + gaps + tags == 0) & (_count(blank, first, last + 1) > 0.4 * line_words) if m else noise
    cells &= ~(babble | scrawl | random_letters & (bars + tabs + gaps + tags == 0))
    cells &= ~(noise & ((odd > 0.1 * chars) & (bars < 2) | (jumble > 0.2 * chars))) & ~nav
    # code: lines within fences, and lines with the signs of calls, assignments and blocks but hardly a common word
    fence = (h0 == h1) & (h1 == h2) & ((h0 == 96) | (h0 == 126))
    opened = np.cumsum(fence) - (np.cumsum(fence) - fence)[np.searchsorted(doc_of_line, doc_of_line)] if m else fence
    signs = _count(np.isin(codes, _codes("(){}[]=")), line_s, line_e)
    calls = (signs >= 2) & (signs >= 0.06 * chars) & (line_common <= 0.2 * line_words) & (bars + tabs + gaps + tags == 0) & (semis <= 1) & (letters > 0.3 * chars) & ~marked & ~ends_sentence & ~japanese
    after_word = _count((codes == 40) & before_alnum, line_s, line_e) if m else signs
    calls |= (after_word >= 1) & (signs >= 2) & (line_words <= 12) & (line_common <= 0.5 * line_words) & (bars + tabs + gaps + tags == 0) & ~marked & ~ends_sentence & ~japanese
    calls |= (lc == 123) & ~ends_sentence | (chars <= 2) & (h0 == 125)  # opens or closes a block
    within = fence | (opened % 2 == 1)
    out["loose_code"] = calls & ~noise & ~within
    coded = within | out["loose_code"]
    out["symbol"] = np.select(
        [coded, repeated & ~html_row, rule, nav, html_row, heading, marked & ~cells | marked & (bars == 0) & (tabs == 0) & (semis < 2) & (commas < 2) & (gaps < 2), cells & ~hexes, noise, ends_sentence & (line_words >= 4) | japanese & ends_sentence, few & ~japanese],
        [10, 7, 5, 8, 4, 9, 2, 4, 6, 0, 3], 1,
    ).astype(np.int8)
    # a short line without a mark continues running text where its neighbours do
    start_low = (cls[first] & (LETTER | UPPER)) == LETTER if m else np.zeros(0, bool)
    sym = out["symbol"]
    if m:
        before = np.where(np.concatenate([[False], doc_of_line[1:] == doc_of_line[:-1]]), np.concatenate([[9], sym[:-1]]), 9)
        after = np.where(np.concatenate([doc_of_line[1:] == doc_of_line[:-1], [False]]), np.concatenate([sym[1:], [9]]), 9)
        flows = np.isin(before, (0, 1)) & np.isin(after, (0, 1))
        same_before = np.concatenate([[False], doc_of_line[1:] == doc_of_line[:-1]])
        open_before = same_before & ~np.concatenate([[True], ends_sentence[:-1]])
        goes_on = start_low & open_before  # begins in lower case after a line that ends no sentence
        some_upper = (np.bincount(doc_of_line, weights=_count((cls & UPPER) != 0, line_s, line_e), minlength=n) > 0)[doc_of_line]
        next_on = np.concatenate([goes_on[1:], [False]]) & np.concatenate([doc_of_line[1:] == doc_of_line[:-1], [False]])
        sentence_inside = _count(enders & np.isin(nxt, _codes(" \t")), first, last) > 0
        texty = (line_words >= 4) | goes_on
        sym[(sym == 3) & (flows | sentence_inside | (goes_on | next_on) & some_upper & texty)] = 1
    # statistics
    symbols = np.bincount(b.owner(np.flatnonzero(visible & ((cls & (LETTER | DIGIT)) == 0))), minlength=n)[:n] if n else np.zeros(0)
    visible_n = np.diff(solid[off]) if n else np.zeros(0)
    out["word_count"] = words
    out["mean_word_length"] = np.bincount(doc_of_word, weights=word_len, minlength=n) / np.maximum(1, words) if n else np.zeros(0)
    out["symbol_ratio"] = symbols / np.maximum(1, visible_n)
    out["punct_line_share"] = np.bincount(doc_of_line, weights=ends_punct, minlength=n) / np.maximum(1, lines) if n else np.zeros(0)
    out["common_word_share"] = np.bincount(doc_of_word, weights=common, minlength=n) / np.maximum(1, words) if n else np.zeros(0)
    # code points in the words of Chinese and Japanese can't be counted as words; eight of them stand for ten words
    out["size"] = words + np.bincount(b.owner(np.flatnonzero((codes >= 0x3041) & (codes <= 0x9FFF))), minlength=n)[:n] // 4 if n else np.zeros(0)
    out["lines"] = lines
    # sentences of a line weigh as the lines they would fill
    out["weight"] = np.maximum(1, _count(enders & (np.isin(nxt, _codes(" \t\n\r　")) | (codes > 0x3000)), line_s, line_e))
    return out


def viterbi(symbols: np.ndarray, owner: np.ndarray, emit: np.ndarray = EMIT, move: np.ndarray = MOVE, start: np.ndarray = START) -> np.ndarray:
    """The likeliest states of the lines of many texts at once: one vectorised step for each line number."""
    le, lm, ls = np.log(emit), np.log(move), np.log(start)
    m = len(symbols)
    state = np.zeros(m, np.int8)
    if not m:
        return state
    new = np.concatenate([[True], owner[1:] != owner[:-1]])
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, m))
    score = np.zeros((m, 4))
    back = np.zeros((m, 4), np.int8)
    score[begin] = ls + le[:, symbols[begin]].T
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    for k in range(1, int(length[0])):
        at = begin[: np.searchsorted(-length, -k, side="left")] + k
        ways = score[at - 1][:, :, None] + lm[None]
        back[at] = ways.argmax(1)
        score[at] = ways.max(1) + le[:, symbols[at]].T
    ends = begin + length - 1
    state[ends] = score[ends].argmax(1)
    for k in range(int(length[0]) - 1, 0, -1):
        at = begin[: np.searchsorted(-length, -k, side="left")] + k
        state[at - 1] = back[at, state[at]]
    return state


def fit(symbols: np.ndarray, owner: np.ndarray, rounds: int = 5, prior: float = PRIOR) -> Model:
    """Viterbi training from the starting values, without labels; prior: how many observations each row of them counts for."""
    emit, move, start = EMIT, MOVE, START
    for _ in range(rounds):
        s = viterbi(symbols, owner, emit, move, start)
        new = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(s) else np.zeros(0, bool)
        e, t = EMIT * prior, MOVE * prior
        np.add.at(e, (s, symbols), 1)
        inner = np.flatnonzero(~new)
        np.add.at(t, (s[inner - 1], s[inner]), 1)
        i = START * prior + np.bincount(s[new], minlength=4)
        emit, move, start = e / e.sum(1, keepdims=True), t / t.sum(1, keepdims=True), i / i.sum()
    return emit, move, start


def train(df: DataFrame, text: str = "text_md", sample: int = SAMPLE) -> Model:
    """The model fitted on about `sample` different texts of df, chosen by a hash of the text; one task fits it, and the driver
    gets its 64 numbers. Only this fit is on a sample: all texts are judged."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scan(sorted(t for b in batches for t in b.column(0).to_pylist()))
        model = fit(s["symbol"], s["doc_of_line"])
        yield pa.RecordBatch.from_arrays([pa.array([m.ravel().tolist()]) for m in model], names=["emit", "move", "start"])

    n = df.count()  # of the files' footers: no column is read
    chance = F.pmod(F.xxhash64(text), F.lit(1_000_000_000))
    picked = df.where(F.col(text).isNotNull() & (chance < int(min(1.0, 1.2 * sample / max(1, n)) * 1_000_000_000))).select(F.col(text).alias("text")).distinct()
    got = picked.coalesce(1).mapInArrow(learn, "emit array<double>, move array<double>, start array<double>").first()
    return tuple(np.array(x).reshape(m.shape) for x, m in zip(got, (EMIT, MOVE, START))) if got else (EMIT, MOVE, START)


def judge(texts: list[str], model: Model = (EMIT, MOVE, START)) -> dict[str, np.ndarray]:
    """Statistics, label shares and kind of each text; kind is None where there is nothing to judge."""
    s = scan(texts)
    n, owner, sym = s["n"], s["doc_of_line"], s["symbol"].copy()
    state = viterbi(sym, owner, *model)
    weight = np.where((sym == 9) | (sym == 10), 0.0, np.where(np.isin(sym, (0, 1, 7)), s["weight"], 1.0))
    shares = np.zeros((n, 4))
    for k in range(4):
        shares[:, k] = np.bincount(owner, weights=weight * (state == k), minlength=n) if len(owner) else 0
    total = shares.sum(1)
    shares /= np.maximum(1e-9, total)[:, None]
    kind = np.array(STATES, dtype=object)[shares.argmax(1)] if n else np.zeros(0, object)
    fenced = np.fromiter((is_fenced(t) for t in texts), bool, n)
    coded = np.bincount(owner, weights=s["loose_code"], minlength=n) if len(owner) else np.zeros(n)
    kind[(total == 0) | (coded > total) | fenced | ((s["size"] < MIN_WORDS) & (shares.argmax(1) != 3)) | ((s["size"] < MIN_WORDS) & (s["lines"] <= 1) & (s["symbol_ratio"] < 0.4) & (s["mean_word_length"] < 15))] = None
    return s | {"shares": shares, "kind": kind, "fenced": fenced}


def is_fenced(text: str) -> bool:
    """One fenced block and nothing else."""
    t = text.strip()
    return len(t) >= 6 and t[:3] in ("```", "~~~") and t.endswith(t[:3]) and t.count("\n" + t[:3]) == 1


SCHEMA = "key string, word_count int, mean_word_length double, symbol_ratio double, punct_line_share double, common_word_share double, prose_share double, list_share double, table_share double, junk_share double, kind string"
_ARROW = pa.schema([("key", pa.string()), ("word_count", pa.int32())] + [(x, pa.float64()) for x in ("mean_word_length", "symbol_ratio", "punct_line_share", "common_word_share", "prose_share", "list_share", "table_share", "junk_share")] + [("kind", pa.string())])


def text_quality(df: DataFrame, key: str = "chunk_id", text: str = "text_md", model: Model | None = None) -> DataFrame:
    """key, the statistics, the shares of the four labels among the lines, and the kind of every row of df.

    A null text has null statistics and a null kind; an empty or blank one zero statistics and a null kind, as
    have texts of fewer than ten words that are no junk, and texts of nothing but code and headings. Rows stay as
    they are, repeated ones and null keys too; other columns are ignored. No shuffle. model: of train(), which is
    called on df if it is None.
    """
    fitted = train(df, text) if model is None else model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, texts = b.column(0), b.column(1).to_pylist()
            for lo, hi in blocks([t or "" for t in texts]):
                part = texts[lo:hi]
                r = judge([t or "" for t in part], fitted)
                null = np.array([t is None for t in part])
                cols = [keys.slice(lo, hi - lo), pa.array(r["word_count"].astype(np.int32), mask=null)]
                cols += [pa.array(r[x].astype(float), mask=null) for x in ("mean_word_length", "symbol_ratio", "punct_line_share", "common_word_share")]
                cols += [pa.array(r["shares"][:, k], mask=null) for k in range(4)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(r["kind"], pa.string(), mask=null)], schema=_ARROW)

    return df.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)


def found(df: DataFrame) -> DataFrame:
    """chunk_id and kind of the chunks that are not prose."""
    return text_quality(df).where("kind <> 'prose'").select(F.col("key").alias("chunk_id"), "kind").distinct()
