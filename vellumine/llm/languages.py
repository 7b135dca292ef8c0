"""Problem 8: the languages of texts and their passages, by hyperdimensional n-gram profiles."""

from __future__ import annotations

import pickle
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumine.llm.chars import BREAK, LETTER, SPACE, Block, blocks, classes

LANGUAGES = ("de", "en", "es", "fr", "it", "ja", "nl", "pt", "ru")
#: ISO 639-2 codes and English names of these languages.
SPELLINGS = {
    "de": ("deu", "ger", "german"), "en": ("eng", "english"), "es": ("spa", "spanish"), "fr": ("fra", "fre", "french"), "it": ("ita", "italian"),
    "ja": ("jpn", "japanese"), "nl": ("nld", "dut", "dutch"), "pt": ("por", "portuguese"), "ru": ("rus", "russian"),
}
#: Labels that say nothing.
UNKNOWN = ("", "und", "unknown")
#: Length of the letter vectors; texts of each label the profiles are fitted on, and code points taken of each.
DIM, SAMPLE, SAMPLE_CHARS = 2048, 300, 4000
#: Words (or Japanese characters) that make a passage, and a text.
PASSAGE, TEXT, PASSAGE_JA, TEXT_JA = 25, 20, 60, 40
#: Least cosine of a unit with its language's profile, over the length of the unit's vector (so for one triple on average),
#: and what a change of language costs, in such cosines summed over words, in units of their mean size.
LEAST, CHANGE = 0.02, 1.2
#: What a text gets that is in none of the languages; the letters that its words have on average, at least and at most; and
#: the share of its triples that some language has too, if it is written in their scripts.
OTHER, OTHER_WORD, OTHER_KNOWN = "und", (2.2, 14.0), 0.35
#: Letter codes: 1 to 86 for Latin, Cyrillic and their accents, 87 for letters of other scripts, from JA on hiragana, katakana, kanji.
CODES, JA, KATAKANA, KANJI = 96, 88, 92, 94


@lru_cache(1)
def letters() -> np.ndarray:
    """The letter code of every code point, 0 for anything that parts words. Case is folded; Japanese signs share eight codes, so that
    new words have triples known from others; what tells them from Chinese is how hiragana and kanji alternate."""
    cls = classes()
    t = np.where((cls & LETTER) != 0, np.uint8(JA - 1), np.uint8(0))
    alphabet = "abcdefghijklmnopqrstuvwxyz" + "абвгдежзийклмнопрстуфхцчшщъыьэюяё" + "äöüßàâçéèêëîïôùûœáíóúñãõìò"
    own = np.zeros(len(t), bool)
    for i, c in enumerate(alphabet, 1):
        for v in {c, c.upper() if len(c.upper()) == 1 else c}:
            t[ord(v)], own[ord(v)] = i, True
    other = np.flatnonzero((cls & LETTER) != 0)
    for c in other[(other < 0x0250) & ~own[other]]:  # further accents: the letter below them
        base = ord(unicodedata.normalize("NFD", chr(c))[0].lower())
        t[c] = t[base] if base < 128 else JA - 1
    for c in range(0xFF21, 0xFF5B):  # full-width Latin
        base = unicodedata.normalize("NFKC", chr(c)).lower()
        t[c] = t[ord(base[0])]
    t[0x3041:0x3097] = JA + np.arange(0x3041, 0x3097) % (KATAKANA - JA)
    t[0x30A1:0x30FF] = KATAKANA + np.arange(0x30A1, 0x30FF) % (KANJI - KATAKANA)
    t[0x4E00:0xA000] = KANJI + np.arange(0x4E00, 0xA000) % (CODES - KANJI)
    t[0x3005] = KANJI
    return t


def letter_vectors(seed: int = 20) -> np.ndarray:
    """A random vector of +1 and -1 for each letter code."""
    return np.random.default_rng(seed).integers(0, 2, (CODES, DIM), dtype=np.int8) * 2 - 1


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """Vectors of letter triples: the product of the letters' vectors, the first permuted (rotated) twice, the second once."""
    v = letter_vectors()
    a, b, c = grams // (CODES * CODES), grams // CODES % CODES, grams % CODES
    return np.roll(v, 2, axis=1)[a] * np.roll(v, 1, axis=1)[b] * v[c]


def triples(codes: np.ndarray) -> np.ndarray:
    """A number for each place: the triple of letter codes around it, -1 where its middle is no letter."""
    out = np.full(len(codes), -1, np.int32)
    if len(codes):
        wide = np.concatenate([[0], codes, [0]]).astype(np.int32)
        out = np.where(codes > 0, (wide[:-2] * CODES + wide[1:-1]) * CODES + wide[2:], -1).astype(np.int32)
    return out


class Profiles:
    """Language prototypes, and for each triple its dot product with each of them.

    A document's vector is the sum of its triples' vectors, so its dot product with a prototype is the sum of its
    triples' dot products. Those are tabled once; the documents' own vectors of DIM parts need never be built.
    """

    def __init__(self, counts: np.ndarray):
        """counts: languages x CODES**3, how often each triple stands in the sample of each language."""
        self.seen = np.flatnonzero(counts.sum(0) > 1)
        share = counts[:, self.seen] / np.maximum(1, counts[:, self.seen].sum(1, keepdims=True))
        proto = np.zeros((len(LANGUAGES), DIM))
        weight = np.sqrt(share)  # so that a few very common triples don't outweigh the rest
        weight -= weight.mean(0)  # what all languages have in common tells nothing
        for lo in range(0, len(self.seen), 4096):
            proto += weight[:, lo : lo + 4096] @ gram_vectors(self.seen[lo : lo + 4096]).astype(np.float64)
        norm = np.linalg.norm(proto, axis=1, keepdims=True)
        self.proto = proto / np.where(norm > 0, norm, 1)
        self._index()
        self.table = np.zeros((len(self.seen) + 1, len(LANGUAGES)), np.float32)  # row 0: triples never seen
        for lo in range(0, len(self.seen), 4096):
            self.table[lo + 1 : lo + 4097] = gram_vectors(self.seen[lo : lo + 4096]).astype(np.float64) @ self.proto.T / np.sqrt(DIM)

    def _index(self) -> None:
        self.index = np.zeros(CODES**3, np.int32)
        self.index[self.seen] = np.arange(1, len(self.seen) + 1)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "index"}  # made again where it is used: it is larger than the rest

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self._index()


def sample_counts(texts: list[str], labels: list[str]) -> np.ndarray:
    out = np.zeros((len(LANGUAGES), CODES**3), np.float64)
    for k, lang in enumerate(LANGUAGES):
        own = "\n".join(t[:SAMPLE_CHARS] for t, x in zip(texts, labels) if x == lang)
        g = triples(letters()[Block([own]).codes])
        out[k] = np.bincount(g[g >= 0], minlength=CODES**3)
    return out


def fit(texts: list[str], labels: list[str], rounds: int = 2) -> Profiles:
    """Profiles of labelled texts. Labels may be wrong: after a first fit, texts that another language fits better are left out."""
    counts = sample_counts(texts, labels)
    p = Profiles(counts)
    for _ in range(rounds):
        keep = [k for k, (t, lang) in enumerate(zip(texts, labels)) if pure(t, p) == lang]
        p = Profiles(sample_counts([texts[k] for k in keep], [labels[k] for k in keep]))
    return p


def pure(text: str, p: Profiles) -> str | None:
    """The language of most of a text's start."""
    g = triples(letters()[Block([text[:SAMPLE_CHARS]]).codes])
    s = p.table[p.index[g[g >= 0]]].sum(0)
    return LANGUAGES[int(s.argmax())] if len(g) else None


_FENCE = re.compile(r"(?ms)^[ \t]*(```|~~~).*?(?:^[ \t]*\1[^\n]*$|\Z)")
_TAG = re.compile(r"</?[a-zA-Z][^<>\n]*>")
_CODE = np.zeros(128, bool)
_CODE[[ord(c) for c in "_/\\={}<>[]@#$%^&*+|0123456789"]] = True


def without_code(text: str) -> str:
    """The text with fenced blocks and tags blanked out, of the same length."""
    if "```" in text or "~~~" in text:
        text = _FENCE.sub(lambda m: re.sub(r"\S", " ", m[0]), text)
    if "</" in text:
        text = _TAG.sub(lambda m: " " * len(m[0]), text)
    return text


def natural_letters(b: Block) -> np.ndarray:
    """Letter codes, 0 within identifiers, paths and links: runs without white space that hold a digit or a sign of code, and no Japanese."""
    lc = letters()[b.codes]
    if not len(lc):
        return lc
    code = _CODE[np.minimum(b.codes, 127)] & (b.codes < 128)
    s, e = b.runs((b.cls & SPACE) == 0)
    sums = np.concatenate([[0], np.cumsum(code, dtype=np.int32)])
    japanese = np.concatenate([[0], np.cumsum(lc >= JA, dtype=np.int32)])
    odd = (sums[e] > sums[s]) & (japanese[e] == japanese[s])
    change = np.zeros(len(lc) + 1, np.int8)
    change[s[odd]] += 1
    change[e[odd]] -= 1
    return np.where(np.cumsum(change[:-1]) > 0, 0, lc).astype(np.uint8)


def units(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the sentences of each text, cut after sentence ends and at empty lines; single line breaks don't cut."""
    codes = b.codes
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = (b.cls & SPACE) != 0
    brk = (b.cls & BREAK) != 0
    nxt_space = np.concatenate([space[1:], [True]])
    ender = np.isin(codes, np.array([ord(c) for c in ".!?…"], np.uint32))
    quote = np.isin(codes, np.array([ord(c) for c in "\"'”’»)«"], np.uint32))
    nxt_quote = np.concatenate([quote[1:], [False]])
    wide = np.isin(codes, np.array([ord(c) for c in "。！？"], np.uint32))
    prev_brk = np.concatenate([[False], brk[:-1]])
    prev_cr = np.concatenate([[False], codes[:-1] == 13])
    cut = ender & (nxt_space | nxt_quote) | wide | (brk & prev_brk & ~((codes == 10) & prev_cr))
    # lines that begin with a mark, a heading sign or a cell part their text from the line before
    marks = np.isin(codes, np.array([ord(c) for c in "#-*•|–"], np.uint32))
    cut |= brk & np.concatenate([marks[1:], [False]])
    inside = ~cut
    s, e = b.runs(inside | cut)  # whole texts
    starts = np.unique(np.concatenate([s, np.flatnonzero(cut) + 1]))
    starts = starts[starts < n]
    ends = np.append(starts[1:], n)
    return starts, ends


def squares(g: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """For each unit the sum of the squares of its triples' counts."""
    at = np.flatnonzero(g >= 0)
    unit = np.searchsorted(starts, at, side="right") - 1
    key = np.sort(unit * CODES**3 + g[at])
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return np.bincount(key[new] // CODES**3, weights=np.diff(np.append(new, len(key))) ** 2.0, minlength=n) if len(key) else np.zeros(n)


def analyse(texts: list[str], p: Profiles) -> dict[str, np.ndarray]:
    """Passages of each text: text, language, start, end, words, confidence; and the words of each text in any language.

    Sentences are scored by all profiles. Along a text the likeliest sequence of languages is taken, where a change
    costs something (one vectorised step for each sentence number). Passages shorter than a few words, as quotes
    and names, join their surroundings, and equal neighbours become one.
    """
    b = Block([without_code(t) for t in texts])
    lc = natural_letters(b)
    g = triples(lc)
    rows = p.index[g]
    rows[g < 0] = 0
    us, ue = units(b)
    m = len(us)
    L = len(LANGUAGES)
    empty = {k: np.zeros(0, np.int64) for k in ("text", "lang", "start", "end", "words")} | {"conf": np.zeros(0), "size": np.zeros(b.n, np.int64), "ja_size": np.zeros(b.n, np.int64), "other": np.zeros(b.n, np.int64), "other_ja": np.zeros(b.n, np.int64), "total": np.zeros((b.n, L))}
    if not m:
        return empty
    owner = b.owner(us)
    known = rows > 0
    score = np.add.reduceat(p.table[rows], us, axis=0)
    grams = np.add.reduceat(known.astype(np.int32), us)
    all_grams = np.add.reduceat((g >= 0).astype(np.int32), us)
    ja = np.add.reduceat((lc >= JA).astype(np.int32), us)
    ws, _ = b.runs(lc > 0)
    plain = lc[ws] < JA
    words = np.bincount(np.searchsorted(us, ws[plain], side="right") - 1, minlength=m)
    # Cosine of a unit with each profile. The vectors of different triples are orthogonal but for 1 / sqrt(DIM), so the
    # square of the length of a unit's vector is the sum of the squares of its triples' counts; the table has sqrt(DIM).
    length = np.maximum(1.0, squares(g, us, m))
    cosine = score / np.sqrt(length)[:, None]
    mass = np.where(ja > 3 * words, ja / 2.4, words)  # in words
    best = cosine.max(1)
    natural = (mass >= 2) & (all_grams - ja >= OTHER_WORD[0] * words)
    usable = natural & (best / np.sqrt(length) >= LEAST) & (grams >= 0.6 * all_grams)
    # the emission is the cosine, of one triple on average, for each word: long units tell more than short ones
    value = np.where(usable[:, None], cosine / np.sqrt(length)[:, None] * mass[:, None], 0.0)
    spread_of = np.abs(p.table).mean() + 1e-9
    value /= spread_of
    foreign = np.add.reduceat(((lc == JA - 1) | (lc >= KANJI)).astype(np.int32), us)  # letters of other scripts, and kanji
    strange = natural & ~usable & (all_grams - ja <= OTHER_WORD[1] * words) & ((foreign > 0.5 * all_grams) | (grams >= OTHER_KNOWN * all_grams) & (length <= 4 * all_grams))
    per_text = lambda who, weight: np.bincount(owner[who], weights=weight[who], minlength=b.n).astype(np.int64)
    empty |= {"other": per_text(np.flatnonzero(strange), words), "other_ja": per_text(np.flatnonzero(strange), ja)}
    # Viterbi over the units of each text
    new = np.concatenate([[True], owner[1:] != owner[:-1]])
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, m))
    total = value.copy()
    back = np.zeros((m, L), np.int8)
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    for k in range(1, int(length[0])):
        at = begin[: np.searchsorted(-length, -k, side="left")] + k
        prev = total[at - 1]
        top = prev.argmax(1)
        jump = prev[np.arange(len(at)), top] - CHANGE
        stay = prev >= jump[:, None]
        back[at] = np.where(stay, np.arange(L), top[:, None])
        total[at] += np.where(stay, prev, jump[:, None])
    state = np.zeros(m, np.int8)
    ends = begin + length - 1
    state[ends] = total[ends].argmax(1)
    for k in range(int(length[0]) - 1, 0, -1):
        at = begin[: np.searchsorted(-length, -k, side="left")] + k
        state[at - 1] = back[at, state[at]]
    # passages: runs of a language over the usable units; short foreign ones between go first
    u = np.flatnonzero(usable)
    size_words, size_ja = per_text(u, words), per_text(u, ja)
    whole = np.zeros((b.n, L))
    np.add.at(whole, owner[u], value[u])
    for least in (6, 12):
        if not len(u):
            return empty | {"size": size_words, "ja_size": size_ja, "total": whole}
        run = np.cumsum(np.concatenate([[True], (state[u][1:] != state[u][:-1]) | (owner[u][1:] != owner[u][:-1])])) - 1
        run_words = np.bincount(run, weights=mass[u])
        runs_of = np.bincount(owner[u][np.concatenate([[True], run[1:] != run[:-1]])], minlength=b.n)
        keep = (run_words[run] >= least) | (runs_of[owner[u]] == 1)
        u = u[keep]
    if not len(u):
        return empty | {"size": size_words, "ja_size": size_ja, "total": whole}
    head = np.concatenate([[True], (state[u][1:] != state[u][:-1]) | (owner[u][1:] != owner[u][:-1])])
    run = np.cumsum(head) - 1
    at = np.flatnonzero(head)
    last = np.append(at[1:], len(u)) - 1
    run_score = np.add.reduceat(score[u], at, axis=0)
    run_grams = np.add.reduceat(all_grams[u], at)
    lang = state[u][at].astype(np.int64)
    mine = run_score[np.arange(len(at)), lang]
    run_score[np.arange(len(at)), lang] = -np.inf
    rival = np.maximum(0, run_score.max(1))
    conf = np.clip((mine - rival) / np.maximum(1e-9, mine), 0, 1)
    return empty | {"text": owner[u][at], "lang": lang, "start": us[u][at] - b.offsets[owner[u][at]], "end": ue[u][last] - b.offsets[owner[u][at]], "words": np.where(lang == LANGUAGES.index("ja"), np.add.reduceat(ja[u], at), np.add.reduceat(words[u], at)), "conf": conf, "grams": run_grams, "size": size_words, "ja_size": size_ja, "total": whole}


def languages_of(r: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, language, confidence): the languages that count in each text; the likeliest one where no passage is long enough;
    number len(LANGUAGES), with confidence 0, for a text in a language that no profile fits."""
    n, L = r["total"].shape
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    ja = LANGUAGES.index("ja")
    enough = (r["size"] >= TEXT) | (r["ja_size"] >= TEXT_JA)
    conf = np.zeros((n, L))
    long = np.where(r["lang"] == ja, r["words"] >= PASSAGE_JA, r["words"] >= PASSAGE) if len(r["lang"]) else np.zeros(0, bool)
    np.maximum.at(conf, (r["text"][long], r["lang"][long]), np.maximum(1e-6, r["conf"][long]))
    alone = enough & ~conf.any(1)
    top = r["total"].argmax(1)
    who = np.flatnonzero(alone & (r["total"].max(1) > 0))
    conf[who, top[who]] = 1e-6
    conf[~enough] = 0
    t, lang = np.nonzero(conf)
    # texts in a language of no profile: enough words that look like a language, none of those known
    u = np.flatnonzero(~conf.any(1) & ((r["other"] >= TEXT) | (r["other_ja"] >= TEXT_JA)))
    return np.concatenate([t, u]), np.concatenate([lang, np.full(len(u), L)]), np.concatenate([conf[t, lang], np.zeros(len(u))])


def label_language(label: Column) -> Column:
    """The two-letter code that a label means; null where it says nothing, the label itself in lower case where it is another language."""
    c = F.lower(F.trim(F.regexp_replace(label, r"\p{IsWhite_Space}+", " ")))
    head = F.regexp_extract(c, r"^([a-z]*)(?:[-_ (].*)?$", 1)
    known = {x: two for two, more in SPELLINGS.items() for x in (two, *more)} | {x: "" for x in UNKNOWN}
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.nullif(F.coalesce(F.element_at(table, F.when(c == "", "").when(head != "", head)), c), F.lit(""))


def labelled_sample(documents: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """lang, c, text: at most `sample` different labelled texts of each language, chosen by a hash of the text (c); of each, its
    first SAMPLE_CHARS code points. Copies count once."""
    rows = documents.select(F.col(text).alias("text"), label_language(F.col(lang)).alias("lang")).where(F.col("lang").isin(*LANGUAGES) & (F.length("text") >= 200))
    # Copies have one hash: they count once, and are sampled once.
    hashes = rows.select("lang", F.xxhash64("text").alias("h")).distinct()
    counts = {r["lang"]: r["n"] for r in hashes.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    chance = F.pmod(F.xxhash64("text"), F.lit(1_000_000_000))
    most = F.lit(False)
    for k, n in counts.items():
        most = most | (F.col("lang") == k) & (chance < int(min(1.0, 1.3 * sample / n) * 1_000_000_000))
    picked = rows.where(most).select("lang", "text", chance.alias("c")).distinct()
    picked = picked.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("c", "text"))).where(F.col("n") <= sample)

    return picked.select("lang", "c", F.substring("text", 1, SAMPLE_CHARS).alias("text"))


def train(documents: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Profiles:
    """Profiles fitted on labelled_sample(), in one task; the driver gets the profiles alone. Only this fit is on a sample:
    all texts are judged, and whole."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted(r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(3))))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit([t for _, _, t in got], [k for k, _, _ in got]))], pa.binary())], names=["profiles"])

    fitted = labelled_sample(documents, text, lang, sample).coalesce(1).mapInArrow(learn, "profiles binary").first()
    return pickle.loads(fitted[0]) if fitted else fit([], [])


def passages(documents: DataFrame, profiles: Profiles, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang, char_start, char_end, words, confidence of every passage of every text; words are characters for Japanese.

    Null, empty and blank texts, and such without natural language, give nothing. Rows count as they come, repeated
    ones and null keys too; other columns are ignored. No shuffle.
    """
    kind = dict(documents.dtypes)[key]
    shared = documents.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, texts = b.column(0), [t or "" for t in b.column(1).to_pylist()]
            for lo, hi in blocks(texts, 1 << 18):
                r = analyse(texts[lo:hi], shared.value)
                yield pa.RecordBatch.from_arrays([keys.slice(lo, hi - lo).take(pa.array(r["text"], pa.int64())), pa.array([LANGUAGES[x] for x in r["lang"]], pa.string()), pa.array(r["start"], pa.int32()), pa.array(r["end"], pa.int32()), pa.array(r["words"], pa.int32()), pa.array(r["conf"], pa.float64())], names=["key", "lang", "char_start", "char_end", "words", "confidence"])

    return documents.where(F.length(text) > 0).select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, lang string, char_start int, char_end int, words int, confidence double")


def document_languages(documents: DataFrame, profiles: Profiles, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """key, label (what the stored label means), lang, confidence, languages: a row for each language that counts in a text, 'und' for
    a text in another language. Rows as in passages()."""
    kind = dict(documents.dtypes)[key]
    shared = documents.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(2).to_pylist()]
            for lo, hi in blocks(texts, 1 << 18):
                t, k, c = languages_of(analyse(texts[lo:hi], shared.value))
                at = pa.array(t, pa.int64())
                several = np.bincount(t, minlength=hi - lo)[t] if len(t) else t
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo).take(at), b.column(1).slice(lo, hi - lo).take(at), pa.array([(*LANGUAGES, OTHER)[x] for x in k], pa.string()), pa.array(c, pa.float64()), pa.array(several, pa.int32())], names=["key", "label", "lang", "confidence", "languages"])

    rows = documents.where(F.length(text) > 0).select(F.col(key).alias("key"), label_language(F.col(lang)).alias("label"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, label string, lang string, confidence double, languages int")


def found(documents: DataFrame) -> DataFrame:
    """doc_id and lang of the texts whose label is missing, names another language, or stands on a text in several. Texts in a
    language without a profile have no two-letter code here and are left to document_languages()."""
    d = document_languages(documents, train(documents)).where(F.col("lang") != OTHER)
    return d.where("label is null or label <> lang or languages > 1").select(F.col("key").alias("doc_id"), "lang").distinct()
