"""Text expressions: normal forms, counts, readability, quality, summaries, keywords, slugs, similarity.

Structure (headings, lists, links) is that of Markdown with ASCII blanks; words are parted by Unicode white space.
A null text counts as empty unless a function says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The Unicode property White_Space, as a class that Java and RE2 both read.
WS = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
HEADING = r"(?md)^#+[ \t]"
LIST_ITEM = r"(?md)^[ \t]*[-*+][ \t]+"
IMAGE = r"!\[[^\]\n]*\]"
LINK = r"\[[^\]\n]*\]\([^)\n]*\)"
BROKEN_LINK = r"\[[^\]\n]*\]\((?:[ \t]*|#)\)"
TABLE_LINE = r"\|[^\n]*\|"
#: What each flag takes off the quality score.
PENALTIES = {"empty_body": 1.0, "too_short": 0.6, "too_long": 0.2, "image_only": 0.5, "no_structure": 0.3, "broken_links": 0.1}
#: The terms of each taxonomy label.
TAXONOMY = {
    "api-documentation": ("api", "endpoint", "rest", "json"),
    "setup-guide": ("install", "setup", "configuration", "config"),
    "tutorial": ("tutorial", "how to", "step by step", "guide"),
    "release-notes": ("release", "changelog", "version", "update"),
    "troubleshooting": ("troubleshoot", "error", "issue", "problem"),
}
#: Technical terms that count as keywords in any case.
TECH_TERMS = "API|JSON|XML|HTML|CSS|JavaScript|Python|Java|SQL|REST|HTTP|HTTPS|URL|ID|UUID"
ACCENTED = "йёáàâäãåāăąçćčďéèêëēėęěíìîïīįñńňóòôöõōőřŕśšťúùûüūůűųýÿžźż"
PLAIN = "иеaaaaaaaaacccdeeeeeeeeiiiiiinnnooooooorrsstuuuuuuuuyyzzz"


def text_of(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{WS}]+|[{WS}]+$", "")


def normalize_text(c: Column) -> Column:
    """One kind of line end, no more than one empty line in a row, no white space around."""
    lf = F.regexp_replace(text_of(c), r"\r\n?", "\n")
    return strip(F.regexp_replace(lf, r"\n{3,}", "\n\n"))


def count_tokens(c: Column) -> Column:
    """The estimate of four characters a token."""
    return F.floor(F.length(text_of(c)) / 4).cast("int")


def word_count(c: Column) -> Column:
    return F.regexp_count(text_of(c), F.lit(f"[^{WS}]+"))


def count(c: Column, pattern: str) -> Column:
    return F.regexp_count(text_of(c), F.lit(pattern))


def words(c: Column) -> Column:
    """Runs of letters and digits in lower case."""
    return F.regexp_extract_all(F.lower(text_of(c)), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def readability(c: Column) -> dict[str, Column]:
    """chars_per_word, words_per_paragraph, heading_ratio; unrounded. Blank texts give zeros."""
    t = text_of(c)
    clean = F.regexp_replace(t, r"[#*`\[\]()_]", "")
    n_words = F.regexp_count(clean, F.lit(f"[^{WS}]+"))
    n_chars = F.length(F.regexp_replace(clean, f"[{WS}]+", ""))
    paragraphs = F.size(F.filter(F.split(t, r"\n[ \t\r\f]*\n[ \t\r\n\f]*|^#"), lambda p: F.length(F.regexp_replace(p, f"[{WS}]+", "")) > 0))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return {"chars_per_word": ratio(n_chars, n_words), "words_per_paragraph": ratio(n_words, paragraphs), "heading_ratio": ratio(count(c, HEADING), paragraphs)}


def density(n: Column, c: Column) -> Column:
    """n per thousand characters; 0 for an empty text."""
    return F.when(F.length(text_of(c)) > 0, n * 1000.0 / F.length(text_of(c))).otherwise(0.0)


def media_density(c: Column, attachments: Column) -> Column:
    return density(count(c, IMAGE) + attachments, c)


def link_density(c: Column, links: Column) -> Column:
    return density(F.greatest(count(c, LINK), links), c)


def flags_of(n: Column, headings: Column, images: Column, broken: Column, attachments: Column) -> Column:
    """The flags in their order, from counts: empty_body, too_short or too_long, image_only, no_structure, broken_links."""
    return F.array_compact(F.array(
        F.when(n == 0, F.lit("empty_body")),
        F.when(n < 10, F.lit("too_short")).when(n > 10000, F.lit("too_long")),
        F.when((attachments > 0) & (n < 50) & (images >= attachments), F.lit("image_only")),
        F.when((n > 200) & (headings == 0), F.lit("no_structure")),
        F.when(broken > 0, F.lit("broken_links")),
    ))


def quality_flags(c: Column, attachments: Column) -> Column:
    return flags_of(word_count(c), count(c, HEADING), count(c, IMAGE), count(c, BROKEN_LINK), attachments)


def structure_of(n: Column, headings: Column) -> Column:
    return F.least(F.lit(1.0), headings / F.greatest(F.lit(1.0), n / 200.0))


def quality_score(flags: Column, structure: Column, n_words: Column) -> Column:
    """1 less the penalties, never below 0, plus a tenth each for structure and for a usual length, never above 1."""
    table = F.create_map(*[F.lit(x) for p in PENALTIES.items() for x in p])
    base = F.aggregate(flags, F.lit(1.0), lambda acc, f: F.greatest(F.lit(0.0), acc - F.coalesce(F.element_at(table, f), F.lit(0.1))))
    more = F.when(structure > 0.1, F.least(F.lit(1.0), base + 0.1)).otherwise(base)
    return F.round(F.when(n_words.between(50, 2000), F.least(F.lit(1.0), more + 0.1)).otherwise(more), 3)


def summary(c: Column) -> Column:
    """The first sentence, at most 300 characters."""
    first = strip(F.element_at(F.split(text_of(c), r"[.!?][ \t\r\n\f]+", 2), 1))
    return F.when(F.length(first) > 300, F.concat(F.substring(first, 1, 297), F.lit("..."))).otherwise(first)


def keywords(c: Column) -> Column:
    """Capitalised words, then technical terms in any case; the first eight different ones."""
    all_words = F.regexp_extract_all(text_of(c), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))
    caps = F.filter(all_words, lambda w: w.rlike("^[A-Z][a-z]+$"))
    tech = F.filter(all_words, lambda w: w.rlike(f"^(?i:{TECH_TERMS})$"))
    return F.slice(F.array_distinct(F.concat(caps, tech)), 1, 8)


def taxonomy(c: Column, source_system: Column) -> Column:
    low = F.lower(text_of(c))
    labels = []
    for label, terms in TAXONOMY.items():
        hit = None
        for t in terms:
            hit = low.contains(t) if hit is None else hit | low.contains(t)
        labels.append(F.when(hit, F.lit(label)))
    labels.append(F.when(F.length(source_system) > 0, F.concat(F.lit("source-"), source_system)))
    return F.slice(F.array_compact(F.array(*labels)), 1, 5)


def collection(existing: Column, space_key: Column, source_system: Column) -> Column:
    filled = lambda x: F.when(F.length(x) > 0, x)
    return F.coalesce(filled(existing), F.lower(filled(space_key)), source_system, F.lit("unknown"))


def path_tags(breadcrumbs: Column, url: Column, c: Column) -> Column:
    """Tags of the breadcrumbs but the last, of the space in the URL, and of telling headings; distinct, in that order."""
    crumb = lambda x: F.regexp_replace(F.replace(F.lower(x), F.lit(" "), F.lit("-")), r"[^\p{L}\p{N}_\-]", "")
    above = F.when(F.size(breadcrumbs) > 1, F.slice(breadcrumbs, F.lit(1), F.size(breadcrumbs) - 1)).otherwise(F.array().cast("array<string>"))
    tags = F.filter(F.transform(above, crumb), lambda x: F.length(x) > 2)
    space = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"/spaces/([^/]*)/pages/[^/]*", 1))
    more = [F.when(F.length(space) > 0, space)] + [F.when(text_of(c).contains(f"# {t}"), F.lit(t.lower())) for t in ("API", "Installation", "Configuration")]
    return F.array_distinct(F.concat(tags, F.array_compact(F.array(*more))))


def content_type(c: Column) -> Column:
    """table, code, macro or text. Single words that repeat make a table if they do so among the first 50 lines that aren't
    blank, a fixed value of the rule; all else looks at the whole text."""
    t = strip(text_of(c))
    table = t.rlike(r"\|[^\n]*\|[^\n]*\|") | t.rlike(r"(?is)<table.*?</table>")
    lines = F.filter(F.transform(F.split(t, "\n"), strip), lambda x: F.length(x) > 0)
    single = F.filter(F.slice(lines, 1, 50), lambda x: ~x.rlike(f"[{WS}]") & ~x.startswith("#"))
    repeated = F.size(F.filter(F.array_distinct(single), lambda x: F.size(F.filter(single, lambda y: y == x)) > 2))
    structured = (F.size(F.split(t, "\n")) > 10) & (F.size(lines) > 20) & (repeated > 3)
    code = t.rlike(r"(?md)^```\w*\n[\s\S]*?^```$")
    macros = sum((count(t, p) for p in (r"\{[^}]+\}", r"(?i)<ac:[^>]+[/>]", r"\[\w+:[^\]]+\]", r"<!-- [^\n]* -->")), F.lit(0))
    return F.when(table | structured, "table").when(code, "code").when(macros > 3, "macro").otherwise("text")


def canon(c: Column) -> Column:
    """Lower case without accents, dashes and punctuation; single blanks."""
    low = F.translate(F.lower(text_of(c)), ACCENTED, PLAIN)
    return F.trim(F.regexp_replace(F.regexp_replace(low, r"_", " "), r"[^\p{L}\p{N}]+", " "))


def stem_word(c: Column) -> Column:
    """Without -ing (words of more than four letters), else without -ed (of more than three)."""
    cut = lambda n: F.substring(c, F.lit(1), F.length(c) - n)
    return F.when(c.endswith("ing") & (F.length(c) > 4), cut(3)).when(c.endswith("ed") & (F.length(c) > 3), cut(2)).otherwise(c)


def contains_term(canonical: Column, term: Column) -> Column:
    """Is the canonical term, or its stem, among the words of a canonical text?"""
    padded = F.concat(F.lit(" "), canonical, F.lit(" "))
    has = lambda t: padded.contains(F.concat(F.lit(" "), t, F.lit(" ")))
    return (F.length(term) > 0) & (has(term) | has(stem_word(term)))


def doc_slug(url: Column, title: Column) -> Column:
    """The canonical last part of a URL, else the canonical title."""
    part = lambda p, g: F.nullif(F.regexp_extract(F.coalesce(url, F.lit("")), p, g), F.lit(""))
    tail = F.coalesce(part(r"/pages/\d+/([^/?]+)", 1), part(r"/([^/]+?)(?:\.(?:md|txt|rst))?/?$", 1))
    return F.when(tail.isNotNull(), canon(tail)).otherwise(canon(title))


def query_slug(c: Column) -> Column:
    """Only letters, digits, - and _, without a row of _ or any at the ends."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text_of(c), r"[^A-Za-z0-9_\-]", "_"), "_+", "_"), "^_|_$", "")


def trigrams(c: Column) -> Column:
    """The different trigrams of the words of a text, each with two blanks before and one behind."""
    padded = F.transform(words(c), lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    return F.array_distinct(F.flatten(F.transform(padded, lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: F.substring(p, i, F.lit(3))))))


def trigram_similarity(a: Column, b: Column) -> Column:
    """Shared trigrams over all trigrams; a and b are trigram sets."""
    both = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) - both > 0, both / (F.size(a) + F.size(b) - both)).otherwise(0.0)


def truncate_tokens(c: Column, cap: int, suffix: str = "") -> Column:
    """The longest start of the text that has at most `cap` tokens (of four characters) with the suffix behind it."""
    most = 4 * cap + 3
    return F.when(F.length(c) <= most, c).otherwise(F.concat(F.substring(c, 1, most - len(suffix)), F.lit(suffix)))


def orphan_heading(c: Column) -> Column:
    """At most one line that isn't blank, and that one a heading."""
    lines = F.filter(F.split(text_of(c), "\n"), lambda x: F.length(strip(x)) > 0)
    return (F.size(lines) <= 1) & F.coalesce(F.try_element_at(lines, F.lit(1)).rlike(r"^[ \t]*#"), F.lit(True))


def table_digest(c: Column, rows: int = 5) -> Column:
    """The head of the first table, its rule, its first rows and how many more lines with cells the text has; null without a table."""
    cells = F.filter(F.split(text_of(c), "\n"), lambda x: x.contains("|"))
    more = F.size(cells) - 2 - rows
    shown = F.array_join(F.slice(cells, 1, 2 + rows), "\n")
    return F.when(F.size(cells) >= 2, F.when(more > 0, F.concat(shown, F.lit("\n... ("), more.cast("string"), F.lit(" more rows)"))).otherwise(shown))


def code_digest(c: Column, lines: int = 3) -> Column:
    """The language of the first fenced block, the names it defines (at most eight, in order) and its first lines; null without one."""
    body = F.regexp_extract(text_of(c), r"(?s)```\w*\n(.*?)\n?```", 1)
    lang = F.regexp_extract(text_of(c), r"```(\w*)\n", 1)
    names = F.slice(F.array_distinct(F.regexp_extract_all(body, F.lit(r"(?:def|class|function|export)[ \t]+(\w+)"), F.lit(1))), 1, 8)
    head = F.concat(F.lit("Code ("), F.when(lang != "", lang).otherwise("text"), F.lit("): "), F.array_join(names, ", "), F.lit("\n"))
    return F.when(text_of(c).rlike(r"(?s)```\w*\n.*?```"), F.concat(head, F.array_join(F.slice(F.split(body, "\n"), 1, lines), "\n")))
