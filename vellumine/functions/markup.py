"""HTML, editor JSON (ADF) and XML topics as Markdown, and their links and media. Arrow-backed UDFs over the standard library's parsers."""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F

_SKIP = frozenset(("script", "style", "noscript"))
_BLOCKS = frozenset(("p", "div", "section", "article", "table", "ul", "ol", "blockquote", "pre", "h1", "h2", "h3", "h4", "h5", "h6"))
_VOID = frozenset(("br", "hr", "img", "input", "meta", "link", "col"))
_MARKS = {"code": "`", "strong": "**", "em": "*", "strike": "~~"}
#: Media types by file ending.
MEDIA_TYPES = {"image": ("png", "jpg", "jpeg", "gif", "svg", "webp", "bmp"), "video": ("mp4", "mov", "avi", "webm"), "audio": ("mp3", "wav", "ogg"), "document": ("pdf", "doc", "docx", "xls", "xlsx", "ppt", "pptx")}


def tidy(text: str) -> str:
    text = re.sub(r"\r\n?", "\n", text)
    text = re.sub(r"[ \t]+\n", "\n", text)
    return re.sub(r"\n{3,}", "\n\n", text).strip()


class _Html(HTMLParser):
    """Writes Markdown as tags come; unclosed tags are tolerated."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.lists: list[int] = []  # -1 for bullets, else the next number
        self.skip = 0
        self.pre = 0
        self.hrefs: list[tuple[str, int]] = []
        self.cells: list[str] | None = None
        self.rows = 0
        self.links: list[tuple[str, str]] = []
        self.media: list[dict] = []

    def text(self) -> str:
        return tidy("".join(self.out))

    def _block(self) -> None:
        if self.out and self.cells is None:
            self.out.append("\n\n")

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(attrs)
        if tag in _SKIP:
            self.skip += 1
        elif tag in ("ac:image", "ri:attachment", "img"):
            name = a.get("ri:filename") or a.get("alt") or (a.get("src") or "").rsplit("/", 1)[-1]
            if tag != "ac:image":
                self.media.append({"filename": name, "url": a.get("src") or "", "media_type": media_type(name)})
            if tag == "img":
                self.out.append(f"![{a.get('alt') or ''}]({a.get('src') or ''})")
        elif tag[0] == "h" and tag[1:].isdigit():
            self._block()
            self.out.append("#" * min(6, int(tag[1:])) + " ")
        elif tag in ("ul", "ol"):
            self._block()
            self.lists.append(-1 if tag == "ul" else 1)
        elif tag == "li":
            depth = "    " * max(0, len(self.lists) - 1)
            n = self.lists[-1] if self.lists else -1
            self.out.append(f"\n{depth}{'*' if n < 0 else f'{n}.'} ")
            if n > 0:
                self.lists[-1] += 1
        elif tag in ("strong", "b"):
            self.out.append("**")
        elif tag in ("em", "i"):
            self.out.append("*")
        elif tag == "pre":
            self._block()
            self.out.append("```\n")
            self.pre += 1
        elif tag == "code" and not self.pre:
            self.out.append("`")
        elif tag == "br":
            self.out.append("\n")
        elif tag == "hr":
            self.out.append("\n\n---\n\n")
        elif tag == "a":
            self.hrefs.append((a.get("href") or "", len(self.out)))
        elif tag == "table":
            self._block()
            self.rows = 0
        elif tag == "tr":
            self.cells = []
        elif tag in ("td", "th"):
            if self.cells is not None:
                self.cells.append("")
        elif tag in _BLOCKS:
            self._block()
            if tag == "blockquote":
                self.out.append("> ")

    def handle_endtag(self, tag: str) -> None:
        if tag in _SKIP:
            self.skip = max(0, self.skip - 1)
        elif tag in ("ul", "ol"):
            if self.lists:
                self.lists.pop()
            self._block()
        elif tag in ("strong", "b"):
            self.out.append("**")
        elif tag in ("em", "i"):
            self.out.append("*")
        elif tag == "pre":
            self.out.append("\n```")
            self.pre = max(0, self.pre - 1)
            self._block()
        elif tag == "code" and not self.pre:
            self.out.append("`")
        elif tag == "a" and self.hrefs:
            href, at = self.hrefs.pop()
            label = "".join(self.out[at:])
            if href:
                self.links.append((href, re.sub(r"\s+", " ", label).strip()))
                self.out[at:] = [f"[{label}]({href})"]
        elif tag == "tr" and self.cells is not None:
            row, self.cells = self.cells, None
            self.out.append("| " + " | ".join(re.sub(r"\s+", " ", c).strip() for c in row) + " |\n")
            if not self.rows:
                self.out.append("|" + " --- |" * len(row) + "\n")
            self.rows += 1
        elif tag in _BLOCKS:
            self._block()

    def handle_data(self, data: str) -> None:
        if self.skip:
            return
        if self.cells is not None:
            if self.cells:
                self.cells[-1] += data
        else:
            self.out.append(data if self.pre else re.sub(r"\s+", " ", data))


def _parsed(html: str | None) -> _Html:
    p = _Html()
    p.feed(html or "")
    p.close()
    return p


def html_markdown(html: str | None) -> str:
    return _parsed(html).text()


def html_links(html: str | None) -> list[str]:
    """Different targets, sorted."""
    return sorted({h for h, _ in _parsed(html).links})


def media_type(name: str | None) -> str:
    end = (name or "").rsplit(".", 1)[-1].lower()
    return next((k for k, ends in MEDIA_TYPES.items() if end in ends), "file")


def html_media(html: str | None) -> list[dict]:
    return [{"ord": i} | m for i, m in enumerate(_parsed(html).media)]


def _adf(adf: str | dict | None) -> dict:
    try:
        d = json.loads(adf) if isinstance(adf, str) else adf
    except ValueError:
        return {}
    return d if isinstance(d, dict) else {}


def adf_markdown(adf: str | dict | None) -> str:
    """Paragraphs, headings, quotes, panels, code and lists; unknown blocks give their content."""
    d = _adf(adf)
    return _adf_blocks(d.get("content")) if d.get("type") == "doc" else ""


def _adf_inline(nodes: list | None) -> str:
    out = []
    for n in nodes or []:
        if n.get("type") == "hardBreak":
            out.append("\n")
        elif n.get("type") == "text":
            t = n.get("text") or ""
            marks = {m.get("type"): m for m in n.get("marks") or []}
            for kind, sign in _MARKS.items():
                if kind in marks:
                    t = f"{sign}{t}{sign}"
            href = (marks.get("link", {}).get("attrs") or {}).get("href")
            out.append(f"[{t}]({href})" if href else t)
    return "".join(out).strip()


def _adf_blocks(nodes: list | None) -> str:
    return tidy("\n\n".join(b for b in (_adf_block(n).strip() for n in nodes or []) if b))


def _adf_block(n: dict) -> str:
    kind, attrs, content = n.get("type"), n.get("attrs") or {}, n.get("content") or []
    inner = lambda c: [x for x in _adf_blocks(c).split("\n") if x.strip()]
    if kind == "paragraph":
        return _adf_inline(content)
    if kind == "heading":
        return f"{'#' * max(1, min(6, int(attrs.get('level') or 1)))} {_adf_inline(content)}"
    if kind in ("blockquote", "panel"):
        return "\n".join(f"> {x}".rstrip() for x in _adf_blocks(content).split("\n"))
    if kind == "codeBlock":
        return f"```{attrs.get('language') or ''}\n{''.join(c.get('text') or '' for c in content)}\n```"
    if kind == "bulletList":
        return "\n".join(f"- {x}" for li in content for x in inner(li.get("content")))
    if kind == "orderedList":
        rows = [x for li in content for x in inner(li.get("content"))]
        return "\n".join(f"{i}. {x}" for i, x in enumerate(rows, int(attrs.get("order") or 1)))
    return _adf_blocks(content) if content else ""


def _adf_walk(n: object):
    if isinstance(n, dict):
        yield n
        for v in n.values():
            yield from _adf_walk(v)
    elif isinstance(n, list):
        for v in n:
            yield from _adf_walk(v)


def adf_links(adf: str | dict | None) -> list[str]:
    """Different targets of link marks and cards, sorted."""
    out = set()
    for n in _adf_walk(_adf(adf)):
        if n.get("type") == "link":
            out.add((n.get("attrs") or {}).get("href"))
        elif n.get("type") in ("inlineCard", "blockCard"):
            out.add((n.get("attrs") or {}).get("url"))
    return sorted(x for x in out if x)


def adf_media(adf: str | dict | None) -> list[dict]:
    out = []
    for n in _adf_walk(_adf(adf)):
        if n.get("type") == "media":
            a = n.get("attrs") or {}
            name = a.get("alt") or (a.get("url") or "").rsplit("/", 1)[-1]
            kind = media_type(name)
            out.append({"ord": len(out), "filename": name, "url": a.get("url") or "", "media_type": kind if kind != "file" else "image" if a.get("type") == "file" and not name else kind})
    return out


def canonical_json(value: str | None) -> str | None:
    """Sorted keys, no blanks; null for null, the text itself where it is no JSON."""
    if value is None:
        return None
    try:
        return json.dumps(json.loads(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    except ValueError:
        return value


def _tree(xml: str | None) -> ET.Element | None:
    try:
        return ET.fromstring(re.sub(r"<!DOCTYPE[^>\[]*(\[[^\]]*\])?[^>]*>", "", xml or ""))
    except ET.ParseError:
        return None


def xml_markdown(xml: str | None) -> str:
    """A topic's titles, paragraphs, lists, code, notes, tables and links; broken XML gives its text without tags."""
    root = _tree(xml)
    if root is None:
        return tidy(re.sub(r"[ \t]+", " ", re.sub(r"<[^>]+>", " ", xml or "")))
    return tidy(_topic(root, 0))


def _flat(e: ET.Element, level: int) -> str:
    parts = [e.text or ""]
    for c in e:
        parts += [_topic(c, level), c.tail or ""]
    return re.sub(r"[ \t]*\n[ \t]*(?!\n)", lambda m: m[0].strip(" \t"), "".join(parts))


def _topic(e: ET.Element, level: int) -> str:
    tag = e.tag.rsplit("}", 1)[-1].lower()
    if tag == "prolog":
        return ""  # metadata, which xml_topic() reads
    if tag in ("concept", "task", "reference", "topic", "section"):
        return "\n\n" + _flat(e, level + 1) + "\n\n"
    text = _flat(e, level)
    line = re.sub(r"\s+", " ", text).strip()
    if tag in ("title", "navtitle"):
        return f"\n\n{'#' * min(6, max(1, level))} {line}\n\n"
    if tag in ("p", "shortdesc", "abstract", "cmd", "info"):
        return f"\n\n{line}\n\n"
    if tag in ("codeblock", "screen", "pre"):
        return f"\n\n```\n{text.strip()}\n```\n\n"
    if tag in ("ul", "ol", "steps", "steps-unordered"):
        items = [re.sub(r"\s+", " ", _flat(c, level)).strip() for c in e]
        return "\n\n" + "\n".join(f"- {x}" if tag in ("ul", "steps-unordered") else f"{i}. {x}" for i, x in enumerate(items, 1)) + "\n\n"
    if tag == "note":
        return f"\n\n> {line}\n\n"
    if tag in ("row", "strow", "sthead"):
        return "| " + " | ".join(re.sub(r"\s+", " ", _flat(c, level)).strip() for c in e) + " |\n"
    if tag in ("b", "uicontrol"):
        return f"**{line}**"
    if tag == "i":
        return f"*{line}*"
    if tag in ("codeph", "filepath", "cmdname"):
        return f"`{line}`"
    if tag in ("xref", "link"):
        href = e.get("href") or ""
        return f"[{line or href}]({href})" if href else line
    if tag == "image":
        return f"![{e.get('alt') or ''}]({e.get('href') or ''})"
    return text


def xml_links(xml: str | None) -> list[dict]:
    """Cross references, related links, reused content and map entries, in that order: kind, target, text."""
    root = _tree(xml)
    out: list[dict] = []
    if root is not None:
        for tags, attrs in ((("xref",), ("href", "keyref")), (("link",), ("href", "keyref")), (None, ("conref", "conkeyref")), (("topicref", "mapref", "chapter"), ("href", "keyref"))):
            for e in root.iter():
                tag = e.tag.rsplit("}", 1)[-1].lower()
                for a in attrs:
                    if (tags is None or tag in tags) and e.get(a):
                        out.append({"kind": a if tags is None else tag, "target": e.get(a), "text": "".join(e.itertext()).strip()})
    return out


def xml_topic(xml: str | None) -> dict:
    """title, keywords, othermeta ('name:content'), images of a topic."""
    root = _tree(xml)
    if root is None:
        return {"title": None, "keywords": [], "othermeta": [], "images": []}
    title = next((e for e in root.iter() if e.tag.rsplit("}", 1)[-1] == "title"), None)
    return {
        "title": None if title is None else re.sub(r"\s+", " ", "".join(title.itertext())).strip(), "keywords": [("".join(e.itertext())).strip() for e in root.iter("keyword")],
        "othermeta": [f"{e.get('name')}:{e.get('content')}" for e in root.iter("othermeta")], "images": [e.get("href") for e in root.iter("image") if e.get("href")],
    }


def xml_map(xml: str | None) -> list[dict]:
    """Entries of a map, each once, in document order: depth, target, title, key."""
    root = _tree(xml)
    out: list[dict] = []

    def walk(e: ET.Element, depth: int) -> None:
        for c in e:
            tag = c.tag.rsplit("}", 1)[-1].lower()
            ref = tag in ("topicref", "mapref", "chapter", "keydef")
            if ref:
                out.append({"depth": depth, "target": c.get("href") or "", "title": c.get("navtitle") or "", "key": c.get("keys") or ""})
            walk(c, depth + ref)

    if root is not None:
        walk(root, 0)
    return out


def _udf(f, kind: str):
    @F.pandas_udf(kind)
    def run(s: pd.Series) -> pd.Series:
        return s.map(f)

    return run


MEDIA = "array<struct<ord:int,filename:string,url:string,media_type:string>>"


def html_to_markdown(c):
    return _udf(html_markdown, "string")(c)


def adf_to_markdown(c):
    return _udf(adf_markdown, "string")(c)


def xml_to_markdown(c):
    return _udf(xml_markdown, "string")(c)


def links_of(c, kind: str):
    """Targets in HTML ('storage') or editor JSON ('adf')."""
    return _udf(html_links if kind == "storage" else adf_links, "array<string>")(c)


def media_of(c, kind: str):
    return _udf(html_media if kind == "storage" else adf_media, MEDIA)(c)


def xml_links_of(c):
    return _udf(xml_links, "array<struct<kind:string,target:string,text:string>>")(c)


def xml_topic_of(c):
    @F.pandas_udf("title string, keywords array<string>, othermeta array<string>, images array<string>")
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([xml_topic(x) for x in s], columns=["title", "keywords", "othermeta", "images"])

    return run(c)


def xml_map_of(c):
    return _udf(xml_map, "array<struct<depth:int,target:string,title:string,key:string>>")(c)


def canonical_json_of(c):
    return _udf(canonical_json, "string")(c)
