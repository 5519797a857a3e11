"""Defined terms in legal texts marked up as web pages.

A page becomes a small tree (standard library parser). Whatever the layout, the articles are first reduced to
items: a marker, a paragraph, and nested items, each with the amendment that was last announced before it.
Readers for the drafting styles then turn an item to a term and its definition. One page is one row, and its
records leave as rows; nested items are kept as JSON.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Openings of rubrics of articles that define terms, by language.
RUBRICS = {"en": ["definition", "definitions"], "lt": ["apibrėžt"], "fr": ["définition", "définitions"], "de": ["begriffsbestimmung"], "es": ["definicion"], "it": ["definizion"], "pl": ["definicj"], "nl": ["definitie"], "pt": ["definiç"], "sv": ["definition"]}
#: Quotation marks, and the drafting styles of definitions.
QUOTES = "„“”‘’\"'"
MEANS = re.compile(r"[\"'“”‘’](?P<term>[^\"'“”‘’]{2,120})[\"'“”‘’]\s+means\b")
GUILLEMETS = re.compile(r"^\s*[«\"“”](?P<term>[^»\"“”]+?)[»\"“”](?:\s+(?:ou\s+[A-ZÀ-Ý]{2,10}|\([^)]+\)))?\s*[:,](?:\s+|$)")
FOOTNOTE = re.compile(r"\s*\(\s*\d+\s*\)")
TRIANGLE = re.compile(r"[▼▲]([A-Z]\d*)")
CORRIGENDUM = re.compile(r"[►▶][A-Z]\d*\s*|\s*[◄◀]")
NUMBERED = re.compile(r"^\d+\)\s+")
DASH = re.compile("[–—]")
BASE_ACT = {"marker": "B", "celex": "", "action": None}
LEVELS = {"title": ("tis", "eli-title"), "chapter": ("cpt", "eli-chapter"), "section": ("sct", "eli-section")}


@dataclass
class Node:
    tag: str
    attrs: dict[str, str]
    parent: Node | None = None
    children: list[Node | str] = field(default_factory=list)

    @property
    def classes(self) -> set[str]:
        return set((self.attrs.get("class") or "").split())

    @property
    def ident(self) -> str:
        return self.attrs.get("id") or ""

    def elements(self) -> Iterator[Node]:
        return (c for c in self.children if isinstance(c, Node))

    def walk(self) -> Iterator[Node]:
        for c in self.elements():
            yield c
            yield from c.walk()

    def ancestors(self) -> Iterator[Node]:
        node = self.parent
        while node is not None:
            yield node
            node = node.parent

    def first(self, tag: str | None = None, cls: str | None = None, prefix: str | None = None, deep: bool = True) -> Node | None:
        for n in self.walk() if deep else self.elements():
            if (tag is None or n.tag == tag) and (cls is None or cls in n.classes) and (prefix is None or any(c.startswith(prefix) for c in n.classes)):
                return n
        return None

    def pieces(self) -> Iterator[str]:
        for c in self.children:
            if isinstance(c, str):
                yield c
            else:
                yield from c.pieces()

    def text(self) -> str:
        return " ".join(s for s in (p.strip() for p in self.pieces()) if s).replace("\xa0", " ").strip()


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {})

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        for node in (self.at, *self.at.ancestors()):
            if node.tag == tag and node.parent is not None:
                self.at = node.parent
                return

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Node:
    """The element that holds the document, or the whole page."""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return next((n for n in tree.root.walk() if n.ident == "docHtml"), tree.root)


def layout_of(doc: Node) -> str | None:
    """`divlayout`, `tablelayout`, or None."""
    for n in doc.walk():
        if n.tag == "div" and "eli-subdivision" in n.classes:
            return "divlayout"
    return "tablelayout" if any({"dlist-term", "dlist-definition"} & n.classes for n in doc.walk()) else None


def plain(text: str) -> str:
    """Lower case without combining marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))


def tidy(text: str) -> str:
    return FOOTNOTE.sub("", text.replace("\xa0", " ").strip()).rstrip(";").rstrip()


def amendment_of(node: Node) -> dict:
    """The act and marker that a paragraph of class modref announces."""
    link = node.first("a")
    if link is None:
        return dict(BASE_ACT)
    celex, _, action = (link.attrs.get("title") or "").partition(":")
    marker = TRIANGLE.search(node.text())
    return {"marker": marker[1] if marker else "B", "celex": celex.strip(), "action": action.strip() or None}


def is_amendment(node: Node) -> bool:
    return node.tag == "p" and "modref" in node.classes


@dataclass
class Item:
    marker: str
    text: str
    amendment: dict
    body: Node
    paragraph: Node | None

    def nested(self) -> list[dict]:
        return [{"marker": i.marker, "text": tidy(i.text), "amendment": i.amendment, "sub_items": i.nested()} for i in items_below(self.body, self.amendment)]


def _grid_item(node: Node, amendment: dict) -> Item:
    left = node.first("div", "grid-list-column-1", deep=False)
    right = node.first("div", "grid-list-column-2", deep=False)
    span = left.first("span") if left else None
    marker = ((span or left).text() if left else "").strip().strip("()")
    paragraph = right.first("p", "norm") if right else None
    return Item(marker, paragraph.text() if paragraph else "", dict(amendment), right or Node("div", {}), paragraph)


def items_below(parent: Node, amendment: dict) -> list[Item]:
    """Grid items that are direct children; paragraphs between them move the amendment on."""
    found, now = [], dict(amendment)
    for child in parent.elements():
        if is_amendment(child):
            now = amendment_of(child)
        elif "grid-container" in child.classes:
            found.append(_grid_item(child, now))
    return found


def outer_items(article: Node) -> tuple[list[Item], set[str]]:
    """Grid items of an article that lie in no other one, in order of the document."""
    found, markers, now = [], set(), dict(BASE_ACT)

    def visit(node: Node, inside: bool) -> None:
        nonlocal now
        for child in node.elements():
            if is_amendment(child):
                now = amendment_of(child)
                markers.add(now["marker"])
                continue
            grid = "grid-container" in child.classes
            if grid and not inside:
                found.append(_grid_item(child, now))
            visit(child, inside or grid)

    visit(article, False)
    return found, markers


# Readers: each returns (term, definition) or None.


def read_quoted(item: Item, lang: str) -> tuple[str, str] | None:
    hit = (GUILLEMETS if lang == "fr" else MEANS).search(item.text)
    return (hit["term"].strip(), tidy(item.text[hit.end() :])) if hit else None


def read_numbered(item: Item, lang: str) -> tuple[str, str] | None:
    """term – definition; or a heading that ends in a colon, whose definition is the nested items."""
    if lang == "fr" and (hit := GUILLEMETS.search(item.text)):
        rest = item.text[hit.end() :].strip()
        return hit["term"].strip(), "" if rest.endswith(":") or (not rest and item.nested()) else tidy(rest)
    if item.text.endswith(":"):
        term = " ".join(DASH.split(item.text.rstrip(":"))[0].split()[:5])
        return (term, "") if term else None
    parts = DASH.split(item.text, maxsplit=1)
    term = parts[0].strip()
    return (term, tidy(parts[1])) if len(parts) == 2 and term else None


def read_cell(cell: Node) -> tuple[str, str, bool] | None:
    """(term, definition, whether nested items count) of a table's second cell."""
    head = cell.first("p", "normal")
    if head is not None:
        body = cell.first("p", "norm")
        return DASH.split(head.text())[0].strip().strip(QUOTES), tidy(body.text()) if body else "", True
    parts = DASH.split(CORRIGENDUM.sub("", cell.text()), maxsplit=1)
    term = parts[0].strip().strip(QUOTES)
    return (term, tidy(parts[1]), False) if len(parts) == 2 and term else None


# Articles


def _label(node: Node, prefix: str) -> str | None:
    found = node.first(prefix=prefix)
    return (found.text() or None) if found else None


def div_context(article: Node) -> dict:
    out = {f"{level}_{part}": None for level in LEVELS for part in ("label", "rubric")}
    for node in article.ancestors():
        for level, (short, cls) in LEVELS.items():
            if (node.ident.startswith(f"{short}_") or cls in node.classes) and out[f"{level}_label"] is None:
                out[f"{level}_label"], out[f"{level}_rubric"] = _label(node, f"{short}_label"), _label(node, f"{short}_rubric")
    return out


def div_rubric(article: Node) -> tuple[str | None, str | None]:
    own = article.first("p", "stitle-article-norm")
    if own is not None and own.text():
        return own.text(), "article"
    for node in article.ancestors():
        if node.ident.startswith(("cpt_", "tis_")):
            shown = node.first("p", "title-division-2", deep=False)
            if shown is not None and shown.text():
                return shown.text(), "chapter"
    return None, None


def div_articles(doc: Node, lang: str) -> Iterator[dict]:
    for article in doc.walk():
        if article.tag != "div" or not re.fullmatch(r"art_\w+", article.ident):
            continue
        above = [n.ident for n in article.ancestors() if n.ident]
        if any(i.startswith(("anx_", "rct_")) for i in above):
            continue
        title = article.first("p", "title-article-norm")
        raw = title.text() if title else ""
        number = re.search(r"\d+\w*", raw)
        rubric, source = div_rubric(article)
        items, _ = outer_items(article)
        grid = next((n for n in article.walk() if "grid-container" in n.classes), None)
        read = read_numbered if grid is not None and NUMBERED.match(grid.text()) else read_quoted
        path = [i for i in reversed(above) if re.match(r"(enc|tis|cpt|sct|art)_", i)]
        records = []
        for item in items:
            got = read(item, lang) if item.paragraph is not None else None
            if got:
                notes = [a.attrs["id"][4:] for a in item.paragraph.walk() if a.tag == "a" and a.ident.startswith("src.E")]
                records.append({"term": got[0], "definition": got[1], "amendment": item.amendment, "sub_items": item.nested(), "footnote_refs": notes, "list_path": item.marker or str(len(records) + 1)})
        yield {"art_id": article.ident, "path": ".".join([*path, article.ident]), "number": number[0] if number else raw or None, "rubric": rubric, "rubric_source": source, "context": div_context(article), "records": records}


def table_articles(doc: Node, lang: str) -> Iterator[dict]:
    context = {f"{level}_{part}": None for level in LEVELS for part in ("label", "rubric")}
    now, amendment = None, dict(BASE_ACT)
    levels = {"title-division-1": "title", "title-division-2": "chapter"}
    for child in doc.elements():
        for cls, level in levels.items():
            if cls in child.classes:
                context[f"{level}_label"], context[f"{level}_rubric"] = child.text() or None, None
            if f"s{cls}" in child.classes:
                context[f"{level}_rubric"] = child.text() or None
        if child.tag == "p" and "title-article-norm" in child.classes:
            if now:
                yield now
            number = re.search(r"(\d+)", child.text())
            annex = "PRIEDAS" in child.text().upper() or not number
            now = None if annex else {"art_id": f"art_{number[1]}", "path": f"art_{number[1]}", "number": number[1], "rubric": None, "rubric_source": None, "context": dict(context), "records": []}
            amendment = dict(BASE_ACT)
        elif now is None:
            continue
        elif child.tag == "p" and "stitle-article-norm" in child.classes:
            now["rubric"] = child.text() or None
            now["rubric_source"] = "article" if now["rubric"] else None
        elif is_amendment(child):
            amendment = amendment_of(child)
        else:
            for table in [child] if child.tag == "table" else [n for n in child.walk() if n.tag == "table"]:
                row = table.first("tr")
                cells = [c for c in row.elements() if c.tag == "td"] if row else []
                if len(cells) < 2:
                    continue
                own = dict(amendment)
                for p in cells[1].elements():
                    own = amendment_of(p) if is_amendment(p) else own
                got = read_cell(cells[1])
                if got and got[0]:
                    nested = Item("", "", own, cells[1], None).nested() if got[2] else []
                    now["records"].append({"term": got[0], "definition": got[1], "amendment": own, "sub_items": nested, "footnote_refs": [], "list_path": cells[0].text().strip().strip("()") or str(len(now["records"]) + 1)})
    if now:
        yield now


def articles(html: str, lang: str) -> tuple[str, list[dict]]:
    doc = parse(html)
    layout = layout_of(doc) or "divlayout"
    return layout, list((table_articles if layout == "tablelayout" else div_articles)(doc, lang))


def footnotes(html: str) -> list[dict]:
    found = [n for n in parse(html).walk() if n.tag == "div" and n.ident.startswith("fnp_")]
    return [{"footnote_id": n.ident[4:], "marker": (re.search(r"\d+", n.ident[4:]) or [n.ident[4:]])[0], "text": n.text()} for n in found]


def definitions_article(found: list[dict], lang: str, keywords: list[str] | None = None) -> dict | None:
    """The first article whose own rubric names definitions, else the first below such a chapter."""
    words = [plain(w) for w in (keywords or RUBRICS.get(lang, RUBRICS["en"]))]
    for source in ("article", "chapter"):
        for a in found:
            if a["rubric_source"] == source and any(w in plain(a["rubric"]) for w in words):
                return a
    return None


_RECORD = "celex_id string, lang string, layout string, structural_path string, list_path string, article_number string, article_rubric string, term string, term_normalized string, definition string, marker string, amendment_celex string, amendment_action string, context string, sub_items string, n_sub_items int, footnote_refs array<string>, approved string"


#: Pages are parsed, and their rows handed on, in slices of about so many bytes of markup.
SLICE_BYTES = 1 << 20
_ARROW = {"string": pa.string(), "int": pa.int32(), "array<string>": pa.list_(pa.string())}


def _slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch cut so that each part has at most about `most` bytes of html; a longer page stands alone."""
    start = size = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column("html")), 0).to_pylist()):
        if i > start and size + n > most:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


def _parsed(pages: DataFrame, rows_of: Callable[[str, str, str], Iterator[tuple]], schema: str) -> DataFrame:
    """rows_of (celex_id, lang, html) for every page. What a task holds is bounded by a slice, not by a batch's number of pages."""
    fields = [c.split() for c in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                rows = [r for page in zip(*(c.to_pylist() for c in part.columns), strict=True) for r in rows_of(*page)]
                if rows:
                    columns = [pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(zip(*rows, strict=True), fields, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])

    return pages.select("celex_id", "lang", "html").mapInArrow(work, schema)


def definitions(pages: DataFrame, article: str | None = None) -> DataFrame:
    """Records of pages (celex_id, lang, html); of one article where its number is given."""

    def rows_of(celex: str, lang: str, html: str) -> Iterator[tuple]:
        layout, found = articles(html or "", lang)
        for a in found:
            if article is not None and a["number"] != article:
                continue
            for r in a["records"]:
                m = r["amendment"]
                yield celex, lang, layout, a["path"], r["list_path"], a["number"], a["rubric"], r["term"], r["term"].lower(), r["definition"], m["marker"], m["celex"], m["action"], json.dumps(a["context"], ensure_ascii=False), json.dumps(r["sub_items"], ensure_ascii=False), len(r["sub_items"]), r["footnote_refs"], "false"

    return _parsed(pages, rows_of, _RECORD)


def article_list(pages: DataFrame) -> DataFrame:
    """article_metadata: every article with its rubric and number of definitions."""

    def rows_of(celex: str, lang: str, html: str) -> Iterator[tuple]:
        layout, found = articles(html or "", lang)
        for a in found:
            yield celex, lang, layout, a["path"], a["number"], a["rubric"], a["rubric_source"], len(a["records"])

    return _parsed(pages, rows_of, "celex_id string, lang string, layout string, structural_path string, article_number string, article_rubric string, article_rubric_source string, definition_count int")


def writer_fields(records: DataFrame) -> DataFrame:
    """Records as the store takes them: a trivial definition becomes its nested items, joined."""
    items = F.from_json("sub_items", "array<struct<marker:string,text:string>>")
    joined = F.array_join(F.transform(F.filter(items, lambda x: x["text"] != ""), lambda x: F.concat(F.lit("("), x["marker"], F.lit(") "), x["text"])), "; ")
    trivial = F.trim("definition").isin("", ":", "–", "—")
    date = F.regexp_extract("celex_id", r"-(\d{4})(\d{2})(\d{2})$", 0)
    return records.select(
        "lang",
        F.col("term").alias("term_raw"),
        "term_normalized",
        F.when(trivial, joined).otherwise(F.col("definition")).alias("definition_raw"),
        F.concat(F.col("celex_id"), F.lit("#"), F.col("structural_path")).alias("source_file"),
        F.col("article_number").alias("article"),
        F.col("list_path").alias("clause_num"),
        F.when(date != "", F.concat_ws("-", F.substring(date, 2, 4), F.substring(date, 6, 2), F.substring(date, 8, 2))).alias("first_seen_date"),
        "approved",
    )


#: A small page for demonstration and tests.
DEMO = (
    '<div id="docHtml"><div id="tis_I"><p class="tis_label">TITLE I</p><div id="art_2" class="eli-subdivision"><p class="title-article-norm">Article 2</p>'
    '<p class="stitle-article-norm">Definitions</p><div class="grid-container"><div class="grid-list-column-1"><span>(1)</span></div><div class="grid-list-column-2">'
    '<p class="norm">‘goods’ means any thing that moves;</p></div></div><p class="modref"><a title="32020R0001: AMENDMENT">▼M1</a></p>'
    '<div class="grid-container"><div class="grid-list-column-1"><span>(2)</span></div><div class="grid-list-column-2"><p class="norm">‘carrier’ means:</p>'
    '<div class="grid-container"><div class="grid-list-column-1"><span>(a)</span></div><div class="grid-list-column-2"><p class="norm">a person who carries;</p></div></div></div></div></div></div></div>'
)
