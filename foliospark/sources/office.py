"""Readers of Office formats on the standard library: docx, xlsx, pptx, odt, ods, odp, csv and rtf. Older binary formats give an error."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from xml.etree import ElementTree as ET

from ..functions.render import table


@dataclass
class Extracted:
    """flat text, a document tree (schemas.TREE), Markdown of tables, count of pages or sheets."""

    flat: str
    nodes: list[dict] = field(default_factory=list)
    tables: list[str] = field(default_factory=list)
    pages: int | None = None


def _tag(node: ET.Element) -> str:
    return node.tag.rpartition("}")[2]


def _attr(node: ET.Element | None, name: str) -> str | None:
    return None if node is None else next((v for k, v in node.attrib.items() if k.rpartition("}")[2] == name), None)


def _all(node: ET.Element, name: str) -> Iterator[ET.Element]:
    return (x for x in node.iter() if _tag(x) == name)


def _first(node: ET.Element, name: str) -> ET.Element | None:
    return next(_all(node, name), None)


def grid_of(rows: list[list[str]]) -> dict:
    return {"rows": len(rows), "cols": max((len(r) for r in rows), default=0), "cells": [{"row": i, "col": j, "content": c} for i, r in enumerate(rows) for j, c in enumerate(r)]}


class _Builder:
    def __init__(self) -> None:
        self.nodes: list[dict] = []
        self.flat: list[str] = []
        self.tables: list[str] = []

    def add(self, kind: str, text: str = "", level: int | None = None, grid: dict | None = None) -> int:
        self.nodes.append({"node_type": kind, "text": text, "heading_text": text if kind in ("heading", "group") else None, "heading_level": level, "description": None, "grid": grid, "children": []})
        if text.strip():
            self.flat.append(text)
        return len(self.nodes) - 1

    def table(self, rows: list[list[str]]) -> int:
        grid = grid_of(rows)
        self.tables.append(table(grid))
        self.flat += ["\t".join(r) for r in rows]
        return self.add("table", grid=grid)

    def done(self, pages: int | None = None) -> Extracted:
        return Extracted("\n".join(self.flat), self.nodes, [t for t in self.tables if t], pages)


def _part(z: zipfile.ZipFile, name: str) -> ET.Element:
    return ET.fromstring(z.read(name))


def _docx_text(paragraph: ET.Element) -> str:
    out = []
    for x in paragraph.iter():
        kind = _tag(x)
        out.append(x.text or "" if kind == "t" else "\t" if kind == "tab" else "\n" if kind in ("br", "cr") else "")
    return "".join(out)


def read_docx(content: bytes) -> Extracted:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = _first(_part(z, "word/document.xml"), "body")
    out, items = _Builder(), []

    def close() -> None:
        if items:
            out.nodes[out.add("list")]["children"] = list(items)
            items.clear()

    for block in body if body is not None else ():
        if _tag(block) == "tbl":
            close()
            out.table([["\n".join(_docx_text(p) for p in _all(cell, "p")) for cell in row if _tag(cell) == "tc"] for row in block if _tag(row) == "tr"])
        elif _tag(block) == "p":
            style = _attr(_first(block, "pStyle"), "val") or ""
            text = _docx_text(block)
            heading = re.fullmatch(r"(?i)heading\s*([1-9])|title", style)
            if heading:
                close()
                out.add("heading", text, int(heading[1] or 1))
            elif _first(block, "numPr") is not None:
                items.append(out.add("list_item", text))
            else:
                close()
                out.add("paragraph", text)
            for picture in _all(block, "docPr"):
                close()
                out.nodes[out.add("image")]["description"] = _attr(picture, "descr")
    close()
    return out.done()


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]*", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def read_xlsx(content: bytes) -> Extracted:
    out = _Builder()
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = ["".join(t.text or "" for t in _all(s, "t")) for s in _part(z, "xl/sharedStrings.xml")] if "xl/sharedStrings.xml" in z.namelist() else []
        names = [_attr(s, "name") or "" for s in _all(_part(z, "xl/workbook.xml"), "sheet")]
        sheets = sorted((n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
        for i, sheet in enumerate(sheets):
            rows: list[list[str]] = []
            for row in _all(_part(z, sheet), "row"):
                cells: dict[int, str] = {}
                for c in (x for x in row if _tag(x) == "c"):
                    value, kind = _first(c, "v"), c.get("t")
                    text = (value.text or "") if value is not None else ""
                    text = shared[int(text)] if kind == "s" and text else "".join(t.text or "" for t in _all(c, "t")) if kind == "inlineStr" else text
                    cells[_column(c.get("r") or "") if c.get("r") else len(cells)] = text
                rows.append([cells.get(j, "") for j in range(max(cells, default=-1) + 1)])
            if any(any(r) for r in rows):
                out.add("heading", names[i] if i < len(names) else f"Sheet{i + 1}", 2)
                out.table(rows)
    return out.done(len(sheets))


def read_pptx(content: bytes) -> Extracted:
    out = _Builder()
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        slides = sorted((n for n in z.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
        for slide in slides:
            root = _part(z, slide)
            for shape in (x for x in root.iter() if _tag(x) in ("sp", "graphicFrame", "pic")):
                if _tag(shape) == "pic":
                    out.nodes[out.add("image")]["description"] = _attr(_first(shape, "cNvPr"), "descr")
                elif (tbl := _first(shape, "tbl")) is not None:
                    out.table([["".join(t.text or "" for t in _all(c, "t")) for c in row if _tag(c) == "tc"] for row in tbl if _tag(row) == "tr"])
                else:
                    title = (_attr(_first(shape, "ph"), "type") or "").lower() in ("title", "ctrtitle")
                    for p in _all(shape, "p"):
                        text = "".join(t.text or "" for t in _all(p, "t"))
                        if text.strip():
                            out.add("heading" if title else "paragraph", text, 2 if title else None)
    return out.done(len(slides))


def read_odf(content: bytes) -> Extracted:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = _first(_part(z, "content.xml"), "body")
    out = _Builder()

    def walk(node: ET.Element) -> None:
        for x in node:
            kind = _tag(x)
            if kind == "h":
                out.add("heading", "".join(x.itertext()), int(_attr(x, "outline-level") or 1))
            elif kind == "p":
                out.add("paragraph", "".join(x.itertext()))
            elif kind == "list":
                items = [out.add("list_item", " ".join("".join(p.itertext()) for p in _all(i, "p"))) for i in x if _tag(i) == "list-item"]
                out.nodes[out.add("list")]["children"] = items
            elif kind == "table":
                rows = [[" ".join("".join(p.itertext()) for p in _all(c, "p")) for c in row if _tag(c) in ("table-cell", "covered-table-cell")] for row in _all(x, "table-row")]
                while rows and not any(rows[-1]):
                    rows.pop()
                if rows:
                    out.table(rows)
            else:
                walk(x)

    if body is not None:
        walk(body)
    return out.done()


def _plain(content: bytes) -> str:
    for encoding in ("utf-8-sig", "cp1252"):
        try:
            return content.decode(encoding)
        except UnicodeDecodeError:
            continue
    return content.decode("latin-1")


def read_csv(content: bytes) -> Extracted:
    """No tree: the table's Markdown stands for it."""
    text = _plain(content)
    rows = [r for r in csv.reader(io.StringIO(text)) if r]
    md = table(grid_of(rows))
    return Extracted(text, [], [md] if md else [], None)


_RTF = re.compile(r"\\([a-z]+)(-?\d+)? ?|\\'([0-9a-fA-F]{2})|\\([^a-z])|([{}])|([^\\{}]+)", re.S)
_RTF_SKIPPED = {"fonttbl", "colortbl", "stylesheet", "info", "pict", "header", "footer", "generator"}


def read_rtf(content: bytes) -> Extracted:
    out, stack, skip, drop = [], [], False, 0
    for word, number, code, sign, brace, text in _RTF.findall(content.decode("latin-1")):
        if brace == "{":
            stack.append(skip)
        elif brace == "}":
            skip = stack.pop() if stack else False
        elif sign == "*" or word in _RTF_SKIPPED:
            skip = True
        elif skip:
            continue
        elif word in ("par", "line", "sect", "page"):
            out.append("\n")
        elif word == "tab":
            out.append("\t")
        elif word == "u":
            out.append(chr(int(number) % 65536))
            drop = 1
        elif code:
            out.append("" if drop else bytes.fromhex(code).decode("cp1252", "replace"))
            drop = 0
        elif sign:
            out.append(" " if sign == "~" else sign if sign in "\\{}" else "")
        elif text:
            plain = re.sub(r"[\r\n]", "", text)
            out.append(plain[drop:])
            drop = 0
    flat = "".join(out).strip()
    b = _Builder()
    for p in flat.split("\n"):
        b.add("paragraph", p)
    return b.done()


READERS: dict[str, Callable[[bytes], Extracted]] = {".docx": read_docx, ".xlsx": read_xlsx, ".pptx": read_pptx, ".odt": read_odf, ".ods": read_odf, ".odp": read_odf, ".csv": read_csv, ".rtf": read_rtf}


def read(ext: str, content: bytes) -> Extracted:
    if ext not in READERS:
        raise ValueError(f"no reader for {ext or 'files without extension'}: convert it to a current format")
    return READERS[ext](content)
