"""Small documents built with the standard library."""

from __future__ import annotations

import io
import zipfile
import zlib


def _zip(parts: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


def docx() -> bytes:
    p = lambda text, props="": f"<w:p>{f'<w:pPr>{props}</w:pPr>' if props else ''}<w:r><w:t>{text}</w:t></w:r></w:p>"
    cell = lambda t: f"<w:tc>{p(t)}</w:tc>"
    body = p("Title", '<w:pStyle w:val="Heading1"/>') + p("Some text.") + p("one", "<w:numPr/>") + p("two", "<w:numPr/>") + f"<w:tbl><w:tr>{cell('a')}{cell('b|c')}</w:tr><w:tr>{cell('1')}{cell('2')}</w:tr></w:tbl>"
    return _zip({"word/document.xml": f'<w:document xmlns:w="w"><w:body>{body}</w:body></w:document>'})


def xlsx() -> bytes:
    sheet = '<worksheet xmlns="x"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1"><v>3.5</v></c></row><row r="2"><c r="B2" t="inlineStr"><is><t>in</t></is></c></row></sheetData></worksheet>'
    return _zip({"xl/workbook.xml": '<workbook xmlns="x"><sheets><sheet name="Data"/></sheets></workbook>', "xl/sharedStrings.xml": '<sst xmlns="x"><si><t>head</t></si></sst>', "xl/worksheets/sheet1.xml": sheet})


def pptx() -> bytes:
    slide = lambda t: f'<p:sld xmlns:p="p" xmlns:a="a"><p:sp><p:nvPr><p:ph type="title"/></p:nvPr><a:p><a:t>{t}</a:t></a:p></p:sp><p:sp><a:p><a:t>point</a:t></a:p></p:sp></p:sld>'
    return _zip({"ppt/slides/slide2.xml": slide("Second"), "ppt/slides/slide1.xml": slide("First")})


def odt() -> bytes:
    return _zip({"content.xml": '<o:document xmlns:o="o" xmlns:t="t"><o:body><o:text><t:h t:outline-level="2">Head</t:h><t:p>Body</t:p><t:list><t:list-item><t:p>x</t:p></t:list-item></t:list></o:text></o:body></o:document>'})


def pdf(pages: list[str], flate: bool = True, encrypted: bool = False) -> bytes:
    kids = " ".join(f"{10 + 2 * i} 0 R" for i in range(len(pages)))
    objects = [b"1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj", f"2 0 obj << /Type /Pages /Count {len(pages)} /Kids [{kids}] >> endobj".encode()]
    for i, text in enumerate(pages):
        stream = f"BT /F1 12 Tf 72 720 Td ({text}) Tj ET".encode("latin-1") if text else b""
        head = "<< /Filter /FlateDecode >>" if flate else "<< >>"
        objects.append(f"{10 + 2 * i} 0 obj << /Type /Page /Parent 2 0 R /Contents {11 + 2 * i} 0 R >> endobj".encode())
        objects.append(f"{11 + 2 * i} 0 obj {head} stream\n".encode() + (zlib.compress(stream) if flate else stream) + b"\nendstream endobj")
    return b"%PDF-1.4\n" + b"\n".join(objects) + (b"\ntrailer << /Encrypt 9 0 R >>" if encrypted else b"\ntrailer << /Root 1 0 R >>")


RTF = rb"{\rtf1\ansi{\fonttbl{\f0 Arial;}}Hello \b bold\b0\par caf\'e9 \u8364?\par}"
CSV = "name,note\nx,a|b\ny,\"two\nlines\"\n".encode()
