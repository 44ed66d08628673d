"""A reader for simple PDFs on the standard library: pages, and text of Flate-coded or plain content streams. Encrypted files are unreadable."""

from __future__ import annotations

import re
import zlib

_OBJECT = re.compile(rb"(\d+)\s+\d+\s+obj\b(.*?)\bendobj", re.S)
_STREAM = re.compile(rb"(.*?)\bstream\r?\n(.*?)\r?\n?endstream", re.S)
_REFS = re.compile(rb"(\d+)\s+\d+\s+R")
_TEXT = re.compile(rb"\((?:[^()\\]|\\.)*\)|<[0-9A-Fa-f\s]*>|-?\d+\.?\d*|\bT[JjdDm*]|['\"]|\bET\b|\[|\]", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


class Pdf:
    """Objects of a file by number, those in object streams included."""

    def __init__(self, content: bytes) -> None:
        if b"%PDF-" not in content[:1024]:
            raise ValueError("not a PDF")
        if re.search(rb"/Encrypt\s+\d+\s+\d+\s+R", content):
            raise ValueError("the PDF is encrypted")
        self.objects: dict[int, bytes] = {int(n): body for n, body in _OBJECT.findall(content)}
        for body in list(self.objects.values()):
            if b"/ObjStm" in body.split(b"stream", 1)[0]:
                self._unpack(body)

    def _unpack(self, body: bytes) -> None:
        head, data = self.stream(body)
        n, first = (int(re.search(rb"/%b\s+(\d+)" % k, head)[1]) for k in (b"N", b"First"))
        table = list(map(int, data[:first].split()))[: 2 * n]
        for i in range(0, len(table), 2):
            end = first + table[i + 3] if i + 3 < len(table) else len(data)
            self.objects.setdefault(table[i], data[first + table[i + 1] : end])

    def stream(self, body: bytes) -> tuple[bytes, bytes]:
        """(dictionary, decoded data) of a stream object."""
        m = _STREAM.match(body)
        if not m:
            return body, b""
        head, data = m[1], m[2]
        if b"/FlateDecode" in head:
            data = zlib.decompressobj().decompress(data)
        return head, data

    def pages(self) -> list[bytes]:
        """Page objects in the order of the tree; all page objects if the tree is broken."""
        out: list[bytes] = []
        seen: set[int] = set()

        def walk(n: int) -> None:
            body = self.objects.get(n, b"")
            if n in seen:
                return
            seen.add(n)
            if re.search(rb"/Type\s*/Pages\b", body):
                kids = re.search(rb"/Kids\s*\[(.*?)\]", body, re.S)
                for k in _REFS.findall(kids[1]) if kids else ():
                    walk(int(k))
            elif re.search(rb"/Type\s*/Page\b", body):
                out.append(body)

        root = next((m[1] for b in self.objects.values() if re.search(rb"/Type\s*/Catalog\b", b) and (m := re.search(rb"/Pages\s+(\d+)\s+\d+\s+R", b))), None)
        if root:
            walk(int(root))
        return out or [b for b in self.objects.values() if re.search(rb"/Type\s*/Page\b", b)]

    def text(self, page: bytes) -> str:
        m = re.search(rb"/Contents\s*(\[.*?\]|\d+\s+\d+\s+R)", page, re.S)
        parts = [self.stream(self.objects.get(int(n), b""))[1] for n in _REFS.findall(m[1])] if m else []
        return text_of(b"\n".join(parts))


def _string(token: bytes) -> str:
    if token[:1] == b"<":
        digits = re.sub(rb"\s", b"", token[1:-1])
        raw = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    else:
        raw = re.sub(rb"\\([0-7]{1,3}|\r?\n|.)", lambda m: bytes([int(m[1], 8) & 255]) if m[1][:1].isdigit() else b"" if m[1].strip() == b"" else _ESCAPES.get(m[1], m[1]), token[1:-1], flags=re.S)
    return raw[2:].decode("utf-16-be", "replace") if raw[:2] == b"\xfe\xff" else raw.decode("cp1252", "replace")


def text_of(stream: bytes) -> str:
    """Shown strings of a content stream; moves to another line give line ends."""
    out: list[str] = []
    held: list[str] = []
    for token in _TEXT.findall(stream):
        if token[:1] in (b"(", b"<"):
            held.append(_string(token))
        elif token in (b"Tj", b"TJ"):
            out += held
            held = []
        elif token in (b"'", b'"'):
            out += ["\n", *held]
            held = []
        elif token in (b"Td", b"TD", b"T*", b"Tm", b"ET"):
            out.append("\n")
            held = []
    return re.sub(r"\n{2,}", "\n", "".join(out)).strip("\n")


def page_count(content: bytes) -> int:
    """Pages by the catalogue's tree, by page objects, by /Count; 0 if the file cannot be read."""
    try:
        if n := len(Pdf(content).pages()):
            return n
    except (ValueError, zlib.error, TypeError, IndexError):
        if b"/Encrypt" in content:
            return 0
    found = re.findall(rb"/Type\s*/Page\b", content) if b"%PDF-" in content[:1024] else []
    if found:
        return min(len(found), 9999)
    counts = [int(c) for c in re.findall(rb"/Count\s+(\d+)", content)] if b"%PDF-" in content[:1024] else []
    return max(counts, default=0)


def sampled_chars(content: bytes, sample: int) -> list[int]:
    """Characters of evenly spaced pages; empty if the text layer cannot be read."""
    try:
        pdf = Pdf(content)
        pages = pdf.pages()
        n = min(sample, len(pages))
        return [len(pdf.text(pages[i])) for i in sorted({i * len(pages) // n for i in range(n)})]
    except (ValueError, zlib.error, TypeError, IndexError):
        return []


def page_texts(content: bytes) -> list[str]:
    pdf = Pdf(content)
    return [pdf.text(p) for p in pdf.pages()]
