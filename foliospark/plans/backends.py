"""Parsers behind one protocol. A backend is made once for each task; whatever it raises becomes an error row."""

from __future__ import annotations

import base64
import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cache
from typing import Protocol

from ..config import Settings
from ..functions.render import document
from ..sources import office, pdf

ANALYST = "You transcribe document pages. Name the document's type first, then list stamps, signatures, logos, codes and pictures with their place, then give all text as Markdown, word for word and in reading order, tables as pipe tables."
FIRST_PAGE = "Transcribe this page in full, with the document's type and its visual elements."
OTHER_PAGE = "Transcribe this page in full as Markdown, word for word."


@dataclass
class Parsed:
    text: str
    pages: int | None = None
    table_count: int | None = None
    cpu_fallback: bool = False


#: First bytes of image files (fixed values).
_IMAGES = ((b"\x89PNG", "image/png"), (b"\xff\xd8\xff", "image/jpeg"), (b"II*\x00", "image/tiff"), (b"MM\x00*", "image/tiff"), (b"BM", "image/bmp"), (b"RIFF", "image/webp"))


def image_type(image: bytes) -> str:
    return next((kind for head, kind in _IMAGES if image.startswith(head)), "image/png")


class Backend(Protocol):
    """force_ocr asks for recognition from pixels, after the text layer has turned out to be garbage."""

    def parse(self, name: str, ext: str, content: bytes, pages: list[int] | None, force_ocr: bool) -> Parsed: ...


@cache
def held(slots: int) -> threading.BoundedSemaphore:
    """What bounds the requests that a worker process has on its way to a server."""
    return threading.BoundedSemaphore(max(1, slots))


class OfficeBackend:
    def __init__(self, s: Settings) -> None:
        self.s = s

    def parse(self, name: str, ext: str, content: bytes, pages: list[int] | None, force_ocr: bool) -> Parsed:
        if force_ocr:  # an office file has no pixels; the same parse again would give the same garbage
            raise NotImplementedError("office files cannot be recognised")
        found = office.read(ext, content)
        text = document(found.nodes, found.flat, found.tables, self.s.table_fallback, self.s.image_placeholder)
        return Parsed(text, found.pages, len(found.tables))


class TextPdfBackend:
    """The text layer; with force_ocr the pages' pixels, by the functions given for rendering and recognition."""

    def __init__(self, s: Settings, render: Callable | None = None, ocr: Callable | None = None) -> None:
        self.s, self.render, self.ocr = s, render, ocr

    def parse(self, name: str, ext: str, content: bytes, pages: list[int] | None, force_ocr: bool) -> Parsed:
        if force_ocr:
            if self.render is None or self.ocr is None:
                raise NotImplementedError("no recognition backend is registered")
            total = pdf.page_count(content)
            return Parsed("\n\n".join(self.ocr(self.render(content, p, self.s.vlm_image_dpi)) for p in (range(total) if pages is None else pages)), total, 0)
        texts = pdf.page_texts(content)
        chosen = texts if pages is None else [texts[p] for p in pages]
        return Parsed("\n\n".join(chosen), len(texts), 0)


class VisionBackend:
    """Pages as images to an OpenAI-compatible server, with retries; then a local recognition function; then a marker text."""

    def __init__(self, s: Settings, post: Callable | None = None, render: Callable | None = None, ocr: Callable | None = None, sleep: Callable = time.sleep) -> None:
        self.s, self.post, self.render, self.ocr, self.sleep = s, post or self._post, render, ocr, sleep

    def _post(self, payload: dict) -> str:
        import requests

        r = requests.post(f"{self.s.vlm_base_url}/chat/completions", json=payload, timeout=self.s.vlm_timeout_s)
        r.raise_for_status()
        return r.json()["choices"][0]["message"]["content"] or ""

    def ask(self, image: bytes, first: bool) -> str:
        url = f"data:{image_type(image)};base64," + base64.b64encode(image).decode()
        user = [{"type": "image_url", "image_url": {"url": url}}, {"type": "text", "text": FIRST_PAGE if first else OTHER_PAGE}]
        payload = {"model": self.s.vlm_model, "temperature": 0, "max_tokens": self.s.vlm_max_tokens, "messages": [{"role": "system", "content": ANALYST}, {"role": "user", "content": user}], "chat_template_kwargs": {"enable_thinking": False}}
        for attempt in range(self.s.vlm_retry_attempts):
            try:
                return self.post(payload)
            except Exception:
                if attempt + 1 == self.s.vlm_retry_attempts:
                    raise
                self.sleep(self.s.vlm_retry_backoff**attempt)
        raise ValueError("no attempt is allowed")

    def page(self, image: bytes, number: int) -> tuple[str, bool]:
        """(text, whether it came from the fallback)."""
        try:
            return self.ask(image, number == 0), False
        except Exception as e:
            try:
                if self.ocr is None:
                    raise NotImplementedError("no recognition backend is registered") from e
                return f"> The vision request failed; this is recognised text without visual elements.\n\n{self.ocr(image)}", True
            except Exception as worse:
                return f"\n\n> Page {number + 1} could not be extracted: {worse}\n\n", True

    def parse(self, name: str, ext: str, content: bytes, pages: list[int] | None, force_ocr: bool) -> Parsed:
        if ext == ".pdf" and self.render is None:
            raise NotImplementedError("no page renderer is registered")
        total = pdf.page_count(content) if ext == ".pdf" else 1
        parts, fallback, chosen = [], False, list(range(total) if pages is None else pages)

        def read(k: int) -> tuple[str, bool]:
            with held(self.s.vision_slots):
                return self.page(self.render(content, chosen[k], self.s.vlm_image_dpi) if ext == ".pdf" else content, k)

        # pages of a document side by side, put together in their order
        with ThreadPoolExecutor(max(1, self.s.vlm_max_workers)) as pool:
            for k, (text, used) in enumerate(pool.map(read, range(len(chosen)))):
                fallback |= used
                if text.strip():
                    parts.append(text if k == 0 else f"\n\n---\n*Page {k + 1}*\n\n{text}")
        return Parsed("".join(parts), len(chosen), None, fallback)


class Registry:
    """Factories by route name; a later registration replaces an earlier one."""

    def __init__(self) -> None:
        self.factories: dict[str, Callable[[Settings], Backend]] = {"office": OfficeBackend, "text_pdf": TextPdfBackend, "vision": VisionBackend}

    def register(self, route: str, factory: Callable[[Settings], Backend]) -> Registry:
        self.factories[route] = factory
        return self

    def make(self, route: str, s: Settings) -> Backend:
        return self.factories[route](s)


def first_working(*functions: Callable[[bytes], str]) -> Callable[[bytes], str]:
    """Recognition by the first of several engines that does not raise."""

    def ocr(image: bytes) -> str:
        causes = []
        for f in functions:
            try:
                return f(image)
            except Exception as e:
                causes.append(str(e) or type(e).__name__)
        raise RuntimeError("; ".join(causes) or "no recognition engine")

    return ocr
