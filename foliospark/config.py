"""Settings of the ingestion engine, as profiles."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace

#: Extensions by kind (fixed values).
OFFICE_EXTENSIONS = (".docx", ".doc", ".odt", ".rtf", ".xlsx", ".xls", ".ods", ".csv", ".pptx", ".ppt", ".odp")
IMAGE_EXTENSIONS = (".png", ".jpg", ".jpeg", ".tiff", ".tif", ".bmp", ".webp")
PDF_EXTENSION = ".pdf"

#: Classes of documents and the folder of each (fixed values). UNKNOWN has none.
CLASS_FOLDERS = {
    "OFFICE": "office",
    "IMAGE": "images",
    "PDF_VLM_TEXT": "pdfs/vlm_text",
    "PDF_SHORT_TEXT": "pdfs/short_text",
    "PDF_SHORT_SCAN": "pdfs/short_scanned",
    "PDF_LONG_TEXT": "pdfs/long_text",
    "PDF_LONG_SCAN": "pdfs/long_scanned",
}
UNKNOWN = "UNKNOWN"
LONG_CLASSES = ("PDF_LONG_TEXT", "PDF_LONG_SCAN")
UNREADABLE = "unreadable PDF (encrypted or corrupted) or unrecognised extension"


@dataclass(frozen=True)
class Settings:
    """All tunables. Pages and characters decide the route of a PDF; slots bound the tasks of a route."""

    vlm_text_threshold: int = 4
    long_pdf_threshold: int = 200
    scanned_long_threshold: int = 20
    scan_char_threshold: int = 50
    scan_sample_pages: int = 5
    long_head_pages: int = 10
    long_tail_pages: int = 10
    vlm_base_url: str = "http://127.0.0.1:8000/v1"
    vlm_model: str = "default"
    vlm_max_tokens: int = 8192
    vlm_image_dpi: int = 200
    vlm_max_workers: int = 4
    vlm_retry_attempts: int = 3
    vlm_retry_backoff: float = 2.0
    vlm_timeout_s: int = 180
    office_slots: int = 8
    text_slots: int = 1
    vision_slots: int = 4
    office_garbage: float = 0.02
    pdf_garbage: float = 0.01
    arabic_forms: float = 0.3
    max_upload_mb: int = 100
    job_ttl_s: int = 86_400
    office_extensions: tuple[str, ...] = OFFICE_EXTENSIONS
    image_extensions: tuple[str, ...] = IMAGE_EXTENSIONS
    output_suffix: str = ".txt"
    table_fallback: bool = True
    image_placeholder: bool = True

    def override(self, **values: object) -> Settings:
        """A copy with the values that are not None, as command-line flags give them."""
        return replace(self, **{k: v for k, v in values.items() if v is not None})

    @property
    def allowed_uploads(self) -> tuple[str, ...]:
        return (*self.office_extensions, *self.image_extensions, PDF_EXTENSION)


_NO_CSV = tuple(x for x in OFFICE_EXTENSIONS if x != ".csv")
PROFILES = {
    "engine": Settings(),
    "orchestrator": Settings(vlm_text_threshold=10, office_extensions=_NO_CSV, table_fallback=False),
    "service": Settings(vlm_text_threshold=10, office_extensions=_NO_CSV, table_fallback=False, image_placeholder=False, output_suffix=".md"),
}


def settings(profile: str = "engine", env: Mapping[str, str] | None = None, **values: object) -> Settings:
    """A profile, then FOLIOSPARK_<FIELD> from the environment, then keyword values."""
    env = os.environ if env is None else env
    given = {}
    for f in fields(Settings):
        raw = env.get(f"FOLIOSPARK_{f.name.upper()}")
        if raw is not None:
            kind = type(getattr(PROFILES[profile], f.name))
            given[f.name] = tuple(raw.split(",")) if kind is tuple else raw.lower() in ("1", "true", "yes") if kind is bool else kind(raw)
    return PROFILES[profile].override(**given).override(**values)
