"""Log records as JSON lines."""

from __future__ import annotations

import json
import logging
import sys
import traceback
from datetime import UTC, datetime
from typing import TextIO


#: Field of a line, and how a record gives it; fields without a value are left out.
FIELDS = {
    "time": lambda r: datetime.fromtimestamp(r.created, UTC).isoformat(timespec="milliseconds"),
    "severity": lambda r: r.levelname.lower(),
    "source": lambda r: f"{r.name}:{r.funcName}:{r.lineno}",
    "text": logging.LogRecord.getMessage,
    "error": lambda r: "".join(traceback.format_exception(r.exc_info[1])).rstrip() if r.exc_info and r.exc_info[1] else None,
}


class JsonLines(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        found = {name: get(record) for name, get in FIELDS.items()}
        return json.dumps({name: value for name, value in found.items() if value is not None}, ensure_ascii=False)


def setup(level: int = logging.INFO, stream: TextIO = sys.stderr) -> logging.Logger:
    """The library's logger, writing JSON lines; calling it again changes nothing but the level."""
    log = logging.getLogger("foliospark")
    log.setLevel(level)
    if not any(isinstance(h.formatter, JsonLines) for h in log.handlers):
        handler = logging.StreamHandler(stream)
        handler.setFormatter(JsonLines())
        log.addHandler(handler)
    return log
