"""Text functions as Column expressions: they stay in the JVM and inside code generation."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .pieces import by_pieces

#: Directional marks and the byte order mark (fixed values).
BIDI = r"[\x{200E}\x{200F}\x{202A}-\x{202E}\x{2066}-\x{2069}\x{061C}\x{FEFF}]"
#: Unicode white space as Python has it (fixed values).
SPACE = r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: Line ends as Python has them (fixed values).
LINE_END = r"\r\n|[\n\r\x{0B}\x{0C}\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"
#: What counts as garbage in Office text: NUL and all above the punctuation block but the ideographic space.
OFFICE_GARBAGE = r"[^\x{01}-\x{206F}\x{3000}]"
#: What counts as garbage in PDF text: all outside Latin, combining marks, Arabic and punctuation, but white space.
PDF_GARBAGE = r"[^\x{00}-\x{024F}\x{0300}-\x{036F}\x{0600}-\x{06FF}\x{0750}-\x{077F}\x{08A0}-\x{08FF}\x{2000}-\x{206F}\x{1680}\x{3000}]"
#: Arabic presentation forms, and all Arabic.
ARABIC_FORMS = r"[\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}]"
ARABIC = r"[\x{0600}-\x{06FF}\x{0750}-\x{077F}\x{08A0}-\x{08FF}\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}]"
#: Fewer Arabic characters than this say nothing about their encoding.
ARABIC_LEAST = 11


def plain_ascii(text: Column) -> Column:
    """True for texts without any character beyond ASCII: two lengths, and no pattern has to run."""
    return F.octet_length(text) == F.length(text)


def strip_bidi(text: Column) -> Column:
    return F.when(plain_ascii(text), text).otherwise(F.regexp_replace(text, BIDI, ""))


def strip(text: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(text, rf"\A[{SPACE}]+|[{SPACE}]+\z", "")


def count_of(text: Column, pattern: str) -> Column:
    """Characters of one of the classes above, none of which has an ASCII character but NUL."""
    return F.when(plain_ascii(text) & (F.instr(text, "\u0000") == 0), F.lit(0)).otherwise(F.regexp_count(text, F.lit(pattern))).cast("long")


def share_of(text: Column, pattern: str) -> Column:
    """Characters of a class over all; 0 for an empty text."""
    return F.when(F.length(text) > 0, count_of(text, pattern) / F.length(text)).otherwise(F.lit(0.0))


def office_garbage(text: Column) -> Column:
    return share_of(text, OFFICE_GARBAGE)


def pdf_garbage(text: Column) -> Column:
    return share_of(text, PDF_GARBAGE)


def arabic_forms(text: Column) -> Column:
    """Presentation forms over all Arabic characters; 0 if there are too few of these."""
    total = count_of(text, ARABIC)
    return F.when(total >= ARABIC_LEAST, count_of(text, ARABIC_FORMS) / total).otherwise(F.lit(0.0))


@by_pieces(StringType())
def nfkc(texts: pa.Array) -> pa.Array:
    """Compatibility composition: Spark has no such function, so texts that are not plain ASCII go through Arrow."""
    return pa.array([t if t is None or t.isascii() else unicodedata.normalize("NFKC", t) for t in texts.to_pylist()], pa.string())


def lines(text: Column) -> Column:
    return F.split(text, LINE_END)


def is_table_row(line: Column) -> Column:
    """Begins and ends with a bar, white space aside; a lone bar does both."""
    return line.rlike(rf"(?s)\A[{SPACE}]*\|(?:.*\|)?[{SPACE}]*\z")


def count_tables(text: Column) -> Column:
    """Runs of lines that begin and end with a bar: a letter for each line, then runs of letters."""
    marks = F.array_join(F.transform(lines(text), lambda x: F.when(is_table_row(x), "r").otherwise("-")), "")
    return F.regexp_count(marks, F.lit("r+")).cast("int")


def escape_cell(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


def pipe_row(cells: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))


def elapsed(seconds: Column, hours: bool = False) -> Column:
    """`1.5s`, `2m 1.5s` and, if wanted, `1h 2m 1.5s`."""
    minutes = F.floor(seconds / 60).cast("long")
    rest = F.format_string("%.1fs", (seconds - minutes * 60).cast("double"))
    short = F.when(minutes > 0, F.concat(minutes.cast("string"), F.lit("m "), rest)).otherwise(rest)
    if not hours:
        return short
    whole = F.floor(minutes / 60)
    return F.when(whole > 0, F.concat(whole.cast("string"), F.lit("h "), (minutes % 60).cast("string"), F.lit("m "), rest)).otherwise(short)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(name: Column) -> Column:
    """Lower-cased last suffix with its dot; none for `.pdf` and `a.`."""
    return F.lower(F.regexp_extract(name, r"(?s)^.+(\.[^./]+)$", 1))


def stem(name: Column) -> Column:
    return F.regexp_extract(name, r"(?s)^(.+?)(\.[^./]+)?$", 1)


def last_json(log: Column) -> Column:
    """The last line that begins with a brace and parses, as (text); earlier ones are tried if later ones do not parse."""
    candidates = F.filter(F.transform(lines(log), strip), lambda x: x.startswith("{") & F.is_valid_json(x) if hasattr(F, "is_valid_json") else x.startswith("{") & F.try_parse_json(x).isNotNull())
    return F.try_element_at(candidates, F.lit(-1))


def data_url(content: Column, kind: str = "image/png") -> Column:
    return F.concat(F.lit(f"data:{kind};base64,"), F.regexp_replace(F.base64(content), r"\s", ""))


def backoff_seconds(attempt: Column, backoff: float = 2.0) -> Column:
    return F.pow(F.lit(backoff), attempt)


def front_matter(source: Column, parser: Column, **fields: Column) -> Column:
    """The head of an output document: lines of the fields that are not null."""
    items = [F.concat(F.lit(f"{k}: "), v) for k, v in {"source": source, "parser": parser, **fields}.items()]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *items), F.lit("\n---\n\n"))


def yes_no(flag: Column) -> Column:
    return F.when(flag, F.lit("True")).otherwise(F.lit("False"))
