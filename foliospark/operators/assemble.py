"""Putting pages, files and names together."""

from __future__ import annotations

import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import extension, stem, strip, strip_bidi

PAGE_BREAK, FILE_BREAK = "\n\n---\n*Page {}*\n\n", "\n\n---\n\n"


def assemble_pages(pages: DataFrame, doc: str = "doc_id", page: str = "page_no", text: str = "text", fallback: str | None = None) -> DataFrame:
    """One text for each document: pages in order, blank ones left out, all but page 0 behind a numbered break; directional marks removed."""
    head = F.when(F.col(page) > 0, F.format_string(PAGE_BREAK.replace("{}", "%d"), F.col(page) + 1)).otherwise("")
    part = F.when(F.length(strip(F.col(text))) > 0, F.concat(head, F.col(text)))
    ordered = F.array_sort(F.collect_list(F.when(part.isNotNull(), F.struct(F.col(page).alias("p"), part.alias("t")))))
    flags = [F.bool_or(F.coalesce(F.col(fallback), F.lit(False))).alias("cpu_fallback")] if fallback else []
    return pages.groupBy(doc).agg(strip_bidi(F.array_join(F.transform(ordered, lambda x: x["t"]), "")).alias("content"), F.count("*").cast("int").alias("pages"), *flags)


def assemble_files(files: DataFrame, job: str = "job_id", name: str = "name", text: str = "content") -> DataFrame:
    """One text for each job: files in name order between rules. Names that begin with an underscore are left out."""
    shown = files.where(~F.col(name).startswith("_"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(name).alias("n"), F.col(text).alias("t"))))
    return shown.groupBy(job).agg(F.array_join(F.transform(ordered, lambda x: x["t"]), FILE_BREAK).alias("markdown"))


def first_by_content(files: DataFrame, content: Column, order: str, hash_of: str = "content_md5") -> DataFrame:
    """One row for each content: the first by `order`. Only digests meet in the aggregate, not contents."""
    hashed = files.withColumn(hash_of, F.md5(content))
    first = hashed.groupBy(hash_of).agg(F.min(order).alias("_first"))
    # a semi-join on both keys keeps the survivor; a hot digest is skew-splittable, unlike a window
    return hashed.join(first.withColumnRenamed(hash_of, "_hash"), (F.col(hash_of) == F.col("_hash")) & (F.col(order) == F.col("_first")), "left_semi")


def rank_within(rows: DataFrame, key: str, order: str, to: str, blocks: int = 64) -> DataFrame:
    """rows with column `to`: the place, from 0, of each among those of its key by `order` (nulls first).

    Ranked in blocks (key, range of `order`), so that a key with a large part of all rows is dealt over many tasks. The ranges come
    from at most blocks - 1 values of `order`, picked by hash; they decide where rows go, not what they get.
    """
    some = rows.select(F.col(order).alias("o")).where("o is not null").orderBy(F.xxhash64("o"), "o").limit(blocks - 1)
    bounds = sorted({r[0] for r in some.collect()})
    at = F.coalesce(F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col(order))), F.lit(0)) if bounds else F.lit(0)
    placed = rows.withColumn("_at", at).withColumn("_in", F.row_number().over(Window.partitionBy(key, "_at").orderBy(order)))
    sums = rows.select(F.col(key), at.alias("_at")).groupBy(key, "_at").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(key).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(F.col(key).alias("_key"), F.col("_at").alias("_block"), F.coalesce(before, F.lit(0)).alias("_before"))
    out = placed.join(sums, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_at") == F.col("_block")))
    return out.withColumn(to, F.col("_before") + F.col("_in") - 1).drop("_at", "_in", "_key", "_block", "_before")


def numbered_names(files: DataFrame, name: str, order: str, to: str = "unique_name") -> DataFrame:
    """`a.pdf`, `a_1.pdf`, `a_2.pdf` by order among equal names; exact where no file already has such a number (see exact_names)."""
    ext = F.regexp_extract(F.col(name), r"(?s)^.+(\.[^./]+)$", 1)
    numbered = F.concat(stem(F.col(name)), F.lit("_"), F.col("_rank").cast("string"), ext)
    return rank_within(files, name, order, "_rank").withColumn(to, F.when(F.col("_rank") == 0, F.col(name)).otherwise(numbered)).drop("_rank")


def free_names(names: Iterable[str], taken: Iterable[str] = ()) -> list[str]:
    """Each name, or its first free number, against all that came before."""
    used, following, out = set(taken), {}, []
    for name in names:
        head, ext = re.fullmatch(r"(?s)(.+?)(\.[^./]+)?", name).groups() if name else ("", "")
        new, i = name, following.get(name, 1)
        while new in used:
            new, i = f"{head}_{i}{ext or ''}", i + 1
        following[name] = i
        used.add(new)
        out.append(new)
    return out


def exact_names(files: DataFrame, name: str, order: str, folder: str, to: str = "unique_name") -> DataFrame:
    """Unique names by the exact rule, folder by folder and within it by stem without its numbers, so that a group holds only names that can meet."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields) + f", `{to}` string"
    root = F.regexp_replace(stem(F.col(name)), r"(_\d+)+$", "")

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable").drop(columns="_root")
        return pdf.assign(**{to: free_names(pdf[name])})

    return files.withColumn("_root", F.concat(root, extension(F.col(name)))).groupBy(folder, "_root").applyInPandas(number, schema)
