"""Queries of the ingestion operators over the driver's tables, with the same in SQL.

A document's text stands for a file: every 100 characters are a page, documents with doc_id % 7 = 3 keep 10 characters of text layer on
each page (scans), and doc_id % 10 gives the extension. Conversations are documents whose turns are pages; orders are batches of line
items; a user's events are a job's.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Settings
from .functions import text as T
from .functions.render import render_grid, render_tree
from .operators import assemble, classify, jobs

Query = Callable[[SparkSession, str], DataFrame]
S = Settings()
PAGE_CHARS, THIN_CHARS = 100, 10
_EXTS = ".docx .png .bin .pdf .pdf .pdf .pdf .pdf .pdf .pdf".split()


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _ext(doc_id: Column) -> Column:
    return F.get(F.lit(_EXTS), (doc_id % 10).cast("int"))


def _files(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, ext, page_count, chars of the sampled pages."""
    d = _table(spark, sf, "documents").select("doc_id", F.length("text").alias("n"))
    d = d.withColumn("page_count", F.ceil(F.col("n") / PAGE_CHARS).cast("int"))
    most = F.when(F.col("doc_id") % 7 == 3, THIN_CHARS).otherwise(PAGE_CHARS)
    chars = F.transform(classify.sample_pages(F.col("page_count"), S.scan_sample_pages), lambda p: F.least(most, F.col("n") - p * PAGE_CHARS).cast("int"))
    return d.select("doc_id", _ext(F.col("doc_id")).alias("ext"), "page_count", chars.alias("chars"))


_FILES_SQL = f"""
files AS (
  SELECT doc_id, [{", ".join(f"'{e}'" for e in _EXTS)}][doc_id % 10 + 1] AS ext, n, (n + 99) // 100 AS page_count,
    CASE WHEN doc_id % 7 = 3 THEN 10 ELSE 100 END AS most
  FROM (SELECT doc_id, length(text) AS n FROM documents)
), sampled AS (
  SELECT *, list_distinct(list_transform(range(least(5, page_count)), lambda i: (i * page_count) // least(5, page_count))) AS spots FROM files
), averages AS (
  SELECT *, list_avg(list_transform(spots, lambda p: least(most, n - p * 100))) AS average FROM sampled
), routed AS (
  SELECT *, CASE WHEN ext = '.docx' THEN 'OFFICE' WHEN ext = '.png' THEN 'IMAGE' WHEN ext <> '.pdf' OR page_count = 0 THEN 'UNKNOWN'
    WHEN average < 50 AND page_count > 20 THEN 'PDF_LONG_SCAN' WHEN average < 50 THEN 'PDF_SHORT_SCAN'
    WHEN page_count <= 4 THEN 'PDF_VLM_TEXT' WHEN page_count > 200 THEN 'PDF_LONG_TEXT' ELSE 'PDF_SHORT_TEXT' END AS doc_class
  FROM averages
)"""


def route_counts(spark: SparkSession, sf: str) -> DataFrame:
    """How many documents and pages take each route."""
    return classify.classify(_files(spark, sf), S).groupBy("doc_class", "parser", "folder", "label").agg(F.count("*").alias("n_docs"), F.sum("page_count").alias("n_pages"))


_ROUTE_SQL = f"""WITH {_FILES_SQL}
SELECT doc_class, CASE doc_class WHEN 'OFFICE' THEN 'office' WHEN 'PDF_SHORT_TEXT' THEN 'text_pdf' WHEN 'UNKNOWN' THEN 'none' ELSE 'vision' END AS parser,
  CASE doc_class WHEN 'OFFICE' THEN 'office' WHEN 'IMAGE' THEN 'images' WHEN 'PDF_VLM_TEXT' THEN 'pdfs/vlm_text' WHEN 'PDF_SHORT_TEXT' THEN 'pdfs/short_text'
    WHEN 'PDF_SHORT_SCAN' THEN 'pdfs/short_scanned' WHEN 'PDF_LONG_TEXT' THEN 'pdfs/long_text' WHEN 'PDF_LONG_SCAN' THEN 'pdfs/long_scanned' END AS folder,
  lower(replace(replace(doc_class, 'PDF_', ''), '_', '/')) AS label, count(*)::BIGINT AS n_docs, sum(page_count)::BIGINT AS n_pages
FROM routed GROUP BY doc_class"""


def sample_pages(spark: SparkSession, sf: str) -> DataFrame:
    f = _files(spark, sf)
    at = classify.sample_pages(F.col("page_count"), S.scan_sample_pages)
    return f.select("doc_id", F.col("page_count").cast("long").alias("page_count"), F.array_join(at.cast("array<string>"), ",").alias("sampled"), F.aggregate("chars", F.lit(0).cast("long"), lambda a, x: a + x).alias("chars"))


_SAMPLE_SQL = f"""WITH {_FILES_SQL}
SELECT doc_id, page_count::BIGINT AS page_count, coalesce(array_to_string(list_sort(spots), ','), '') AS sampled,
  coalesce(list_sum(list_transform(spots, lambda p: least(most, n - p * 100))), 0)::BIGINT AS chars FROM sampled"""


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    d = _table(spark, sf, "documents").select("doc_id", "text", F.ceil(F.length("text") / PAGE_CHARS).cast("int").alias("n"))
    return d.where("n > 0").select("doc_id", "text", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("page_no")).select("doc_id", "page_no", F.substring("text", F.col("page_no") * PAGE_CHARS + 1, F.lit(PAGE_CHARS)).alias("text"))


def head_tail(spark: SparkSession, sf: str) -> DataFrame:
    """Kept and dropped pages of each document: the head and the tail, and the rest."""
    pages = _pages(spark, sf).select("doc_id", "page_no")
    head = S.long_head_pages
    kept = classify.page_limits(pages, S).groupBy("doc_id").agg(F.count("*").alias("n_kept"), F.max("n_pages").alias("n_pages"))
    told = kept.withColumn("n_dropped", F.col("n_pages") - F.col("n_kept"))
    return told.select("doc_id", "n_pages", "n_kept", "n_dropped", F.when(F.col("n_dropped") > 0, F.lit(head).cast("long")).alias("first_dropped"))


_HEAD_TAIL_SQL = """
SELECT doc_id, p AS n_pages, least(p, 20) AS n_kept, greatest(p - 20, 0) AS n_dropped, CASE WHEN p > 20 THEN 10::BIGINT END AS first_dropped
FROM (SELECT doc_id, ((length(text) + 99) // 100)::BIGINT AS p FROM documents) WHERE p > 0"""


def ingest_run(spark: SparkSession, sf: str) -> DataFrame:
    """A whole run over CSV files, one for each nation, that are written from the tables first: scan, class, parse, check, front matter, table count."""
    from .plans import ingest
    from .sources import files

    folder = scratch(spark, "ingest")
    rows = _table(spark, sf, "nation").select(F.concat_ws("\n", F.lit("key,region"), F.concat_ws(",", "n_nationkey", "n_regionkey")).alias("value"), F.regexp_replace("n_name", " ", "_").alias("name"))
    rows.repartition(4).write.partitionBy("name").text(f"{folder}/in")
    found = files.scan_tree(spark, f"{folder}/in").where(F.col("path").contains("/name="))
    # Spark names the files; the folder tells the document, and every one is a CSV file
    named = found.withColumns({"name": F.concat(F.regexp_extract("path", "/name=([^/]+)/", 1), F.lit(".csv")), "ext": F.lit(".csv")})
    out = ingest.run(named, S, scratch=f"{folder}/work")
    return out.select("source", "doc_class", "parser", "content", "ok", "error", "table_count", "cpu_fallback")


_INGEST_SQL = r"""
SELECT replace(n_name, ' ', '_') || '.csv' AS source, 'OFFICE' AS doc_class, 'office' AS parser,
  '---' || chr(10) || 'source: ' || replace(n_name, ' ', '_') || '.csv' || chr(10) || 'parser: office' || chr(10) || '---' || chr(10) || chr(10)
    || '| key | region |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || n_nationkey || ' | ' || n_regionkey || ' |' AS content,
  true AS ok, NULL::VARCHAR AS error, 1 AS table_count, false AS cpu_fallback
FROM nation"""


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: below spark.checkpoint.dir, or a local one in a local session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base or tempfile.mkdtemp(prefix='foliospark-')}/{name}-{uuid.uuid4().hex}"


def head_tail_turns(spark: SparkSession, sf: str) -> DataFrame:
    return classify.page_limits(_table(spark, sf, "conversations").select("conv_id", "turn", "role"), S, "conv_id", "turn", 2, 2)


_TURNS_SQL = """
SELECT conv_id, turn, role, n_pages FROM (SELECT conv_id, turn, role, count(*) OVER (PARTITION BY conv_id) AS n_pages FROM conversations)
WHERE n_pages <= 4 OR turn < 2 OR turn >= n_pages - 2"""


def assemble_pages(spark: SparkSession, sf: str) -> DataFrame:
    c = _table(spark, sf, "conversations").select("conv_id", "turn", F.when(F.col("turn") == 1, F.lit("  \n")).otherwise(F.concat(F.lit("‏"), "text")).alias("text"), (F.col("role") == "user").alias("flag"))
    return assemble.assemble_pages(c, "conv_id", "turn", "text", "flag").withColumn("pages", F.col("pages").cast("long"))


_ASSEMBLE_SQL = r"""
SELECT conv_id, coalesce(string_agg(CASE WHEN turn = 1 THEN NULL WHEN turn > 0 THEN chr(10) || chr(10) || '---' || chr(10) || '*Page ' || (turn + 1) || '*' || chr(10) || chr(10) || text ELSE text END, '' ORDER BY turn), '') AS content,
  count(*)::BIGINT AS pages, bool_or(role = 'user') AS cpu_fallback
FROM conversations GROUP BY conv_id"""


def assemble_files(spark: SparkSession, sf: str) -> DataFrame:
    c = _table(spark, sf, "conversations").select(F.col("conv_id").alias("job_id"), F.concat(F.when(F.col("turn") == 2, "_").otherwise(""), "role", F.col("turn").cast("string"), F.lit(".txt")).alias("name"), F.col("text").alias("content"))
    return assemble.assemble_files(c)


_FILES_CONCAT_SQL = """
SELECT conv_id AS job_id, string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY role || turn || '.txt') AS markdown
FROM conversations WHERE turn <> 2 GROUP BY conv_id"""


def dedup_md5(spark: SparkSession, sf: str) -> DataFrame:
    d = _table(spark, sf, "documents").select("doc_id", "text")
    return assemble.first_by_content(d, F.col("text"), "doc_id").select("doc_id", "content_md5")


_DEDUP_SQL = "SELECT min(doc_id) AS doc_id, md5(text) AS content_md5 FROM documents GROUP BY md5(text)"


def _odd(text: Column) -> Column:
    """Texts with marks, CJK, Cyrillic and Arabic in place of some letters."""
    return F.translate(text, "aeozxq,", "‎中Жﭐﺍا　")


_ODD_SQL = "translate(text, 'aeozxq,', chr(8206) || chr(20013) || chr(1046) || chr(64336) || chr(65165) || chr(1575) || chr(12288))"


def strip_bidi(spark: SparkSession, sf: str) -> DataFrame:
    d = _table(spark, sf, "documents").select("doc_id", "text", _odd(F.col("text")).alias("odd")).withColumn("t", T.strip_bidi(F.col("odd")))
    bare = T.strip(F.concat(F.lit("　\n\x1c"), F.col("text"), F.lit("   ")))
    return d.select("doc_id", F.length("t").cast("long").alias("n"), F.md5("t").alias("stripped_md5"), F.md5(bare).alias("bare_md5"))


_BIDI_SQL = f"""
SELECT doc_id, length(t)::BIGINT AS n, md5(t) AS stripped_md5, md5(regexp_replace(text, '^[{T.SPACE}]+|[{T.SPACE}]+$', '', 'g')) AS bare_md5
FROM (SELECT doc_id, text, replace({_ODD_SQL}, chr(8206), '') AS t FROM documents)"""


def _garbage(spark: SparkSession, sf: str, pattern: str, limit: float) -> DataFrame:
    t = _table(spark, sf, "documents").select("doc_id", F.translate(F.col("text"), "zjw,", "中Ж℀　").alias("t"))
    n = t.select("doc_id", T.count_of(F.col("t"), pattern).alias("n_bad"), F.length("t").cast("long").alias("n"))
    return n.select("doc_id", "n_bad", "n", F.coalesce(F.try_divide("n_bad", "n") > limit, F.lit(False)).alias("garbage"))


def garbage_office(spark: SparkSession, sf: str) -> DataFrame:
    return _garbage(spark, sf, T.OFFICE_GARBAGE, S.office_garbage)


def garbage_pdf(spark: SparkSession, sf: str) -> DataFrame:
    return _garbage(spark, sf, T.PDF_GARBAGE, S.pdf_garbage)


def _garbage_sql(letters: str, limit: float) -> str:
    bad = " + ".join(f"(length(text) - length(replace(text, '{c}', '')))" for c in letters)
    return f"SELECT doc_id, ({bad})::BIGINT AS n_bad, length(text)::BIGINT AS n, length(text) > 0 AND ({bad}) / length(text)::DOUBLE > {limit} AS garbage FROM documents"


def arabic_forms(spark: SparkSession, sf: str) -> DataFrame:
    d = _table(spark, sf, "documents").select("doc_id", _odd(F.col("text")).alias("t"))
    return d.select("doc_id", T.count_of(F.col("t"), T.ARABIC_FORMS).alias("n_forms"), T.count_of(F.col("t"), T.ARABIC).alias("n_arabic"), (T.arabic_forms(F.col("t")) > S.arabic_forms).alias("old_encoding"))


_ARABIC_SQL = """
SELECT doc_id, f::BIGINT AS n_forms, a::BIGINT AS n_arabic, a > 10 AND f / a::DOUBLE > 0.3 AS old_encoding
FROM (SELECT doc_id, length(text) - length(regexp_replace(text, '[zx]', '', 'g')) AS f, length(text) - length(regexp_replace(text, '[zxq]', '', 'g')) AS a FROM documents)"""


def nfkc(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "documents").select("doc_id", F.md5(T.nfkc(F.replace(F.col("text"), F.lit("ti"), F.lit("tⅰ")))).alias("nfkc_md5"))


def md_tables(spark: SparkSession, sf: str) -> DataFrame:
    t = F.replace(F.replace(F.col("text"), F.lit(". "), F.lit(" |\r\n | ")), F.lit(", "), F.lit("\n"))
    return _table(spark, sf, "documents").select("doc_id", T.count_tables(t).cast("long").alias("n_tables"))


_TABLES_SQL = """
WITH l AS (SELECT doc_id, list_transform(string_split(replace(replace(replace(text, '. ', ' |' || chr(13) || chr(10) || ' | '), ', ', chr(10)), chr(13) || chr(10), chr(10)), chr(10)), lambda x: starts_with(trim(x), '|') AND ends_with(trim(x), '|')) AS r FROM documents)
SELECT doc_id, len(list_filter(range(1, len(r) + 1), lambda i: r[i] AND (i = 1 OR NOT r[i - 1])))::BIGINT AS n_tables FROM l"""


def pipe_table(spark: SparkSession, sf: str) -> DataFrame:
    """The nations of each region as a pipe table; the last cell of a row is missing for odd keys."""
    n = _table(spark, sf, "nation").join(_table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = n.groupBy("r_name").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("r"))
    cell = lambda r, c, t: F.struct(F.lit(r).cast("int").alias("row") if isinstance(r, int) else r.cast("int").alias("row"), F.lit(c).cast("int").alias("col"), t.alias("content"))
    body = F.flatten(F.transform("r", lambda x, i: F.array(cell(i + 1, 0, x["n_nationkey"].cast("string")), cell(i + 1, 1, F.concat(F.lit("a|"), x["n_name"], F.lit("\nb"))), cell(F.when(x["n_nationkey"] % 2 == 0, i + 1).otherwise(99), 2, F.lit("even")))))
    cells = F.concat(F.array(cell(0, 0, F.lit("key")), cell(0, 1, F.lit("name")), cell(0, 2, F.lit("kind"))), body)
    grid = F.struct((F.size("r") + 1).cast("int").alias("rows"), F.lit(3).alias("cols"), cells.alias("cells"))
    return rows.select("r_name", render_grid(grid).alias("markdown"))


_PIPE_SQL = r"""
SELECT r_name, '| key | name | kind |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg('| ' || n_nationkey || ' | a\|' || n_name || ' b | ' || CASE WHEN n_nationkey % 2 = 0 THEN 'even' ELSE '' END || ' |', chr(10) ORDER BY n_nationkey) AS markdown
FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name"""


def tree_markdown(spark: SparkSession, sf: str) -> DataFrame:
    """Headings and list items of each page as a document tree, rendered."""
    p = _table(spark, sf, "pages").select("page_id", F.regexp_extract_all("html", F.lit(r"<(h1|li)>([^<]*)<"), F.lit(1)).alias("k"), F.regexp_extract_all("html", F.lit(r"<(h1|li)>([^<]*)<"), F.lit(2)).alias("t"))
    none = F.lit(None)
    node = lambda z: F.struct(
        F.when(z["k"] == "h1", "heading").otherwise("list_item").alias("node_type"), z["t"].alias("text"), none.cast("string").alias("heading_text"), F.lit(1).alias("heading_level"),
        none.cast("string").alias("description"), none.cast("struct<rows:int,cols:int,cells:array<struct<row:int,col:int,content:string>>>").alias("grid"), F.lit([]).cast("array<int>").alias("children"),
    )
    return p.select("page_id", render_tree(F.transform(F.arrays_zip("k", "t"), node)).alias("markdown"))


_TREE_SQL = r"""
WITH x AS (SELECT page_id, regexp_extract_all(html, '<(h1|li)>([^<]*)<', 1) AS k, regexp_extract_all(html, '<(h1|li)>([^<]*)<', 2) AS t FROM pages)
SELECT page_id, array_to_string(list_transform(list_filter(range(1, len(k) + 1), lambda i: trim(t[i]) <> ''), lambda i: CASE WHEN k[i] = 'h1' THEN '# ' ELSE '- ' END || trim(t[i])), chr(10) || chr(10)) AS markdown FROM x"""


def tree_roots(spark: SparkSession, sf: str) -> DataFrame:
    """Trees of line items (children of i: 2i + 1 and 2i + 2, also where there is no such item): roots, links to nodes that exist, links to nodes that are not headings."""
    nodes = _table(spark, sf, "lineitem").groupBy("l_orderkey", (F.col("l_linenumber") - 1).alias("i")).agg(F.min("l_returnflag").alias("flag"))
    links = nodes.select("l_orderkey", F.explode(F.array(2 * F.col("i") + 1, 2 * F.col("i") + 2)).alias("i"))
    roots = nodes.join(links, ["l_orderkey", "i"], "left_anti").groupBy("l_orderkey").agg(F.count("*").alias("n_roots"))
    met = links.join(nodes, ["l_orderkey", "i"]).groupBy("l_orderkey").agg(F.count("*").alias("n_links"), F.count_if(F.col("flag") != "R").alias("n_shown"))
    return roots.join(met, "l_orderkey", "left").select("l_orderkey", "n_roots", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_shown", F.lit(0)).alias("n_shown"))


_ROOTS_SQL = """
WITH n AS (SELECT l_orderkey, l_linenumber - 1 AS i, min(l_returnflag) AS flag FROM lineitem GROUP BY ALL),
p AS (SELECT n.*, m.i IS NOT NULL AS held FROM n LEFT JOIN n m ON n.l_orderkey = m.l_orderkey AND n.i > 0 AND m.i = (n.i - 1) // 2)
SELECT l_orderkey, count(*) FILTER (NOT held)::BIGINT AS n_roots, count(*) FILTER (held)::BIGINT AS n_links, count(*) FILTER (held AND flag <> 'R')::BIGINT AS n_shown FROM p GROUP BY l_orderkey HAVING n_roots > 0"""


def unique_names(spark: SparkSession, sf: str) -> DataFrame:
    p = _table(spark, sf, "part").select("p_partkey", F.concat(F.substring_index("p_name", " ", 1), F.lit(".pdf")).alias("name"))
    return assemble.numbered_names(p, "name", "p_partkey")


_NAMES_SQL = """
SELECT p_partkey, n || '.pdf' AS name, CASE WHEN k = 0 THEN n || '.pdf' ELSE n || '_' || k || '.pdf' END AS unique_name
FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY p_partkey) - 1 AS k FROM (SELECT p_partkey, string_split(p_name, ' ')[1] AS n FROM part))"""


def exact_names(spark: SparkSession, sf: str) -> DataFrame:
    p = _table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("folder"), F.concat(F.substring_index("p_name", " ", 1), F.lit(".pdf")).alias("name"))
    return assemble.exact_names(p, "name", "p_partkey", "folder")


_EXACT_SQL = """
SELECT p_partkey, folder, n || '.pdf' AS name, CASE WHEN k = 0 THEN n || '.pdf' ELSE n || '_' || k || '.pdf' END AS unique_name
FROM (SELECT *, row_number() OVER (PARTITION BY folder, n ORDER BY p_partkey) - 1 AS k FROM (SELECT p_partkey, p_brand AS folder, string_split(p_name, ' ')[1] AS n FROM part))"""


def extensions(spark: SparkSession, sf: str) -> DataFrame:
    name = T.base_name(F.regexp_replace("url", "[?#].*$", ""))
    return _table(spark, sf, "pages").select("page_id", name.alias("name"), T.extension(name).alias("ext"), T.stem(name).alias("stem"))


_EXT_SQL = r"""
SELECT page_id, n AS name, lower(regexp_extract(n, '^.+(\.[^./]+)$', 1)) AS ext, CASE WHEN regexp_matches(n, '^.+\.[^./]+$') THEN regexp_extract(n, '^(.+)\.[^./]+$', 1) ELSE n END AS stem
FROM (SELECT page_id, string_split(regexp_replace(url, '[?#].*$', ''), '/')[-1] AS n FROM pages)"""


def upload_gate(spark: SparkSession, sf: str) -> DataFrame:
    d = _table(spark, sf, "documents")
    return d.select("doc_id", classify.upload_gate(_ext(F.col("doc_id")), F.col("n_chars") * 20_000, S).cast("long").alias("http_status"))


_UPLOAD_SQL = "SELECT doc_id, CASE WHEN doc_id % 10 = 2 THEN 400 WHEN n_chars * 20000 > 104857600 THEN 413 ELSE 202 END::BIGINT AS http_status FROM documents"


def _results(spark: SparkSession, sf: str) -> DataFrame:
    """First lines of two orders in three as results of their files; returned ones failed."""
    x = _table(spark, sf, "lineitem").where("l_orderkey % 3 <> 0").groupBy("l_orderkey").agg(F.min(F.struct("l_linenumber", "l_returnflag", "l_quantity")).alias("x"))
    return x.select(F.col("l_orderkey").alias("o_orderkey"), F.when(F.col("x.l_returnflag") == "R", F.concat(F.lit("line "), F.col("x.l_linenumber").cast("string"))).alias("error"), F.col("x.l_quantity").alias("elapsed_s"))


_RESULTS_SQL = "r AS (SELECT l_orderkey, CASE WHEN arg_min(l_returnflag, (l_linenumber, l_returnflag, l_quantity)) = 'R' THEN 'line ' || min(l_linenumber) END AS error FROM lineitem WHERE l_orderkey % 3 <> 0 GROUP BY l_orderkey)"


def result_merge(spark: SparkSession, sf: str) -> DataFrame:
    states = _table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return jobs.merge_results(states, _results(spark, sf), "o_orderkey").groupBy("o_orderpriority", "status").agg(F.count("*").alias("n_files"), F.min("error").alias("first_error"))


_MERGE_SQL = f"""WITH {_RESULTS_SQL}
SELECT o_orderpriority, CASE WHEN l_orderkey IS NULL THEN 'pending' WHEN error IS NULL THEN 'ok' ELSE 'error' END AS status, count(*)::BIGINT AS n_files, min(error) AS first_error
FROM orders LEFT JOIN r ON o_orderkey = l_orderkey GROUP BY ALL"""


def missing_results(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.missing(_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), _results(spark, sf), "o_orderkey")


_MISSING_SQL = f"WITH {_RESULTS_SQL} SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM r)"


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    x = _table(spark, sf, "lineitem").select("l_linestatus", "l_shipdate", F.when(F.col("l_returnflag") == "R", F.lit("returned")).alias("error"), (F.col("l_tax") > 0.07).alias("cpu_fallback"))
    return jobs.counts(x.withColumn("year", F.year("l_shipdate").cast("long")), ["l_linestatus", "year"])


_SUMMARY_SQL = """
SELECT l_linestatus, year(l_shipdate)::BIGINT AS year, count(*)::BIGINT AS n_files, count(*) FILTER (l_returnflag <> 'R')::BIGINT AS n_ok, count(*) FILTER (l_returnflag = 'R')::BIGINT AS n_error, bool_or(l_tax > 0.07) AS cpu_fallback
FROM lineitem GROUP BY ALL"""


def run_report(spark: SparkSession, sf: str) -> DataFrame:
    d = _table(spark, sf, "documents").select("doc_id", "text")
    unique = assemble.first_by_content(d, F.col("text"), "doc_id").select("doc_id")
    results = _table(spark, sf, "labels").join(unique, "doc_id").select("doc_id", F.when(F.col("quality") == 0, F.lit("poor")).alias("error"))
    return jobs.report(d, unique, results, "doc_id")


_REPORT_SQL = """
WITH u AS (SELECT min(doc_id) AS doc_id FROM documents GROUP BY text), r AS (SELECT doc_id, quality FROM labels WHERE doc_id IN (SELECT doc_id FROM u))
SELECT (SELECT count(*) FROM documents)::BIGINT AS n_found, (SELECT count(*) FROM u)::BIGINT AS n_unique, count(*)::BIGINT AS n_returned, count(*) FILTER (quality <> 0)::BIGINT AS n_ok, count(*) FILTER (quality = 0)::BIGINT AS n_failed,
  (SELECT count(*) FROM u WHERE doc_id NOT IN (SELECT doc_id FROM r))::BIGINT AS n_missing, count(*) FILTER (quality = 0) = 0 AND (SELECT count(*) FROM u WHERE doc_id NOT IN (SELECT doc_id FROM r)) = 0 AS complete
FROM r"""


def job_status(spark: SparkSession, sf: str) -> DataFrame:
    x = _table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("job_id"), F.when(F.col("l_returnflag") != "N", F.concat("l_returnflag", F.lit("/"), "l_linestatus")).alias("error"))
    return jobs.job_status(x)


_STATUS_SQL = """
SELECT l_orderkey AS job_id, CASE WHEN bool_and(l_returnflag <> 'N') THEN 'failed' ELSE 'done' END AS status,
  CASE WHEN bool_and(l_returnflag <> 'N') THEN string_agg(l_returnflag || '/' || l_linestatus, '; ' ORDER BY l_returnflag || '/' || l_linestatus) END AS error
FROM lineitem GROUP BY l_orderkey"""


def job_latest(spark: SparkSession, sf: str) -> DataFrame:
    out = jobs.latest(_table(spark, sf, "events"), "user_id", "ts", "event_type", "event_id")
    return out.select("user_id", "status", "n_events", F.unix_micros(F.col("created_at").cast("timestamp")).alias("created_us"), F.unix_micros(F.col("updated_at").cast("timestamp")).alias("updated_us"))


_LATEST_SQL = """
SELECT user_id, arg_max(event_type, (ts, event_id)) AS status, count(*)::BIGINT AS n_events, epoch_us(min(ts))::BIGINT AS created_us, epoch_us(max(ts))::BIGINT AS updated_us FROM events GROUP BY user_id"""


def job_lives(spark: SparkSession, sf: str) -> DataFrame:
    out = jobs.lives(_table(spark, sf, "events").select("user_id", "ts"), "user_id", "ts", S.job_ttl_s)
    return out.select("user_id", "life", "n_events", F.unix_micros(F.col("created_at").cast("timestamp")).alias("created_us"), F.unix_micros(F.col("updated_at").cast("timestamp")).alias("updated_us"))


_LIVES_SQL = """
WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 86400 SECOND THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS life FROM g)
SELECT user_id, life::BIGINT AS life, count(*)::BIGINT AS n_events, epoch_us(min(ts))::BIGINT AS created_us, epoch_us(max(ts))::BIGINT AS updated_us FROM n GROUP BY user_id, life"""


def job_gates(spark: SparkSession, sf: str) -> DataFrame:
    """What requests for results and deletion get, by the latest status of each job; every seventh job is unknown."""
    names = F.create_map(*[F.lit(x) for x in ("click", "queued", "view", "processing", "purchase", "done")])
    status = F.when(F.col("user_id") % 7 != 0, F.coalesce(names[F.col("status")], F.lit("failed")))
    j = jobs.latest(_table(spark, sf, "events"), "user_id", "ts", "event_type", "event_id").withColumn("status", status)
    return j.groupBy("status", jobs.result_gate(F.col("status")).cast("long").alias("result_status"), jobs.delete_gate(F.col("status")).cast("long").alias("delete_status")).agg(F.count("*").alias("n_jobs"))


_GATES_SQL = """
WITH j AS (SELECT CASE WHEN user_id % 7 <> 0 THEN CASE arg_max(event_type, (ts, event_id)) WHEN 'click' THEN 'queued' WHEN 'view' THEN 'processing' WHEN 'purchase' THEN 'done' ELSE 'failed' END END AS status FROM events GROUP BY user_id)
SELECT status, CASE WHEN status IS NULL THEN 404 WHEN status IN ('queued', 'processing') THEN 409 ELSE 200 END::BIGINT AS result_status,
  CASE WHEN status IS NULL THEN 404 WHEN status = 'processing' THEN 409 ELSE 204 END::BIGINT AS delete_status, count(*)::BIGINT AS n_jobs FROM j GROUP BY ALL"""


def job_results(spark: SparkSession, sf: str) -> DataFrame:
    """Finished jobs that are not deleted, with their texts and summaries."""
    states = job_status(spark, sf)
    left = jobs.remove_jobs(states, _table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("job_id")))
    texts = _table(spark, sf, "lineitem").where("l_linenumber <= 2").groupBy(F.col("l_orderkey").alias("job_id")).agg(F.count("*").alias("n_texts"))
    sums = _table(spark, sf, "orders").where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("job_id"), "o_orderpriority")
    return jobs.with_results(left, texts, sums).select("job_id", "n_texts", "o_orderpriority")


_JOB_RESULTS_SQL = """
SELECT l_orderkey AS job_id, count(*) FILTER (l_linenumber <= 2)::BIGINT AS n_texts, any_value(o_orderpriority) AS o_orderpriority
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P' AND o_orderkey % 5 <> 0
GROUP BY l_orderkey HAVING bool_or(l_returnflag = 'N') AND bool_or(l_linenumber <= 2)"""


def elapsed_format(spark: SparkSession, sf: str) -> DataFrame:
    x = _table(spark, sf, "lineitem").select((F.floor("l_quantity") * F.col("l_linenumber") * 30.5).alias("seconds")).distinct()
    return x.select("seconds", T.elapsed(F.col("seconds")).alias("short"), T.elapsed(F.col("seconds"), hours=True).alias("long"))


_ELAPSED_SQL = """
WITH x AS (SELECT DISTINCT floor(l_quantity) * l_linenumber * 30.5::DOUBLE AS seconds FROM lineitem),
y AS (SELECT seconds, floor(seconds / 60)::BIGINT AS m, printf('%.1fs', seconds - floor(seconds / 60) * 60) AS r FROM x)
SELECT seconds, CASE WHEN m > 0 THEN m || 'm ' ELSE '' END || r AS short, CASE WHEN m >= 60 THEN (m // 60) || 'h ' || (m % 60) || 'm ' WHEN m > 0 THEN m || 'm ' ELSE '' END || r AS long FROM y"""


def last_json(spark: SparkSession, sf: str) -> DataFrame:
    log = F.concat(F.lit('start\n{"old": 1}\n  '), F.col("props"), F.lit("\n{broken\nbye"))
    return _table(spark, sf, "events").select("event_id", T.last_json(F.when(F.col("event_id") % 5 != 0, log).otherwise(F.lit("no json here"))).alias("line"))


_JSON_SQL = "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN trim(props) END AS line FROM events"


def parser_verdict(spark: SparkSession, sf: str) -> DataFrame:
    ok, error = jobs.verdict(F.col("l_returnflag") == "N", (F.col("l_linenumber") % 3).cast("int"), F.when(F.col("l_linestatus") == "O", F.lit("late")).otherwise(""))
    return _table(spark, sf, "lineitem").select(ok.alias("ok"), error.alias("error")).groupBy("ok", "error").agg(F.count("*").alias("n"))


_VERDICT_SQL = """
SELECT ok, CASE WHEN e IS NOT NULL THEN e WHEN NOT ok THEN 'process exited ' || x END AS error, count(*)::BIGINT AS n
FROM (SELECT l_returnflag = 'N' AND l_linenumber % 3 = 0 AS ok, CASE WHEN l_linestatus = 'O' THEN 'late' END AS e, l_linenumber % 3 AS x FROM lineitem) GROUP BY ALL"""


def front_matter(spark: SparkSession, sf: str) -> DataFrame:
    d = _table(spark, sf, "documents")
    pages = F.when(F.col("doc_id") % 3 != 0, F.ceil(F.col("n_chars") / PAGE_CHARS).cast("string"))
    langs = F.array_join(F.array(F.col("lang"), F.lit("xx")), ", ")
    return d.select("doc_id", T.front_matter(F.col("source"), F.lit("office"), pages=pages, languages=langs, cpu_fallback=T.yes_no(F.col("doc_id") % 2 == 0)).alias("head"))


_FRONT_SQL = """
SELECT doc_id, '---' || chr(10) || 'source: ' || source || chr(10) || 'parser: office' || chr(10) || CASE WHEN doc_id % 3 <> 0 THEN 'pages: ' || ((n_chars + 99) // 100) || chr(10) ELSE '' END
  || 'languages: ' || lang || ', xx' || chr(10) || 'cpu_fallback: ' || CASE WHEN doc_id % 2 = 0 THEN 'True' ELSE 'False' END || chr(10) || '---' || chr(10) || chr(10) AS head FROM documents"""


def parser_line(spark: SparkSession, sf: str) -> DataFrame:
    from .plans.sinks import parser_lines

    x = _table(spark, sf, "labels").select("doc_id", (F.col("quality") == 1).alias("ok"), F.lit("office").alias("parser"), F.when(F.col("toxic") == 1, 3).alias("pages"), F.when(F.col("quality") == 0, F.lit('bad "x"')).alias("error"), F.lit(None).cast("int").alias("table_count"), F.lit(False).alias("cpu_fallback"))
    return parser_lines(x)


_LINE_SQL = """
SELECT doc_id, '{"ok":' || CASE WHEN quality = 1 THEN 'true' ELSE 'false' END || ',"parser":"office","pages":' || CASE WHEN toxic = 1 THEN '3' ELSE 'null' END
  || ',"error":' || CASE WHEN quality = 0 THEN '"bad \\"x\\""' ELSE 'null' END || ',"table_count":null,"cpu_fallback":false}' AS line FROM labels"""


def data_url(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "documents").select("doc_id", F.md5(T.data_url(F.col("text").cast("binary"))).alias("url_md5"), F.md5(F.col("text").cast("binary")).alias("content_md5"))


_URL_SQL = "SELECT doc_id, md5('data:image/png;base64,' || base64(encode(text))) AS url_md5, md5(text) AS content_md5 FROM documents"


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    from .plans.sinks import manifest as sorted_files

    f = classify.classify(_files(spark, sf), S).withColumn("name", F.concat(F.lit("f"), (F.col("doc_id") % 50).cast("string"), "ext"))
    return sorted_files(f)


_MANIFEST_SQL = f"""WITH {_FILES_SQL}, placed AS (
  SELECT doc_id, 'f' || (doc_id % 50) AS s, ext, doc_class, CASE doc_class WHEN 'OFFICE' THEN 'office' WHEN 'IMAGE' THEN 'images' WHEN 'PDF_VLM_TEXT' THEN 'pdfs/vlm_text' WHEN 'PDF_SHORT_TEXT' THEN 'pdfs/short_text'
    WHEN 'PDF_SHORT_SCAN' THEN 'pdfs/short_scanned' WHEN 'PDF_LONG_TEXT' THEN 'pdfs/long_text' ELSE 'pdfs/long_scanned' END AS folder FROM routed WHERE doc_class <> 'UNKNOWN')
SELECT doc_id, s || ext AS name, doc_class, folder, folder || '/' || s || CASE WHEN k > 0 THEN '_' || k ELSE '' END || ext AS unique_name
FROM (SELECT *, row_number() OVER (PARTITION BY folder, s, ext ORDER BY doc_id) - 1 AS k FROM placed)"""


#: name: (query, SQL)
ALL: dict[str, tuple[Query, str]] = {
    "q_route_counts": (route_counts, _ROUTE_SQL),
    "q_sample_pages": (sample_pages, _SAMPLE_SQL),
    "q_head_tail": (head_tail, _HEAD_TAIL_SQL),
    "q_ingest_run": (ingest_run, _INGEST_SQL),
    "q_head_tail_turns": (head_tail_turns, _TURNS_SQL),
    "q_assemble_pages": (assemble_pages, _ASSEMBLE_SQL),
    "q_assemble_files": (assemble_files, _FILES_CONCAT_SQL),
    "q_dedup_md5": (dedup_md5, _DEDUP_SQL),
    "q_strip_bidi": (strip_bidi, _BIDI_SQL),
    "q_garbage_office": (garbage_office, _garbage_sql("zw", S.office_garbage)),
    "q_garbage_pdf": (garbage_pdf, _garbage_sql("zjw", S.pdf_garbage)),
    "q_arabic_forms": (arabic_forms, _ARABIC_SQL),
    "q_nfkc": (nfkc, "SELECT doc_id, md5(text) AS nfkc_md5 FROM documents"),
    "q_md_tables": (md_tables, _TABLES_SQL),
    "q_pipe_table": (pipe_table, _PIPE_SQL),
    "q_tree_markdown": (tree_markdown, _TREE_SQL),
    "q_tree_roots": (tree_roots, _ROOTS_SQL),
    "q_unique_names": (unique_names, _NAMES_SQL),
    "q_exact_names": (exact_names, _EXACT_SQL),
    "q_extensions": (extensions, _EXT_SQL),
    "q_upload_gate": (upload_gate, _UPLOAD_SQL),
    "q_result_merge": (result_merge, _MERGE_SQL),
    "q_missing_results": (missing_results, _MISSING_SQL),
    "q_run_summary": (run_summary, _SUMMARY_SQL),
    "q_run_report": (run_report, _REPORT_SQL),
    "q_job_status": (job_status, _STATUS_SQL),
    "q_job_latest": (job_latest, _LATEST_SQL),
    "q_job_lives": (job_lives, _LIVES_SQL),
    "q_job_gates": (job_gates, _GATES_SQL),
    "q_job_results": (job_results, _JOB_RESULTS_SQL),
    "q_elapsed_format": (elapsed_format, _ELAPSED_SQL),
    "q_last_json": (last_json, _JSON_SQL),
    "q_parser_verdict": (parser_verdict, _VERDICT_SQL),
    "q_front_matter": (front_matter, _FRONT_SQL),
    "q_parser_line": (parser_line, _LINE_SQL),
    "q_data_url": (data_url, _URL_SQL),
    "q_manifest": (manifest, _MANIFEST_SQL),
}
QUERIES: dict[str, Query] = {k: q for k, (q, _) in ALL.items()}
ORACLE_SQL: dict[str, str] = {k: s for k, (_, s) in ALL.items()}
