"""Queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decontaminate import op7_decontaminate
from .langid import op5_language_id
from .licenses import op3_license_scan
from .mixing import OP10_SQL, op10_mix_sources
from .order_minhash import op2_order_minhash
from .quality import op9_quality
from .simhash import op4_simhash
from .tokens import op1_token_shards
from .urls import op6_url_filter
from .warc import OP8_SQL, op8_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_shards": op1_token_shards,
    "op2_order_minhash": op2_order_minhash,
    "op3_license_scan": op3_license_scan,
    "op4_simhash": op4_simhash,
    "op5_language_id": op5_language_id,
    "op6_url_filter": op6_url_filter,
    "op7_decontaminate": op7_decontaminate,
    "op8_warc": op8_warc,
    "op9_quality": op9_quality,
    "op10_mix_sources": op10_mix_sources,
}
ORACLE_SQL: dict[str, str] = {"op8_warc": OP8_SQL, "op10_mix_sources": OP10_SQL}
