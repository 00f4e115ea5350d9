"""Registered queries of this folder and, where SQL can express them, the same results in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skylake.llm import (
    archive_convert, chat_format, collocations, decontamination, packing, pii, secret_scan, simhash, site_style, toxicity, url_filter,
    weighted_sampling, whitening,
)
from skylake.llm.common import load

Query = Callable[[SparkSession, str], DataFrame]


def _over(operator: Callable[..., DataFrame], *tables: str) -> Query:
    return lambda spark, sf_dir: operator(*(load(spark, sf_dir, t) for t in tables))


QUERIES: dict[str, Query] = {
    "op1_toxicity": _over(toxicity.op1_toxicity, "documents", "labels"),
    "op2_simhash": _over(simhash.op2_simhash, "documents"),
    "op3_chat": _over(chat_format.op3_chat, "conversations"),
    "op4_decontamination": _over(decontamination.op4_decontamination, "documents", "benchmark"),
    "op5_packing": _over(packing.op5_packing, "documents"),
    "op6_url_filter": _over(url_filter.op6_url_filter, "pages"),
    "op7_secrets": _over(secret_scan.op7_secrets, "documents"),
    "op8_warc": _over(archive_convert.op8_warc, "pages"),
    "op9_main_text": _over(site_style.op9_main_text, "pages"),
    "op10_fingerprints": _over(weighted_sampling.op10_fingerprints, "documents"),
    "op11_whitening": _over(whitening.op11_whitening, "embeddings"),
    "op12_pii": _over(pii.op12_pii, "documents"),
    "op13_collocations": _over(collocations.op13_collocations, "documents"),
}

ORACLE_SQL: dict[str, str] = {
    "op3_chat": chat_format.SQL,
    "op4_decontamination": decontamination.SQL,
    "op6_url_filter": url_filter.SQL,
    "op8_warc": archive_convert.SQL,
    "op13_collocations": collocations.SQL,
}
