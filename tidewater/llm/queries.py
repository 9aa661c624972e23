"""The operators' queries over the given tables, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import (
    chat,
    decontaminate,
    html_text,
    language,
    lexical,
    lm_score,
    near_dedup,
    pieces,
    quality,
    resampling,
    secrets,
    token_files,
    urls,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_score": lm_score.op1_lm_score,
    "op2_near_dedup": near_dedup.op2_near_dedup,
    "op3_language": language.op3_language,
    "op4_token_files": token_files.op4_token_files,
    "op5_quality": quality.op5_quality,
    "op6_chat": chat.op6_chat,
    "op7_urls": urls.op7_urls,
    "op8_pieces": pieces.op8_pieces,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_html_text": html_text.op10_html_text,
    "op11_lexical_search": lexical.op11_lexical_search,
    "op12_secrets": secrets.op12_secrets,
    "op13_resampling": resampling.op13_resampling,
}

ORACLES: dict[str, str] = {"op11_lexical_search": lexical.OP11_SQL}
