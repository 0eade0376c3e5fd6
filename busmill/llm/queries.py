"""The registered queries of the training-data operators, over the whole tables below sf_dir."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import infill, jaccard, licenses, lines, phrases, subtrees, topk
from .decontaminate import op8_decontamination
from .infill import op11_fill_in_middle
from .jaccard import op2_near_duplicates
from .language import op10_language_id
from .licenses import op5_license_scan
from .lines import op4_line_dedup
from .packing import op7_pack_sequences
from .pages import op6_main_text
from .phrases import op13_collocations
from .quality import op3_quality
from .repeats import op1_repeated_bytes
from .subtrees import op12_repeated_words
from .topk import op9_top_k

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repeated_bytes": op1_repeated_bytes,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_quality": op3_quality,
    "op4_line_dedup": op4_line_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_main_text": op6_main_text,
    "op7_pack_sequences": op7_pack_sequences,
    "op8_decontamination": op8_decontamination,
    "op9_top_k": op9_top_k,
    "op10_language_id": op10_language_id,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_repeated_words": op12_repeated_words,
    "op13_collocations": op13_collocations,
}

ORACLE_SQL: dict[str, str] = {
    "op2_near_duplicates": jaccard.ORACLE,
    "op4_line_dedup": lines.ORACLE,
    "op5_license_scan": licenses.ORACLE,
    "op9_top_k": topk.ORACLE,
    "op11_fill_in_middle": infill.ORACLE,
    "op12_repeated_words": subtrees.ORACLE,
    "op13_collocations": phrases.ORACLE,
}
