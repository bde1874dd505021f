"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op8_bpe
from .decontaminate import op6_decontaminate
from .extract import op2_main_text
from .hardneg import OP11_SQL, op11_hard_negatives
from .importance import op13_importance
from .langid import language_of_pages, op10_language
from .pii import op9_pii
from .pitman_yor import op7_pitman_yor
from .repeats import op12_repeats
from .sharding import op1_sharding
from .simhash import op4_simhash
from .tokenbin import op5_token_ids
from .vptree import op3_neighbours

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_main_text": op2_main_text,
    "op3_neighbours": op3_neighbours,
    "op4_simhash": op4_simhash,
    "op5_token_ids": op5_token_ids,
    "op6_decontaminate": op6_decontaminate,
    "op7_pitman_yor": op7_pitman_yor,
    "op8_bpe": op8_bpe,
    "op9_pii": op9_pii,
    "op10_language": op10_language,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_repeats": op12_repeats,
    "op13_importance": op13_importance,
    "language_of_pages": language_of_pages,
}

#: The other queries have no SQL: checksums, hashes and learned models have no DuckDB form.
ORACLE: dict[str, str] = {"op11_hard_negatives": OP11_SQL}
