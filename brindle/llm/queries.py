"""Named queries of the operators, and the SQL that checks those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brindle.llm.conversations import OP11_SQL, op11_conversations
from brindle.llm.decontaminate import op5_decontaminate
from brindle.llm.language import op6_language
from brindle.llm.line_dedup import OP3_SQL, op3_line_dedup
from brindle.llm.main_text import op1_main_text
from brindle.llm.personal_data import op7_personal_data
from brindle.llm.pieces import op4_pieces
from brindle.llm.simhash import op8_simhash
from brindle.llm.super_min_hash import op12_near_duplicates
from brindle.llm.token_alignment import op13_alignment
from brindle.llm.token_files import op2_token_files
from brindle.llm.url_rules import OP9_SQL, op9_url_rules
from brindle.llm.vantage import op10_vantage

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_main_text": op1_main_text,
    "op2_token_files": op2_token_files,
    "op3_line_dedup": op3_line_dedup,
    "op4_pieces": op4_pieces,
    "op5_decontaminate": op5_decontaminate,
    "op6_language": op6_language,
    "op7_personal_data": op7_personal_data,
    "op8_simhash": op8_simhash,
    "op9_url_rules": op9_url_rules,
    "op10_vantage": op10_vantage,
    "op11_conversations": op11_conversations,
    "op12_near_duplicates": op12_near_duplicates,
    "op13_alignment": op13_alignment,
}
ORACLES: dict[str, str] = {"op3_line_dedup": OP3_SQL, "op9_url_rules": OP9_SQL, "op11_conversations": OP11_SQL}
