"""Every query of the subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from recordlake.llm import (
    decontaminate,
    fill_middle,
    jaccard_join,
    language,
    line_dedup,
    mixing,
    quality,
    recurrent_scores,
    secrets,
    substring_dedup,
    toxicity,
    vector_codes,
    vector_search,
)

QUERIES = {
    "op1_line_dedup": line_dedup.query,
    "op2_secret_scans": secrets.query,
    "op3_vector_search": vector_search.query,
    "op4_jaccard_join": jaccard_join.query,
    "op5_toxicity": toxicity.query,
    "op6_decontaminate": decontaminate.query,
    "op7_mixing": mixing.query,
    "op8_quality": quality.query,
    "op9_language": language.query,
    "op10_substring_dedup": substring_dedup.query,
    "op11_vector_codes": vector_codes.query,
    "op12_recurrent_scores": recurrent_scores.query,
    "op13_fill_middle": fill_middle.query,
}

ORACLES = {
    "op1_line_dedup": line_dedup.ORACLE_SQL,
    "op2_secret_scans": secrets.ORACLE_SQL,
    "op3_vector_search": vector_search.ORACLE_SQL,
    "op7_mixing": mixing.ORACLE_SQL,
    "op11_vector_codes": vector_codes.ORACLE_SQL,
    "op13_fill_middle": fill_middle.ORACLE_SQL,
}
