"""Operators of a training-data pipeline over the documents table.

Nothing else in the library imports this subpackage.  QUERIES and ORACLES map the registered query names to
their functions and, where SQL can express them, to DuckDB SQL.
"""

from __future__ import annotations

from functools import wraps

from . import (
    decontaminate,
    infill,
    line_dedup,
    minhash,
    packing,
    phrases,
    pii,
    quality_classifier,
    quality_rules,
    simhash,
    token_counts,
    token_files,
    toxicity,
)
from .common import ship


def _shipped(query):
    @wraps(query)
    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {f.__name__: _shipped(f) for f in (
    token_files.op1_token_files,
    line_dedup.op2_line_dedup,
    quality_classifier.op3_quality_classifier,
    packing.op4_packing,
    token_counts.op5_token_counts,
    simhash.op6_simhash,
    toxicity.op7_toxicity,
    pii.op8_pii,
    decontaminate.op9_decontaminate,
    quality_rules.op10_quality_rules,
    phrases.op11_phrases,
    minhash.op12_minhash,
    infill.op13_fill_in_middle,
)}

ORACLES = {
    "op2_line_dedup": line_dedup.ORACLE,
    "op9_decontaminate": decontaminate.ORACLE,
    "op10_quality_rules": quality_rules.ORACLE,
    "op11_phrases": phrases.ORACLE,
    "op12_minhash": minhash.ORACLE,
    "op13_fill_in_middle": infill.ORACLE,
}
