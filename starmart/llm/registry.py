"""Queries of the corpus operators and the SQL that some of them must equal."""

from __future__ import annotations

from starmart.llm import (
    contamination,
    language,
    lattice,
    licenses,
    mixing,
    multiindex,
    negatives,
    quality,
    simhash,
    structure,
    superkmers,
    toolcalls,
    toxicity,
)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_toolcalls": toolcalls.op2_toolcalls,
    "op3_licenses": licenses.op3_licenses,
    "op4_multiindex": multiindex.op4_multiindex,
    "op5_language": language.op5_language,
    "op6_superkmers": superkmers.op6_superkmers,
    "op7_simhash": simhash.op7_simhash,
    "op8_mixing": mixing.op8_mixing,
    "op9_quality": quality.op9_quality,
    "op10_contamination": contamination.op10_contamination,
    "op11_lattice": lattice.op11_lattice,
    "op12_structure": structure.op12_structure,
    "op13_negatives": negatives.op13_negatives,
}

ORACLES: dict[str, str] = {
    "op4_multiindex": multiindex.ORACLE,
    "op6_superkmers": superkmers.ORACLE,
    "op10_contamination": contamination.ORACLE,
    "op12_structure": structure.ORACLE,
    "op13_negatives": negatives.ORACLE,
}
