"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from tripmart.llm import (
    bond,
    ctw,
    cuckoo,
    decontaminate,
    hnsw,
    language,
    licenses,
    line_spread,
    packing,
    runs,
    simhash,
    token_counts,
    token_files,
)

QUERIES = {
    "op1_best_fit_packing": packing.query,
    "op2_context_tree": ctw.query,
    "op3_line_spread": line_spread.query,
    "op4_language_spans": language.query,
    "op5_token_counts": token_counts.query,
    "op6_token_files": token_files.query,
    "op7_hnsw_near_dedup": hnsw.query,
    "op8_decontaminate": decontaminate.query,
    "op9_license_scan": licenses.query,
    "op10_simhash": simhash.query,
    "op11_word_runs": runs.query,
    "op12_exact_dedup": cuckoo.query,
    "op13_hard_negatives": bond.query,
}
SQL = {
    "op3_line_spread": line_spread.SQL,
    "op8_decontaminate": decontaminate.SQL,
    "op12_exact_dedup": cuckoo.SQL,
    "op13_hard_negatives": bond.SQL,
}
