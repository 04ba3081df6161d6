"""Queries of this subpackage and the SQL they are checked with."""

from __future__ import annotations

from martline.llm import ball_tree, bpe, collocations, harmonic, html_layout, license_scan, line_quality, preference, simhash_golay, substring_dedup, toxicity, warc, word_runs

QUERIES = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_simhash_near_dedup": simhash_golay.op2_simhash_near_dedup,
    "op3_ball_tree_top_k": ball_tree.op3_ball_tree_top_k,
    "op4_preference_format": preference.op4_preference_format,
    "op5_warc_index_merge": warc.op5_warc_index_merge,
    "op6_harmonic_packing": harmonic.op6_harmonic_packing,
    "op7_line_frequency_rules": line_quality.op7_line_frequency_rules,
    "op8_bpe_round_trip": bpe.op8_bpe_round_trip,
    "op9_html_layout_text": html_layout.op9_html_layout_text,
    "op10_toxicity_chain": toxicity.op10_toxicity_chain,
    "op11_license_scan": license_scan.op11_license_scan,
    "op12_periodic_runs": word_runs.op12_periodic_runs,
    "op13_phrase_collocations": collocations.op13_phrase_collocations,
}

SQL = {
    "op13_phrase_collocations": collocations.SQL,
    "op4_preference_format": preference.SQL,
    "op5_warc_index_merge": warc.SQL,
    "op3_ball_tree_top_k": ball_tree.SQL,
    "op1_substring_dedup": substring_dedup.SQL,
}
