"""Queries of this subpackage: name → callable (spark, sf_dir) → DataFrame, and DuckDB SQL where it can express one."""

from __future__ import annotations

from tabsmith.llm.centroids import OP13_SQL, op13_vptree_centroids
from tabsmith.llm.decontaminate import OP11_SQL, op11_prefix_decontamination
from tabsmith.llm.exact_dedup import OP7_SQL, op7_bloom_exact_dedup
from tabsmith.llm.fim import OP12_SQL, op12_fim_piece_table
from tabsmith.llm.langid import op1_language_id_ecoc
from tabsmith.llm.licenses import op9_license_scan
from tabsmith.llm.mixing import OP4_SQL, op4_mix_sainte_lague
from tabsmith.llm.pieces import op5_sentencepiece_viterbi
from tabsmith.llm.simhash import op3_simhash_near_dedup
from tabsmith.llm.topk import OP8_SQL, op8_topk_uniform_threshold
from tabsmith.llm.toxicity import op10_toxicity_counterfactual
from tabsmith.llm.warc import OP6_SQL, op6_warc_round_trip
from tabsmith.llm.wavelet import op2_wavelet_token_shards

QUERIES = {
    "op1_language_id_ecoc": op1_language_id_ecoc,
    "op2_wavelet_token_shards": op2_wavelet_token_shards,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_mix_sainte_lague": op4_mix_sainte_lague,
    "op5_sentencepiece_viterbi": op5_sentencepiece_viterbi,
    "op6_warc_round_trip": op6_warc_round_trip,
    "op7_bloom_exact_dedup": op7_bloom_exact_dedup,
    "op8_topk_uniform_threshold": op8_topk_uniform_threshold,
    "op9_license_scan": op9_license_scan,
    "op10_toxicity_counterfactual": op10_toxicity_counterfactual,
    "op11_prefix_decontamination": op11_prefix_decontamination,
    "op12_fim_piece_table": op12_fim_piece_table,
    "op13_vptree_centroids": op13_vptree_centroids,
}

ORACLES = {
    "op4_mix_sainte_lague": OP4_SQL,
    "op6_warc_round_trip": OP6_SQL,
    "op7_bloom_exact_dedup": OP7_SQL,
    "op8_topk_uniform_threshold": OP8_SQL,
    "op11_prefix_decontamination": OP11_SQL,
    "op12_fim_piece_table": OP12_SQL,
    "op13_vptree_centroids": OP13_SQL,
}
