"""The registered queries of this subpackage and their SQL."""

from clickpipe.llm import divergence_trees, itq_dedup, topk_search
from clickpipe.llm.bag_minhash import op6_bag_minhash
from clickpipe.llm.byte_bpe import op5_byte_bpe
from clickpipe.llm.license_scan import op3_license_scan
from clickpipe.llm.line_dedup import op4_line_dedup
from clickpipe.llm.main_text import op7_main_text
from clickpipe.llm.pii_bootstrap import op13_pii_bootstrap
from clickpipe.llm.quality_qda import op10_quality_qda
from clickpipe.llm.source_mix import op8_source_mix
from clickpipe.llm.suffix_dedup import op9_suffix_dedup
from clickpipe.llm.token_alignment import op12_token_alignment

QUERIES = {
    "op1_topk_search": topk_search.op1_topk_search,
    "op2_itq_dedup": itq_dedup.op2_itq_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_line_dedup": op4_line_dedup,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_bag_minhash": op6_bag_minhash,
    "op7_main_text": op7_main_text,
    "op8_source_mix": op8_source_mix,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_quality_qda": op10_quality_qda,
    "op11_source_divergence": divergence_trees.op11_source_divergence,
    "op12_token_alignment": op12_token_alignment,
    "op13_pii_bootstrap": op13_pii_bootstrap,
}

ORACLE_SQL = {
    "op1_topk_search": topk_search.ORACLE_SQL,
    "op2_itq_dedup": itq_dedup.ORACLE_SQL,
    "op11_source_divergence": divergence_trees.ORACLE_SQL,
}
