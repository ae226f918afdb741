"""The registered queries of this subpackage and their oracle SQL."""

from granary.llm.byte_bpe import op12_byte_bpe
from granary.llm.chat_format import op4_preference_format
from granary.llm.decontaminate import op5_decontaminate
from granary.llm.exact_dedup import OP7_SQL, op7_exact_dedup
from granary.llm.jaccard_join import op8_jaccard_join
from granary.llm.language_model import op9_deleted_interpolation
from granary.llm.packing import op6_best_fit_packing
from granary.llm.quality import op3_quality_rules
from granary.llm.sale_assembly import op11_sale_assembly
from granary.llm.suffix_dedup import op2_suffix_dedup
from granary.llm.url_filter import OP10_SQL, op10_url_filter
from granary.llm.warc import op1_warc
from granary.llm.whitening import op13_whitening

QUERIES = {
    "op1_warc": op1_warc,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_preference_format": op4_preference_format,
    "op5_decontaminate": op5_decontaminate,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_deleted_interpolation": op9_deleted_interpolation,
    "op10_url_filter": op10_url_filter,
    "op11_sale_assembly": op11_sale_assembly,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_whitening": op13_whitening,
}
ORACLES = {
    "op7_exact_dedup": OP7_SQL,
    "op10_url_filter": OP10_SQL,
}
