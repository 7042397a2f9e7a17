"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from tablewarden.llm.chat_formatting import OP8_SQL, op8_perspective_rotation
from tablewarden.llm.decontamination import OP2_SQL, op2_template_decontamination
from tablewarden.llm.exact_dedup import OP12_SQL, op12_exact_dedup
from tablewarden.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from tablewarden.llm.language_id import op3_language_codes
from tablewarden.llm.lexical_search import OP13_SQL, op13_ranked_search
from tablewarden.llm.pii import op1_pii_boosting
from tablewarden.llm.quality_rules import op4_repetition_coverage
from tablewarden.llm.sentencepiece_codec import op5_sentencepiece
from tablewarden.llm.sharding import OP9_SQL, op9_jump_hash
from tablewarden.llm.simhash import op6_simhash
from tablewarden.llm.substring_dedup import op10_substring_dedup
from tablewarden.llm.token_counts import op7_token_counts

QUERIES = {
    f.__name__: f
    for f in (
        op1_pii_boosting,
        op2_template_decontamination,
        op3_language_codes,
        op4_repetition_coverage,
        op5_sentencepiece,
        op6_simhash,
        op7_token_counts,
        op8_perspective_rotation,
        op9_jump_hash,
        op10_substring_dedup,
        op11_hard_negatives,
        op12_exact_dedup,
        op13_ranked_search,
    )
}
ORACLES = {
    "op2_template_decontamination": OP2_SQL,
    "op8_perspective_rotation": OP8_SQL,
    "op9_jump_hash": OP9_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_exact_dedup": OP12_SQL,
    "op13_ranked_search": OP13_SQL,
}
