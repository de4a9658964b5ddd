"""The queries of this subpackage, by name, and the SQL of those SQL can express."""

from __future__ import annotations

from .bpe import op2_byte_bpe
from .exact_dedup import OP11_SQL, op11_exact_dedup
from .hard_negatives import OP13_SQL, op13_hard_negatives
from .mixing import OP3_SQL, op3_curriculum_mix
from .multiset_hash import op4_multiset_hash
from .quality import OP1_SQL, op1_host_rules
from .simhash import op5_simhash_ball
from .suffix_dedup import op6_suffix_dedup
from .token_files import op7_token_files
from .toxicity import op10_toxicity
from .url_lists import OP8_SQL, op8_url_lists
from .vector_codes import OP12_SQL, op12_vector_codes
from .warc import OP9_SQL, op9_warc

REGISTRY = {
    "op1_host_rules": op1_host_rules,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_curriculum_mix": op3_curriculum_mix,
    "op4_multiset_hash": op4_multiset_hash,
    "op5_simhash_ball": op5_simhash_ball,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_token_files": op7_token_files,
    "op8_url_lists": op8_url_lists,
    "op9_warc": op9_warc,
    "op10_toxicity": op10_toxicity,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_vector_codes": op12_vector_codes,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLE: dict[str, str] = {
    "op1_host_rules": OP1_SQL,
    "op3_curriculum_mix": OP3_SQL,
    "op8_url_lists": OP8_SQL,
    "op9_warc": OP9_SQL,
    "op11_exact_dedup": OP11_SQL,
    "op12_vector_codes": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
