"""The registered queries of this package and their SQL."""

from __future__ import annotations

from aerostar.llm import exact_dedup, hard_negatives, license_rules, line_dedup, merkle, mixing, topk
from aerostar.llm.bpe import op11_bpe
from aerostar.llm.exact_dedup import op10_exact_dedup
from aerostar.llm.hard_negatives import op13_hard_negatives
from aerostar.llm.license_rules import op3_license_rules
from aerostar.llm.line_dedup import op5_line_dedup
from aerostar.llm.merkle import op12_merkle_manifest
from aerostar.llm.mixing import op4_mix_sources
from aerostar.llm.ngram_join import op9_ngram_join
from aerostar.llm.packing import op1_pack_batches
from aerostar.llm.passages import op8_substring_dedup
from aerostar.llm.topk import op7_topk_search
from aerostar.llm.toxicity import op2_toxicity
from aerostar.llm.url_filter import op6_url_filter

_QUERIES = (op1_pack_batches, op2_toxicity, op3_license_rules, op4_mix_sources, op5_line_dedup,
            op6_url_filter, op7_topk_search, op8_substring_dedup, op9_ngram_join, op10_exact_dedup, op11_bpe,
            op12_merkle_manifest, op13_hard_negatives)


def queries() -> dict:
    return {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    """None for packing, learning (2, 6), chaining, the n-gram join and BPE: see tests/llm."""
    return {"op3_license_rules": license_rules.SQL, "op4_mix_sources": mixing.SQL,
            "op5_line_dedup": line_dedup.SQL, "op7_topk_search": topk.SQL,
            "op10_exact_dedup": exact_dedup.SQL, "op12_merkle_manifest": merkle.SQL,
            "op13_hard_negatives": hard_negatives.SQL}
