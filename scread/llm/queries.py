"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from . import ann_tree, automaton_dedup, bwt_dedup, byte_bpe, chat, hard_negatives, jaccard_join, line_rules, mixing, packing, quality, toxicity, turn_repair


def queries() -> dict:
    return {
        "op1_mixing": mixing.op1_mixing,
        "op2_quality_rules": line_rules.op2_quality_rules,
        "op3_ann": ann_tree.op3_ann,
        "op4_toxicity": toxicity.op4_toxicity,
        "op5_suffix_dedup": bwt_dedup.op5_suffix_dedup,
        "op6_quality": quality.op6_quality,
        "op7_jaccard_join": jaccard_join.op7_jaccard_join,
        "op8_packing": packing.op8_packing,
        "op9_substring_dedup": automaton_dedup.op9_substring_dedup,
        "op10_chat_format": chat.op10_chat_format,
        "op11_byte_bpe": byte_bpe.op11_byte_bpe,
        "op12_hard_negatives": hard_negatives.op12_hard_negatives,
        "op13_turn_repair": turn_repair.op13_turn_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_quality_rules": line_rules.OP2_SQL,
        "op5_suffix_dedup": bwt_dedup.OP5_SQL,
        "op7_jaccard_join": jaccard_join.OP7_SQL,
        "op9_substring_dedup": automaton_dedup.OP9_SQL,
        "op10_chat_format": chat.OP10_SQL,
        "op12_hard_negatives": hard_negatives.OP12_SQL,
    }
