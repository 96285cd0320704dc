"""Queries and SQL of this package."""

from __future__ import annotations

from voxelforge.llm import chat, exact_dedup, licenses, lines, mixing, near_dedup, packing, quality, secrets, suffixes

QUERIES = {
    "op1_licenses": licenses.op1_licenses,
    "op2_near_dedup": near_dedup.op2_near_dedup,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_lines": lines.op4_lines,
    "op5_suffixes": suffixes.op5_suffixes,
    "op6_mixing": mixing.op6_mixing,
    "op7_chat": chat.op7_chat,
    "op8_quality": quality.op8_quality,
    "op9_secrets": secrets.op9_secrets,
    "op10_packing": packing.op10_packing,
}
ORACLES = {
    "op3_exact_dedup": exact_dedup.OP3_SQL,
    "op4_lines": lines.OP4_SQL,
    "op7_chat": chat.OP7_SQL,
    "op9_secrets": secrets.OP9_SQL,
}
