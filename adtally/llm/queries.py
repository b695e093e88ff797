"""The queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from adtally.llm import align, bpe, chat, exact, jaccard, licences, mixing, quality, repair, simhash, topk, toxicity, urls

QUERIES = {
    "op1_licence_scan": licences.op1,
    "op2_exact_topk": topk.op2,
    "op3_bpe": bpe.op3,
    "op4_quality": quality.op4,
    "op5_simhash": simhash.op5,
    "op6_mixing": mixing.op6,
    "op7_url_filter": urls.op7,
    "op8_exact_dedup": exact.op8,
    "op9_toxicity": toxicity.op9,
    "op10_chat_format": chat.op10,
    "op11_jaccard_join": jaccard.op11,
    "op12_token_alignment": align.op12,
    "op13_conversation_repair": repair.op13,
}
SQL = {
    "op2_exact_topk": topk.OP2_SQL,
    "op7_url_filter": urls.OP7_SQL,
    "op8_exact_dedup": exact.OP8_SQL,
    "op10_chat_format": chat.OP10_SQL,
    "op13_conversation_repair": repair.OP13_SQL,
}
