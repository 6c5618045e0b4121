"""The sub-package's registered queries and their DuckDB SQL."""

from __future__ import annotations

from . import chat, kneser_ney, language_id, media, packing, pii, quality, sentencepiece_bpe, simhash, token_store

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_token_store": token_store.op2_token_store,
    "op3_sentencepiece": sentencepiece_bpe.op3_sentencepiece,
    "op4_lm_scoring": kneser_ney.op4_lm_scoring,
    "op5_quality_rules": quality.op5_quality_rules,
    "op6_simhash": simhash.op6_simhash,
    "op7_packing": packing.op7_packing,
    "op8_chat_format": chat.op8_chat_format,
    "op9_media_columns": media.op9_media_columns,
    "op10_pii": pii.op10_pii,
}
ORACLE_SQL: dict[str, str] = {"op5_quality_rules": quality.SQL, "op7_packing": packing.SQL, "op8_chat_format": chat.SQL}
