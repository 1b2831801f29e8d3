"""Queries and SQL of the corpus operators."""

from __future__ import annotations

from weftline.llm import language, licenses, media, mixing, mixture, neighbours, packing, secrets, simhash, tokencount

QUERIES = {"op1_mixture": mixture.op1_mixture, "op7_secrets": secrets.op7_secrets, "op2_neighbours": neighbours.op2_neighbours, "op8_language": language.op8_language, "op4_tokens": tokencount.op4_tokens, "op5_simhash": simhash.op5_simhash, "op3_media": media.op3_media, "op6_mix": mixing.op6_mix, "op9_pack": packing.op9_pack, "op10_licenses": licenses.op10_licenses}
ORACLES = {"op6_mix": mixing.ORACLE_SQL}
