"""The queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from . import audioprint, decontaminate, dialogue, mixing, repeats, sharding, simhash, spelling, tokens, toolcalls, toxicity, warc, wrappers

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_tool_calls": toolcalls.op2_tool_calls,
    "op3_mixing": mixing.op3_mixing,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_audio_align": audioprint.op5_audio_align,
    "op6_simhash": simhash.op6_simhash,
    "op7_sharding": sharding.op7_sharding,
    "op8_main_text": wrappers.op8_main_text,
    "op9_repeats": repeats.op9_repeats,
    "op10_tokens": tokens.op10_tokens,
    "op11_spelling": spelling.op11_spelling,
    "op12_warc": warc.op12_warc,
    "op13_repair": dialogue.op13_repair,
}
ORACLES = {
    "op2_tool_calls": toolcalls.ORACLE,
    "op3_mixing": mixing.ORACLE,
    "op4_decontaminate": decontaminate.ORACLE,
    "op6_simhash": simhash.ORACLE,
    "op7_sharding": sharding.ORACLE,
    "op8_main_text": wrappers.ORACLE,
    "op9_repeats": repeats.ORACLE,
    "op11_spelling": spelling.ORACLE,
    "op12_warc": warc.ORACLE,
    "op13_repair": dialogue.ORACLE,
}
