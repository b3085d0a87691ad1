"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from . import chat, forest, langid, linededup, mixing, packing, periods, pivots, quality, repair, simhash, urls, warc

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_warc": warc.op2_warc,
    "op3_packing": packing.op3_packing,
    "op4_urls": urls.op4_urls,
    "op5_simhash": simhash.op5_simhash,
    "op6_chat": chat.op6_chat,
    "op7_line_dedup": linededup.op7_line_dedup,
    "op8_forest": forest.op8_forest,
    "op9_language_id": langid.op9_language_id,
    "op10_pivots": pivots.op10_pivots,
    "op11_repair": repair.op11_repair,
    "op12_periods": periods.op12_periods,
    "op13_quality": quality.op13_quality,
}

ORACLE_SQL = {
    "op2_warc": warc.OP2_SQL,
    "op6_chat": chat.OP6_SQL,
    "op7_line_dedup": linededup.OP7_SQL,
    "op11_repair": repair.OP11_SQL,
    "op12_periods": periods.OP12_SQL,
}
