"""The named queries of the training-data operators.

Only ranked search has a SQL twin: decoding layers, tilings, Newton steps, trained models, graphs,
unsigned hashes, window minima and cheapest edits are not SQL; ``tests/llm`` holds each against
a plain brute-force version.
"""

from tidewell.llm import (
    conversations,
    decontaminate,
    language,
    licences,
    lines,
    mixing,
    pages,
    passages,
    quality,
    ranking,
    secrets,
    simhash,
    vectors,
)

QUERIES = {
    f.__name__: f
    for f in (
        secrets.op1_secrets,
        decontaminate.op2_decontaminate,
        mixing.op3_mixing,
        quality.op4_quality,
        vectors.op5_vectors,
        language.op6_language,
        lines.op7_lines,
        simhash.op8_simhash,
        licences.op9_licences,
        passages.op10_passages,
        ranking.op11_search,
        pages.op12_pages,
        conversations.op13_conversations,
    )
}
ORACLE_SQL: dict[str, str] = {"op11_search": ranking.OP11_SQL}
