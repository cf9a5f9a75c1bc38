"""The registered queries of this subpackage."""

from __future__ import annotations

from stationcast.llm import (decontamination, embeddings, lines, lm, merkle, minhash, mixing, oracles,
                             quality, runs, sharding, substrings, toxicity, urls)
from stationcast.llm.store import table


def _on(function, *names):
    return lambda spark, sf_dir: function(spark, *[table(spark, sf_dir, n) for n in names])


QUERIES = {
    "op1_subword_lattice": _on(lm.op1_subword_lattice, "documents"),
    "op2_line_field": _on(quality.op2_line_field, "documents", "labels"),
    "op3_pareto_mix": _on(mixing.op3_pareto_mix, "documents"),
    "op4_noisy_channel": _on(toxicity.op4_noisy_channel, "documents", "labels"),
    "op5_url_rules": _on(urls.op5_url_rules, "pages"),
    "op6_recompression": _on(substrings.op6_recompression, "documents"),
    "op7_iterative_quantisation": _on(embeddings.op7_iterative_quantisation, "embeddings"),
    "op8_prob_minhash": _on(minhash.op8_prob_minhash, "documents"),
    "op9_positional_index": _on(decontamination.op9_positional_index, "documents", "benchmark"),
    "op10_byte_shards": _on(sharding.op10_byte_shards, "documents"),
    "op11_periodic_runs": _on(runs.op11_periodic_runs, "documents"),
    "op12_merkle_manifest": _on(merkle.op12_merkle_manifest, "documents"),
    "op13_line_bitmaps": _on(lines.op13_line_bitmaps, "documents"),
}
ORACLES = oracles.ORACLES
