"""The queries of this subpackage by name, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from remitlens.llm import automata, decontamination, htmltext, lengths, manifest, mixing, periodic, quality, repeats, sharding, simhash, urlfilter, warc
from remitlens.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_vector_packing": sharding.op1,
    "op2_deep_shallow_repeats": repeats.op2,
    "op3_pivotal_mix": mixing.op3,
    "op4_line_frequency": quality.op4,
    "op5_temporal_url_lists": urlfilter.op5,
    "op6_length_histogram": lengths.op6,
    "op7_vp_simhash": simhash.op7,
    "op8_template_leaks": decontamination.op8,
    "op9_dom_marginals": htmltext.op9,
    "op10_warc_archive": warc.op10,
    "op11_level_manifest": manifest.op11,
    "op12_pattern_runs": periodic.op12,
    "op13_shard_automata": automata.op13,
}
