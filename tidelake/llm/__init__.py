"""Training-data operators: filters, packing, fingerprints, scans, mixing and search.

Nothing else in the library imports this subpackage.  ``QUERIES`` maps the
registered query names to ``(spark, sf_dir) -> DataFrame``; ``ORACLES`` holds
DuckDB SQL for those that SQL can express.
"""

from . import licenses, minhash, mixing, packing, secrets, simhash, substring, topk, toxicity, url_filter

QUERIES = {
    "op1_url_filter": url_filter.op1_url_filter,
    "op2_pack": packing.op2_pack,
    "op3_fingerprints": minhash.op3_fingerprints,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_substrings": substring.op5_substrings,
    "op6_simhash": simhash.op6_simhash,
    "op7_secrets": secrets.op7_secrets,
    "op8_licenses": licenses.op8_licenses,
    "op9_mix": mixing.op9_mix,
    "op10_topk": topk.op10_topk,
}

ORACLES = {
    "op1_url_filter": url_filter.ORACLE_SQL,
    "op5_substrings": substring.ORACLE_SQL,
    "op9_mix": mixing.ORACLE_SQL,
    "op10_topk": topk.ORACLE_SQL,
}
