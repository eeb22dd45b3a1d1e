"""The registered queries of this subpackage and their SQL."""

from . import ann, decontaminate, licenses, mixing, near_dup, phrases, pii, repeats, token_output, toxicity, url_filter, variants, warc

QUERIES = {
    "op1_ann": ann.op1_ann,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_near_dup": near_dup.op3_near_dup,
    "op4_licenses": licenses.op4_licenses,
    "op5_url_filter": url_filter.op5_url_filter,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_token_output": token_output.op7_token_output,
    "op8_pii": pii.op8_pii,
    "op9_warc": warc.op9_warc,
    "op10_mixing": mixing.op10_mixing,
    "op11_collocations": phrases.op11_collocations,
    "op12_spelling_variants": variants.op12_spelling_variants,
    "op13_repeats": repeats.op13_repeats,
}
ORACLE_SQL = {"op3_near_dup": near_dup.SQL, "op5_url_filter": url_filter.SQL, "op9_warc": warc.SQL, "op11_collocations": phrases.SQL}
