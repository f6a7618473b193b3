"""The queries of this folder, opN_<name>, and their SQL."""

from . import conversations, decontaminate, html_tree, jaccard_join, licenses, line_frequency, maxent_lm, mixing, secrets_scan, spelling, toxicity, urls, warc

QUERIES = {
    "op1_url_filter": urls.op1_url_filter,
    "op2_html_tree": html_tree.op2_html_tree,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_warc": warc.op4_warc,
    "op5_maxent_lm": maxent_lm.op5_maxent_lm,
    "op6_license_scan": licenses.op6_license_scan,
    "op7_line_frequency": line_frequency.op7_line_frequency,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_mix_sources": mixing.op9_mix_sources,
    "op10_jaccard_join": jaccard_join.op10_jaccard_join,
    "op11_spelling": spelling.op11_spelling,
    "op12_conversations": conversations.op12_conversations,
    "op13_secrets": secrets_scan.op13_secrets,
}
ORACLES = {
    "op1_url_filter": urls.ORACLE,
    "op4_warc": warc.ORACLE,
    "op7_line_frequency": line_frequency.ORACLE,
    "op8_decontaminate": decontaminate.ORACLE,
    "op11_spelling": spelling.ORACLE,
    "op12_conversations": conversations.ORACLE,
    "op13_secrets": secrets_scan.ORACLE,
}
