"""The registered queries of this subpackage, and their SQL where SQL can state them."""

from . import op1_mixing, op10_lm, op11_merkle, op12_periods, op13_exact, op2_decontaminate, op3_substring, op4_classifier, op5_jaccard, op6_language, op7_quality, op8_html, op9_licenses

QUERIES = {
    "op1_mixing": op1_mixing.op1_mixing,
    "op2_decontaminate": op2_decontaminate.op2_decontaminate,
    "op3_substring": op3_substring.op3_substring,
    "op4_classifier": op4_classifier.op4_classifier,
    "op5_jaccard": op5_jaccard.op5_jaccard,
    "op6_language": op6_language.op6_language,
    "op7_quality": op7_quality.op7_quality,
    "op8_html": op8_html.op8_html,
    "op9_licenses": op9_licenses.op9_licenses,
    "op10_lm": op10_lm.op10_lm,
    "op11_merkle": op11_merkle.op11_merkle,
    "op12_periods": op12_periods.op12_periods,
    "op13_exact": op13_exact.op13_exact,
}
SQL = {
    "op1_mixing": op1_mixing.SQL,
    "op5_jaccard": op5_jaccard.SQL,
    "op7_quality": op7_quality.SQL,
    "op11_merkle": op11_merkle.SQL,
    "op12_periods": op12_periods.SQL,
    "op13_exact": op13_exact.SQL,
}
