from tidemark.functions.exprs import (  # noqa: F401
    js_term, ks_pvalue, pct_change, relative_change, round9, safe_div,
)
