"""The operators' registered queries and, where SQL can express one, its DuckDB twin."""
from __future__ import annotations

from .bpe_prefix import op5_bpe_prefix
from .cross_entropy import op9_cross_entropy
from .decontaminate import ORACLE_SQL as _OP12_SQL
from .decontaminate import op12_suffix_arrays
from .exact_dedup import ORACLE_SQL as _OP6_SQL
from .exact_dedup import op6_exact_dedup
from .feast_whitening import op13_feast_whitening
from .packing import op8_best_fit_packing
from .pii_surrogates import op1_pii_surrogates
from .rabitq import op4_rabitq
from .ranked_search import ORACLE_SQL as _OP11_SQL
from .ranked_search import op11_ranked_search
from .simhash_dedup import op7_simhash_pigeonring
from .token_records import op2_token_records
from .toxicity import op3_toxicity_kernel
from .warc import ORACLE_SQL as _OP10_SQL
from .warc import op10_warc_salvage

QUERIES = {f.__name__: f for f in (
    op1_pii_surrogates, op2_token_records, op3_toxicity_kernel, op4_rabitq, op5_bpe_prefix, op6_exact_dedup,
    op7_simhash_pigeonring, op8_best_fit_packing, op9_cross_entropy, op10_warc_salvage,
    op11_ranked_search, op12_suffix_arrays, op13_feast_whitening)}
ORACLE_SQL = {"op6_exact_dedup": _OP6_SQL, "op10_warc_salvage": _OP10_SQL, "op11_ranked_search": _OP11_SQL, "op12_suffix_arrays": _OP12_SQL}
