"""histdim -- Type-2 history warehouse loads as Spark DataFrame operators.

Layout:

* ``histdim.sources``   schemas, delimited-file reader/writer, versioned store
* ``histdim.functions`` column expressions: cleaning rules, change predicates
* ``histdim.operators`` DataFrame operators: dedupe/windows, joins, Type-2
  merge and dimension load, surrogate keys, star schema, audit/checks
* ``histdim.plans``     the three load pipelines and the registered queries
* ``histdim.streaming`` (nothing: the original load has no streaming)
"""

from histdim.functions.clean import (decode_aliases, decode_codes, normalize_country,  # noqa: F401
                                     null_default, null_future_dates, parse_mixed_date,
                                     parse_packed_date, reconcile, remove_chars, repair_amounts,
                                     split_compound_key, strip_prefix, trim_columns)
from histdim.functions.compare import changed, differs  # noqa: F401
from histdim.operators.audit import dq_checks, dq_fact_keys, load_audit  # noqa: F401
from histdim.operators.dedupe import (current_rows, derive_end_date, exact_dedupe,  # noqa: F401
                                      flag_latest, flag_open, latest_per_key, open_rows,
                                      require_key)
from histdim.operators.history import (detect_changes, expire_changed,  # noqa: F401
                                       insert_new_version, insert_unmatched, scd2_dim_load,
                                       scd2_merge, with_load_defaults)
from histdim.operators.joins import (append_new_exact, append_new_keyed, lookup,  # noqa: F401
                                     new_keys_only)
from histdim.operators.keys import assign_surrogate_keys  # noqa: F401
from histdim.operators.star import (conform_customers, enrich_products, load_fact,  # noqa: F401
                                    load_sales_stage)
