from strata.operators.dedupe import keep_latest, insert_ignore, union_keys, new_keys  # noqa: F401
from strata.operators.merge import merge_upsert, UpsertRule  # noqa: F401
from strata.operators.quality import (  # noqa: F401
    null_profile, duplicate_stats, dq_report, validate_records, split_valid, check_pk,
    fk_split, counts_consistent, constraint_violations,
)
