"""Operators: every function maps DataFrame(s) to a DataFrame."""

from shroud.operators.generalize import (  # noqa: F401
    bin_numeric, generalize_numeric, roll_up_rare, tail_candidates, trim_tails,
)
from shroud.operators.kanon import (  # noqa: F401
    flag_k, iter_k_check, k_anonymity, k_anonymity_path, l_diversity,
)
from shroud.operators.pseudonym import pseudonym_table, pseudonymize, salted_hash  # noqa: F401
from shroud.operators.transforms import (  # noqa: F401
    EDUCATION_MAP, blank_missing, censor, censor_to_parent, date_part_only, drop_roles,
    incomplete_counts, incomplete_flag, lookup_name, lookup_parent, mark_nulls, mark_value,
    recode, recode_education, set_constant, suppress_below_k, suppress_unique_users,
    to_number, with_kkey,
)
from shroud.operators.stats import (  # noqa: F401
    bin_average, entropy, gender_shares, grain_size, mean_age, perplexity_change,
    pick_next_to_generalize, table_entropy, total_records, utility_diff, utility_matrix,
    value_counts, value_shares,
)
from shroud.operators.users import (  # noqa: F401
    apply_drops, best_drop, combo_counts, combo_status, course_combos, course_list,
    flag_unique_users, score_drops, unique_user_share, user_combos, user_k_anonymity,
    with_course_combo,
)
