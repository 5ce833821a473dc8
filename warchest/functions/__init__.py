from .codes import (CODE_TABLES, decode, fold_category, is_candidate_id, is_committee_id,
                    is_known_category, known_category)
from .dates import calendar_date, iso_date, transaction_month, transaction_year
from .matching import (confidence_band, formal_name, name_key, name_match_score, office_code,
                       parse_name, party_adjusted, party_code, term_cycles, term_in_range)
from .names import capitalize_name

__all__ = [
    "CODE_TABLES", "calendar_date", "capitalize_name", "confidence_band", "decode",
    "fold_category", "formal_name", "is_candidate_id", "is_committee_id", "is_known_category",
    "iso_date", "known_category", "name_key", "name_match_score", "office_code", "parse_name", "party_adjusted",
    "party_code", "term_cycles", "term_in_range", "transaction_month", "transaction_year",
]
