from ledgerspark.functions.rules import (DECOMMISSIONED, EVAL_LABELS, FINDINGS, LABELS, ladder,
                                         exact_avg, money_sum,
                                         round_decimal, safe_div)
from ledgerspark.functions.stats import average_rank, hashed_normal, rank_auc
from ledgerspark.functions.text import dollars

__all__ = ["DECOMMISSIONED", "EVAL_LABELS", "FINDINGS", "LABELS", "average_rank", "dollars",
           "exact_avg", "hashed_normal", "round_decimal", "ladder", "money_sum", "rank_auc", "safe_div"]
