from .checks import (ContractViolation, assert_contract, grain_report, key_violations,
                     null_violations)
from .delta import counter_delta, hot_keys
from .latest import latest_by
from .rank import competition_rank, first_n, order_by_rank, top_k
from .rollup import positive_rollup

__all__ = [
    "ContractViolation", "assert_contract", "grain_report", "key_violations", "null_violations",
    "counter_delta", "hot_keys", "latest_by", "competition_rank", "first_n", "order_by_rank",
    "top_k", "positive_rollup",
]
