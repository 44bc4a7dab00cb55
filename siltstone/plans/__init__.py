from siltstone.plans.checks import check_state
from siltstone.plans.corporate import run_corporate
from siltstone.plans.star import run_star
from siltstone.plans.store import WarehouseStore
from siltstone.plans.vault import run_vault

__all__ = ["WarehouseStore", "check_state", "run_corporate", "run_star", "run_vault"]
