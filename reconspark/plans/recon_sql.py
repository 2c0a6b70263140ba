"""Oracle SQL of the reconciliation queries."""

from __future__ import annotations

from reconspark.plans.chain_sql import STEPS, oracle

ORACLES = {name: oracle(name) for name in STEPS if name not in ("bill", "item_coded", "period_bill", "period_order", "month_close")}
