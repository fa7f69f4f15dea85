from tidewatch.plans.asof import State, as_of, spread_nulls
from tidewatch.plans.chains import mark_chain
from tidewatch.plans.ordered import Ordered, arrange

__all__ = ["Ordered", "State", "arrange", "as_of", "mark_chain", "spread_nulls"]
