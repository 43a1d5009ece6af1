"""SQL answers for the registered queries, and the comparison."""

from checks.oracles import BATCH_ORACLES
from checks.oracles_feeds import FEED_ORACLES

ORACLES = BATCH_ORACLES | FEED_ORACLES
