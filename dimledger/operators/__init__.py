from dimledger.operators.relational import *  # noqa: F401,F403
from dimledger.operators.scan import *  # noqa: F401,F403
from dimledger.operators.scd2 import *  # noqa: F401,F403
from dimledger.operators.watermark import *  # noqa: F401,F403
