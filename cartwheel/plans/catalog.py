"""All registered driver keys (importing the modules registers them)."""

from cartwheel.plans import registry  # noqa: F401
from cartwheel.plans import registry_io  # noqa: F401
from cartwheel.plans import registry_vec  # noqa: F401
from cartwheel.plans import registry_flows  # noqa: F401

SPARK = registry.SPARK
ORACLE = registry.ORACLE
