"""Named queries over the driver tables, and their SQL."""

from fleetboard.plans import maintained as maintained
from fleetboard.plans import queries as queries
