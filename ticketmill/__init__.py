"""Issue-tracker analytics ingest on Spark.

Landed raw JSON in, five clean relations out: projects, releases, boards,
issues and transitions.
"""

from ticketmill.params import RunParams
from ticketmill.plans.pipeline import run
from ticketmill.plans.relations import Raw, Relations, build

__all__ = ["Raw", "Relations", "RunParams", "build", "run"]
