"""``python -m tickwise ...`` runs the job CLI (see ``tickwise.plans.jobs``)."""

import sys

from tickwise.plans.jobs import main

sys.exit(main())
