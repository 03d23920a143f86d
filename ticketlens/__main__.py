"""``python -m ticketlens ...``: the whole analysis as one job (see plans/job.py)."""

import sys

from ticketlens.plans.job import main

sys.exit(main())
