"""``python -m strata ...`` runs the job command line (see ``jobs.run_medallion``)."""

import sys

from jobs.run_medallion import main

sys.exit(main())
