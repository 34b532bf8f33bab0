"""``python -m hiremart ...``: the batch job's command line (see plans/job.py)."""

from .plans.job import main

raise SystemExit(main())
