"""spark-submit entry point for the batch job.

    zip -r hiremart.zip hiremart
    spark-submit --py-files hiremart.zip run_job.py --input <jsonl paths> --output-dir <dir>
"""

from hiremart.plans.job import main

if __name__ == "__main__":
    raise SystemExit(main())
