"""``spark-submit run_job.py stream|batch settings.json``: one of the two jobs, from a checkout."""

from rollmill.jobs import main

if __name__ == "__main__":
    main()
