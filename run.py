"""spark-submit entry point: ``spark-submit --py-files fareflow.zip run.py <command> ...``.

Same commands as ``python -m fareflow`` (run, snapshot, test, freshness); the
master, executors and ``spark.checkpoint.dir`` come from spark-submit.
"""

import sys

from fareflow.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
