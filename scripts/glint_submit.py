"""spark-submit launcher: `spark-submit --py-files glint.zip scripts/glint_submit.py etl ...`."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from glint.__main__ import main  # noqa: E402

if __name__ == "__main__":
    main(sys.argv[1:])
