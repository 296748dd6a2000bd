"""Print the formatted physical plan of registered queries.

    python tools/explain.py [sf_dir] [key ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tempora.plans import catalog  # noqa: E402
from tempora.session import local_session  # noqa: E402


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/")] or list(catalog.QUERIES)
    spark = local_session(8)
    for key in keys:
        print(f"===== {key}")
        catalog.QUERIES[key](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
