"""Print the formatted physical plan of registered queries.

Usage: python tools/explain.py <query> [<query> ...] [--sf /root/testdata/sf0.01]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("queries", nargs="+")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    args = ap.parse_args(argv)

    from bellwether.plans.queries import registry
    from bellwether.session import get_session

    spark = get_session("local[8]", shuffle_partitions=8)
    reg = registry()
    for name in args.queries:
        print(f"===== {name} =====")
        reg[name](spark, args.sf).explain("formatted")


if __name__ == "__main__":
    main(sys.argv[1:])
