"""Print the formatted physical plans of some queries (scan pushdown,
exchanges, broadcasts, codegen) as markdown.

usage: python scripts/show_plans.py [sf_dir] name ...
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hearth.plans.catalog import QUERIES  # noqa: E402
from hearth.session import get_session  # noqa: E402

KEEP = re.compile(r"^(\s*[+:\- ]*(\*\(\d+\) )?[A-Z][A-Za-z]+.*\(\d+\)\s*$)|ReadSchema|PushedFilters|PartitionFilters"
                  r"|^\(\d+\) (Exchange|BroadcastExchange|BroadcastHashJoin|SortMergeJoin|Window|HashAggregate)")


def main():
    sf = sys.argv[1]
    spark = get_session("local[8]")
    print(f"# Physical plans at `{os.path.basename(sf)}`\n")
    print("Generated by `scripts/show_plans.py`; tree and scan details of `explain('formatted')`.\n")
    for name in sys.argv[2:]:
        buf = io.StringIO()
        with redirect_stdout(buf):
            QUERIES[name](spark, sf).explain("formatted")
        lines = [ln for ln in buf.getvalue().splitlines() if KEEP.search(ln)]
        lines = [re.sub(r"file:/\S+", "<path>", ln) for ln in lines]
        print(f"## {name}\n\n```\n" + "\n".join(lines[:80]) + "\n```\n")


if __name__ == "__main__":
    main()
