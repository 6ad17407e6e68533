"""Write the final (adaptive) physical plan of every registered question.

    python scripts/explain_all.py [sf_dir] [out_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    out = argv[2] if len(argv) > 2 else "docs/plans"
    from beatline.plans.catalog import QUERIES
    from beatline.session import local_session
    spark = local_session(8, 16)
    os.makedirs(out, exist_ok=True)
    for k, fn in QUERIES.items():
        if argv[3:] and k not in argv[3:]:
            continue
        df = fn(spark, sf_dir)
        df.collect()  # run it, so the adaptive plan is final
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain(mode="formatted")
        plan = buf.getvalue()
        with open(os.path.join(out, f"{k}.txt"), "w") as f:
            f.write(f"# {k} at {sf_dir}, local[8], after execution\n\n{plan}\n")
        print(k)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
