"""Print an output's schema and first rows: python -m strata.show <path> [n] [format]."""

from __future__ import annotations

import sys

from strata.session import build_session
from strata.sources.lake import preview, read_output


def main(argv: list[str]) -> int:
    if not argv:
        print(__doc__)
        return 2
    path = argv[0]
    n = int(argv[1]) if len(argv) > 1 else 20
    fmt = argv[2] if len(argv) > 2 else "parquet"
    spark = build_session(app_name="strata-show")
    schema, rows = preview(read_output(spark, path, fmt), n)
    print(schema)
    rows.show(n, truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
