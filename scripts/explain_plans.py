"""Print the physical plans of the main operators (formatted explain).

Usage: python scripts/explain_plans.py [sf_dir] > PLANS.txt
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from kinfold import registry  # noqa: E402
from kinfold.operators import restore as rs  # noqa: E402
from kinfold.operators.records import label_records  # noqa: E402
from kinfold.session import local_session  # noqa: E402
from kinfold.sources import star  # noqa: E402


def show(title: str, df) -> None:
    print(f"\n## {title}\n")
    print(df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    g = star.star_graph(spark, sf)
    show("cohort: filter + grants (predicate pushdown)", registry.flagship_cohort(spark, sf))
    w = registry.flagship_walk(spark, sf)
    show("down visit: lineitem edges semi-joined with the orders frontier",
         g.semi_edges("lineitem_orders", "dst", w.frontier("orders")))
    show("records: lineitem nodes joined to their written state", label_records(w, "lineitem"))
    recs = registry.flagship_records(spark, sf)
    show("restore: node rows (map-only)", rs.restore_records(recs, g.dictionary).nodes)
    show("type topology (recursive CTE)", registry.q_type_topology(spark, sf))


if __name__ == "__main__":
    main()
