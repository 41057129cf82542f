"""Write PLANS.md: the physical plans of the main operators, with notes.

    python scripts/explain_plans.py [/root/testdata/sf0.01] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from revmart.functions.dates import month_filter  # noqa: E402
from revmart.operators.conform import stamp_load_time  # noqa: E402
from revmart.plans import catalog  # noqa: E402
from revmart.plans.jobs import landing_frame  # noqa: E402
from revmart.plans.sql import PREVIEW_MONTHS_SQL, gold_sql, run_on  # noqa: E402
from revmart.schemas import BRONZE_FILE_ORDER, BRONZE_PARTITIONS, BRONZE_SCHEMA, LANDING_PARTITIONS  # noqa: E402
from revmart.session import get_session, remove_scratch, scratch_path  # noqa: E402
from revmart.sources.feed import feed_last_page  # noqa: E402
from revmart.sources.zones import layout_for_write, read_zone, write_zone  # noqa: E402

HEAD = """# Physical plans of the main operators

Written by `python scripts/explain_plans.py > PLANS.md` from
`df._jdf.queryExecution().executedPlan()` on sf0.01 (`local[8]`, 16 shuffle partitions, AQE on; expression
ids removed, long lines cut). Plans are as Spark prints them before the run.
"""

NOTES = {
    "gold mart on lineitem (flagship)": "Reads 4 columns. `count(DISTINCT)` becomes two aggregation levels: the first "
    "exchange is keyed by (month, version, id), so a (month, version) group holding a third of all rows is spread by id "
    "over every reducer; the second carries one partial row per group and map task. The month key is integer work; its "
    "text is formatted once per group.",
    "gold mart SQL on the silver zone": "The `spark.sql` form on the temp view gets the same plan; `try_cast` keeps a "
    "stray rating text NULL under ANSI mode.",
    "landing write layout": "On a written page table. One `from_xml` per page, with a schema of entries alone; the outer "
    "explode plus the not-null filter keeps the optimizer from parsing again for an inferred filter.",
    "last page test": "One `from_xml` per page with a schema of links alone: no review is built.",
    "bronze write layout": "One `ArrowEvalPython` node for both text columns (the only Python). The partial aggregate "
    "collapses copies inside each map task; the one exchange carries whole rows, hashed by all their columns; its "
    "reducers sort locally and write.",
    "silver write layout": "No exchange: a task writes the rows of its bronze splits.",
    "month filter on the bronze zone": "Partition keys prune directories (rows whose keys name no month stay in); the "
    "date range reaches the scan.",
    "month samples on the silver zone": "The report's statement: both branches prune directories and keep 3 rows per "
    "task (`TakeOrderedAndProject`).",
    "global sort (sort_multi_key)": "A range exchange on the keys and a hash of the row, so a hot key is cut.",
}


def main(sf: str) -> None:
    spark = get_session(master="local[8]", spark__sql__shuffle__partitions="16", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("OFF")
    bronze, pages = scratch_path(spark, "plans-bronze"), scratch_path(spark, "plans-pages")
    write_zone(catalog.rv_bronze(spark, sf), bronze, BRONZE_PARTITIONS, BRONZE_FILE_ORDER)
    catalog.pages(spark, sf).write.parquet(pages)
    page_table = spark.read.parquet(pages)
    zone = read_zone(spark, bronze, BRONZE_SCHEMA)
    silver = stamp_load_time(zone)
    silver.createOrReplaceTempView("vw_plans_silver")
    items = {
        "gold mart on lineitem (flagship)": catalog.q_gold_reviews_by_version_month(spark, sf),
        "gold mart SQL on the silver zone": spark.sql(gold_sql("vw_plans_silver")),
        "landing write layout": layout_for_write(landing_frame(page_table), LANDING_PARTITIONS),
        "last page test": feed_last_page(page_table),
        "bronze write layout": layout_for_write(catalog.rv_bronze(spark, sf), BRONZE_PARTITIONS, BRONZE_FILE_ORDER, files="keep"),
        "silver write layout": layout_for_write(silver, BRONZE_PARTITIONS, BRONZE_FILE_ORDER, files="keep"),
        "month filter on the bronze zone": month_filter(zone, "dt_date", "2022-06", ("pt_ano", "pt_mes")),
        "month samples on the silver zone": run_on(spark, PREVIEW_MONTHS_SQL, silver),
        "global sort (sort_multi_key)": catalog.q_sort_multi_key(spark, sf),
    }
    print(HEAD)
    for name, df in items.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {name}\n\n{NOTES[name]}\n\n```")
        for line in plan.splitlines():
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "Location: ...", line)
            print(re.sub(r", \[plan_id=\d+\]", "", line)[:220])
        print("```\n")
    remove_scratch(spark)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
