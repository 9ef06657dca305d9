"""Print the formatted physical plan of a gold mart over written silver tables.

usage: python tools/explain.py [sf_dir] [mart ...]

Builds the silver tables from the fixture adapters (first load), writes them
below the session's checkpoint folder, runs each mart once (so the adaptive
plan is final) and prints ``explain("formatted")``.
"""

from __future__ import annotations

import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from strata.conf import AS_OF, T1  # noqa: E402
from strata.fixtures.retail import bronze_tables, load_star  # noqa: E402
from strata.plans import gold  # noqa: E402
from strata.plans.silver import SilverStore  # noqa: E402
from strata.schemas import REFRESH_TABLES, SCD2_TABLES  # noqa: E402
from strata.session import build_session, work_dir  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    marts = sys.argv[2:] or list(gold.MARTS)
    spark = build_session("local[8]", 8, extra={"spark.ui.showConsoleProgress": "false"})
    bronze = bronze_tables(load_star(spark, sf))
    store = SilverStore(spark, work_dir(spark, "explain"))
    for t in REFRESH_TABLES + SCD2_TABLES:
        store.load(t, bronze[t], "1", T1)
    silver = {t: store.read(t) for t in REFRESH_TABLES + SCD2_TABLES}
    for name in marts:
        fn = gold.MARTS[name]
        df = fn(silver, AS_OF) if name == "customer_engagement" else fn(silver)
        df.write.format("noop").mode("overwrite").save()
        print(f"===== {name} =====")
        df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
