"""Headline timings: prints one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)

Every query is computed in full (all rows and columns go to a no-op sink). The
commercial build writes ten tables and runs their declared tests, like the
published full refresh of that datamart.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from stratalake.plans.build import COMMERCIAL, build_layers, check_results  # noqa: E402
from stratalake.session import build_session, scratch_path  # noqa: E402
from stratalake.sources.tables import Lake  # noqa: E402
from workload.feeds import Feeds  # noqa: E402
from workload.registry import AS_OF, CALENDAR, QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_UP = "/root/testdata/sf0.001"

HEADLINE = (
    "sv04_silver_vendas",
    "sv05_silver_itens_pedido",
    "sv17_silver_projetos",
    "sv19_silver_titulos_financeiros",
    "gd02_dim_clientes",
    "gf01_fct_vendas",
    "gf02_fct_ordens_compra",
    "gf03_fct_ordens_producao",
    "gf04_fct_expedicao",
    "gf06_fct_titulo_financeiro",
    "gf07_fct_lancamentos",
    "ga01_dre_contabil",
    "ga02_dre_gerencial",
    "pl01_controle_inadimplentes",
    "pl07_overdue_by_customer",
    "pl09_enriched_sales",
    "in01_upsert",
    "in05_affected_groups",
    "dq03_unique_combination",
    "dq05_relationships",
    "dq06_total_consistency",
    "dq15_reconcile",
)


def consume(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def commercial_build(spark: SparkSession, sf_dir: str) -> float:
    lake = Lake(spark, scratch_path(spark, "bench"), prefix=f"b{uuid.uuid4().hex[:8]}_")
    start = time.perf_counter()
    built = build_layers(
        spark, Feeds(spark, sf_dir), lake, COMMERCIAL, as_of=AS_OF, calendar=CALENDAR
    )
    check_results(built, COMMERCIAL).collect()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm = WARM_UP if Path(WARM_UP).exists() else SF_DIR
    times: dict[str, float] = {}
    for name in HEADLINE:
        consume(spark, name, warm)
        times[name] = round(consume(spark, name, SF_DIR), 3)
    commercial_build(spark, warm)
    times["commercial_build_and_tests"] = round(commercial_build(spark, SF_DIR), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
