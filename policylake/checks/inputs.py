"""Inputs of the registered queries, as SQL text that both engines run on the driver tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_folder, spread
from ..sources.driver_tables import load

AS_OF = date(2024, 6, 30)

# Row orders that decide which row of a repeated key is kept.
ORDER = {
    "clients": ("row_seq",),
    "policies": ("row_seq",),
    "vehicles": ("row_seq",),
    "claims": ("date_cloture_claim", "montant_indemnisation_claim", "quantite", "taux", "vehicle_id",
               "montant_estime_dommage_claim", "description_sinistre_claim"),
}

# Claims with a given delay probability, so that reports can be checked to the last digit.
SCORED_SQL = """
select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_partkey as string)) as claim_id,
       concat('con-', cast(l_orderkey as string)) as contract_id,
       cast(case when (l_suppkey + l_linenumber + l_orderkey) % 3 = 0 then 1 else 0 end as int) as is_delayed,
       case when l_linestatus = 'O' and l_linenumber % 2 = 0 then 'En_cours'
            when l_returnflag = 'R' then 'Clos' when l_suppkey % 7 = 0 then null else 'Refusé' end as statut_sinistre_claim,
       l_extendedprice as montant_indemnisation_claim,
       l_quantity as quantite,
       cast((l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 31) % 10007 as double) / 10006 as delay_probability
from {lineitem}
"""

# New order rows as a text file brings them: unreadable numbers and days, a column too few and one too many.
ARRIVING_SQL = """
select cast(o_orderkey as string) as o_orderkey,
       cast(o_custkey as string) as o_custkey,
       case when o_orderkey % 50 = 3 then 'abc' else cast(cast(o_totalprice as decimal(18,2)) as string) end as o_totalprice,
       case when o_orderkey % 70 = 1 then '32/01/2020'
            else concat(substr(cast(o_orderdate as string), 9, 2), '/', substr(cast(o_orderdate as string), 6, 2), '/',
                        substr(cast(o_orderdate as string), 1, 4)) end as o_orderdate,
       case when o_orderkey % 40 = 5 then 'NA' else o_orderpriority end as o_orderpriority,
       'x' as extra_column
from {orders}
"""


def scored_claims(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(SCORED_SQL, lineitem=spread(load(spark, folder, "lineitem")))


def arriving_orders(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(ARRIVING_SQL, orders=load(spark, folder, "orders"))


def arriving_csv(spark: SparkSession, folder: str) -> str:
    """The arriving rows as a folder of CSV files."""
    path = scratch_folder(spark, "arriving")
    arriving_orders(spark, folder).write.option("header", True).csv(path)
    return path
