"""The four raw insurance tables, derived from the order-entry test tables.

Every value is a plain expression of a source row, written in the SQL that Spark and other
engines share, so that a check in another engine starts from the same dirty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import spread

RAW_SQL = {
    "clients": """
select
  concat(' cli-', cast(c_custkey - case when c_custkey % 50 = 7 then 1 else 0 end as string),
         case when c_custkey % 3 = 0 then ' ' else '' end) as `ID Client`,
  case when c_custkey % 31 = 0 then 'N/A' else lower(c_name) end as `Nom`,
  case c_custkey % 4 when 0 then 'jean-pierre' when 1 then '  AMINA ' when 2 then 'o''neil 2ND' else 'Non renseigné' end as `Prénom`,
  case c_custkey % 8 when 0 then 'Masculin' when 1 then 'femme' when 2 then 'M' when 3 then ' f '
       when 4 then 'Homme' when 5 then 'FÉMININ' when 6 then 'inconnu' else 'x' end as `Genre`,
  case when c_custkey % 17 = 0 then 'inconnu' when c_custkey % 13 = 0 then concat(cast(c_custkey % 110 as string), ' ans')
       else cast(c_custkey % 110 as string) end as `Age`,
  replace(cast(cast(c_acctbal as decimal(18,2)) as string), '.', ',') as `Revenu Annuel`,
  cast((c_custkey * 37) % 1100 as int) as `Score-Crédit`,
  lower(c_mktsegment) as `Niveau Professionnel`,
  n_name as `Gouvernorat`,
  concat('ville ', lower(n_name), case when c_custkey % 5 = 0 then ' nord' else '-sud' end) as `Ville`,
  cast(c_custkey % 6 as string) as `nb retards paiement`,
  case when c_custkey % 29 = 0 then 'oui' else cast(c_custkey % 4 as string) end as `nb infractions majeures`,
  concat(cast(c_custkey % 13 as string), ' pts') as `points permis retires`,
  cast(c_custkey % 3 - 1 as bigint) as `incidents paiement assureur`,
  case when c_custkey % 4 = 0 then 'oui' when c_custkey % 4 = 1 then 'non' else '2' end as `historique dettes`,
  case when c_custkey % 6 = 5 then '--' else concat(cast(c_custkey % 5 as string), ',7') end as `nombre enfants`,
  cast(c_custkey % 5 as string) as `num contracts target`,
  concat('0,', cast((c_custkey * 13) % 900 + 100 as string)) as `risque comportemental`,
  concat('0.', cast((c_custkey * 17) % 900 + 100 as string)) as `risque rse`,
  concat('~0,', cast((c_custkey * 19) % 900 + 100 as string)) as `risque financier`,
  cast((c_custkey * 23) % 1000 as double) / 1000 as `risque fraude`,
  cast((c_custkey * 29) % 1000 as double) / 1000 as `risque global`,
  case c_custkey % 5 when 0 then 'Vrai' when 1 then 'non' when 2 then '1.0' when 3 then '2' else '' end as `participe conduite responsable`,
  case c_custkey % 4 when 0 then 'OUI' when 1 then 'Faux' when 2 then ' y ' else '0.0' end as `entretien regulier`,
  c_custkey % 2 = 0 as `vehicule peu polluant`,
  case c_custkey % 3 when 0 then 'true' when 1 then 'n' else 'peut-être' end as `engagement securite routiere`,
  cast(c_custkey % 3 as int) as `changement frequent assureur`,
  case c_custkey % 6 when 0 then 'prudent' when 1 then ' AGRESSIF' when 2 then 'Aggressive' when 3 then 'normal'
       when 4 then 'xyz' else '?' end as `driving behavior`,
  c_custkey as `row seq`
from {customer} left join {nation} on c_nationkey = n_nationkey
""",
    "policies": """
select
  case when o_orderkey % 89 = 0 then 'nan'
       else concat('con-', cast(o_orderkey - case when o_orderkey % 60 = 9 then 1 else 0 end as string)) end as contract_id,
  concat('CLI-', cast(o_custkey as string)) as clientid,
  case when o_orderkey % 71 = 0 then 'xx'
       when o_orderkey % 3 = 0 then cast(o_orderdate as string)
       when o_orderkey % 3 = 1 then concat(substr(cast(o_orderdate as string), 9, 2), '/', substr(cast(o_orderdate as string), 6, 2), '/',
                                           substr(cast(o_orderdate as string), 1, 4))
       else concat(substr(cast(o_orderdate as string), 9, 2), '/', substr(cast(o_orderdate as string), 6, 2), '/',
                   substr(cast(o_orderdate as string), 1, 4), ' 10:30') end as date_debut_contrat,
  o_orderdate + (interval '1' day) * cast((o_orderkey * 7) % 1500 - 60 as int) as date_fin_contrat,
  lower(o_orderpriority) as type_couverture,
  case when o_orderkey % 101 = 0 then '-5' when o_orderkey % 103 = 0 then '0'
       else replace(cast(cast(o_totalprice as decimal(18,2)) as string), '.', ',') end as prime_assurance_annuelle,
  cast(o_orderkey % 7 - 2 as bigint) as nb_sinistres_precedents,
  case when o_orderkey % 53 = 0 then 'n/a' else cast((o_orderkey * 11) % 400 - 10 as string) end as delai_souscription_sinistre_jours,
  o_orderstatus as statut_commande,
  o_orderkey as row_seq
from {orders}
""",
    "vehicles": """
select
  concat('veh-', cast(p_partkey - case when p_partkey % 40 = 3 then 1 else 0 end as string)) as vehicule_id,
  concat(' con-', cast(p_partkey * 3 as string)) as contrat_id,
  lower(p_type) as type_vehicule,
  upper(p_brand) as marque,
  p_name as modele,
  case p_partkey % 4 when 0 then 'privé' when 1 then 'PROFESSIONNEL' when 2 then 'nan' else 'taxi-collectif' end as usage_vehicule,
  concat(' ', cast(p_partkey % 300 as string), ' tu ', cast(p_partkey as string)) as immatriculation,
  case when p_partkey % 37 = 0 then 'neuf' else cast(1960 + p_partkey % 70 as string) end as annee_modele,
  p_size as puissance_fiscale,
  concat(cast((p_partkey * 7919) % 320 as string), ' ', cast((p_partkey * 31) % 900 + 100 as string)) as kilometrage_actuel,
  case when p_partkey % 41 = 0 then 0.0 else p_retailprice end as valeur_vehicule,
  p_partkey as row_seq
from {part}
""",
    "claims": """
select
  case when l_orderkey % 97 = 0 then ' none' else concat('clm-', cast(l_orderkey as string), '-', cast(l_linenumber as string)) end as `Sinistre ID`,
  concat('con-', cast(l_orderkey as string)) as contract_id,
  case when l_orderkey % 11 = 0 then 'NaN' else concat('cli-', cast(o_custkey as string)) end as client_id,
  concat('veh-', cast(l_partkey as string)) as vehicle_id,
  case when l_orderkey % 67 = 0 then '31/13/2020' else concat(substr(cast(o_orderdate as string), 1, 10), ' 0', cast(l_linenumber as string), ':15:00') end as date_sinistre_claim,
  case when l_linestatus = 'O' and l_linenumber % 2 = 0 then null
       else concat(substr(cast(l_shipdate as string), 9, 2), '/', substr(cast(l_shipdate as string), 6, 2), '/',
                   substr(cast(l_shipdate as string), 1, 4), ' 18:45') end as date_cloture_claim,
  case l_returnflag when 'A' then ' accident MATÉRIEL' when 'R' then 'vol d''objet' else 'bris-de-glace' end as type_sinistre_claim,
  case when l_linestatus = 'O' and l_linenumber % 2 = 0 then
         case l_partkey % 4 when 0 then ' En cours' when 1 then 'OUVERT' when 2 then 'en cours  expertise' else 'En cours d expertise' end
       else case l_partkey % 6 when 0 then 'Refusée' when 1 then 'clos avec indemnisation' when 2 then 'Clôturé' when 3 then 'Rejet'
                 when 4 then 'clos sans indemnisation ' else 'en attente-client' end end as statut_sinistre_claim,
  case when l_suppkey % 10 = 0 then '  ' else concat('  choc   avant', chr(9), ' n', cast(l_linenumber as string), '  fin ') end as description_sinistre_claim,
  case when l_partkey % 83 = 0 then '-1' when l_partkey % 79 = 0 then '0'
       else replace(cast(cast(l_extendedprice as decimal(18,2)) as string), '.', ',') end as `Montant Estimé / Dommage - claim`,
  l_extendedprice * (1 - l_discount) * (0.4 + cast(l_suppkey % 10 as double) / 10) as montant_indemnisation_claim,
  case l_suppkey % 4 when 0 then 'oui' when 1 then 'Non' when 2 then '0' else 'nsp' end as est_frauduleux_claim,
  case l_suppkey % 3 when 0 then 'vrai' when 1 then 'F' else '' end as incoherence_dommages,
  l_suppkey % 2 = 0 as nature_sinistre_consistante,
  case when l_partkey % 43 = 0 then 'na' else cast(l_linenumber * 60 as string) end as sla_jours,
  cast(l_linenumber * 4 as string) as duree_traitement_jours,
  case when l_linenumber = 3 then '-6' else cast(l_linenumber * 96 as string) end as duree_traitement_heures,
  l_quantity as quantite,
  l_tax as taux
from {lineitem} join {orders} on l_orderkey = o_orderkey
""",
}

SOURCES = {
    "clients": ("customer", "nation"),
    "policies": ("orders",),
    "vehicles": ("part",),
    "claims": ("lineitem", "orders"),
}


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def raw_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of ``clients``, ``policies``, ``vehicles``, ``claims``."""
    return spark.sql(RAW_SQL[name], **{t: spread(load(spark, folder, t)) for t in SOURCES[name]})


def raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: raw_table(spark, folder, name) for name in RAW_SQL}
