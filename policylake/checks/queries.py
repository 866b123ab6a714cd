"""One query per operator, each over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bands, dates, numbers, text
from ..functions.steps import apply_steps
from ..operators import schema
from ..operators.dedupe import keep_first
from ..operators.lookup import lookup
from ..operators.quality import key_violations, null_nonfinite, rejected_rows, storage_profile
from ..operators.quantiles import quantiles
from ..operators.sizes import literal_rows
from ..plans import build, claims, clients, dashboard, delay_scoring, delay_training, jobs, policies, vehicles, warehouse
from ..plans.bounds import bounds_table, clip_bounds, clip_columns, read_bounds
from ..session import TABLE_SETTINGS, scratch_folder, spread, stage, tune
from ..sources import ingest, snapshots, tables
from ..sources.driver_tables import load, raw_table, raw_tables
from ..streaming import arrivals
from .inputs import AS_OF, ORDER, arriving_csv, arriving_orders, scored_claims

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return f(tune(spark, TABLE_SETTINGS), folder)

    QUERIES[f.__name__] = run
    return f


def rounded(f: Query) -> Query:
    """Doubles to six decimals: engines interpolate quantiles with different last bits."""
    inner = QUERIES[f.__name__]

    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = inner(spark, folder)
        doubles = {c: F.round(c, 6) for c, t in df.dtypes if t == "double"}
        return df.withColumns(doubles)

    QUERIES[f.__name__] = run
    return f


def _raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    df = schema.normalize_headers(raw_table(spark, folder, name))
    for key in {"clients": ["client_id"], "policies": ["contract_id", "client_id"],
                "vehicles": ["vehicle_id", "contract_id"], "claims": ["claim_id"]}[name]:
        df = schema.require_column(df, key)
    return df


def _with(df: DataFrame, rules: dict[str, tuple[str, object]], *keep: str) -> DataFrame:
    """``keep`` columns, each source column as ``<name>`` and its rule's result as the new name."""
    df = df.select(*keep, *[F.col(source).alias(new) for new, (source, _) in rules.items()])
    return apply_steps(df, {new: rule for new, (_, rule) in rules.items()})


# Scans, sources and sinks

@query
def scan_table(spark, folder):
    root = scratch_folder(spark, "zones")
    tables.write_table(load(spark, folder, "lineitem"), root, "raw.claims", "replace")
    return tables.read_table(spark, root, "raw.claims")


@query
def ingest_csv_scan(spark, folder):
    return ingest.read_csv(spark, arriving_csv(spark, folder)).drop(ingest.CORRUPT)


def _mixed_csv(spark, folder) -> str:
    """Arriving rows in files of two headers: columns in reverse order, and without the priority."""
    path, new = scratch_folder(spark, "arriving"), arriving_orders(spark, folder)
    even = F.col("o_orderkey").cast("bigint") % 2 == 0
    new.filter(even).select(*reversed(new.columns)).write.option("header", True).csv(f"{path}/even")
    new.filter(~even).drop("o_orderpriority").write.option("header", True).csv(f"{path}/odd")
    return path


@query
def ingest_mixed_headers(spark, folder):
    return ingest.conform(ingest.read_csv(spark, _mixed_csv(spark, folder)), load(spark, folder, "orders").schema)


@query
def ingest_conform(spark, folder):
    new = ingest.read_csv(spark, arriving_csv(spark, folder))
    return ingest.conform(new, load(spark, folder, "orders").schema)


def _orders_zone(spark, folder) -> str:
    root = scratch_folder(spark, "zones")
    tables.write_table(load(spark, folder, "orders"), root, "raw.orders", "replace")
    return root


@query
def ingest_append(spark, folder):
    root = _orders_zone(spark, folder)
    ingest.append_csv(spark, arriving_csv(spark, folder), root, "raw.orders", key="o_orderkey")
    return tables.read_table(spark, root, "raw.orders")


@query
def ingest_quarantine(spark, folder):
    root = _orders_zone(spark, folder)
    ingest.append_csv(spark, arriving_csv(spark, folder), root, "raw.orders", "o_orderkey", "raw.orders_rejected")
    return tables.read_table(spark, root, "raw.orders_rejected").select("o_orderkey", "o_totalprice", "o_orderdate", "reason")


@query
def ingest_corrupt_lines(spark, folder):
    """Lines with a field too many are set aside, and the table grows by what is counted."""
    root, path = _orders_zone(spark, folder), scratch_folder(spark, "arriving")
    new = arriving_orders(spark, folder).withColumn("extra_column", F.expr("case when cast(o_orderkey as bigint) % 30 = 7 then 'x,y' else 'x' end"))
    new.write.option("header", True).option("quote", "").csv(path)
    before = tables.read_table(spark, root, "raw.orders").count()
    counts = ingest.append_csv(spark, path, root, "raw.orders", "o_orderkey", "raw.orders_rejected")
    grown = tables.read_table(spark, root, "raw.orders").agg((F.count(F.lit(1)) - before).alias("grown"))
    kept = tables.read_table(spark, root, "raw.orders_rejected").agg(F.count_if(F.col(ingest.CORRUPT).isNotNull()).alias("corrupt"))
    return counts.withColumns({"grown": grown.scalar(), "corrupt": kept.scalar()})


@query
def ingest_dry_run(spark, folder):
    root, path = _orders_zone(spark, folder), arriving_csv(spark, folder)
    counts = ingest.append_csv(spark, path, root, "raw.orders", dry_run=True)
    new = ingest.conform(ingest.read_csv(spark, path), load(spark, folder, "orders").schema)
    first = ingest.preview(new, ["o_orderkey"]).select("o_orderkey", "o_totalprice")
    return first.withColumn("would_append", counts.select("appended").scalar())


@query
def ingest_summary(spark, folder):
    root, parts = scratch_folder(spark, "zones"), []
    for name in ("customer", "orders", "part", "lineitem"):
        source, path = load(spark, folder, name), scratch_folder(spark, f"csv_{name}")
        tables.write_table(source, root, f"raw.{name}", "replace")
        source.write.option("header", True).option("escape", '"').csv(path)
        parts.append(ingest.append_csv(spark, path, root, f"raw.{name}"))
    return ingest.ingest_summary(parts)


@query
def load_replace(spark, folder):
    root = scratch_folder(spark, "zones")
    tables.write_table(load(spark, folder, "orders"), root, "stg.customer", "replace")
    tables.write_table(load(spark, folder, "customer"), root, "stg.customer", "replace", "c_custkey")
    return tables.read_table(spark, root, "stg.customer")


@query
def load_versions(spark, folder):
    """Rows and greatest key of each version: three loads, the last one appended, after the first was dropped."""
    root = scratch_folder(spark, "zones")
    rows = load(spark, folder, "orders").select("o_orderkey", "o_custkey").dropDuplicates(["o_orderkey"])
    tables.write_table(rows.filter("o_orderkey % 5 = 0"), root, "stg.orders", "replace", "o_orderkey")
    tables.write_table(rows.filter("o_orderkey % 5 = 1"), root, "stg.orders", "replace", "o_orderkey")
    tables.write_table(rows.filter("o_orderkey % 5 = 2"), root, "stg.orders", "append", "o_orderkey")
    path = tables.table_path(root, "stg.orders")
    snapshots.remove_old_versions(spark, path, keep=2)
    found = [tables.read_table(spark, root, "stg.orders", v).agg(F.lit(v).cast("bigint").alias("version"), F.count(F.lit(1)).alias("rows"), F.max("o_orderkey").alias("greatest"))
             for v in snapshots.versions(spark, path)]
    return found[0].unionByName(found[1])


@query
def load_append(spark, folder):
    root = scratch_folder(spark, "zones")
    for _ in range(2):
        tables.write_table(load(spark, folder, "part"), root, "stg.part", "append")
    return tables.read_table(spark, root, "stg.part")


@query
def load_all_counts(spark, folder):
    root = scratch_folder(spark, "zones")
    jobs.build(spark, raw_tables(spark, folder), root, AS_OF, ORDER)
    return tables.row_counts({n: tables.read_table(spark, root, f"{z}.{n}") for z, n, _ in tables.OUTPUT_TABLES})


@query
def pipeline_row_counts(spark, folder):
    return tables.row_counts(build.build_outputs(raw_tables(spark, folder), AS_OF, ORDER))


@query
def schema_diff(spark, folder):
    old = load(spark, folder, "orders")
    new = arriving_orders(spark, folder)
    sides = schema.compare_headers(old, new)
    filled = {}
    for df in (old, new):
        filled |= {c: (df, n) for c, n in schema.filled_counts(df).items()}
    counts = old.agg(*[n.alias(c) for c, n in schema.filled_counts(old).items()])
    extra = new.agg(*[n.alias(f"{c}__new") for c, n in schema.filled_counts(new).items()])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.lit(side).alias("side"),
                 (counts.select(c).scalar() if side != "extra" else extra.select(f"{c}__new").scalar()).alias("filled"))
        for c, side in sides.items()
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))


@query
def profile_storage_types(spark, folder):
    return storage_profile(_raw(spark, folder, "clients").drop("row_seq"))


@query
def pk_violations(spark, folder):
    ids = apply_steps(_raw(spark, folder, "claims").select("claim_id"), {"claim_id": text.normalized_id()})
    return key_violations(ids, "claim_id")


@query
def write_rejects(spark, folder):
    df = _raw(spark, folder, "policies").select("contract_id", "client_id", "row_seq")
    return rejected_rows(apply_steps(df, {"contract_id": text.normalized_id()}), "contract_id")


@query
def sanitize_nonfinite(spark, folder):
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    df = load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_suppkey") % 5 == 0, nan).when(F.col("l_suppkey") % 5 == 1, inf)
        .when(F.col("l_suppkey") % 5 == 2, -inf).otherwise(F.col("l_tax")).alias("value"),
    )
    return null_nonfinite(df)


# Schema and projection

@query
def normalize_columns(spark, folder):
    return schema.normalize_headers(raw_table(spark, folder, "clients"))


@query
def require_column(spark, folder):
    df = schema.normalize_headers(raw_table(spark, folder, "vehicles"))
    return schema.require_column(schema.require_column(df, "vehicle_id"), "contract_id").select("vehicle_id", "contract_id", "row_seq")


@query
def optional_defaults(spark, folder):
    df = _raw(spark, folder, "policies").select("contract_id", "statut_commande", "row_seq")
    return schema.with_optional(df, {"statut_commande": ("string", "Unknown"), "statut_sinistre_claim": ("string", "Unknown"),
                                     "sla_jours": ("double", None)})


@query
def whitelist_projection(spark, folder):
    return schema.keep_columns(_raw(spark, folder, "vehicles"), warehouse.DIM_VEHICLE)


@query
def drop_leakage_columns(spark, folder):
    df = _raw(spark, folder, "claims").select("claim_id", "taux", "sla_jours", "duree_traitement_jours", "duree_traitement_heures")
    return df.drop(*warehouse.ML_DROPPED)


@query
def feature_types(spark, folder):
    df = claims.parse_claims(raw_table(spark, folder, "claims"))
    kinds = schema.feature_columns(df)
    counts = df.agg(*[F.count(c).alias(c) for c in kinds])
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(k or "none").alias("kind"), F.col(c).alias("filled")) for c, k in kinds.items()]
    return counts.select(F.inline(F.array(*rows)))


# Scalar rules

@query
def normalize_id(spark, folder):
    df = _raw(spark, folder, "claims")
    return _with(df, {"claim_key": ("claim_id", text.normalized_id()), "client_key": ("client_id", text.normalized_id()),
                      "number_key": ("quantite", text.normalized_id("double"))}, "claim_id")


@query
def missing_tokens(spark, folder):
    return _with(_raw(spark, folder, "clients"), {"nom_ok": ("nom", text.missing_to_null()), "prenom_ok": ("prenom", text.missing_to_null()),
                                                  "genre_ok": ("genre", text.missing_to_null())}, "row_seq")


@query
def safe_numeric(spark, folder):
    df = _raw(spark, folder, "policies")
    rule = (*numbers.strict_number(), numbers.within())
    return _with(df, {"prime": ("prime_assurance_annuelle", rule), "delai": ("delai_souscription_sinistre_jours", rule),
                      "couverture": ("type_couverture", rule)}, "row_seq")


@query
def flex_numeric(spark, folder):
    names = ("age", "revenu_annuel", "nb_infractions_majeures", "points_permis_retires", "historique_dettes", "risque_financier", "nombre_enfants")
    return _with(_raw(spark, folder, "clients"), {f"{c}_n": (c, numbers.flexible_number()) for c in names}, "row_seq")


@query
def int_count(spark, folder):
    df = _raw(spark, folder, "clients")
    return _with(df, {f"{c}_n": (c, numbers.whole_count(dict(df.dtypes)[c])) for c in clients.COUNTS}, "row_seq")


@query
def safe_bool(spark, folder):
    df = _raw(spark, folder, "clients")
    return _with(df, {f"{c}_b": (c, numbers.flag(dict(df.dtypes)[c])) for c in clients.FLAGS}, "row_seq")


@query
def safe_datetime(spark, folder):
    df = _raw(spark, folder, "policies")
    return _with(df, {"debut": ("date_debut_contrat", dates.parsed_timestamp()),
                      "fin": ("date_fin_contrat", dates.parsed_timestamp("timestamp_ntz"))}, "row_seq")


@query
def clean_text_title(spark, folder):
    df = _raw(spark, folder, "clients")
    return _with(df, {f"{c}_t": (c, text.clean_text()) for c in ("prenom", "ville", "nom")}, "row_seq")


@query
def clean_text_modes(spark, folder):
    df = _raw(spark, folder, "vehicles")
    return _with(df, {f"usage_{m}": ("usage_vehicule", text.clean_text(mode=m)) for m in ("title", "upper", "lower", "none")}, "row_seq")


@query
def collapse_whitespace(spark, folder):
    return _with(_raw(spark, folder, "claims"), {"description": ("description_sinistre_claim", text.collapsed_text())}, "claim_id")


@query
def plate_normalize(spark, folder):
    return _with(_raw(spark, folder, "vehicles"), {"plaque": ("immatriculation", text.plate())}, "row_seq")


@query
def map_gender(spark, folder):
    return _with(_raw(spark, folder, "clients"), {"genre_mf": ("genre", text.gender())}, "row_seq", "genre")


@query
def map_driving_behavior(spark, folder):
    return _with(_raw(spark, folder, "clients"), {"conduite": ("driving_behavior", text.driving_behavior())}, "row_seq")


@query
def std_status(spark, folder):
    return _with(_raw(spark, folder, "claims"), {"statut": ("statut_sinistre_claim", text.claim_status())}, "claim_id", "statut_sinistre_claim")


@query
def range_nullify(spark, folder):
    df = _raw(spark, folder, "vehicles")
    return _with(df, {c: (c, (*numbers.strict_number(dict(df.dtypes)[c]), numbers.within(*r)))
                      for c, r in {"annee_modele": (1970, AS_OF.year + 1), **vehicles.RANGES}.items()}, "row_seq")


@query
def floor_zero(spark, folder):
    return _with(_raw(spark, folder, "policies"), {"sinistres": ("nb_sinistres_precedents", (*numbers.strict_number("bigint"), numbers.at_least_zero))}, "row_seq")


@query
def safe_ratio(spark, folder):
    df = vehicles.parse_vehicles(raw_table(spark, folder, "vehicles"), AS_OF)
    return df.select("row_seq", numbers.ratio(F.col("kilometrage_actuel"), F.col("vehicle_age")).alias("km_an"),
                     numbers.ratio(F.col("kilometrage_actuel"), F.col("valeur_vehicule")).alias("km_valeur"))


@query
def risk_scores(spark, folder):
    df = clients.clean_clients(raw_table(spark, folder, "clients"), order_by=ORDER["clients"])
    return df.select("client_id", "driving_risk_score", "financial_stress_score", "responsible_behavior_score")


@query
def elapsed_days(spark, folder):
    df = policies.parse_policies(raw_table(spark, folder, "policies"))
    days = dates.elapsed_days(F.col("date_debut_contrat"), F.col("date_fin_contrat"))
    return apply_steps(df.select("row_seq", days.alias("jours")), {"jours": [numbers.within(0)]})


def _parsed_claims(spark, folder) -> DataFrame:
    return claims.parse_claims(raw_table(spark, folder, "claims"))


@query
def claim_duration(spark, folder):
    return _parsed_claims(spark, folder).select("claim_id", "vehicle_id", "duree_traitement_jours", "duree_traitement_heures")


@query
def delay_label(spark, folder):
    df = _parsed_claims(spark, folder)
    return df.select("claim_id", "vehicle_id", claims.delay_label().alias("is_delayed"), claims.delay_label(None).alias("known_label"))


@query
def claim_gap(spark, folder):
    df = claims.with_gap(_parsed_claims(spark, folder))
    return df.select("claim_id", "vehicle_id", "claim_gap_amount", "claim_gap_ratio")


@query
def vehicle_age(spark, folder):
    return vehicles.parse_vehicles(raw_table(spark, folder, "vehicles"), AS_OF).select("row_seq", "vehicle_age")


@query
def date_parts(spark, folder):
    df = load(spark, folder, "events")
    return df.select("event_id", *[c.alias(n) for n, c in dates.claim_date_parts(F.col("ts")).items()])


@query
def date_key(spark, folder):
    return load(spark, folder, "events").select("event_id", dates.date_key(F.col("ts")).alias("date_key"))


# Filters

@query
def drop_null_pk(spark, folder):
    df = apply_steps(_raw(spark, folder, "claims"), {"claim_id": text.normalized_id()})
    return df.filter(F.col("claim_id").isNotNull()).select("claim_id", "vehicle_id", "quantite")


@query
def labelled_rows(spark, folder):
    df = scored_claims(spark, folder).withColumn("is_delayed", F.when(F.col("quantite") > 10, F.col("is_delayed")))
    return delay_training.labelled(df).select("claim_id", "is_delayed")


@query
def active_claims(spark, folder):
    return delay_scoring.active_claims(scored_claims(spark, folder)).select("claim_id", "statut_sinistre_claim")


@query
def active_claims_fallback(spark, folder):
    closed = scored_claims(spark, folder).withColumn("statut_sinistre_claim", F.nullif("statut_sinistre_claim", F.lit("En_cours")))
    return delay_scoring.active_claims(closed).select("claim_id", "statut_sinistre_claim")


@query
def duration_training_rows(spark, folder):
    clean = _clean(spark, folder, "claims")
    rows = delay_training.duration_rows(clean.select("claim_id", "vehicle_id"), clean)
    return rows.select("claim_id", "duree_traitement_jours")


@query
def predicted_delayed(spark, folder):
    return scored_claims(spark, folder).filter(F.col("delay_probability") > delay_scoring.LATE_ABOVE).select("claim_id", "delay_probability")


# Joins

def _clean(spark, folder, name) -> DataFrame:
    raw = raw_table(spark, folder, name)
    if name == "vehicles":
        return vehicles.clean_vehicles(raw, as_of=AS_OF, order_by=ORDER[name])
    return {"clients": clients.clean_clients, "policies": policies.clean_policies, "claims": claims.clean_claims}[name](
        raw, order_by=ORDER[name]
    )


def _ids(df: DataFrame, *names: str) -> DataFrame:
    return apply_steps(df.select(*names), {n: text.normalized_id() for n in names if n.endswith("_id")})


@query
def fact_join_policy(spark, folder):
    left = _ids(_raw(spark, folder, "claims"), "claim_id", "contract_id", "quantite")
    right = _ids(_raw(spark, folder, "policies"), "contract_id", "row_seq", "statut_commande", "type_couverture")
    return lookup(left, keep_first(right, "contract_id", ORDER["policies"]), "contract_id", ["type_couverture", "statut_commande"])


@query
def fact_join_client(spark, folder):
    left = _ids(_raw(spark, folder, "claims"), "claim_id", "contract_id", "client_id", "vehicle_id")
    pol = keep_first(_ids(_raw(spark, folder, "policies"), "contract_id", "client_id", "row_seq"), "contract_id", ORDER["policies"])
    cli = keep_first(_ids(_raw(spark, folder, "clients"), "client_id", "row_seq", "gouvernorat"), "client_id", ORDER["clients"])
    both = lookup(left, pol, "contract_id", ["client_id"])
    both = both.withColumn("client_id", F.coalesce("client_id_x", "client_id_y")).drop("client_id_x", "client_id_y")
    return lookup(both, cli, "client_id", ["gouvernorat"])


@query
def coalesce_client(spark, folder):
    left = _ids(_raw(spark, folder, "claims"), "claim_id", "contract_id", "client_id", "vehicle_id")
    pol = keep_first(_ids(_raw(spark, folder, "policies"), "contract_id", "client_id", "row_seq"), "contract_id", ORDER["policies"])
    both = lookup(left, pol, "contract_id", ["client_id"], unique=True, salted=True)
    return both.select("claim_id", "vehicle_id", F.coalesce("client_id_x", "client_id_y").alias("client_id"))


@query
def fact_join_vehicle(spark, folder):
    left = _ids(_raw(spark, folder, "claims"), "claim_id", "vehicle_id", "quantite")
    veh = keep_first(_ids(_raw(spark, folder, "vehicles"), "vehicle_id", "row_seq", "marque", "modele"), "vehicle_id", ORDER["vehicles"])
    return lookup(left, veh, "vehicle_id", ["marque", "modele"], salted=True)


@query
def ml_wide_join(spark, folder):
    wide = build.wide_claims(_staged_clean(spark, folder))
    return wide.select(
        "claim_id", F.col("policy__type_couverture").alias("type_couverture"), F.col("vehicle__marque").alias("marque"),
        F.when(F.col("client_id").isNotNull(), F.col("client__genre")).alias("genre"),
        F.when(F.col("client_id").isNotNull(), F.col("client__income_band")).alias("income_band"),
    )


@query
def lookup_join_rowcount(spark, folder):
    left = load(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("key"))
    right = load(spark, folder, "lineitem").select(F.col("l_orderkey").alias("key"), F.lit(1).alias("found"))
    joined = lookup(left, right, "key", ["found"])
    return joined.agg(F.count(F.lit(1)).alias("rows"), F.count("found").alias("matched"))


# Aggregates

@query
def quantiles_exact(spark, folder):
    df = spread(load(spark, folder, "lineitem"))
    ps = (0.01, 0.2, 0.5, 0.95, 0.99)
    wanted = {c: (F.col(c), ps) for c in ("l_extendedprice", "l_quantity", "l_tax")}
    found = quantiles(df, wanted)
    rows = [(c, p, round(v, 6)) for c, vs in found.items() for p, v in zip(ps, vs)]
    return literal_rows(spark, rows, ("column_name", "probability", "value"))


QUERIES["quantiles"] = QUERIES.pop("quantiles_exact")


@rounded
@query
def clip_outliers(spark, folder):
    df = spread(load(spark, folder, "lineitem")).select("l_orderkey", "l_linenumber", "l_extendedprice", F.nullif("l_tax", F.lit(0.0)).alias("l_tax"))
    names = ("l_extendedprice", "l_tax")
    return clip_columns(df, clip_bounds(df, names), names)


def _risky(spark, folder) -> DataFrame:
    return delay_scoring.with_default_delay(delay_scoring.with_risk(scored_claims(spark, folder)))


@query
def risk_distribution(spark, folder):
    return dashboard.risk_distribution(_risky(spark, folder))


@query
def label_distribution(spark, folder):
    return delay_training.class_counts(delay_training.labelled(scored_claims(spark, folder)))


@query
def dashboard_metrics(spark, folder):
    m = dashboard.dashboard_metrics(_risky(spark, folder), AS_OF)
    return m.withColumns({c: F.round(c, 4) for c, t in m.dtypes if t == "double"})


@query
def recommended_staff(spark, folder):
    counts = dashboard.risk_distribution(_risky(spark, folder))
    per = [F.coalesce(F.sum(F.when(F.col("risk_level") == r, F.col("claims"))), F.lit(0)) for r in bands.RISK_LABELS[::-1]]
    return counts.agg(dashboard.staff_needed(*per).alias("recommended_staff"))


@rounded
@query
def impute_median(spark, folder):
    df = vehicles.parse_vehicles(raw_table(spark, folder, "vehicles"), AS_OF)
    names = ["annee_modele", "kilometrage_actuel", "valeur_vehicule", "vehicle_age"]
    found = delay_training.medians(df, names)
    return df.select("row_seq", *[F.coalesce(c, F.lit(found[c])).alias(c) for c in names])


@query
def impute_mode(spark, folder):
    df = clients.parse_clients(raw_table(spark, folder, "clients"))
    return delay_training.modes(df, ["genre", "prenom", "niveau_professionnel", "driving_behavior", "gouvernorat"])


@query
def standard_scale(spark, folder):
    found = delay_training.scaling(load(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"])
    return found.select("column_name", F.round("mean", 4).alias("mean"), F.round("deviation", 4).alias("deviation"))


@query
def class_weights(spark, folder):
    found = delay_training.class_weights(delay_training.labelled(scored_claims(spark, folder)))
    return found.select("is_delayed", "rows", F.round("balanced_weight", 6).alias("balanced_weight"), F.round("boost_weight", 6).alias("boost_weight"))


def _predicted(spark, folder) -> DataFrame:
    called = (F.col("delay_probability") > delay_scoring.LATE_ABOVE).cast("int")
    return scored_claims(spark, folder).withColumn("prediction", called)


@query
def confusion_matrix(spark, folder):
    return delay_training.confusion_matrix(_predicted(spark, folder))


@query
def classification_report(spark, folder):
    found = delay_training.classification_report(_predicted(spark, folder))
    return found.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query
def roc_auc(spark, folder):
    auc = delay_training.roc_auc(scored_claims(spark, folder))
    return literal_rows(spark, [(round(auc, 6),)], ("auc",))


@query
def regression_metrics(spark, folder):
    found = delay_training.regression_metrics(load(spark, folder, "lineitem"), "l_quantity", "l_linenumber")
    return found.select(F.round("mae", 6).alias("mae"), F.round("r2", 6).alias("r2"), "rows")


@query
def distinct_status(spark, folder):
    return _with(_raw(spark, folder, "claims"), {"statut": ("statut_sinistre_claim", text.claim_status())}).distinct()


@query
def dedupe_keep_first(spark, folder):
    df = load(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate", "l_extendedprice")
    return keep_first(df, "l_orderkey", ["l_shipdate", "l_extendedprice"])


@query
def top_high_risk(spark, folder):
    return dashboard.top_high_risk(_risky(spark, folder))


@query
def best_model(spark, folder):
    first = _predicted(spark, folder)
    second = first.withColumn("delay_probability", 1 - F.col("delay_probability")).withColumn("prediction", 1 - F.col("prediction"))
    both = delay_training.model_metrics(first, "random_forest").unionByName(delay_training.model_metrics(second, "boosted_trees"))
    return delay_training.best_model(both).select("model", F.round("auc", 6).alias("auc"))


# Bands

@query
def age_group(spark, folder):
    df = clients.parse_clients(raw_table(spark, folder, "clients"))
    return df.select("row_seq", "age", bands.age_group(F.col("age")).alias("age_group"))


@query
def credit_band(spark, folder):
    df = clients.parse_clients(raw_table(spark, folder, "clients"))
    return df.select("row_seq", "score_credit", bands.credit_band(F.col("score_credit")).alias("credit_band"))


@query
def tenure_bucket(spark, folder):
    return _clean(spark, folder, "policies").select("contract_id", "policy_duration_days", "policy_tenure_bucket")


@query
def risk_level(spark, folder):
    return delay_scoring.with_risk(scored_claims(spark, folder)).select("claim_id", "risk_level")


@rounded
@query
def income_band(spark, folder):
    return _clean(spark, folder, "clients").select("client_id", "revenu_annuel", "income_band")


@rounded
@query
def vehicle_value_band(spark, folder):
    return _clean(spark, folder, "vehicles").select("vehicle_id", "valeur_vehicule", "vehicle_value_band")


@rounded
@query
def claim_severity_bucket(spark, folder):
    return _clean(spark, folder, "claims").select("claim_id", "montant_indemnisation_claim", "claim_severity_bucket")


# Whole tables

@rounded
@query
def clean_clients(spark, folder):
    return _clean(spark, folder, "clients")


@rounded
@query
def clean_policies(spark, folder):
    return _clean(spark, folder, "policies")


@rounded
@query
def clean_vehicles(spark, folder):
    return _clean(spark, folder, "vehicles")


@rounded
@query
def clean_claims(spark, folder):
    return _clean(spark, folder, "claims")


@rounded
@query
def dim_client(spark, folder):
    return warehouse.dim_client(_clean(spark, folder, "clients"), unique=True)


@rounded
@query
def dim_policy(spark, folder):
    return warehouse.dim_policy(_clean(spark, folder, "policies"), unique=True)


@rounded
@query
def dim_vehicle(spark, folder):
    return warehouse.dim_vehicle(_clean(spark, folder, "vehicles"))


@query
def dim_time(spark, folder):
    clean = build.concurrently(spark, {n: (lambda n=n: _clean(spark, folder, n)) for n in ("policies", "claims")})
    return warehouse.dim_time(clean["policies"], clean["claims"])


def _staged_clean(spark, folder) -> dict[str, DataFrame]:
    return build.clean_tables(raw_tables(spark, folder), as_of=AS_OF, order_by=ORDER, staged=True)


def _wide(spark, folder) -> DataFrame:
    return build.stage_wide(_staged_clean(spark, folder))


@rounded
@query
def fact_claim(spark, folder):
    return warehouse.fact_claim(_wide(spark, folder))


@rounded
@query
def ml_claim(spark, folder):
    return warehouse.ml_claim(_wide(spark, folder))


# Learning, scoring and reports

@query
def training_features(spark, folder):
    df = delay_training.training_features(warehouse.ml_claim(_wide(spark, folder)))
    return df.select("is_delayed", "type_couverture", "marque", "income_band", "claim_month", "sla_jours", "vehicle_age")


@query
def stratified_split(spark, folder):
    return delay_training.stratified_split(scored_claims(spark, folder)).select("claim_id", "is_delayed", "split")


@query
def split_balance(spark, folder):
    parts = delay_training.stratified_split(scored_claims(spark, folder))
    return delay_training.split_balance(parts).withColumn("share", F.round("share", 6))


def _staged_learning(spark, folder) -> tuple[DataFrame, DataFrame]:
    clean = _staged_clean(spark, folder)
    wide = build.stage_wide(clean)
    return warehouse.ml_claim(wide), clean["clean_claims"]


def _within_one(*names: str):
    return F.forall(F.array(*names), lambda x: x.between(0, 1))


@query
def train_delay_models(spark, folder):
    """Rows each model was tested on, and whether its figures follow from the scores of these rows."""
    trained = delay_training.train_delay_models(_staged_learning(spark, folder)[0])
    again = [df.agg(F.avg((F.col("is_delayed") == F.col("prediction")).cast("double")).alias("again"), F.count(F.lit(1)).alias("scored_rows"),
                    F.min(F.col("delay_probability").between(0, 1)).alias("probabilities_ok")).withColumn("model", F.lit(name))
             for name, df in trained.scored.items()]
    both = trained.metrics.join(again[0].unionByName(again[1]), "model")
    figures = _within_one("accuracy", "auc", "precision_delayed", "recall_delayed") & (F.abs(F.col("accuracy") - F.col("again")) < 1e-9)
    return both.select("model", F.col("test_rows").cast("bigint").alias("test_rows"), "scored_rows", "probabilities_ok", figures.alias("figures_ok"))


@query
def train_duration_model(spark, folder):
    found = delay_training.train_duration_model(*_staged_learning(spark, folder))[1]
    return found.select("split", "rows", ((F.col("mae") >= 0) & (F.col("r2") <= 1)).alias("figures_ok"))


def _stored_zones(spark, folder) -> str:
    root = scratch_folder(spark, "zones")
    ml, clean = _staged_learning(spark, folder)
    tables.write_table(ml, root, "ml.ml_claim", "replace", "claim_id")
    tables.write_table(clean, root, "stg.clean_claims", "replace", "claim_id")
    return root


@query
def model_metrics_table(spark, folder):
    """The stored figures beside the stored matrices and class reports."""
    path = scratch_folder(spark, "models")
    jobs.train(spark, _stored_zones(spark, folder), path)
    cells = spark.read.parquet(f"{path}/matrices").groupBy("model").agg(
        F.sum("rows").alias("matrix_rows"), F.sum(F.when(F.col("label") == F.col("predicted"), F.col("rows")).otherwise(0)).alias("right")
    )
    reports = spark.read.parquet(f"{path}/reports").groupBy("model").agg(F.sum("support").alias("support"))
    both = spark.read.parquet(f"{path}/metrics").join(cells, "model").join(reports, "model")
    return both.select("model", F.col("test_rows").cast("bigint").alias("test_rows"), "matrix_rows", "support", (F.abs(F.col("accuracy") - F.col("right") / F.col("matrix_rows")) < 1e-9).alias("figures_ok"))


def _scores_checked(scored: DataFrame, days_ok) -> DataFrame:
    p = F.col("delay_probability")
    level = F.when(p <= 0.3, "Low").when(p <= 0.7, "Medium").otherwise("High")
    return scored.select("claim_id", p.between(0, 1).alias("probability_ok"), (F.col("risk_level") == level).alias("level_ok"), days_ok.alias("days_ok"))


def days_follow(scored: DataFrame):
    """Whether a row's days follow from the scores: some for a late claim, none for another one, and 0 for all where no claim is late."""
    late, days = F.col("delay_probability") > 0.5, F.col("predicted_delay_days")
    some_late = F.coalesce(scored.agg(F.max(late).alias("late")).scalar(), F.lit(False))
    return F.when(late, days.isNotNull()).when(some_late, days.isNull()).otherwise(F.coalesce(days == 0, F.lit(False)))


@query
def score_claims(spark, folder):
    """Scored claims, and whether probability, level and days obey their rules: days only above one half, none known below it unless no claim is above."""
    root, path = _stored_zones(spark, folder), scratch_folder(spark, "models")
    jobs.train(spark, root, path)
    scored = jobs.score(spark, root, path, scratch_folder(spark, "dashboard"), AS_OF)
    return _scores_checked(scored, days_follow(scored))


@query
def predicted_delay_days(spark, folder):
    return _risky(spark, folder).select("claim_id", "predicted_delay_days")


@query
def dashboard_json(spark, folder):
    path, scored = scratch_folder(spark, "dashboard"), _risky(spark, folder)
    dashboard.save_dashboard(scored, path, AS_OF)
    document = dashboard.read_dashboard(spark, path, scored)
    flat = document.select("summary.*", "risk_distribution", "high_risk_claims", "monthly_projection")
    return flat.select(
        "high_risk_count", "recommended_staff", F.round("estimated_cost_impact", 2).alias("estimated_cost_impact"),
        F.element_at("risk_distribution", "Medium").alias("medium"),
        F.concat_ws(",", F.transform("high_risk_claims", lambda r: r["claim_id"])).alias("top_claims"),
        F.col("monthly_projection.month").alias("month"), F.col("monthly_projection.staff_needed").alias("staff_needed"),
    )


# Streams

@query
def stream_ingest(spark, folder):
    path, target = arriving_csv(spark, folder), load(spark, folder, "orders").schema
    out, rejected, state = (scratch_folder(spark, n) for n in ("arrivals", "rejected", "checkpoint"))
    header = ingest.csv_header(spark, path)
    stream = arrivals.csv_arrivals(spark, path, header)
    arrivals.append_arrivals(stream, target, out, rejected, state).awaitTermination()
    return arrivals.read_arrivals(spark, out, target).drop(arrivals.BATCH)


@query
def stream_mixed_headers(spark, folder):
    path, target = _mixed_csv(spark, folder), load(spark, folder, "orders").schema
    out, rejected, state = (scratch_folder(spark, n) for n in ("arrivals", "rejected", "checkpoint"))
    arrivals.append_files(arrivals.csv_files(spark, f"{path}/*"), target, out, rejected, state).awaitTermination()
    return arrivals.read_arrivals(spark, out, target).drop(arrivals.BATCH)


@query
def stream_claims_once(spark, folder):
    """How often each claim comes out of a stream that is restarted between two deliveries, the second of which repeats the first."""
    arriving, out, state = (scratch_folder(spark, n) for n in ("arriving_claims", "claims", "checkpoint"))
    source = _raw(spark, folder, "claims").select("claim_id", "vehicle_id")
    for delivery in (source.filter("hash(vehicle_id) % 2 = 0"), source):
        delivery.write.mode("append").parquet(arriving)
        stream = arrivals.first_arrivals(spark.readStream.schema(source.schema).parquet(arriving))
        writer = stream.writeStream.option("checkpointLocation", state).trigger(availableNow=True).format("parquet")
        writer.start(out).awaitTermination()
    ids = apply_steps(spark.read.schema(source.schema).parquet(out), {"claim_id": text.normalized_id()})
    return ids.groupBy("claim_id").agg(F.count(F.lit(1)).alias("arrivals"))


@query
def stream_limits(spark, folder):
    """Limits that follow a stream of two deliveries: the ends, and whether the ranks of the quartiles are right within one percent."""
    arriving, out, state = (scratch_folder(spark, n) for n in ("arriving_items", "sketches", "checkpoint"))
    source, names = load(spark, folder, "lineitem").select("l_orderkey", "l_extendedprice", "l_quantity"), ["l_extendedprice", "l_quantity"]
    for part in (0, 1):
        source.filter(F.col("l_orderkey") % 2 == part).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(source.schema).parquet(arriving)
        arrivals.sketch_arrivals(stream, names, out, state).awaitTermination()
    places = (0.0, 0.25, 0.5, 0.75, 1.0)
    limits = arrivals.followed_limits(spark, out, places)

    def within(name: str, p: float, value: float):
        under, upto = (F.avg(c.cast("double")) for c in (F.col(name) < value, F.col(name) <= value))
        return (under <= p + 0.01) & (upto >= p - 0.01)

    rows = [F.struct(F.lit(n).alias("name"), F.count(n).alias("rows"), F.lit(limits[n][0]).alias("least"), F.lit(limits[n][-1]).alias("greatest"),
                     reduce(lambda a, b: a & b, [within(n, p, v) for p, v in zip(places, limits[n])]).alias("ranks_ok")) for n in names]
    return source.agg(F.array(*rows).alias("all")).select(F.inline("all"))


@query
def schema_history(spark, folder):
    """A table after a column was renamed and another added: old rows keep their values, and lack the new column."""
    root, rows = scratch_folder(spark, "zones"), load(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    tables.write_table(rows.filter("c_custkey % 3 > 0").drop("c_mktsegment"), root, "stg.clients", "replace", "c_custkey")
    snapshots.rename_columns(spark, tables.table_path(root, "stg.clients"), {"c_acctbal": "balance"})
    tables.write_table(rows.filter("c_custkey % 3 = 0").withColumnRenamed("c_acctbal", "balance"), root, "stg.clients", "append", "c_custkey", add_columns=True)
    return tables.read_table(spark, root, "stg.clients")


@query
def stream_score(spark, folder):
    raw = raw_tables(spark, folder)
    limits = build.learn_bounds(raw, AS_OF)
    clean = {n: stage(df, n) for n, df in build.clean_tables(raw, limits, AS_OF, ORDER).items()}
    wide = build.stage_wide(clean)
    limits["ml"] = warehouse.ml_bounds(wide)
    trained = delay_training.train_delay_models(warehouse.ml_claim(wide, limits["ml"]))
    saved = scratch_folder(spark, "saved_limits")
    bounds_table(spark, limits).write.parquet(saved)
    limits = read_bounds(spark.read.parquet(saved))
    arriving = scratch_folder(spark, "arriving_claims")
    source = schema.normalize_headers(raw["claims"])
    source.write.parquet(arriving)
    out, state = scratch_folder(spark, "scored"), scratch_folder(spark, "checkpoint")
    stream = spark.readStream.schema(source.schema).parquet(arriving)
    arrivals.score_arrivals(stream, clean, limits, trained.models[trained.best], None, out, state).awaitTermination()
    late = F.col("delay_probability") > 0.5
    return _scores_checked(spark.read.parquet(out), F.col("predicted_delay_days") == F.when(late, 30.0).otherwise(0.0))
