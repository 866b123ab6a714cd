"""The registered queries in plain SQL, written apart from the Spark code, for a check engine."""

from __future__ import annotations

from ..functions.text import CLAIM_STATUS, MISSING_WORDS
from ..plans import clients, warehouse
from ..plans.dashboard import METRICS
from ..sources.driver_tables import RAW_SQL, SOURCES
from ..sources.ingest import CSV_MISSING
from .inputs import ARRIVING_SQL, AS_OF, ORDER, SCORED_SQL


def _sql(text: str) -> str:
    tables = {t: t for names in SOURCES.values() for t in names}
    return text.format(**tables).replace("`", '"')


def _q(*words: str) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


YES = _q("1", "true", "vrai", "yes", "oui", "y", "t")
NO = _q("0", "false", "faux", "no", "non", "n", "f")


def strip(x):
    return f"regexp_replace({x}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"


def ident(x):
    return f"nullif(nullif(nullif(upper({strip(x)}), 'NAN'), 'NONE'), '')"


def missing(x):
    return f"case when lower({strip(x)}) in ({_q(*MISSING_WORDS)}) then null else {strip(x)} end"


def words(x):
    return f"nullif(nullif(nullif({strip(x)}, 'nan'), 'None'), '')"


def title(x):
    runs = f"regexp_extract_all(lower({x}), '(\\p{{L}}+|[^\\p{{L}}]+)')"
    return f"array_to_string(list_transform({runs}, lambda w: upper(w[1:1]) || w[2:]), '')"


def strict(x):
    dotted = f"replace(replace({x}, ' ', ''), ',', '.')"
    return (f"case when regexp_full_match({dotted}, '\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*') "
            f"then try_cast({dotted} as double) end")


def flex(x):
    m = f"lower({missing(x)})"
    chunk = f"regexp_extract(replace(replace({m}, ' ', ''), ',', '.'), '[-+]?[0-9]*\\.?[0-9]+')"
    return f"case when {m} in ({YES}) then 1.0 when {m} in ({NO}) then 0.0 else try_cast(nullif({chunk}, '') as double) end"


def count_(x):
    return f"case when floor({x}) >= 0 then cast(floor({x}) as bigint) end"


def flag(x):
    w = f"lower({strip(x)})"
    n = f"try_cast({w} as double)"
    return f"case when {w} in ({YES}) then true when {w} in ({NO}) then false when {n} = 1 then true when {n} = 0 then false end"


def stamp(x):
    s = strip(x)
    return (f"coalesce(try_cast(case when regexp_matches({s}, '^[0-9]{{4}}-') then {s} end as timestamp), "
            f"try_strptime({s}, '%d/%m/%Y %H:%M'), try_strptime({s}, '%d/%m/%Y'))")


def within(x, low=None, high=None):
    tests = ([f"{x} >= {low}"] if low is not None else []) + ([f"{x} <= {high}"] if high is not None else [])
    return f"case when {' and '.join(tests)} then {x} end"


def clip(x, low, high):
    return f"case when {x} is not null then least(greatest({x}, {low}), {high}) end"


def band(x, edges, labels):
    parts = " ".join(f"when {x} <= {e} then '{lab}'" for e, lab in zip(edges, labels))
    last = f" when {x} is not null then '{labels[-1]}'" if len(labels) > len(edges) else ""
    return f"case {parts}{last} end"


FIVE = ("very_low", "low", "mid", "high", "very_high")
AGE = ((24, 34, 44, 54, 64, 120), ("<25", "25-34", "35-44", "45-54", "55-64", "65+"))
CREDIT = ((450, 600, 750), ("poor", "fair", "good", "excellent"))
TENURE = ((180, 365, 730, 1095), ("<6m", "6-12m", "1-2y", "2-3y", "3y+"))
RISK = ((0.3, 0.7, 1.0), ("Low", "Medium", "High"))

STATUS_KEY = f"translate(regexp_replace(lower({words('s')}), '\\s+', '_', 'g'), 'éèêàç', 'eeeac')"


def status(x):
    key = STATUS_KEY.replace("(s,", f"({x},")
    cases = " ".join(f"when {_q(k)} then {_q(v)}" for k, v in CLAIM_STATUS.items())
    return f"case {key} {cases} else {title(words(x))} end"


def hours(a, b):
    return f"((epoch_us({b}) - epoch_us({a})) / 1000000.0 / 3600.0)"


RAW = {
    "raw_clients": _sql(RAW_SQL["clients"]),
    "raw_policies": _sql(RAW_SQL["policies"]),
    "raw_vehicles": _sql(RAW_SQL["vehicles"]),
    "raw_claims": _sql(RAW_SQL["claims"]),
}

# header spelling in the raw table -> column name
CLIENT_HEADERS = {
    "ID Client": "client_id", "Nom": "nom", "Prénom": "prenom", "Genre": "genre", "Age": "age",
    "Revenu Annuel": "revenu_annuel", "Score-Crédit": "score_credit", "Niveau Professionnel": "niveau_professionnel",
    "Gouvernorat": "gouvernorat", "Ville": "ville",
    **{c.replace("_", " "): c for c in (*clients.COUNTS, *clients.RISKS, *clients.FLAGS, "driving_behavior", "row_seq")},
}
CTES: dict[str, str] = dict(RAW)
CTES["n_clients"] = "select " + ", ".join(f'"{h}" as {c}' for h, c in CLIENT_HEADERS.items()) + " from raw_clients"
CTES["n_policies"] = "select clientid as client_id, * exclude (clientid) from raw_policies"
CTES["n_vehicles"] = "select vehicule_id as vehicle_id, contrat_id as contract_id, * exclude (vehicule_id, contrat_id) from raw_vehicles"
CTES["n_claims"] = ('select "Sinistre ID" as claim_id, "Montant Estimé / Dommage - claim" as montant_estime_dommage_claim, '
                    '* exclude ("Sinistre ID", "Montant Estimé / Dommage - claim") from raw_claims')

_typed = {"score_credit": "cast(score_credit as double)", "risque_fraude": "risque_fraude", "risque_global": "risque_global",
          "incidents_paiement_assureur": "cast(incidents_paiement_assureur as double)"}
_flags = {"vehicule_peu_polluant": "vehicule_peu_polluant",
          "changement_frequent_assureur": "case changement_frequent_assureur when 1 then true when 0 then false end"}


def _number(c):
    return _typed.get(c) or flex(c)


GENDER = (f"case when upper({strip('genre')}) in ('MASCULIN','HOMME','MALE','M') then 'M' "
          f"when upper({strip('genre')}) in ('FEMININ','FÉMININ','FEMME','FEMALE','F') then 'F' end")
DRIVING = (f"case {title(missing('driving_behavior'))} when 'Aggressive' then 'Aggressif' when 'Agressif' then 'Aggressif' "
           f"when 'Aggressif' then 'Aggressif' when 'Prudent' then 'Prudent' when 'Normal' then 'Normal' end")
CTES["p_clients"] = (
    f"select {ident('client_id')} as client_id, row_seq, {GENDER} as genre, {DRIVING} as driving_behavior, "
    + ", ".join(f"{title(missing(c))} as {c}" for c in clients.NAMES)
    + f", {within(flex('age'), 16, 100)} as age, {within(flex('revenu_annuel'), 0)} as revenu_annuel, "
    + f"{within(_number('score_credit'), 0, 1000)} as score_credit, "
    + ", ".join(f"{count_(_number(c))} as {c}" for c in clients.COUNTS) + ", "
    + ", ".join(f"{_number(c)} as {c}" for c in clients.RISKS) + ", "
    + ", ".join(f"cast({_flags.get(c) or flag(c)} as bigint) as {c}" for c in clients.FLAGS)
    + f" from n_clients where {ident('client_id')} is not null"
)


def _ends(names):
    return ", ".join(f"quantile_cont({c}, 0.01) as {c}_lo, quantile_cont({c}, 0.99) as {c}_hi" for c in names)


def _capped(names):
    return ", ".join(f"{clip(c, c + '_lo', c + '_hi')} as {c}" for c in names)


def _fifths(c):
    return ", ".join(f"quantile_cont({c}, {p}) as e{i}" for i, p in enumerate((0.2, 0.4, 0.6, 0.8)))


_clipped = list(clients.CLIPPED)
CTES["b_clients"] = f"select {_ends(_clipped)} from p_clients"
CTES["c_clients"] = f"select p.* replace ({_capped(_clipped)}) from p_clients p, b_clients"
CTES["e_clients"] = f"select {_fifths('revenu_annuel')} from c_clients"
CTES["clean_clients"] = (
    "select " + ", ".join(clients.OUTPUT) + " from (select c.*, "
    f"case when age > 0 then {band('age', *AGE)} end as age_group, {band('revenu_annuel', ('e0', 'e1', 'e2', 'e3'), FIVE)} as income_band, "
    f"{band('score_credit', *CREDIT)} as credit_band, "
    "greatest(0.0, coalesce(nb_infractions_majeures, 0) + coalesce(points_permis_retires, 0) / 10.0) as driving_risk_score, "
    "greatest(0.0, cast(coalesce(nb_retards_paiement, 0) + coalesce(incidents_paiement_assureur, 0) + coalesce(historique_dettes, 0) as double)) "
    "as financial_stress_score, "
    "coalesce(participe_conduite_responsable, 0) + coalesce(entretien_regulier, 0) + coalesce(engagement_securite_routiere, 0) "
    "as responsible_behavior_score from c_clients c, e_clients) qualify row_number() over (partition by client_id order by row_seq) = 1"
)

CTES["p_policies"] = (
    f"select n.* replace ({ident('contract_id')} as contract_id, {ident('client_id')} as client_id, {stamp('date_debut_contrat')} as date_debut_contrat, "
    f"{title(words('type_couverture'))} as type_couverture, {within(strict('prime_assurance_annuelle'), 0)} as prime_assurance_annuelle, "
    f"cast(greatest(nb_sinistres_precedents, 0) as double) as nb_sinistres_precedents, "
    f"{within(strict('delai_souscription_sinistre_jours'), 0)} as delai_souscription_sinistre_jours) from n_policies n"
)
_pol = ["prime_assurance_annuelle", "delai_souscription_sinistre_jours"]
CTES["b_policies"] = f"select {_ends(_pol)} from p_policies"
_days = "floor((epoch_us(date_fin_contrat) - epoch_us(date_debut_contrat)) / 86400000000.0)"
CTES["clean_policies"] = (
    f"select *, {band('policy_duration_days', *TENURE)} as policy_tenure_bucket from (select p.* replace ({_capped(_pol)}), "
    f"{within(_days, 0)} as policy_duration_days from p_policies p, b_policies where contract_id is not null) "
    "qualify row_number() over (partition by contract_id order by row_seq) = 1"
)

Y = AS_OF.year
CTES["p_vehicles"] = (
    f"select *, {within(f'({Y}.0 - annee_modele)', 0, 100)} as vehicle_age from (select n.* replace ({ident('vehicle_id')} as vehicle_id, "
    f"{ident('contract_id')} as contract_id, {title(words('type_vehicule'))} as type_vehicule, {title(words('marque'))} as marque, "
    f"{title(words('modele'))} as modele, {title(words('usage_vehicule'))} as usage_vehicule, "
    f"replace(upper({words('immatriculation')}), ' ', '') as immatriculation, {within(strict('annee_modele'), 1970, Y + 1)} as annee_modele, "
    f"{within('cast(puissance_fiscale as double)', 0, 200)} as puissance_fiscale, {within(strict('kilometrage_actuel'), 0, 3000000)} as kilometrage_actuel, "
    f"{within('valeur_vehicule', 0, 50000000)} as valeur_vehicule) from n_vehicles n)"
)
_veh = ["puissance_fiscale", "kilometrage_actuel", "valeur_vehicule"]
CTES["b_vehicles"] = f"select {_ends(_veh)} from p_vehicles"
CTES["c_vehicles"] = (
    f"select *, {within('kilometrage_actuel / nullif(vehicle_age, 0)', 0, 300000)} as mileage_per_year from "
    f"(select p.* replace ({_capped(_veh)}) from p_vehicles p, b_vehicles)"
)
CTES["e_vehicles"] = f"select {_ends(['mileage_per_year'])}, {_fifths('valeur_vehicule')} from c_vehicles"
CTES["clean_vehicles"] = (
    f"select c.* replace ({_capped(['mileage_per_year'])}), {band('valeur_vehicule', ('e0', 'e1', 'e2', 'e3'), FIVE)} as vehicle_value_band "
    "from c_vehicles c, e_vehicles where vehicle_id is not null qualify row_number() over (partition by vehicle_id order by row_seq) = 1"
)

_h = hours("date_sinistre_claim", "date_cloture_claim")
_both = "date_sinistre_claim is not null and date_cloture_claim is not null"
CTES["q_claims"] = (
    f"select n.* replace ({ident('claim_id')} as claim_id, {ident('contract_id')} as contract_id, {ident('client_id')} as client_id, "
    f"{ident('vehicle_id')} as vehicle_id, {stamp('date_sinistre_claim')} as date_sinistre_claim, {stamp('date_cloture_claim')} as date_cloture_claim, "
    f"{title(words('type_sinistre_claim'))} as type_sinistre_claim, {status('statut_sinistre_claim')} as statut_sinistre_claim, "
    + "nullif(nullif(nullif(" + strip("regexp_replace(description_sinistre_claim, '\\s+', ' ', 'g')") + ", 'nan'), 'None'), '') as description_sinistre_claim, "
    f"{within(strict('montant_estime_dommage_claim'), 0)} as montant_estime_dommage_claim, {within('montant_indemnisation_claim', 0)} as montant_indemnisation_claim, "
    f"cast({flag('est_frauduleux_claim')} as bigint) as est_frauduleux_claim, {flag('incoherence_dommages')} as incoherence_dommages, "
    f"{within(strict('sla_jours'), 0)} as sla_jours, {within(strict('duree_traitement_jours'), 0)} as duree_traitement_jours, "
    f"{within(strict('duree_traitement_heures'), 0)} as duree_traitement_heures) from n_claims n"
)
CTES["p_claims"] = (
    f"select q.* replace (case when {_both} then case when {_h} >= 0 then {_h} end else duree_traitement_heures end as duree_traitement_heures, "
    f"case when {_both} then case when {_h} >= 0 then {_h} / 24.0 end else duree_traitement_jours end as duree_traitement_jours) from q_claims q"
)
_amounts = ["montant_estime_dommage_claim", "montant_indemnisation_claim"]
CTES["b_claims"] = f"select {_ends(_amounts)} from p_claims"
CTES["c_claims"] = (
    "select *, montant_indemnisation_claim - montant_estime_dommage_claim as claim_gap_amount, "
    "(montant_indemnisation_claim - montant_estime_dommage_claim) / nullif(montant_estime_dommage_claim, 0) as claim_gap_ratio, "
    "case when duree_traitement_jours > sla_jours then 1::bigint else 0::bigint end as is_delayed "
    f"from (select p.* replace ({_capped(_amounts)}) from p_claims p, b_claims)"
)
CTES["e_claims"] = (
    f"select {_ends(['claim_gap_ratio'])}, quantile_cont(montant_indemnisation_claim, 0.5) as e0, "
    "quantile_cont(montant_indemnisation_claim, 0.8) as e1, quantile_cont(montant_indemnisation_claim, 0.95) as e2 from c_claims"
)
CTES["clean_claims"] = (
    f"select c.* replace ({_capped(['claim_gap_ratio'])}), "
    f"{band('montant_indemnisation_claim', ('e0', 'e1', 'e2'), ('low', 'medium', 'high', 'very_high'))} as claim_severity_bucket "
    "from c_claims c, e_claims where claim_id is not null qualify row_number() over (partition by claim_id order by "
    + ", ".join(f"{c} asc nulls first" for c in ORDER["claims"]) + ") = 1"
)


def _pick(alias, names, skip=()):
    return ", ".join(f"{alias}.{n}" for n in names if n not in skip)


CTES["u_fact"] = (
    f"select c.* exclude (client_id, date_cloture_claim, duree_traitement_jours, duree_traitement_heures, sla_jours, is_delayed), "
    f"coalesce(c.client_id, p.client_id) as client_id, {_pick('p', warehouse.FACT_POLICY)}, {_pick('v', warehouse.FACT_VEHICLE)}, "
    "montant_indemnisation_claim / nullif(p.prime_assurance_annuelle, 0) as loss_ratio, "
    "cast(strftime(date_sinistre_claim, '%Y%m%d') as bigint) as date_key "
    "from clean_claims c left join clean_policies p on c.contract_id = p.contract_id left join clean_vehicles v on c.vehicle_id = v.vehicle_id"
)
CTES["u_fact_ends"] = f"select {_ends(['loss_ratio'])} from u_fact"
CTES["fact_claim"] = (
    f"select f.* replace ({_capped(['loss_ratio'])}), {_pick('k', warehouse.FACT_CLIENT)} "
    "from u_fact f cross join u_fact_ends left join clean_clients k on f.client_id = k.client_id"
)
CTES["u_ml"] = (
    "select c.* exclude (date_cloture_claim, duree_traitement_jours, duree_traitement_heures, description_sinistre_claim), "
    f"{_pick('p', warehouse.ML_POLICY)}, {_pick('k', warehouse.ML_CLIENT)}, {_pick('v', warehouse.ML_VEHICLE)}, "
    "p.prime_assurance_annuelle / nullif(v.valeur_vehicule, 0) as premium_to_value_ratio, "
    "cast(year(date_sinistre_claim) as int) as claim_year, cast(month(date_sinistre_claim) as int) as claim_month, "
    "cast(quarter(date_sinistre_claim) as int) as claim_quarter, cast(isodow(date_sinistre_claim) - 1 as int) as claim_dayofweek, "
    "cast(hour(date_sinistre_claim) as int) as claim_hour "
    "from clean_claims c left join clean_policies p on c.contract_id = p.contract_id "
    "left join clean_clients k on c.client_id = k.client_id left join clean_vehicles v on c.vehicle_id = v.vehicle_id"
)
CTES["u_ml_ends"] = f"select {_ends(['premium_to_value_ratio'])} from u_ml"
CTES["ml_claim"] = f"select m.* replace ({_capped(['premium_to_value_ratio'])}) from u_ml m, u_ml_ends"
CTES["days"] = (
    "select distinct cast(d as date) as full_date from (select date_debut_contrat as d from clean_policies union all "
    "select date_fin_contrat from clean_policies union all select date_sinistre_claim from clean_claims union all "
    "select date_cloture_claim from clean_claims) where d is not null"
)
CTES["dim_time"] = (
    "select full_date, cast(strftime(full_date, '%Y%m%d') as int) as date_key, cast(year(full_date) as int) as year, "
    "cast(month(full_date) as int) as month, cast(day(full_date) as int) as day, cast(quarter(full_date) as int) as quarter, "
    "cast(week(full_date) as int) as week_of_year from days"
)

CTES["scored"] = _sql(SCORED_SQL)
CTES["risky"] = (
    f"select *, case when delay_probability >= 0 then {band('delay_probability', *RISK)} end as risk_level, "
    "case when delay_probability > 0.5 then 30.0::double else 0.0::double end as predicted_delay_days from scored"
)
CTES["called"] = "select *, cast(delay_probability > 0.5 as int) as prediction from scored"
CTES["arriving"] = _sql(ARRIVING_SQL)
_na = _q(*[w for w in CSV_MISSING if w])
CTES["conformed"] = (
    "select cast(o_orderkey as bigint) as o_orderkey, cast(o_custkey as bigint) as o_custkey, cast(null as varchar) as o_orderstatus, "
    "try_cast(o_totalprice as double) as o_totalprice, try_strptime(o_orderdate, '%d/%m/%Y') as o_orderdate, "
    f"case when o_orderpriority in ({_na}) then null else o_orderpriority end as o_orderpriority from arriving"
)
CTES["metrics"] = (
    "select cast(count_if(risk_level = 'High') as bigint) as high_risk_count, cast(count_if(risk_level = 'Medium') as bigint) as medium_risk_count, "
    "cast(count_if(risk_level = 'Low') as bigint) as low_risk_count, count(*) as total_active_claims, sum(delay_probability) as estimated_delayed_claims, "
    "cast(sum(predicted_delay_days) as bigint) as estimated_total_delay_days, avg(predicted_delay_days) as avg_predicted_delay_days, "
    "sum(montant_indemnisation_claim) filter (delay_probability > 0.5) as estimated_cost_impact, "
    "avg(montant_indemnisation_claim) filter (delay_probability > 0.5) as avg_cost_per_delayed_claim, "
    "greatest(1, cast(ceil((2.0 * count_if(risk_level = 'High') + 1.5 * count_if(risk_level = 'Medium') + count_if(risk_level = 'Low')) / 50.0) as bigint)) "
    "as recommended_staff, 7::int as projection_month from risky"
)
CTES["cells"] = "select is_delayed as label, prediction as predicted, count(*) as rows from called group by all"
CTES["ranks"] = (
    "select is_delayed, rank() over (order by delay_probability) + (count(*) over (partition by delay_probability) - 1) / 2.0 as r from scored"
)
CTES["auc"] = (
    "select (sum(r) filter (is_delayed = 1) - count_if(is_delayed = 1) * (count_if(is_delayed = 1) + 1) / 2.0) / "
    "(count_if(is_delayed = 1)::double * count_if(is_delayed = 0)) as auc from ranks"
)
CTES["ids_claims"] = (f"select {ident('claim_id')} as claim_id, {ident('contract_id')} as contract_id, {ident('client_id')} as client_id, "
                      f"{ident('vehicle_id')} as vehicle_id, quantite from n_claims")
CTES["ids_policies"] = f"select n.* replace ({ident('contract_id')} as contract_id, {ident('client_id')} as client_id) from n_policies n"
CTES["one_policy"] = "select * from ids_policies qualify row_number() over (partition by contract_id order by row_seq) = 1"
CTES["ids_clients"] = f"select n.* replace ({ident('client_id')} as client_id) from n_clients n"
CTES["one_client"] = "select * from ids_clients qualify row_number() over (partition by client_id order by row_seq) = 1"
CTES["one_vehicle"] = (f"select n.* replace ({ident('vehicle_id')} as vehicle_id) from n_vehicles n "
                       f"qualify row_number() over (partition by {ident('vehicle_id')} order by row_seq) = 1")


def _needed(sql: str) -> list[str]:
    """CTE names the text uses, each after the ones it uses itself."""
    import re

    found: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in found and re.search(rf"\b{name}\b", text):
                visit(CTES[name].replace(name, ""))
                if name not in found:
                    found.append(name)

    visit(sql)
    return found


def with_ctes(sql: str) -> str:
    names = _needed(sql)
    return ("with " + ", ".join(f"{n} as ({CTES[n]})" for n in names) + " " if names else "") + sql


def _profile() -> str:
    kinds = {"score_credit": "BIGINT", "incidents_paiement_assureur": "BIGINT", "changement_frequent_assureur": "BIGINT",
             "risque_fraude": "FLOAT", "risque_global": "FLOAT", "vehicule_peu_polluant": "BIT"}
    parts = []
    for c in CLIENT_HEADERS.values():
        if c == "row_seq":
            continue
        if c in kinds:
            parts.append(f"select '{c}' as column_name, '{kinds[c]}' as storage_type, null::int as max_length, count({c}) as filled from n_clients")
        else:
            parts.append(f"select '{c}', case when coalesce(max(length({c})), 0) <= 50 then 'NVARCHAR(50)' when max(length({c})) <= 100 then 'NVARCHAR(100)' "
                         f"when max(length({c})) <= 255 then 'NVARCHAR(255)' else 'NVARCHAR(MAX)' end, max(length({c}))::int, count({c}) from n_clients")
    first = parts.index(next(p for p in parts if "as column_name" in p))
    parts.insert(0, parts.pop(first))
    return " union all ".join(parts)


_KINDS = {
    "numeric": ("montant_estime_dommage_claim", "montant_indemnisation_claim", "est_frauduleux_claim", "sla_jours", "duree_traitement_jours",
                "duree_traitement_heures", "quantite", "taux"),
    "text": ("claim_id", "contract_id", "client_id", "vehicle_id", "type_sinistre_claim", "statut_sinistre_claim", "description_sinistre_claim"),
    "none": ("date_sinistre_claim", "date_cloture_claim", "incoherence_dommages", "nature_sinistre_consistante"),
}
_TEN = ("clean_clients", "clean_policies", "clean_vehicles", "clean_claims")
_TEN_COUNTS = " union all ".join(
    f"select '{n}' as table_name, count(*) as rows from {src}" for n, src in
    [(n, n) for n in _TEN] + [("dim_client", "clean_clients"), ("dim_policy", "clean_policies"), ("dim_vehicle", "clean_vehicles"),
                              ("dim_time", "dim_time"), ("fact_claim", "clean_claims"), ("ml_claim", "clean_claims")]
)
_PS = (0.01, 0.2, 0.5, 0.95, 0.99)


def _modes(columns):
    return " union all ".join(
        f"(select '{c}' as column_name, {c} as value, count(*) as rows from p_clients where {c} is not null group by {c} order by rows desc, value limit 1)"
        for c in columns)


def _filled(columns, table):
    return ", ".join(f"coalesce({c}, (select quantile_cont({c}, 0.5) from {table})) as {c}" for c in columns)


# A fifth of each class, rounded up, is held out.
_tested = ("(select cast(sum(n) as bigint) from (select cast(ceil(count(*) / 5.0) as bigint) as n from ml_claim where is_delayed is not null group by is_delayed))")
_models = "(values ('random_forest'), ('boosted_trees')) m(model)"
_active = "coalesce(statut_sinistre_claim in ('Ouvert', 'En_cours', 'En_cours_d_expertise'), false)"

SQL: dict[str, str] = {
    "scan_table": "select * from lineitem",
    "ingest_csv_scan": "select * from arriving",
    "ingest_conform": "select * from conformed",
    "ingest_append": "select * from orders union all select * from conformed",
    "ingest_quarantine": "select o_orderkey, o_totalprice, o_orderdate, concat_ws(',', case when o_totalprice = 'abc' then 'o_totalprice' end, "
                         "case when o_orderdate = '32/01/2020' then 'o_orderdate' end) as reason from arriving where o_totalprice = 'abc' or o_orderdate = '32/01/2020'",
    "ingest_corrupt_lines": "select 'raw.orders' as table_name, count(*) as read, count(*) filter (not bad) as appended, count(*) filter (bad) as set_aside, "
                            "count(*) filter (not bad) as grown, count(*) filter (corrupt) as corrupt from (select corrupt, corrupt or o_totalprice = 'abc' "
                            "or o_orderdate = '32/01/2020' as bad from (select *, o_orderkey::bigint % 30 = 7 as corrupt from arriving))",
    "ingest_dry_run": "select o_orderkey, o_totalprice, (select count(*) from conformed) as would_append from conformed order by o_orderkey limit 3",
    "ingest_summary": "select table_name, n as read, n as appended, 0::bigint as set_aside from (select 'raw.customer' as table_name, count(*) as n from customer "
                      "union all select 'raw.orders', count(*) from orders union all select 'raw.part', count(*) from part "
                      "union all select 'raw.lineitem', count(*) from lineitem union all select 'total', (select count(*) from customer) + (select count(*) from orders) "
                      "+ (select count(*) from part) + (select count(*) from lineitem))",
    "load_replace": "select * from customer",
    "load_append": "select * from part union all select * from part",
    "load_all_counts": _TEN_COUNTS,
    "pipeline_row_counts": _TEN_COUNTS,
    "schema_diff": "select 'extra_column' as column_name, 'extra' as side, count(*) as filled from arriving union all select 'o_custkey', 'both', count(o_custkey) from orders "
                   "union all select 'o_orderdate', 'both', count(o_orderdate) from orders union all select 'o_orderkey', 'both', count(o_orderkey) from orders "
                   "union all select 'o_orderpriority', 'both', count(o_orderpriority) from orders union all select 'o_orderstatus', 'missing', count(o_orderstatus) from orders "
                   "union all select 'o_totalprice', 'both', count(o_totalprice) from orders",
    "profile_storage_types": _profile(),
    "pk_violations": "select claim_id as key, count(*) as rows from ids_claims group by 1 having count(*) > 1 or claim_id is null",
    "write_rejects": "select contract_id, n.client_id, row_seq, case when contract_id is null then 'null key' else 'repeated key' end as reason "
                     f"from (select {ident('contract_id')} as contract_id, client_id, row_seq, count(*) over (partition by {ident('contract_id')}) as n_same from n_policies) n "
                     "where contract_id is null or n_same > 1",
    "sanitize_nonfinite": "select l_orderkey, l_linenumber, case when l_suppkey % 5 > 2 then l_tax end as value from lineitem",
    "normalize_columns": "select " + ", ".join(f'"{h}" as {"id_client" if c == "client_id" else c}' for h, c in CLIENT_HEADERS.items()) + " from raw_clients",
    "require_column": "select vehicle_id, contract_id, row_seq from n_vehicles",
    "optional_defaults": "select contract_id, statut_commande, row_seq, 'Unknown' as statut_sinistre_claim, null::double as sla_jours from n_policies",
    "whitelist_projection": "select vehicle_id, contract_id, type_vehicule, marque, modele, annee_modele, puissance_fiscale, kilometrage_actuel, valeur_vehicule, usage_vehicule from n_vehicles",
    "drop_leakage_columns": "select claim_id, taux, sla_jours from n_claims",
    "feature_types": " union all ".join(f"select '{c}' as column_name, '{k}' as kind, count({c}) as filled from p_claims" for k, cs in _KINDS.items() for c in cs),
    "normalize_id": f"select claim_id, {ident('claim_id')} as claim_key, {ident('client_id')} as client_key, cast(cast(quantite as bigint) as varchar) as number_key from n_claims",
    "missing_tokens": "select row_seq, " + ", ".join(f"{missing(c)} as {c}_ok" for c in ("nom", "prenom", "genre")) + " from n_clients",
    "safe_numeric": f"select row_seq, {strict('prime_assurance_annuelle')} as prime, {strict('delai_souscription_sinistre_jours')} as delai, {strict('type_couverture')} as couverture from n_policies",
    "flex_numeric": "select row_seq, " + ", ".join(f"{flex(c)} as {c}_n" for c in ("age", "revenu_annuel", "nb_infractions_majeures", "points_permis_retires",
                                                                                  "historique_dettes", "risque_financier", "nombre_enfants")) + " from n_clients",
    "int_count": "select row_seq, " + ", ".join(f"{count_(_number(c))} as {c}_n" for c in clients.COUNTS) + " from n_clients",
    "safe_bool": "select row_seq, " + ", ".join(f"{_flags.get(c) or flag(c)} as {c}_b" for c in clients.FLAGS) + " from n_clients",
    "safe_datetime": f"select row_seq, {stamp('date_debut_contrat')} as debut, date_fin_contrat as fin from n_policies",
    "clean_text_title": "select row_seq, " + ", ".join(f"{title(words(c))} as {c}_t" for c in ("prenom", "ville", "nom")) + " from n_clients",
    "clean_text_modes": f"select row_seq, {title(words('usage_vehicule'))} as usage_title, upper({words('usage_vehicule')}) as usage_upper, "
                        f"lower({words('usage_vehicule')}) as usage_lower, {words('usage_vehicule')} as usage_none from n_vehicles",
    "collapse_whitespace": "select claim_id, nullif(nullif(nullif(" + strip("regexp_replace(description_sinistre_claim, '\\s+', ' ', 'g')")
                           + ", 'nan'), 'None'), '') as description from n_claims",
    "plate_normalize": f"select row_seq, replace(upper({words('immatriculation')}), ' ', '') as plaque from n_vehicles",
    "map_gender": f"select row_seq, genre, {GENDER} as genre_mf from n_clients",
    "map_driving_behavior": f"select row_seq, {DRIVING} as conduite from n_clients",
    "std_status": f"select claim_id, statut_sinistre_claim, {status('statut_sinistre_claim')} as statut from n_claims",
    "range_nullify": f"select row_seq, {within(strict('annee_modele'), 1970, Y + 1)} as annee_modele, {within('cast(puissance_fiscale as double)', 0, 200)} as puissance_fiscale, "
                     f"{within(strict('kilometrage_actuel'), 0, 3000000)} as kilometrage_actuel, {within('valeur_vehicule', 0, 50000000)} as valeur_vehicule from n_vehicles",
    "floor_zero": "select row_seq, cast(greatest(nb_sinistres_precedents, 0) as double) as sinistres from n_policies",
    "safe_ratio": "select row_seq, kilometrage_actuel / nullif(vehicle_age, 0) as km_an, kilometrage_actuel / nullif(valeur_vehicule, 0) as km_valeur from p_vehicles",
    "risk_scores": "select client_id, driving_risk_score, financial_stress_score, responsible_behavior_score from clean_clients",
    "elapsed_days": f"select row_seq, {within(_days, 0)} as jours from p_policies",
    "claim_duration": "select claim_id, vehicle_id, duree_traitement_jours, duree_traitement_heures from p_claims",
    "delay_label": "select claim_id, vehicle_id, case when duree_traitement_jours > sla_jours then 1::bigint else 0::bigint end as is_delayed, "
                   "cast(duree_traitement_jours > sla_jours as bigint) as known_label from p_claims",
    "claim_gap": "select claim_id, vehicle_id, montant_indemnisation_claim - montant_estime_dommage_claim as claim_gap_amount, "
                 "(montant_indemnisation_claim - montant_estime_dommage_claim) / nullif(montant_estime_dommage_claim, 0) as claim_gap_ratio from p_claims",
    "vehicle_age": "select row_seq, vehicle_age from p_vehicles",
    "date_parts": "select event_id, cast(year(ts) as int) as claim_year, cast(month(ts) as int) as claim_month, cast(quarter(ts) as int) as claim_quarter, "
                  "cast(isodow(ts) - 1 as int) as claim_dayofweek, cast(hour(ts) as int) as claim_hour from events",
    "date_key": "select event_id, cast(strftime(ts, '%Y%m%d') as int) as date_key from events",
    "drop_null_pk": "select claim_id, n.vehicle_id, quantite from (select " + ident("claim_id") + " as claim_id, vehicle_id, quantite from n_claims) n where claim_id is not null",
    "labelled_rows": "select claim_id, is_delayed from scored where quantite > 10",
    "active_claims": "select claim_id, statut_sinistre_claim from scored where statut_sinistre_claim in ('Ouvert', 'En_cours', 'En_cours_d_expertise')",
    "active_claims_fallback": "select claim_id, nullif(statut_sinistre_claim, 'En_cours') as statut_sinistre_claim from scored",
    "duration_training_rows": "select claim_id, duree_traitement_jours from clean_claims where is_delayed = 1 and duree_traitement_jours is not null",
    "predicted_delayed": "select claim_id, delay_probability from scored where delay_probability > 0.5",
    "fact_join_policy": "select l.contract_id, l.claim_id, l.quantite, type_couverture, statut_commande from ids_claims l left join one_policy p on l.contract_id = p.contract_id",
    "fact_join_client": "select claim_id, l.contract_id, vehicle_id, coalesce(l.client_id, p.client_id) as client_id, k.gouvernorat from ids_claims l "
                        "left join one_policy p on l.contract_id = p.contract_id left join one_client k on coalesce(l.client_id, p.client_id) = k.client_id",
    "coalesce_client": "select claim_id, vehicle_id, coalesce(l.client_id, p.client_id) as client_id from ids_claims l left join one_policy p on l.contract_id = p.contract_id",
    "fact_join_vehicle": "select l.vehicle_id, claim_id, quantite, marque, modele from ids_claims l left join one_vehicle v on l.vehicle_id = v.vehicle_id",
    "ml_wide_join": "select claim_id, type_couverture, marque, genre, income_band from clean_claims c left join clean_policies p on c.contract_id = p.contract_id "
                    "left join clean_clients k on c.client_id = k.client_id left join clean_vehicles v on c.vehicle_id = v.vehicle_id",
    "lookup_join_rowcount": "select count(*) as rows, cast(count_if(o_custkey in (select l_orderkey from lineitem)) as bigint) as matched from orders",
    "quantiles": " union all ".join(f"select '{c}' as column_name, {p}::double as probability, quantile_cont({c}, {p}) as value from lineitem"
                                    for c in ("l_extendedprice", "l_quantity", "l_tax") for p in _PS),
    "clip_outliers": f"with v as (select l_orderkey, l_linenumber, l_extendedprice, nullif(l_tax, 0) as l_tax from lineitem), "
                     f"b as (select {_ends(['l_extendedprice', 'l_tax'])} from v) select v.* replace ({_capped(['l_extendedprice', 'l_tax'])}) from v, b",
    "risk_distribution": "select risk_level, count(*) as claims from risky group by 1",
    "label_distribution": "select is_delayed, count(*) as rows from scored group by 1",
    "dashboard_metrics": "select " + ", ".join(f"round({c}, 4) as {c}" if c.startswith(("avg", "estimated_d", "estimated_c")) else c for c in METRICS) + " from metrics",
    "recommended_staff": "select recommended_staff from metrics",
    "impute_median": f"select row_seq, {_filled(['annee_modele', 'kilometrage_actuel', 'valeur_vehicule', 'vehicle_age'], 'p_vehicles')} from p_vehicles",
    "impute_mode": _modes(("genre", "prenom", "niveau_professionnel", "driving_behavior", "gouvernorat")),
    "standard_scale": " union all ".join(f"select '{c}' as column_name, round(avg({c}), 4) as mean, round(stddev_pop({c}), 4) as deviation from lineitem"
                                         for c in ("l_quantity", "l_extendedprice", "l_tax")),
    "class_weights": "select is_delayed, count(*) as rows, round((select count(*) from scored) / (2.0::double * count(*)), 6) as balanced_weight, "
                     "case when is_delayed = 1 then round((select count(*) from scored where is_delayed = 0)::double / count(*), 6) else 1.0::double end as boost_weight "
                     "from scored group by 1",
    "confusion_matrix": "select label, predicted, rows from cells",
    "classification_report": "select k.class, round(tp / nullif(pred, 0)::double, 6) as precision, round(tp / sup::double, 6) as recall, "
                             "round(2 * tp / (pred + sup)::double, 6) as f1, sup as support from (select c.class, "
                             "cast((select sum(rows) from cells where label = c.class and predicted = c.class) as bigint) as tp, "
                             "cast((select sum(rows) from cells where predicted = c.class) as bigint) as pred, "
                             "cast((select sum(rows) from cells where label = c.class) as bigint) as sup from (select 0 as class union all select 1) c) k",
    "roc_auc": "select round(auc, 6) as auc from auc",
    "regression_metrics": "select round(avg(abs(l_quantity - l_linenumber)), 6) as mae, round(1 - sum((l_quantity - l_linenumber) * (l_quantity - l_linenumber)) / "
                          "(select sum((l_quantity - m) * (l_quantity - m)) from lineitem, (select avg(l_quantity) as m from lineitem)), 6) as r2, count(*) as rows from lineitem",
    "distinct_status": f"select distinct {status('statut_sinistre_claim')} as statut from n_claims",
    "dedupe_keep_first": "select l_orderkey, l_partkey, l_quantity, l_shipdate, l_extendedprice from lineitem qualify row_number() over "
                         "(partition by l_orderkey order by l_shipdate, l_extendedprice, l_partkey, l_quantity) = 1",
    "top_high_risk": "select claim_id, delay_probability, contract_id, predicted_delay_days from risky where risk_level = 'High' order by delay_probability desc, claim_id limit 10",
    "best_model": "select case when auc >= 0.5 then 'random_forest' else 'boosted_trees' end as model, round(greatest(auc, 1 - auc), 6) as auc from auc",
    "age_group": f"select row_seq, age, case when age > 0 then {band('age', *AGE)} end as age_group from p_clients",
    "credit_band": f"select row_seq, score_credit, {band('score_credit', *CREDIT)} as credit_band from p_clients",
    "tenure_bucket": "select contract_id, policy_duration_days, policy_tenure_bucket from clean_policies",
    "risk_level": "select claim_id, risk_level from risky",
    "income_band": "select client_id, revenu_annuel, income_band from clean_clients",
    "vehicle_value_band": "select vehicle_id, valeur_vehicule, vehicle_value_band from clean_vehicles",
    "claim_severity_bucket": "select claim_id, montant_indemnisation_claim, claim_severity_bucket from clean_claims",
    "clean_clients": "select * from clean_clients",
    "clean_policies": "select * from clean_policies",
    "clean_vehicles": "select * from clean_vehicles",
    "clean_claims": "select * from clean_claims",
    "dim_client": "select " + ", ".join(warehouse.DIM_CLIENT) + " from clean_clients",
    "dim_policy": "select " + ", ".join(warehouse.DIM_POLICY) + " from clean_policies",
    "dim_vehicle": "select " + ", ".join(warehouse.DIM_VEHICLE) + " from clean_vehicles",
    "dim_time": "select * from dim_time",
    "fact_claim": "select * from fact_claim",
    "ml_claim": "select * from ml_claim",
    "training_features": "select cast(is_delayed as int) as is_delayed, type_couverture, marque, income_band, claim_month, sla_jours, vehicle_age from ml_claim where is_delayed is not null",
    "stratified_split": "select claim_id, is_delayed, case when rank() over (partition by is_delayed order by substr(md5(concat(claim_id, '42')), 1, 13)) "
                        "<= ceil(count(*) over (partition by is_delayed) / 5.0) then 'test' else 'train' end as split from scored",
    "split_balance": "select split, is_delayed, count(*) as rows, round(count(*) / sum(count(*)) over (partition by split)::double, 6) as share "
                     "from (select is_delayed, case when rank() over (partition by is_delayed order by substr(md5(concat(claim_id, '42')), 1, 13)) "
                     "<= ceil(count(*) over (partition by is_delayed) / 5.0) then 'test' else 'train' end as split from scored) group by split, is_delayed",
    "ingest_mixed_headers": "select * replace (case when o_orderkey % 2 = 0 then o_orderpriority end as o_orderpriority) from conformed",
    "stream_mixed_headers": "select * replace (case when o_orderkey % 2 = 0 then o_orderpriority end as o_orderpriority) from conformed "
                            "where o_totalprice is not null and o_orderdate is not null",
    "stream_claims_once": "select claim_id, 1::bigint as arrivals from clean_claims",
    "stream_limits": "select 'l_extendedprice' as name, count(l_extendedprice) as rows, min(l_extendedprice) as least, max(l_extendedprice) as greatest, true as ranks_ok from lineitem "
                     "union all select 'l_quantity', count(l_quantity), min(l_quantity), max(l_quantity), true from lineitem",
    "schema_history": "select c_custkey, c_acctbal as balance, case when c_custkey % 3 = 0 then c_mktsegment end as c_mktsegment from customer",
    "load_versions": "with k as (select distinct o_orderkey from orders) select 2::bigint as version, count(*) as rows, max(o_orderkey) as greatest from k where o_orderkey % 5 = 1 "
                     "union all select 3::bigint, count(*), max(o_orderkey) from k where o_orderkey % 5 in (1, 2)",
    "train_delay_models": f"select model, {_tested} as test_rows, {_tested} as scored_rows, true as probabilities_ok, true as figures_ok from {_models}",
    "train_duration_model": "select case when substr(md5(concat(claim_id, '42')), 1, 13) <= '3333333333333' then 'test' else 'train' end as split, "
                            "count(*) as rows, true as figures_ok from clean_claims where is_delayed = 1 and duree_traitement_jours is not null group by 1",
    "model_metrics_table": f"select model, {_tested} as test_rows, {_tested} as matrix_rows, {_tested} as support, true as figures_ok from {_models}",
    "score_claims": f"select claim_id, true as probability_ok, true as level_ok, true as days_ok from ml_claim where {_active} or not exists (from ml_claim where {_active})",
    "stream_score": "select claim_id, true as probability_ok, true as level_ok, true as days_ok from clean_claims",
    "predicted_delay_days": "select claim_id, predicted_delay_days from risky",
    "dashboard_json": "select high_risk_count, recommended_staff, round(estimated_cost_impact, 2) as estimated_cost_impact, medium_risk_count as medium, "
                      "(select string_agg(claim_id, ',' order by delay_probability desc, claim_id) from (select claim_id, delay_probability from risky where risk_level = 'High' "
                      "order by delay_probability desc, claim_id limit 10)) as top_claims, projection_month as month, recommended_staff as staff_needed from metrics",
    "stream_ingest": "select * from conformed where o_totalprice is not null and o_orderdate is not null",
}


# Double columns of the queries whose results are compared to six decimals.
_CLIENT = (*clients.CLIPPED, "age", "driving_risk_score", "financial_stress_score")
_POLICY = (*_pol, "nb_sinistres_precedents", "policy_duration_days")
_VEHICLE = (*_veh, "annee_modele", "vehicle_age", "mileage_per_year")
_CLAIM = (*_amounts, "claim_gap_amount", "claim_gap_ratio", "quantite", "taux")
_TIMES = ("sla_jours", "duree_traitement_jours", "duree_traitement_heures")
_PART_CLIENT = ("risque_global", "driving_risk_score", "financial_stress_score")
ROUNDED: dict[str, tuple[str, ...]] = {
    "quantiles": ("value",),
    "clip_outliers": ("l_extendedprice", "l_tax"),
    "impute_median": ("annee_modele", "kilometrage_actuel", "valeur_vehicule", "vehicle_age"),
    "income_band": ("revenu_annuel",),
    "vehicle_value_band": ("valeur_vehicule",),
    "claim_severity_bucket": ("montant_indemnisation_claim",),
    "clean_clients": _CLIENT,
    "dim_client": _CLIENT,
    "clean_policies": _POLICY,
    "dim_policy": _POLICY,
    "clean_vehicles": _VEHICLE,
    "dim_vehicle": _VEHICLE,
    "clean_claims": (*_CLAIM, *_TIMES),
    "fact_claim": (*_CLAIM, *_POLICY, *_PART_CLIENT, "vehicle_age", "valeur_vehicule", "mileage_per_year", "loss_ratio"),
    "ml_claim": (*_CLAIM, "sla_jours", *_POLICY, *_CLIENT, *[c for c in _VEHICLE if c != "annee_modele"], "premium_to_value_ratio"),
}


def _round(name: str, sql: str) -> str:
    if name not in ROUNDED:
        return sql
    return f"select * replace ({', '.join(f'round({c}, 6) as {c}' for c in ROUNDED[name])}) from ({sql})"


def oracle_sql() -> dict[str, str]:
    """Query name to SQL; queries that train a model return what can be told of it without its random choices."""
    return {name: _round(name, sql if sql.startswith("with ") else with_ctes(sql)) for name, sql in SQL.items()}
