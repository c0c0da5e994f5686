"""Offer-shaped rows derived from the provided tables.

The tables hold no job offers, so one offer is derived per order: its customer gives the place and
the company, the document of the same number gives the description. The text is plain SQL that
Spark and DuckDB read alike; ``{orders}`` and so on stand for the tables. Only integers go into
text, so that both engines spell every value the same way.
"""

OFFERS = r"""
select
    cast(o.o_orderkey as string) as id_offre,
    case o.o_orderkey % 14
        when 0 then 'Data Engineer H/F'
        when 1 then 'Data Analyst'
        when 2 then 'Data Scientist (Machine Learning)'
        when 3 then 'Consultant BI'
        when 4 then 'Ingénieur Data et Business Intelligence'
        when 5 then 'Chef de projet ébi'
        when 6 then 'Expert IA'
        when 7 then 'Analyste données - AWS, Azure'
        when 8 then 'Analytics Engineer Kubernetes, CI/CD'
        when 9 then 'Développeur DevOps / Docker / cicd'
        when 10 then 'Architecte Cloud GCP Terraform'
        when 11 then 'Statisticien'
        when 12 then 'Intelligence artificielle : ML Engineer'
    end as intitule_offre,
    d.text as description_offre,
    o.o_orderdate as date_creation,
    case when o.o_orderkey % 17 <> 0
        then o.o_orderdate + (o.o_orderkey % 40 - 5) * interval '1' day end as date_actualisation,
    case when o.o_orderkey % 19 <> 0 then timestamp '1999-06-15 10:00:00' end as date_ingestion,
    timestamp '1999-07-01 08:00:00' as date_chargement,
    case c.c_custkey % 9
        when 0 then '2A - Ajaccio'
        when 1 then '2B -Bastia'
        when 2 then '974 - Saint-Denis'
        when 3 then '69 - Lyon'
        when 4 then 'France'
        when 5 then '976 - Mamoudzou'
        when 6 then ' 33 - Bordeaux '
    end as libelle_lieu_travail,
    case when o.o_orderkey % 6 = 0 then 48.5 end as latitude,
    case when o.o_orderkey % 12 = 0 then 2.25 end as longitude,
    case when c.c_custkey % 4 <> 0
        then lpad(cast(c.c_custkey * 7919 % 100000 as string), 5, '0') end as code_postal,
    case c.c_custkey % 8
        when 0 then '2a004'
        when 1 then '2B033'
        when 2 then '97' || cast(c.c_custkey % 7 as string) || '05'
        when 3 then lpad(cast(c.c_custkey * 104729 % 100000 as string), 5, '0')
        when 4 then '9705'
    end as code_commune,
    case when c.c_custkey % 5 <> 0 then c.c_name end as nom_entreprise,
    case when c.c_custkey % 7 = 0 then c.c_mktsegment end as description_entreprise,
    case o.o_orderkey % 12
        when 0 then 'CDI' when 1 then 'CDI-I' when 2 then 'CDD' when 3 then 'CDD-I' when 4 then 'MIS'
        when 5 then 'SAI' when 6 then 'APP' when 7 then 'PRO' when 8 then 'LIB' when 9 then 'FRA'
        when 10 then 'XYZ'
    end as code_type_contrat,
    case o.o_orderkey % 13 when 0 then true when 1 then cast(null as boolean) else false end as est_alternance,
    case o.o_orderkey % 7
        when 0 then 'Débutant accepté' when 1 then '2 An(s)' when 2 then 'Expérience exigée'
        when 3 then 'DEBUTANT' when 4 then 'sans objet' when 5 then 'Exigé'
    end as libelle_experience,
    case when o.o_orderkey % 10 <> 3 then 'M18' || cast(o.o_orderkey % 11 as string) end as code_rome,
    case when o.o_orderkey % 10 <> 3 then c.c_mktsegment end as libelle_rome,
    case when o.o_orderkey % 23 = 0 then 'Business Analyst' end as libelle_appellation,
    case o.o_orderkey % 17
        when 0 then 'Annuel de ' || a.amount || '.0 Euros à ' || a.more || '.5 Euros'
        when 1 then 'Annuel de ' || a.amount || ' Euros sur 12 mois'
        when 2 then 'Mensuel de ' || a.month || ' Euros'
        when 3 then 'Mensuel de ' || a.month || '.25 Euros à ' || a.more || ' Euros sur 13.5 mois'
        when 4 then 'Horaire de 12.5 Euros à 15 Euros'
        when 5 then 'Annuel de ' || a.amount || ' Euros - Selon profil'
        when 6 then 'Annuel de ' || a.amount || ' Euros - Selon' || chr(10) || 'profil'
        when 7 then 'annuel de ' || a.amount || ' Euros'
        when 8 then 'Annuel de 40 000 Euros'
        when 9 then 'Annuel de 0 Euros'
        when 10 then 'Annuel de ' || a.more || ' Euros à ' || a.amount || ' Euros'
        when 11 then 'Annuel de 200000 Euros'
        when 12 then ' Mensuel de ' || a.month || '. Euros'
        when 13 then 'A négocier'
        when 14 then 'Annuel de ' || a.amount || ' Euros'
    end as salaire_libelle,
    case when o.o_orderkey % 3 = 0 then 'Temps plein' when o.o_orderkey % 3 = 1 then '24H hebdo' end
        as libelle_duree_travail,
    case o.o_orderkey % 5 when 0 then 'Temps partiel' when 1 then 'TEMPS PLEIN' end
        as libelle_duree_travail_converti,
    case when o.o_orderkey % 4 = 0 then cast(o.o_orderkey % 99 as string) end as code_secteur_activite,
    case when o.o_orderkey % 6 = 0 then c.c_mktsegment end as libelle_secteur_activite,
    case o.o_orderkey % 5 when 0 then true when 1 then false end as offre_difficile_a_pourvoir,
    'batch_' || cast(o.o_orderkey % 2 as string) as batch_id,
    'run_1' as processing_run_id,
    '2.0.0' as silver_schema_version,
    'silver/part=' || cast(o.o_orderkey % 3 as string) as fichier_source_silver
from {orders} o
join {customer} c on c.c_custkey = o.o_custkey
left join {documents} d on d.doc_id = o.o_orderkey
cross join lateral (
    select
        cast(cast(floor(o.o_totalprice) as bigint) as string) as amount,
        cast(cast(floor(o.o_totalprice) as bigint) + o.o_orderkey % 97 as string) as more,
        cast(cast(floor(o.o_totalprice) as bigint) % 20000 as string) as month
) a
"""

# The presence flags a silver row carries, over the columns above.
SILVER = r"""
select r.*,
    date_actualisation >= date_creation as date_actualisation_coherente,
    nom_entreprise is not null as entreprise_renseignee,
    description_entreprise is not null as description_entreprise_renseignee,
    (nom_entreprise is not null or description_entreprise is not null) as information_entreprise_disponible,
    salaire_libelle is not null as salaire_renseigne,
    case
        when lower(trim(salaire_libelle)) like 'annuel%' then 'Annuel'
        when lower(trim(salaire_libelle)) like 'mensuel%' then 'Mensuel'
        when lower(trim(salaire_libelle)) like 'horaire%' then 'Horaire'
    end as periode_salaire,
    (latitude is not null and longitude is not null) as coordonnees_renseignees,
    (libelle_lieu_travail is not null or code_commune is not null or code_postal is not null
        or (latitude is not null and longitude is not null)) as localisation_renseignee
from ({offers}) r
"""


def for_engine(text: str, **tables: str) -> str:
    for name, value in tables.items():
        text = text.replace("{" + name + "}", value)
    return text
