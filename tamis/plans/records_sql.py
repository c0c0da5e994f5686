"""Acquired JSON records and acquisition hits derived from ``events`` (plain SQL for both engines).

Records have keys out of order, numbers with trailing zeros, blanks and a field that nobody declared, so that their text
and their canonical form differ.
"""

# Search queries of the derived acquisition, in order; the last one finds nothing.
QUERIES = ("click", "view", "purchase", "signup", "error", "refund")

HITS = r"""
select
    case when user_id % 50 = 7 then null when user_id % 50 = 8 then '' else cast(user_id as string) end as id,
    event_type as requete, ts, event_id, props, value
from {events}
"""

RECORDS = r"""
select
    event_id,
    '{"zeta": 1.50, "alternance":' || case event_id % 3 when 0 then 'true' when 1 then 'false' else 'null' end
    || ',"competences":' || case event_id % 4 when 0 then 'null'
        else '[{"code":"' || cast(user_id as string) || '"},{"code":2}]' end
    || ',"dateActualisation":"' || cast(cast(ts as date) as string)
        || case when event_id % 6 = 0 then 'T09:00:00Z"' else 'T12:30:00Z"' end
    || ',"dateCreation":"' || case when event_id % 29 = 0 then 'hier'
        else cast(cast(ts as date) as string) || 'T10:00:00Z' end || '"'
    || ',"entreprise":' || case event_id % 7 when 0 then 'null' when 1 then '{"nom":"  "}'
        when 2 then '{"description":"D","siret":"1"}'
        else '{"entrepriseAdaptee":false,"nom":"N' || cast(user_id as string) || '"}' end
    || ',"id":' || case when event_id % 997 = 3 then 'null' when event_id % 991 = 4 then '""'
        else '"' || cast(event_id - case when event_id % 1009 = 5 then 1 else 0 end as string) || '"' end
    || ',"ingestion_timestamp":' || case when event_id % 983 = 6 then '""' else '"2024-02-01_10-00-00"' end
    || ',"intitule":" ' || event_type || ' "'
    || ',"lieuTravail":' || case event_id % 5 when 0 then 'null'
        when 1 then '{"codePostal":"0' || cast(user_id % 9 + 1 as string) || '120","libelle":"L"}'
        when 2 then '{"altitude":7,"latitude":48.5,"longitude":2.25}'
        when 3 then '{}'
        else case when event_id % 977 = 9 then '"Paris"' else '{"commune":"75056","libelle":"75 - Paris"}' end end
    || ',"nombrePostes":' || cast(event_id % 4 as string)
    || ',"props":' || replace(props, ' ', '')
    || ',"salaire":' || case event_id % 4 when 0 then '{}'
        when 1 then '{"libelle":"annuel de ' || cast(user_id as string) || ' Euros"}'
        when 2 then '{"libelle":"Mensuel"}' else '{"libelle":"Selon profil"}' end
    || ',"search_keyword":' || case when event_id % 971 = 1 then 'null' when event_id % 967 = 2 then '"autre"'
        else '"' || event_type || '"' end
    || case when event_id % 953 = 5 then '' else ',"search_keywords":'
        || case when event_id % 947 = 3 then '[]' when event_id % 941 = 4 then '"' || event_type || '"'
            when event_id % 937 = 5 then '["' || event_type || '","inconnu"]'
            else '["' || event_type || '"]' end end
    || '}' as record
from {events}
"""

# Without the defects above: every id unique, every rule kept.
CLEAN_RECORDS = r"""
select
    event_id,
    '{"zeta": 1.50, "alternance":' || case event_id % 3 when 0 then 'true' when 1 then 'false' else 'null' end
    || ',"dateActualisation":"' || cast(cast(ts as date) as string)
        || case when event_id % 6 = 0 then 'T09:00:00Z"' else 'T12:30:00Z"' end
    || ',"dateCreation":"' || cast(cast(ts as date) as string) || 'T10:00:00Z"'
    || ',"description":"' || case when event_id % 8 = 0 then '' else 'Poste de data engineer, AWS' end || '"'
    || ',"entreprise":' || case event_id % 7 when 0 then 'null' when 1 then '{"nom":"  "}'
        when 2 then '{"description":"D"}' else '{"nom":"N' || cast(user_id as string) || '"}' end
    || ',"id":"' || cast(event_id as string) || '"'
    || ',"ingestion_timestamp":"2024-02-01_10-00-00"'
    || ',"intitule":" ' || event_type || ' "'
    || ',"lieuTravail":' || case event_id % 5 when 0 then 'null' when 2 then '{"latitude":48.5,"longitude":2.25}'
        when 3 then '{}' else '{"commune":"75056","libelle":"75 - Paris"}' end
    || ',"nombrePostes":' || cast(event_id % 4 as string)
    || ',"salaire":' || case event_id % 4 when 0 then '{}'
        when 1 then '{"libelle":"annuel de ' || cast(user_id as string) || ' Euros"}'
        when 2 then '{"libelle":"Mensuel de 2000 Euros"}' else '{"libelle":"Selon profil"}' end
    || ',"search_keyword":"' || upper(event_type) || '"'
    || ',"search_keywords":["' || upper(event_type) || '","autre"]'
    || ',"typeContrat":"CDI"}' as record
from {events}
"""
