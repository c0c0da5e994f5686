"""Silver contract: names, types and required columns."""

# Bronze name -> silver name.
RENAMES = {
    "id": "id_offre",
    "intitule": "intitule_offre",
    "description": "description_offre",
    "dateCreation": "date_creation",
    "dateActualisation": "date_actualisation",
    "lieuTravail_libelle": "libelle_lieu_travail",
    "lieuTravail_latitude": "latitude",
    "lieuTravail_longitude": "longitude",
    "lieuTravail_codePostal": "code_postal",
    "lieuTravail_commune": "code_commune",
    "entreprise_nom": "nom_entreprise",
    "entreprise_description": "description_entreprise",
    "entrepriseAdaptee": "est_entreprise_adaptee",
    "employeurHandiEngage": "est_employeur_handi_engage",
    "typeContrat": "code_type_contrat",
    "typeContratLibelle": "libelle_type_contrat",
    "natureContrat": "nature_contrat",
    "experienceExige": "experience_exigee",
    "experienceLibelle": "libelle_experience",
    "romeCode": "code_rome",
    "romeLibelle": "libelle_rome",
    "appellationlibelle": "libelle_appellation",
    "salaire_libelle": "salaire_libelle",
    "alternance": "est_alternance",
    "nombrePostes": "nombre_postes",
    "dureeTravailLibelle": "libelle_duree_travail",
    "dureeTravailLibelleConverti": "libelle_duree_travail_converti",
    "qualificationCode": "code_qualification",
    "qualificationLibelle": "libelle_qualification",
    "codeNAF": "code_naf",
    "secteurActivite": "code_secteur_activite",
    "secteurActiviteLibelle": "libelle_secteur_activite",
    "trancheEffectifEtab": "tranche_effectif_etablissement",
    "offresManqueCandidats": "offre_difficile_a_pourvoir",
    "accessibleTH": "accessible_travailleur_handicape",
    "deplacementCode": "code_deplacement",
    "deplacementLibelle": "libelle_deplacement",
    "experienceCommentaire": "commentaire_experience",
    "complementExercice": "complement_exercice",
    "origineOffre_origine": "origine_offre",
    "origineOffre_urlOrigine": "url_origine_offre",
    "contexteTravail_horaires": "horaires_travail",
    "search_keyword": "mot_cle_recherche",
    "search_keywords": "mots_cles_recherche",
    "ingestion_timestamp": "date_ingestion",
    "batch_id": "batch_id",
    "processing_run_id": "bronze_processing_run_id",
    "bronze_schema_version": "bronze_schema_version",
    "raw_source_file": "fichier_source",
    "raw_source_object_key": "objet_source_raw",
    "raw_record": "enregistrement_brut",
    "competences": "competences_brutes",
    "formations": "formations_brutes",
    "langues": "langues_brutes",
    "qualitesProfessionnelles": "qualites_professionnelles_brutes",
    "contact": "contact_brut",
    "agence": "agence_brute",
    "permis": "permis_bruts",
}

# Bronze columns left out of silver.
DROPPED = ("entreprise_entrepriseAdaptee",)

# Column groups by type.
SOURCE_BOOLEANS = (
    "est_entreprise_adaptee",
    "est_employeur_handi_engage",
    "est_alternance",
    "offre_difficile_a_pourvoir",
    "accessible_travailleur_handicape",
)
COMPUTED_BOOLEANS = (
    "date_actualisation_coherente",
    "entreprise_renseignee",
    "description_entreprise_renseignee",
    "information_entreprise_disponible",
    "salaire_renseigne",
    "coordonnees_renseignees",
    "localisation_renseignee",
)
INSTANTS = (
    "date_creation",
    "date_actualisation",
    "date_ingestion",
    "date_traitement_silver",
    "date_chargement",
)
LONGS = ("nombre_postes",)
DOUBLES = ("latitude", "longitude")

# Columns the serving load insists on.
REQUIRED_FOR_LOAD = (
    "id_offre",
    "batch_id",
    "processing_run_id",
    "silver_schema_version",
    "intitule_offre",
    "date_creation",
    "code_type_contrat",
    "mot_cle_recherche",
    "salaire_renseigne",
    "information_entreprise_disponible",
    "coordonnees_renseignees",
    "localisation_renseignee",
    "objet_source_bronze",
)

# Columns the serving load adds.
SERVING_EXTRA = ("date_chargement", "fichier_source_silver")

# Columns whose absence or gaps a silver report shows.
CRITICAL = (
    "id_offre",
    "intitule_offre",
    "description_offre",
    "date_creation",
    "date_actualisation",
    "libelle_lieu_travail",
    "code_type_contrat",
    "libelle_type_contrat",
    "mot_cle_recherche",
    "fichier_source",
    "enregistrement_brut",
)
CALCULATED = (
    "date_actualisation_coherente",
    "entreprise_renseignee",
    "description_entreprise_renseignee",
    "information_entreprise_disponible",
    "salaire_renseigne",
    "periode_salaire",
    "coordonnees_renseignees",
    "date_traitement_silver",
)
JSON_COLUMNS = (
    "competences_brutes",
    "formations_brutes",
    "langues_brutes",
    "qualites_professionnelles_brutes",
    "contact_brut",
    "agence_brute",
    "permis_bruts",
    "enregistrement_brut",
)

# Projection of the staging view.
STAGING = (
    "id_offre", "intitule_offre", "description_offre",
    "date_creation", "date_actualisation", "date_actualisation_coherente",
    "libelle_lieu_travail", "latitude", "longitude", "code_postal", "code_commune",
    "coordonnees_renseignees", "localisation_renseignee",
    "nom_entreprise", "description_entreprise", "entreprise_renseignee",
    "description_entreprise_renseignee", "information_entreprise_disponible",
    "est_entreprise_adaptee", "est_employeur_handi_engage",
    "code_type_contrat", "libelle_type_contrat", "nature_contrat",
    "experience_exigee", "libelle_experience", "commentaire_experience",
    "code_rome", "libelle_rome", "libelle_appellation",
    "salaire_libelle", "salaire_renseigne", "periode_salaire",
    "est_alternance", "nombre_postes",
    "libelle_duree_travail", "libelle_duree_travail_converti",
    "code_qualification", "libelle_qualification", "code_naf",
    "code_secteur_activite", "libelle_secteur_activite", "tranche_effectif_etablissement",
    "offre_difficile_a_pourvoir", "accessible_travailleur_handicape",
    "code_deplacement", "libelle_deplacement",
    "complement_exercice", "origine_offre", "url_origine_offre", "horaires_travail",
    "mot_cle_recherche", "mots_cles_recherche",
    "date_ingestion", "fichier_source", "objet_source_raw",
    "bronze_processing_run_id", "bronze_schema_version", "objet_source_bronze",
    "batch_id", "processing_run_id", "silver_schema_version", "date_traitement_silver",
    "date_chargement", "fichier_source_silver",
)
