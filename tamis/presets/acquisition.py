"""Acquired records: search queries, nested fields and the bronze contract."""

from pyspark.sql import types as T

# Schema versions carried by every row.
BRONZE_VERSION = "2.0.0"
SILVER_VERSION = "2.0.0"

# Acquisition queries, in the order in which they are sent.
SEARCH_QUERIES = (
    "data engineer",
    "data analyst",
    "data scientist",
    "business intelligence",
    "BI analyst",
    "analytics engineer",
    "python data",
    "consultant data",
)

# Object fields that become parent_child columns.
NESTED_FIELDS = {
    "lieuTravail": ("libelle", "latitude", "longitude", "codePostal", "commune"),
    "entreprise": ("nom", "description", "entrepriseAdaptee"),
    "salaire": ("libelle",),
    "origineOffre": ("origine", "urlOrigine"),
    "contexteTravail": ("horaires",),
}

# Fields always kept as JSON text.
JSON_FIELDS = (
    "competences",
    "formations",
    "langues",
    "qualitesProfessionnelles",
    "contact",
    "agence",
    "permis",
    "search_keywords",
)

# Scalar fields of an acquired record that are not text.
TYPED_FIELDS = {
    "lieuTravail_latitude": T.DoubleType(),
    "lieuTravail_longitude": T.DoubleType(),
    "entreprise_entrepriseAdaptee": T.BooleanType(),
    "alternance": T.BooleanType(),
    "nombrePostes": T.LongType(),
    "offresManqueCandidats": T.BooleanType(),
    "accessibleTH": T.BooleanType(),
    "entrepriseAdaptee": T.BooleanType(),
    "employeurHandiEngage": T.BooleanType(),
}

# Text fields of an acquired record.
TEXT_FIELDS = (
    "id",
    "intitule",
    "description",
    "dateCreation",
    "dateActualisation",
    "romeCode",
    "romeLibelle",
    "appellationlibelle",
    "typeContrat",
    "typeContratLibelle",
    "natureContrat",
    "experienceExige",
    "experienceLibelle",
    "experienceCommentaire",
    "dureeTravailLibelle",
    "dureeTravailLibelleConverti",
    "qualificationCode",
    "qualificationLibelle",
    "codeNAF",
    "secteurActivite",
    "secteurActiviteLibelle",
    "trancheEffectifEtab",
    "deplacementCode",
    "deplacementLibelle",
    "complementExercice",
    "search_keyword",
    "ingestion_timestamp",
)

LINEAGE_COLUMNS = (
    "batch_id",
    "processing_run_id",
    "bronze_schema_version",
    "raw_source_file",
    "raw_source_object_key",
    "raw_record",
)
