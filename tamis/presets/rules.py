"""Enrichment and salary rules."""

from decimal import Decimal

# Job families in order of precedence: label, substrings, whole words.
FAMILIES = (
    (
        "Data Engineering",
        (
            "data engineer",
            "ingénieur data",
            "ingenieur data",
            "data ingénieur",
            "data ingenieur",
            "analytics engineer",
        ),
        (),
    ),
    (
        "Data Analysis / BI",
        (
            "data analyst",
            "business analyst",
            "analyste data",
            "analyste données",
            "analyste donnees",
            "bi analyst",
            "business intelligence",
        ),
        ("bi",),
    ),
    (
        "Data Science / IA",
        ("data scientist", "machine learning", "intelligence artificielle", "ml engineer"),
        ("ia",),
    ),
)
OTHER_FAMILY = "Autre data / numérique"

# Technology labels in output order, with their substrings.
TECHNOLOGIES = (
    ("AWS", ("aws",)),
    ("Azure", ("azure",)),
    ("GCP", ("gcp",)),
    ("Cloud", ("cloud",)),
    ("DevOps", ("devops",)),
    ("Docker", ("docker",)),
    ("Kubernetes", ("kubernetes",)),
    ("Terraform", ("terraform",)),
    ("CI/CD", ("ci/cd", "cicd")),
)

# Contract categories and their codes.
CONTRACTS = (
    ("CDI", ("CDI", "CDI-I")),
    ("CDD / mission", ("CDD", "CDD-I", "MIS", "SAI")),
    ("Alternance", ("APP", "PRO")),
    ("Indépendant / franchise", ("LIB", "FRA")),
)
APPRENTICESHIP = "Alternance"

UNKNOWN = "Non renseigné"
OTHER = "Autre"
UNKNOWN_PERIOD = "Période non renseignée"

# Experience and working-time categories with their substrings.
EXPERIENCE = (
    ("Débutant accepté", ("débutant", "debutant")),
    ("Expérience demandée", ("an",)),
)
WORKING_TIME = (
    ("Temps plein", ("temps plein",)),
    ("Temps partiel", ("temps partiel",)),
)

# Flag column -> status column, label when true, label otherwise.
STATUSES = {
    "coordonnees_renseignees": (
        "statut_coordonnees", "Coordonnées renseignées", "Coordonnées non renseignées"),
    "localisation_renseignee": (
        "statut_localisation", "Localisation renseignée", "Localisation non renseignée"),
    "information_entreprise_disponible": (
        "statut_information_entreprise",
        "Information entreprise disponible", "Information entreprise absente"),
    "salaire_renseigne": ("statut_salaire", "Salaire renseigné", "Salaire non renseigné"),
    "offre_difficile_a_pourvoir": (
        "statut_tension_recrutement",
        "Offre difficile à pourvoir", "Offre non signalée difficile"),
}

# Completeness classes with their lowest score.
COMPLETENESS = (("Offre très complète", 7), ("Offre moyennement complète", 5))
INCOMPLETE = "Offre peu complète"

RECENT_DAYS = 30

# Salary threshold, labels and reasons.
SUSPECT_ABOVE = Decimal("200000")
SINGLE_AMOUNT, AMOUNT_RANGE = "Montant unique", "Fourchette"
REASONS = {
    "unparsed": "Format salarial non reconnu",
    "incoherent": "Incohérence entre période extraite et période normalisée",
    "hourly": "Salaire horaire non annualisé",
    "suspect": "Valeur annualisée atypique supérieure à 200000 EUR",
    "not_annual": "Annualisation impossible",
    "not_positive": "Salaire inférieur ou égal à zéro",
    "reversed": "Salaire maximum inférieur au salaire minimum",
}
METHODS = {
    "unparsed": "Non parsé",
    "hourly": "Non annualisé",
    "yearly": "Déjà annuel",
    "monthly": "Mensuel x 12",
}

# Codes of rows without a known area or label.
NO_AREA = "NON_RENSEIGNE"
NO_REGION = "NR"
