"""Codes, ranks, column names and literal lists that results depend on."""

# Rank code in the raw checklist -> rank.
RANK_CODES = {
    "O": "order",
    "F": "family",
    "SF": "subfamily",
    "T": "tribe",
    "G": "genus",
    "S": "species",
    "SS": "subspecies",
    "V": "variety",
    "FM": "form",
}

# Raw checklist columns that have no place in the output.
DROPPED_COLUMNS = [
    "photo",
    "orientation",
    "author",
    "trivial_name",
    "conservation_status",
    "distribution",
]

# Raw checklist column -> Darwin Core term.
TERM_NAMES = {
    "name": "scientificName",
    "taxon": "taxonRank",
    "literature": "namePublishedIn",
    "remarks": "taxonRemarks",
}

# Darwin Core taxon terms, in vocabulary order (public standard).
TERMS = [
    "taxonID",
    "scientificNameID",
    "acceptedNameUsageID",
    "parentNameUsageID",
    "originalNameUsageID",
    "nameAccordingToID",
    "namePublishedInID",
    "taxonConceptID",
    "scientificName",
    "acceptedNameUsage",
    "parentNameUsage",
    "originalNameUsage",
    "nameAccordingTo",
    "namePublishedIn",
    "namePublishedInYear",
    "higherClassification",
    "kingdom",
    "phylum",
    "class",
    "order",
    "superfamily",
    "family",
    "subfamily",
    "tribe",
    "subtribe",
    "genus",
    "genericName",
    "subgenus",
    "infragenericEpithet",
    "specificEpithet",
    "infraspecificEpithet",
    "cultivarEpithet",
    "taxonRank",
    "verbatimTaxonRank",
    "scientificNameAuthorship",
    "vernacularName",
    "nomenclaturalCode",
    "taxonomicStatus",
    "nomenclaturalStatus",
    "taxonRemarks",
]

# Columns of the final table, in order.
OUTPUT_COLUMNS = [
    "taxonID",
    "scientificName",
    "taxonRank",
    "taxonomicStatus",
    "acceptedNameUsage",
    "acceptedNameUsageID",
    "parentNameUsage",
    "parentNameUsageID",
    "namePublishedIn",
    "taxonRemarks",
    "ipniURL",
]

# Extra columns the table check allows next to the terms.
EXTRA_COLUMNS = ["ipniURL", "tribe", "modified", "modifiedBy", "modifiedByID"]

# Allowed taxonomic statuses.
STATUSES = ["accepted", "synonym", "ambiguous synonym", "variant"]

# Rank columns of a lineage, lowest first.
LINEAGE_RANKS = ["genus", "tribe", "subfamily", "family", "order"]

# Ranks below species that need a species as parent.
INFRASPECIFIC_RANKS = ["subspecies", "form", "variety"]

# Ranks removed when a table is cut at genus level.
BELOW_GENUS_RANKS = ["species", "form", "subvariety", "subspecies", "variety"]

# Ending of a one-word name -> rank; the first that fits wins.
UNINOMIAL_SUFFIXES = [
    ("phyta", "division"),
    ("phytina", "subdivision"),
    ("opsida", "class"),
    ("idae", "subclass"),
    ("ales", "order"),
    ("ineae", "suborder"),
    ("aceae", "family"),
    ("oideae", "subfamily"),
    ("eae", "tribe"),
    ("inae", "subtribe"),
]

# Marker inside a name -> rank; the last marker in the name counts.
INFRASPECIFIC_MARKERS = [
    ("var.", "variety"),
    ("f.", "form"),
    ("ssp.", "subspecies"),
    ("subvar.", "subvariety"),
    ("monstr.", "monstrosity"),
]

# Pattern of those markers (blank after "ssp." not required).
MARKER_PATTERN = r" var\. | f\. | ssp\.| subvar\. | monstr\. "

# Rank -> filter group of the name authority; other ranks have no group.
AUTHORITY_GROUPS = {
    "family": "families",
    "subfamily": "infrafamilies",
    "genus": "genera",
    "species": "species",
    "subspecies": "infraspecies",
    "variety": "infraspecies",
    "form": "infraspecies",
}

# Columns of a name authority answer (after the request id), in order.
AUTHORITY_COLUMNS = [
    "name",
    "authors",
    "publishingAuthor",
    "rank",
    "publication",
    "publicationId",
    "reference",
    "referenceRemarks",
    "typeName",
    "basionymStr",
    "basionymAuthorStr",
    "basionymId",
    "url",
    "ipni_id",
    "fq_id",
    "wfo_id",
]
AUTHORITY_URL = "https://www.ipni.org"

# Names listed both as accepted and as synonym; the synonym goes.
EXCLUDED_SYNONYMS = [
    ("Hypodematiaceae Ching", "synonym"),
    ("Acrostichum L.", "synonym"),
    ("Lomariopsis Fée", "synonym"),
    ("Hymenophylloideae Burnett", "synonym"),
]

# Name whose parse is overridden -> (canonical name, authorship).
NAME_OVERRIDES = {
    "Ericetorum (Jermy) Li Bing Zhang & X. M. Zhou": (
        "Ericetorum",
        "(Jermy) Li Bing Zhang & X. M. Zhou",
    ),
}

# Fixed value: a dot and blanks between two initials of an author.
INITIALS_PATTERN = r"(?U)(?<=[A-Z])\.\s+(?=[A-Z])"

# Ranks that are counted, in report order.
COUNTED_RANKS = ["order", "family", "subfamily", "tribe", "genus", "nothogenus", "species"]

# Ranks that become "hybrid" in the counts when " x " is in the name.
HYBRID_RANKS = ["species", "variety", "subspecies", "form"]

# Heading level of a rank in the treatment.
HEADING_LEVELS = {"order": 2, "family": 3, "subfamily": 4, "tribe": 5, "genus": 6}

# Ranks written as list items in the treatment.
BULLET_RANKS = ["species", "form", "variety", "subspecies"]

# Ranks whose first word is set in italics.
ITALIC_RANKS = ["genus", "species", "variety", "subvariety", "form", "subspecies"]

# Issue label -> (output column, pattern of its value in the body).
ISSUE_FIELDS = {
    "name": r"Name of taxon[\r|\n]*(.*)[\r|\n]*",
    "rank": r"(?U)Rank of taxon[\r|\n]*(\w+)[\r|\n]*",
    "no_species": r"number of species affected[\r|\n]*(.*)",
    "description": r"Description of change[\r|\n]*(.*)",
}
