"""Default rule packs.

FIXED VALUES: every list, pattern, weight and text in this module must equal
the reviewed application's values for results to match it.  They are kept
here verbatim, in their natural order, and are turned into small DataFrames
(rule tables) by ``lexrev.sources.rules``; no operator hard-codes them.
"""

from __future__ import annotations

# ---------------------------------------------------------------- FIXED VALUES
# Scored type lexicon: type -> primary, secondary, patterns, section words.
TYPE_LEXICON = {
    "articles_of_association": {
        "primary": [
            "articles of association", "company governance", "board of directors",
            "shareholders", "general meeting", "quorum", "voting rights",
            "share capital", "dividend distribution", "board composition",
        ],
        "secondary": [
            "annual general meeting", "extraordinary resolution", "ordinary resolution",
            "director appointment", "company secretary", "audit committee",
            "remuneration committee", "corporate governance", "shareholder rights",
        ],
        "pattern": [
            r"article\s+\d+", r"board\s+of\s+directors", r"general\s+meeting",
            r"share\s+capital", r"voting\s+rights", r"dividend\s+policy",
        ],
        "section": ["governance", "meetings", "directors", "shares", "capital"],
    },
    "memorandum_of_association": {
        "primary": [
            "memorandum of association", "company objects", "liability limited",
            "registered office", "authorized capital", "company formation",
        ],
        "secondary": [
            "company purposes", "business activities", "share classes",
            "incorporation", "registered address", "capital structure",
        ],
        "pattern": [
            r"objects?\s+of\s+(?:the\s+)?company", r"liability.*limited",
            r"registered\s+office", r"authorized\s+capital", r"share\s+classes",
        ],
        "section": ["objects", "liability", "capital", "office", "purposes"],
    },
    "ubo_declaration": {
        "primary": [
            "UBO declaration", "ultimate beneficial owner", "beneficial ownership",
            "ownership structure", "control structure", "beneficial interest",
        ],
        "secondary": [
            "ownership percentage", "voting control", "economic interest",
            "trust arrangement", "nominee arrangement",
        ],
        "pattern": [
            r"UBO\s+declaration", r"ultimate\s+beneficial\s+owner",
            r"beneficial\s+ownership", r"\d+%\s+(?:ownership|interest)",
        ],
        "section": ["ownership", "control", "beneficial", "ultimate"],
    },
}

# Points per evidence kind.
KIND_WEIGHTS = {"primary": 3.0, "secondary": 1.5, "pattern": 2.5, "section": 1.0}

# Wider ten-type lexicon (primary, secondary, patterns; no section words).
WIDE_TYPE_LEXICON = {
    "articles_of_association": {
        "primary": ["articles of association", "company governance", "board of directors", "shareholders"],
        "secondary": ["quorum", "general meeting", "voting rights", "share capital", "dividend distribution"],
        "pattern": [r"article\s+\d+", r"board\s+of\s+directors", r"general\s+meeting", r"shareholders?\s+meeting"],
    },
    "memorandum_of_association": {
        "primary": ["memorandum of association", "company objects", "liability limited", "registered office"],
        "secondary": ["authorized capital", "company purposes", "business activities", "share classes"],
        "pattern": [r"objects?\s+of\s+(?:the\s+)?company", r"liability.*limited", r"registered\s+office"],
    },
    "incorporation_application": {
        "primary": ["incorporation application", "company registration", "registration authority", "ADGM registration"],
        "secondary": ["proposed company name", "registered address", "initial directors", "application form"],
        "pattern": [r"application\s+for\s+incorporation", r"proposed\s+(?:company\s+)?name", r"registration\s+authority"],
    },
    "board_resolution": {
        "primary": ["board resolution", "directors resolution", "board meeting", "corporate resolution"],
        "secondary": ["resolved that", "unanimously resolved", "board unanimously", "meeting minutes"],
        "pattern": [r"resolved\s+that", r"board\s+resolution", r"directors?\s+resolve", r"unanimously\s+resolved"],
    },
    "register_members_directors": {
        "primary": ["register of members", "register of directors", "membership register", "shareholder register"],
        "secondary": ["member details", "share certificates", "shareholding", "director information"],
        "pattern": [r"register\s+of\s+(?:members|directors)", r"member\s+(?:name|details)", r"shares?\s+held"],
    },
    "employment_contract": {
        "primary": ["employment contract", "employment agreement", "service agreement", "employment terms"],
        "secondary": ["salary", "working hours", "termination", "probation", "job description"],
        "pattern": [r"employment\s+(?:contract|agreement)", r"salary.*payable", r"working\s+hours"],
    },
    "commercial_agreement": {
        "primary": ["commercial agreement", "business agreement", "service agreement", "supply agreement"],
        "secondary": ["terms and conditions", "payment terms", "delivery", "force majeure"],
        "pattern": [r"terms?\s+and\s+conditions", r"payment\s+terms", r"force\s+majeure"],
    },
    "licensing_application": {
        "primary": ["licensing application", "business license", "regulatory license", "ADGM license"],
        "secondary": ["license fee", "regulatory requirements", "compliance certificate"],
        "pattern": [r"licensing\s+application", r"business\s+licen[cs]e", r"regulatory\s+licen[cs]e"],
    },
    "regulatory_filing": {
        "primary": ["regulatory filing", "compliance report", "regulatory submission", "ADGM filing"],
        "secondary": ["regulatory authority", "compliance requirements", "filing deadline"],
        "pattern": [r"regulatory\s+filing", r"compliance\s+report", r"regulatory\s+submission"],
    },
    "ubo_declaration": {
        "primary": ["UBO declaration", "ultimate beneficial owner", "beneficial ownership", "UBO form"],
        "secondary": ["ownership structure", "beneficial interest", "control structure"],
        "pattern": [r"UBO\s+declaration", r"ultimate\s+beneficial\s+owner", r"beneficial\s+ownership"],
    },
}

# Red-flag rules, in scan order: pattern, issue, severity, suggestion, reference, category.
FLAG_RULES = [
    (r"UAE Federal Courts?", "Incorrect jurisdiction reference", "High",
     "Replace with ADGM Courts", "ADGM Courts Regulations 2020, Section 3", "jurisdiction"),
    (r"without\s+ADGM\s+approval", "Missing ADGM approval requirement", "Medium",
     "Add explicit ADGM approval clause", "ADGM Companies Regulations 2020, Article 15", "regulatory_compliance"),
    (r"UAE\s+(?:law|laws|legal system)", "Incorrect legal system reference", "High",
     "Reference ADGM law and regulations", "ADGM Legal Framework", "jurisdiction"),
    (r"(?:subject to|governed by)\s+UAE\s+(?:law|legislation)", "Incorrect governing law clause", "High",
     "Specify ADGM law as governing law", "ADGM Companies Regulations 2020, Article 2", "governing_law"),
    (r"(?:registered|incorporated)\s+in\s+(?:UAE|United Arab Emirates)(?!\s+(?:ADGM|Abu Dhabi Global Market))",
     "Ambiguous jurisdiction for registration", "Medium",
     "Clarify registration in ADGM specifically", "ADGM Registration Regulations 2020", "registration"),
    (r"shall\s+be\s+void", "Potentially harsh penalty clause", "Medium",
     "Consider graduated penalties or remedies", "ADGM Contract Law", "contract_terms"),
]

# Replacement clause catalogue: category -> template, reference.
CLAUSE_TEMPLATES = [
    ("jurisdiction",
     "This Agreement shall be governed by and construed in accordance with the laws of the Abu Dhabi Global Market "
     "(ADGM), and the parties hereby submit to the exclusive jurisdiction of the ADGM Courts.",
     "ADGM Courts Regulations 2020"),
    ("governing_law",
     "This document and any disputes arising out of or in connection with it shall be governed by ADGM law.",
     "ADGM Legal Framework"),
    ("regulatory_compliance",
     "The Company shall comply with all applicable ADGM regulations and shall obtain all necessary approvals from the "
     "relevant ADGM authorities before undertaking any regulated activities.",
     "ADGM Companies Regulations 2020"),
]

# Documents each filing process requires.
REQUIREMENTS = {
    "company_incorporation": [
        "articles_of_association", "memorandum_of_association", "incorporation_application",
        "register_members_directors", "board_resolution",
    ],
    "licensing_application": [
        "licensing_application", "articles_of_association", "memorandum_of_association", "regulatory_filing",
    ],
    "compliance_filing": ["compliance_policy", "regulatory_filing", "audit_report"],
}

# Process indicators: process, indicator types, minimum count; tested in this order.
PROCESS_INDICATORS = [
    ("company_incorporation", ["articles_of_association", "memorandum_of_association", "incorporation_application"], 2),
    ("licensing_application", ["licensing_application", "regulatory_filing"], 1),
    ("compliance_filing", ["compliance_policy", "regulatory_filing", "audit_report"], 1),
]
DEFAULT_PROCESS = "general_submission"

# Section-opening prefixes (matched at the start, any case).
SECTION_PATTERNS = [
    r"article\s+(\d+)\.?\s*(.+)",
    r"clause\s+(\d+)\.?\s*(.+)",
    r"section\s+(\d+)\.?\s*(.+)",
    r"part\s+([ivxlcdm]+|\d+)\.?\s*(.+)",
    r"chapter\s+(\d+)\.?\s*(.+)",
    r"whereas\s*[,;:]?\s*(.+)",
    r"(?:resolved|it is resolved)\s*[,;:]?\s*(.+)",
    r"definitions?\s*[,;:]?\s*(.+)?",
    r"schedule\s+([A-Z]|\d+)\s*(.+)",
    r"appendix\s+([A-Z]|\d+)\s*(.+)",
    r"recital\s+([A-Z]|\d+)\s*(.+)",
]
HEADER_PATTERN = r"^(ARTICLE|SECTION|CLAUSE|PART|CHAPTER)\s+\d+"
LIST_ITEM_PATTERN = r"^\d+\.|\([a-z]\)|[•\-\*]"

OBLIGATION_WORDS = ["shall", "must", "required", "obligation"]
DEFINITION_WORDS = ["definition", "means", "interpret"]
SIGNIFICANCE_WORDS = ["shall", "must", "required", "prohibited", "liable", "breach", "penalty"]

TABLE_PERSONNEL_WORDS = ["name", "director", "member"]
TABLE_FINANCIAL_WORDS = ["amount", "fee", "cost", "price"]
TABLE_SCHEDULE_WORDS = ["date", "deadline", "schedule"]

SECTION_PROVISION_WORDS = ["article", "clause", "section"]
SECTION_IMPORTANT_WORDS = ["definitions", "objects", "liability", "governance", "directors", "shareholders"]
SECTION_ANNEX_WORDS = ["schedule", "appendix", "exhibit"]
CONCLUSION_WORDS = ["conclusion", "final"]

FORMALITY_WORDS = ["shall", "hereby", "whereas", "pursuant", "accordance", "aforementioned"]
JARGON_WORDS = ["jurisdiction", "liability", "indemnity", "covenant", "warranty", "breach", "remedy"]
CLASSIFIER_TERM_WORDS = ["shall", "hereby", "whereas", "pursuant", "liability", "obligation"]
RISK_WORDS = ["penalty", "breach", "default", "violation", "non-compliance", "liable", "damages"]
LEGAL_TERMS = [
    "agreement", "contract", "party", "parties", "obligation", "right", "duty", "liability", "breach",
    "remedy", "jurisdiction", "court", "law", "regulation", "compliance", "penalty", "damages",
    "indemnity", "warranty", "covenant", "consideration",
]
PASSIVE_PATTERN = r"\b(?:is|was|are|were|been|being)\s+\w+ed\b"
CITATION_PATTERNS = [
    r"ADGM\s+[Rr]egulations?\s+\d{4}",
    r"Companies\s+Regulations\s+\d{4}",
    r"Financial\s+Services\s+and\s+Markets\s+Regulations\s+\d{4}",
]
KEY_PHRASE_PATTERN = r"[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*"
ORGANISATION_PATTERN = r"\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*\s+(?:Limited|Ltd|Corporation|Corp|Company|Co)\b"

SEVERITIES = ["High", "Medium", "Low"]
LOG_KNOWLEDGE = "Knowledge base built from %d ADGM reference documents"
REPORT_TITLE = "# ADGM Document Analysis Summary"
ANNOTATION_PREFIX = " [ADGM Review: "
ANNOTATION_REFERENCE = " | Legal Reference: "
# Highlight / comment colour per severity style (highlight name, RGB of the comment font).
ANNOTATION_STYLES = {
    "high": ("RED", "8B0000"),
    "medium": ("YELLOW", "B8860B"),
    "low": ("GREEN", "006400"),
}
# Retrieval splitter size and overlap, and neighbours per query.
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 200
RETRIEVE_K = 3
# Text-model settings declared for the (never trained) statistical classifiers.
TEXT_MODEL = {
    "max_features": 5000, "ngram_max": 3, "min_df": 2, "max_df": 0.95,
    "nb_alpha": 0.1, "rf_trees": 100, "seed": 42,
}
# ------------------------------------------------------------ END FIXED VALUES
