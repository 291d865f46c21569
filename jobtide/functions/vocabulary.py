"""French/English vocabularies and the industry dimension."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.functions.parsing import clean_text, word_map

Vocabulary = Mapping[str, Sequence[str]]

# Class -> spellings that belong to it (lower case, trimmed).
PAY_PERIOD: Vocabulary = {
    "yearly": ("per year", "par an", "annuel"),
    "monthly": ("per month", "par mois", "mensuel"),
    "weekly": ("per week", "par semaine", "hebdomadaire"),
    "daily": ("per day", "par jour", "journalier"),
    "hourly": ("per hour", "par heure", "horaire"),
}
WORK_TYPE: Vocabulary = {
    "Full-time": ("full-time", "temps plein"),
    "Part-time": ("part-time", "temps partiel"),
    "Contract": ("contract", "contrat"),
    "Internship": ("internship", "stage"),
    "Temporary": ("temporary", "intérim", "temporaire"),
}
FORMATTED_WORK_TYPE: Vocabulary = {
    **WORK_TYPE,
    "Apprenticeship": ("apprenticeship", "apprentissage"),
}
EXPERIENCE_LEVEL: Vocabulary = {
    "Internship": ("internship", "stage"),
    "Entry level": ("entry level", "débutant", "junior"),
    "Associate": ("associate", "confirmé"),
    "Mid-Senior level": ("mid-senior level", "expérimenté"),
    "Director": ("director", "directeur"),
    "Executive": ("executive", "cadre dirigeant"),
}

# Industry code -> label. Code 2 does not exist; three labels own two codes.
UNKNOWN_INDUSTRY = "Other"
INDUSTRIES: Mapping[int, str] = {
    1: "Defense & Space",
    3: "Computer Hardware",
    4: "Computer Software",
    5: "Computer Networking",
    6: "Internet",
    7: "Computer & Network Security",
    8: "Information Technology & Services",
    9: "Semiconductors",
    10: "Telecommunications",
    11: "Law Practice",
    12: "Legal Services",
    13: "Management Consulting",
    14: "Biotechnology",
    15: "Medical Practice",
    16: "Hospital & Health Care",
    17: "Pharmaceuticals",
    18: "Veterinary",
    19: "Medical Devices",
    20: "Cosmetics",
    21: "Apparel & Fashion",
    22: "Sporting Goods",
    23: "Tobacco",
    24: "Supermarkets",
    25: "Food Production",
    26: "Consumer Electronics",
    27: "Consumer Goods",
    28: "Furniture",
    29: "Retail",
    30: "Entertainment",
    31: "Gambling & Casinos",
    32: "Leisure, Travel & Tourism",
    33: "Hospitality",
    34: "Restaurants",
    35: "Sports",
    36: "Food & Beverages",
    37: "Motion Pictures & Film",
    38: "Broadcast Media",
    39: "Museums & Institutions",
    40: "Fine Art",
    41: "Performing Arts",
    42: "Recreational Facilities & Services",
    43: "Banking",
    44: "Insurance",
    45: "Financial Services",
    46: "Real Estate",
    47: "Investment Banking",
    48: "Investment Management",
    49: "Accounting",
    50: "Construction",
    51: "Building Materials",
    52: "Architecture & Planning",
    53: "Civil Engineering",
    54: "Aviation & Aerospace",
    55: "Automotive",
    56: "Chemicals",
    57: "Machinery",
    58: "Mining & Metals",
    59: "Oil & Energy",
    60: "Utilities",
    61: "Shipbuilding",
    62: "Packaging & Containers",
    63: "Railroad Manufacture",
    64: "Renewables & Environment",
    65: "Glass, Ceramics & Concrete",
    66: "Textiles",
    67: "Warehousing",
    68: "Airlines/Aviation",
    69: "Maritime",
    70: "Transportation/Trucking/Railroad",
    71: "Logistics & Supply Chain",
    72: "Import & Export",
    73: "Primary/Secondary Education",
    74: "Higher Education",
    75: "Education Management",
    76: "Research",
    77: "Military",
    78: "Legislative Office",
    79: "Judiciary",
    80: "International Affairs",
    81: "Government Administration",
    82: "Executive Office",
    83: "Law Enforcement",
    84: "Public Safety",
    85: "Public Policy",
    86: "Marketing & Advertising",
    87: "Newspapers",
    88: "Publishing",
    89: "Printing",
    90: "Information Services",
    91: "Libraries",
    92: "Environmental Services",
    93: "Package/Freight Delivery",
    94: "Individual & Family Services",
    95: "Religious Institutions",
    96: "Civic & Social Organization",
    97: "Consumer Services",
    98: "Nonprofit Organization Management",
    99: "Fund-Raising",
    100: "Program Development",
    101: "Writing & Editing",
    102: "Staffing & Recruiting",
    103: "Professional Training & Coaching",
    104: "Market Research",
    105: "Public Relations & Communications",
    106: "Design",
    107: "Graphic Design",
    108: "Photography",
    109: "Arts & Crafts",
    110: "Animation",
    111: "Music",
    112: "Online Media",
    113: "Events Services",
    114: "Business Supplies & Equipment",
    115: "E-Learning",
    116: "Outsourcing/Offshoring",
    117: "Facilities Services",
    118: "Human Resources",
    119: "Venture Capital & Private Equity",
    120: "Think Tanks",
    121: "Nanotechnology",
    122: "Computer Games",
    123: "Alternative Medicine",
    124: "Health, Wellness & Fitness",
    125: "Alternative Dispute Resolution",
    126: "Mental Health Care",
    127: "Philanthropy",
    128: "International Trade & Development",
    129: "Wireless",
    130: "Capital Markets",
    131: "Political Organization",
    132: "Translation & Localization",
    133: "Computer & Network Security",
    134: "Farming",
    135: "Ranching",
    136: "Dairy",
    137: "Fishery",
    138: "Paper & Forest Products",
    139: "Forestry",
    140: "Luxury Goods & Jewelry",
    141: "Renewables & Environment",
    142: "Mechanical or Industrial Engineering",
    143: "Industrial Automation",
    144: "Electrical/Electronic Manufacturing",
    145: "Plastics",
    146: "Rubber & Plastics",
    147: "Wholesale",
    148: "Commercial Real Estate",
    149: "Banking",
    150: "Leasing Real Estate",
}


def normalize(c: Column | str, vocabulary: Vocabulary) -> Column:
    """Class a spelling belongs to, compared trimmed and case-blind; unknown text only trimmed.

    A lookup in a constant map: the text is folded once, whatever the vocabulary's size.
    """
    text = F.col(c) if isinstance(c, str) else c
    classes = {word: label for label, words in vocabulary.items() for word in words}
    return F.coalesce(
        F.try_element_at(word_map(classes), F.lower(F.trim(text))), clean_text(text)
    )


def industry_dimension(spark: SparkSession) -> DataFrame:
    """The fixed code/label table as a local relation (149 rows, so always broadcastable)."""
    return spark.createDataFrame(
        pa.table(
            {
                "industry_id": pa.array(INDUSTRIES.keys(), pa.int32()),
                "industry_name": pa.array(INDUSTRIES.values(), pa.string()),
            }
        )
    )


def has_industry_name(c: Column | str, name: str) -> Column:
    """Predicate on the *code* that holds exactly for codes labelled ``name``.

    Written as a code list, it reaches the Parquet scan as a pushed filter, which a filter on
    the joined label cannot.
    """
    code = F.col(c) if isinstance(c, str) else c
    if name == UNKNOWN_INDUSTRY:
        return ~code.isin(*INDUSTRIES)
    return code.isin(*[i for i, label in INDUSTRIES.items() if label == name])
