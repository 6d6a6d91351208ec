"""Word lists, lookup tables, patterns and formats that results depend on."""

LEGAL_SUFFIXES = {
    "corporation": "corp", "corp": "corp", "incorporated": "inc", "inc": "inc", "limited": "ltd", "ltd": "ltd",
    "private": "pvt", "pvt": "pvt", "company": "co", "co": "co", "llc": "llc", "llp": "llp", "plc": "plc",
    "gmbh": "gmbh", "sarl": "sarl", "sas": "sas", "sa": "sa", "sasu": "sasu", "eurl": "eurl", "snc": "snc",
}

#: Applied in this order, to lower-case text without accents.
LEGAL_PHRASES = [
    (r"\bprivate\s+limited\b", "pvt ltd"),
    (r"\bpvt\.?\s*ltd\.?\b", "pvt ltd"),
    (r"\bco\.?\s*ltd\.?\b", "co ltd"),
    (r"\bsociete\s+anonyme\b", "sa"),
    (r"\bsociete\s+par\s+actions\s+simplifiee\b", "sas"),
    (r"\bsociete\s+a\s+responsabilite\s+limitee\b", "sarl"),
    (r"\blimited\s+liability\s+company\b", "llc"),
    (r"\blimited\s+liability\s+partnership\b", "llp"),
]

ADDRESS_ABBREVIATIONS = {
    "street": "st", "st": "st", "str": "st", "avenue": "ave", "ave": "ave", "av": "ave", "road": "rd", "rd": "rd",
    "boulevard": "blvd", "blvd": "blvd", "bd": "blvd", "highway": "hwy", "hwy": "hwy", "drive": "dr", "dr": "dr",
    "lane": "ln", "ln": "ln", "court": "ct", "ct": "ct", "circle": "cir", "cir": "cir", "parkway": "pkwy",
    "pkwy": "pkwy", "expressway": "expy", "route": "rt", "rue": "rue", "chemin": "ch", "allee": "all", "place": "pl",
    "floor": "fl", "fl": "fl", "suite": "ste", "ste": "ste", "apartment": "apt", "apt": "apt", "building": "bldg",
    "bldg": "bldg", "block": "blk", "blk": "blk", "sector": "sec", "sec": "sec", "room": "rm", "rm": "rm",
    "township": "twp", "townshiip": "twp", "twp": "twp", "nagar": "ngr", "colony": "col", "near": "nr", "nr": "nr",
    "opposite": "opp", "opp": "opp", "behind": "bhnd", "adjacent": "adj",
}

#: Applied in this order: "virginia" comes before "west virginia".
STATES = {
    "new york": "ny", "california": "ca", "texas": "tx", "florida": "fl", "illinois": "il", "pennsylvania": "pa",
    "ohio": "oh", "georgia": "ga", "north carolina": "nc", "michigan": "mi", "new jersey": "nj", "virginia": "va",
    "washington": "wa", "massachusetts": "ma", "arizona": "az", "tennessee": "tn", "indiana": "in", "missouri": "mo",
    "maryland": "md", "wisconsin": "wi", "colorado": "co", "minnesota": "mn", "south carolina": "sc", "alabama": "al",
    "louisiana": "la", "kentucky": "ky", "oregon": "or", "oklahoma": "ok", "connecticut": "ct", "utah": "ut",
    "iowa": "ia", "nevada": "nv", "arkansas": "ar", "mississippi": "ms", "kansas": "ks", "new mexico": "nm",
    "nebraska": "ne", "idaho": "id", "west virginia": "wv", "hawaii": "hi", "new hampshire": "nh", "maine": "me",
    "montana": "mt", "rhode island": "ri", "delaware": "de", "south dakota": "sd", "north dakota": "nd",
    "alaska": "ak", "vermont": "vt", "wyoming": "wy",
}

COUNTRIES = {
    "US": "US", "USA": "US", "UNITED STATES": "US", "UNITED STATES OF AMERICA": "US",
    "IN": "IN", "IND": "IN", "INDIA": "IN", "FR": "FR", "FRA": "FR", "FRANCE": "FR",
}

TRAILING_STOPWORDS = ["&", "and", "at", "by", "for", "in", "of", "or", "the"]

GENERIC_NAME_WORDS = (
    "and cafe center centre company corp corporation enterprises france global group holding holdings hotel inc india "
    "industries international llc ltd pvt restaurant services shop solutions store the usa"
).split()

GENERIC_ADDRESS_WORDS = (
    "apartment apt ave avenue behind bldg block blvd boulevard city colony cross fl floor france india main market "
    "nagar near nr opp opposite rd road sector st state ste street suite unit us"
).split()

#: Dropped from the end of a name by the index normaliser.
INDEX_LEGAL = (
    "inc incorporated corp corporation co company ltd limited llc llp pvt private plc gmbh sarl sas sasu eurl snc sa"
).split()

#: Weight of a shared blocking key, by its type.
KEY_WEIGHTS = {"CN": 4, "PIN_NAME": 3, "2W": 2, "1W": 1, "PFX4": 1, "PFX5": 1, "ADDR": 1, "ADDR2W": 1}

FEATURES = [
    "feat_name_exact_core", "feat_name_exact_clean", "feat_name_token_jaccard", "feat_name_char_trigram_jaccard",
    "feat_name_levenshtein_ratio", "feat_name_jaro_winkler", "feat_name_length_diff", "feat_name_length_ratio",
    "feat_addr_exact_clean", "feat_addr_token_jaccard", "feat_addr_char_trigram_jaccard", "feat_postal_exact_match",
    "feat_number_overlap_ratio", "feat_is_s2", "feat_is_s3",
]

ID_PATTERN = "^S{n}-[A-Za-z0-9_-]+$"

#: Profiling patterns, by region.
PATTERNS = {
    "fr_accent": "[éèêëàâîïôùûüçœæÉÈÊËÀÂÎÏÔÙÛÜÇŒÆ]",
    "fr_street": r"(?i)\b(?:rue|avenue|ave|boulevard|bd|blvd|chemin|allée|allee|place|route|rt|quai|impasse)\b",
    "fr_postal": r"\b[0-9]{5}\b",
    "fr_legal": r"(?i)\b(?:sarl|sas|sa|sasu|eurl|snc|sci)\b",
    "in_pin": r"\b[1-9][0-9]{5}\b",
    "in_landmark": r"(?i)\b(?:near|nr|opp|opposite|behind|beside|adj|adjacent|above|floor|bldg|building|complex|chowk|bazaar|gali|marg|nagar|colony|enclave|vihar|sector|sec)\b",
    "us_zip": r"\b[0-9]{5}(?:-[0-9]{4})?\b",
    "corrupt": "[\ufffd\\x00]",
}
