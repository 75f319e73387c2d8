"""Entity patterns and tables of fixed values, and regex matches with exact code-point offsets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hushwire.functions.offsets import located

# Patterns, word lists and lookup tables that results depend on.
EMAIL = r"\b[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[A-Za-z]{2,}\b"
URL = r"(?i)\b(?:https?://|www\.)[^\s<>()]+"
IPV4 = r"\b(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)\b"
PHONE = r"(?<!\d)(?:\+?\d{1,3}[-.\s]?)?(?:\(?\d{3}\)?[-.\s]?)?\d{3}[-.\s]?\d{4}(?!\d)"
SSN = r"\b\d{3}-\d{2}-\d{4}\b"
DOB = r"\b(?:0?[1-9]|1[0-2])[/-](?:0?[1-9]|[12]\d|3[01])[/-](?:\d{2}|\d{4})\b"
ZIP = r"\b\d{5}(?:-\d{4})?\b"
AADHAAR = r"\b\d{4}\s?\d{4}\s?\d{4}\b"
CARD = r"\b(?:\d[ -]*?){13,19}\b"
CVV = r"(?i)\b(?:cvv|cvc|security code)\s*(?:is|:|#)?\s*(\d{3,4})\b"
ROUTING = r"(?i)\b(?:routing|aba)\s*(?:number|no\.?|#)?\s*(?:is|:)?\s*(\d{9})\b"
MONTHS = "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|jun(?:e)?|jul(?:y)?|aug(?:ust)?|sep(?:tember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
ORDINALS = "first|second|third|fourth|fifth|sixth|seventh|eighth|ninth|tenth|eleventh|twelfth|thirteenth|fourteenth|fifteenth|sixteenth|seventeenth|eighteenth|nineteenth|twentieth|twenty\\s+first|twenty\\s+second|twenty\\s+third|twenty\\s+fourth|twenty\\s+fifth|twenty\\s+sixth|twenty\\s+seventh|twenty\\s+eighth|twenty\\s+ninth|thirtieth|thirty\\s+first"
MONTH_DOB = rf"(?i)\b(?:date of birth|dob|born|birthday)?\s*(?:{MONTHS})\s+(?:\d{{1,2}}|{ORDINALS})(?:,)?\s+(?:\d{{2,4}}|nineteen\s+\w+|twenty\s+\w+)"
ID_WORDS = "member|account|policy|reference|case|claim|mrn|subscriber|insurance|booking|confirmation|patient|medical record|healthcare|authorization|auth|invoice|customer|passport|driver license|drivers license|bank account|routing"
ID = rf"(?i)\b(?:{ID_WORDS})\s*(?:number|no\.?|#|id|code)?\s*(?:is|:|\-)?\s*([A-Z0-9][A-Z0-9\-]{{3,}})\b"
NAME = r"([a-z]+(?:\s+[a-z]+){0,2}?)"
#: Lead-in of a spoken name, and the words that end it.
NAMES = (
    ("my name is", "i am|i'm|calling|from|with|and|on behalf"),
    ("this is", "i am|i'm|calling|from|with|and|on behalf"),
    ("this message is for", "my name is|this is|i am|i'm|calling|from|with|and"),
    ("speaking with", "from|at|and"),
    ("patient name is", "date|dob|phone|member|and"),
)
NAME_BLACKLIST = (
    "nurse assistant doctor agent representative coordinator service health calling message program care customer member patient blue cross shield "
    "voicemail appointment medication phone number my name is hello hi amc callback call department office team hospital clinic speaking with this "
    "from please thank you medical insurance pharmacy"
).split()
TOKEN = r"[A-Za-z0-9@._%+\-']+"
NUMBER_WORDS = {"zero": "0", "oh": "0", "o": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
NUMBER_SEPARATORS = ("dash", "hyphen", "minus", "space", "spaces")
NUMBER_REPEATERS = {"double": 2, "triple": 3}
NUMBER_HINTS = "phone|mobile|number|contact|call me|member|account|policy|id|mrn|claim|dob|date of birth"
TYPE_PRIORITY = {
    "SSN": 1, "AADHAAR_NUMBER": 2, "CREDIT_CARD_NUMBER": 3, "CVV": 4, "PHONE": 5, "EMAIL": 6, "DOB": 7, "INSURANCE_ID": 8, "ACCOUNT_NUMBER": 9,
    "ROUTING_NUMBER": 10, "ID_NUMBER": 11, "ID": 12, "PASSPORT_NUMBER": 13, "DRIVER_LICENSE": 14, "PERSON_NAME": 15, "DOCTOR_NAME": 16, "USERNAME": 17,
    "PASSWORD": 18, "IP_ADDRESS": 19, "URL": 20, "LOCATION": 21, "INSTITUTION_NAME": 22, "ZIP": 23, "AGE": 24, "DATE": 25, "MEDICAL_CONDITION": 30,
    "MEDICATION": 31, "LAB_RESULT": 32,
}
TYPE_ALIASES = {
    "PHONE_NUMBER": "PHONE", "EMAIL_ADDRESS": "EMAIL", "DATE_OF_BIRTH": "DOB", "LOCATION_ADDRESS": "LOCATION", "LOCATION_STREET": "LOCATION",
    "LOCATION_CITY": "LOCATION", "LOCATION_STATE": "LOCATION", "LOCATION_COUNTRY": "LOCATION", "LOCATION_ZIP": "ZIP", "ZIPCODE": "ZIP",
    "AADHAAR": "AADHAAR_NUMBER", "INSURANCE": "INSURANCE_ID", "DOCTOR": "DOCTOR_NAME", "NAME_MEDICAL_PROFESSIONAL": "DOCTOR_NAME",
    "FIRST_NAME": "PERSON_NAME", "LAST_NAME": "PERSON_NAME", "PERSON": "PERSON_NAME", "NAME": "PERSON_NAME", "CREDIT_CARD": "CREDIT_CARD_NUMBER",
    "BANK_ACCOUNT": "ACCOUNT_NUMBER", "PASSPORT": "PASSPORT_NUMBER", "DRIVERS_LICENSE": "DRIVER_LICENSE", "MEDICAL_CODE": "ID_NUMBER",
    "HEALTHCARE_NUMBER": "ID_NUMBER", "ORGANIZATION_MEDICAL_FACILITY": "INSTITUTION_NAME", "ORGANIZATION": "INSTITUTION_NAME",
    "MEDICAL_FACILITY": "INSTITUTION_NAME", "CONDITION": "MEDICAL_CONDITION", "DIAGNOSIS": "MEDICAL_CONDITION", "DRUG": "MEDICATION",
    "DOSE": "MEDICATION", "MEDICAL_PROCESS": "MEDICAL_CONDITION",
}
TAGGER_LABELS = {
    "ACCOUNTNUM": "ACCOUNT_NUMBER", "BUILDINGNUM": "LOCATION", "CITY": "LOCATION", "CREDITCARDNUMBER": "CREDIT_CARD_NUMBER", "DATEOFBIRTH": "DOB",
    "DRIVERLICENSENUM": "DRIVER_LICENSE", "EMAIL": "EMAIL", "GIVENNAME": "PERSON_NAME", "IDCARDNUM": "ID_NUMBER", "PASSWORD": "PASSWORD",
    "SOCIALNUM": "SSN", "STREET": "LOCATION", "SURNAME": "PERSON_NAME", "TAXNUM": "ID_NUMBER", "TELEPHONENUM": "PHONE", "USERNAME": "USERNAME", "ZIPCODE": "ZIP",
}
#: Labels of a named-entity tagger that are entities here.
ENTITY_LABELS = {"PERSON": "PERSON_NAME", "ORG": "INSTITUTION_NAME", "GPE": "LOCATION", "LOC": "LOCATION", "DATE": "DATE"}
#: name, pattern, group, type, score, source: in the order that ties are broken by.
DETECTORS = (
    ("email", EMAIL, 0, "EMAIL", 1.0, "regex"),
    ("url", URL, 0, "URL", 0.95, "regex"),
    ("ipv4", IPV4, 0, "IP_ADDRESS", 0.95, "regex"),
    ("phone", PHONE, 0, "PHONE", 1.0, "regex"),
    ("ssn", SSN, 0, "SSN", 1.0, "regex"),
    ("dob", DOB, 0, "DOB", 1.0, "regex"),
    ("month_dob", MONTH_DOB, 0, "DOB", 0.95, "regex"),
    ("aadhaar", AADHAAR, 0, "AADHAAR_NUMBER", 1.0, "regex"),
    ("cvv", CVV, 1, "CVV", 0.95, "regex_context"),
    ("routing", ROUTING, 1, "ROUTING_NUMBER", 0.95, "regex_context"),
    ("card", CARD, 0, "CREDIT_CARD_NUMBER", 0.95, "regex"),
    ("zip", ZIP, 0, "ZIP", 0.75, "regex"),
    ("id", ID, 1, "ID", 0.95, "regex_context"),
)

ENTITY = "array<struct<text:string,type:string,start:int,end:int,score:double,source:string>>"


def quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def entities(text: str, pattern: str, group: int, kind: str, score: float, source: str) -> Column:
    """All matches of a pattern in column `text` as entities.  Offsets are sums over the pieces between
    matches and the matches; a context pattern ends with its group.  (?U) makes classes, boundaries and
    case folding Unicode-aware.  Nothing beyond one test is evaluated where the pattern never matches."""
    p = quoted("(?U)" + pattern)
    each = f"named_struct('text', g, 'type', '{kind}', 'start', s + length(m) - length(g), 'end', s + length(m), 'score', {score}D, 'source', '{source}')"
    return F.expr(f"CASE WHEN rlike({text}, {p}) THEN {located(text, p, each, group)} ELSE CAST(array() AS {ENTITY}) END")


def name_pattern(lead: str, stops: str) -> str:
    return rf"(?i)\b{lead}\s+{NAME}(?=\s+(?:{stops})\b|[.,;!?]|$)"


def lookup(table: dict, key: Column, default: Column | None = None) -> Column:
    """A small fixed table as a map literal."""
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    found = F.try_element_at(m, key)
    return found if default is None else F.coalesce(found, default)
