"""Names, types and fixed values shared by all modules."""

from __future__ import annotations

# These must equal the tool this library replaces.

PERSONAS = (
    "Executive Sponsor",
    "Economic Buyer",
    "Data Product Manager/Owner",
    "Data User",
    "Application Developer",
    "Real-time Specialist",
    "Operator/Systems Administrator",
    "Technical Decision Maker",
    "Not a target",
)
PERSONAS_FIVE = ("Executive", "Architect", "IT Manager", "Developer", "Not a target")
PERSONAS_SIX = (
    "Executive Sponsor",
    "Economic Buyer",
    "Technical Decision Maker",
    "Technical User",
    "Business Beneficiary",
    "Not a target",
)

# Persona name to CRM enum value; order decides between keys that differ in case only.
CRM_ENUM = {
    "Application Developer": "persona_1",
    "Executive Sponsor": "persona_2",
    "Economic Buyer": "persona_3",
    "Data Product Manager/Owner": "persona_4",
    "Data User": "persona_5",
    "Real-time Specialist": "persona_6",
    "Real-Time Specialist": "persona_6",
    "Operator/Systems Administrator": "persona_7",
    "Technical Decision Maker": "persona_8",
    "Not a target": "persona_9",
}

NULL_TOKENS = ("nan", "NaN", "None")
REPLY_NULL_TOKENS = ("nan", "NaN", "None", "NA", "null")

TOKENS_PER_ROW = 120
TOKENS_PER_MINUTE = 360000
BASE_PAUSE_SECONDS = 1.5
MAX_ATTEMPTS = 5
FIRST_BACKOFF_SECONDS = 2.0
MAX_BACKOFF_SECONDS = 30.0
MIN_CHUNK = 10
MAX_CHUNK = 250
MAX_PASSES = 3
CRM_BLOCK = 100
CONTACT_LIMIT = 10000
FUZZY_THRESHOLD = 60

SUMMARY_SHEET = "HubSpot Export Summary"
ARCHIVE_MEMBER = "contacts-with-job-title-but-no.csv"
REQUEST_METHOD = "POST"
REQUEST_URL = "/v1/chat/completions"
REQUEST_MODEL = "gpt-4.1-nano"
REQUEST_FORMAT = (
    "\n\nCRITICAL OUTPUT FORMAT: Respond with a SINGLE JSON object only.\n"
    'Required keys: {"persona": <one of the defined personas>, "certainty": <0-100 integer or %>}.\n'
    "Do not include extra keys, code fences, or commentary."
)
REQUEST_ID_LABEL = "Prospect Id: "
REQUEST_TITLE_LABEL = "\nJob Title: "
REQUEST_CLOSING = "\n\nReturn ONLY the JSON."

NO_RESPONSE = "No LLM response"
INVALID_PREFIX = "Invalid persona: "
BATCH_PREFIX = "Batch error: "
RETRY_HINT = r"try again in ([0-9]+(?:\.[0-9]+)?)s"
UNKNOWN_DURATION = "—"
FINAL_BATCH_STATES = ("completed", "failed", "cancelled", "canceled")
CRM_PERSONA_PROPERTY = "hs_persona"
CRM_CERTAINTY_PROPERTY = "persona_certainty"

# Characters that count as blank at the ends of a text.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Own addresses, by a name that no company has; hand in the one to filter by.
INTERNAL_MARKER = "@internal"
INTERNAL_OR_TEST = "@internal|test"

# Display names at the CSV edges and their names inside.
DISPLAY_NAMES = {
    "Prospect Id": "prospect_id",
    "Record ID": "record_id",
    "Email": "email",
    "Job Title": "job_title",
    "First Name": "first_name",
    "Last Name": "last_name",
    "Company": "company",
    "Persona": "persona",
    "Persona Certainty": "persona_certainty",
    "Skip Reason": "skip_reason",
}
CLEANED_COLUMNS = ("prospect_id", "job_title", "first_name", "last_name", "email", "company")
CONTACT_COLUMNS = ("prospect_id", "email", "job_title")
EXPECTED_COLUMNS = ("prospect_id", "email", "job_title", "company")
DECISION_COLUMNS = ("prospect_id", "email", "job_title", "persona", "persona_certainty", "skip_reason")

# Rule table of the stand-in classifier: (priority, pattern, persona).
TITLE_RULES = (
    (1, "Founder|Owner|Chief|President|Officer|CEO|CTO|CIO", "Executive Sponsor"),
    (2, "Product Manager|Product Owner", "Data Product Manager/Owner"),
    (3, "VP|Director|Head", "Economic Buyer"),
    (4, "Architect|Principal", "Technical Decision Maker"),
    (5, "Administrator|Operator|SRE|Reliability", "Operator/Systems Administrator"),
    (6, "Real-time|Streaming", "Real-time Specialist"),
    (7, "Analyst|Scientist", "Data User"),
    (8, "Engineer|Developer", "Application Developer"),
)
RULE_DEFAULT = "Not a target"

REPLY_COLUMNS = ("prospect_id", "job_title", "persona", "persona_certainty")
ENVELOPE = """
    custom_id STRING,
    response STRUCT<
        status_code: STRING,
        body: STRUCT<
            choices: ARRAY<STRUCT<message: STRUCT<content: STRING>>>,
            error: STRUCT<message: STRING>
        >
    >
"""
PERSONA_OBJECTS = "ARRAY<STRUCT<persona: STRING, certainty: STRING>>"

CRM_CONTACT = """
    id STRING,
    properties STRUCT<
        hs_object_id: STRING, email: STRING, jobtitle: STRING,
        firstname: STRING, lastname: STRING, company: STRING
    >
"""
