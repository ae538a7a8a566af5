"""Fixed values.

The word lists, header spellings, statuses and texts below must be exactly these for
results to be right; they are facts of the data contract, not logic.
"""

REQUIRED_COLUMNS = ("first_name", "last_name")
OPTIONAL_COLUMNS = ("email", "company", "location", "linkedin_url", "consent")
INPUT_COLUMNS = REQUIRED_COLUMNS + OPTIONAL_COLUMNS

# Header spellings per canonical column.
HEADER_ALIASES = {
    "first_name": ["first_name", "firstname", "first", "given_name", "given"],
    "last_name": ["last_name", "lastname", "last", "surname", "family_name"],
    "email": ["email", "e_mail", "email_address", "mail"],
    "company": ["company", "company_name", "organisation", "organization", "employer"],
    "location": ["location", "city", "country", "region"],
    "linkedin_url": ["linkedin_url", "linkedin", "linkedin_profile", "profile_url"],
    "consent": ["consent", "opt_in", "optin", "marketing_consent", "consent_to_contact",
                "gdpr_consent", "permission"],
}

# Values typed instead of a name, in placeholder-key form.
NAME_PLACEHOLDERS = [
    "test", "testing", "tester", "test test", "n a", "na", "none", "null", "nil", "unknown",
    "anonymous", "anon", "asdf", "qwerty", "xxx", "tbd", "tba", "name", "first name",
    "first_name", "firstname", "last name", "last_name", "lastname", "surname",
]

# Values typed instead of an employer or a place.
ORG_PLACEHOLDERS = [
    "n a", "na", "none", "null", "nil", "unknown", "test", "tbd", "tba", "not applicable",
    "no", "no company", "self", "self employed", "selfemployed", "unemployed", "student",
    "retired", "freelance", "freelancer", "independent", "individual", "personal", "private",
    "other",
]

CONSENT_YES = ["yes", "y", "true", "1", "opt in", "optin", "opted in", "agreed", "agree",
               "granted", "consented", "ok"]
CONSENT_NO = ["no", "n", "false", "0", "opt out", "optout", "opted out", "declined", "decline",
              "withheld", "refused", "none"]

# Delimiters in order of preference.
DELIMITERS = [",", ";", "\t", "|"]

# Windows-1252 characters of the bytes 0x80 to 0x9F, U+FFFD where the code page has none.
CP1252_HIGH = (
    "€�‚ƒ„…†‡ˆ‰Š‹Œ�Ž�"
    "�‘’“”•–—˜™š›œ�žŸ"
)

STATUSES = ["matched", "cached", "not_found", "ambiguous", "budget_deferred",
            "provider_unavailable", "error", "invalid_input"]
MATCHED_STATUSES = ["matched", "cached"]
CACHEABLE_STATUSES = ["matched", "not_found", "ambiguous"]
METHODS = ["email", "linkedin", "name_context", "name_only"]
CALL_KINDS = ["enrich", "identify"]

# Reasons a name is unusable (the placeholder reason appends the quoted value).
NAME_LOOKS_LIKE_EMAIL = "looks like an email address (columns swapped?)"
NAME_HAS_DIGITS = "contains digits"
NAME_HAS_NO_LETTERS = "contains no letters"
NAME_EMPTY = "String should have at least 1 character"
CONSENT_WITHHELD = "consent: withheld"
CONSENT_MISSING = "consent: not recorded (require_consent is on)"

UNRECORDED_MESSAGE = "no result recorded: the enrich invocation failed after retries"
MAX_ERROR_MESSAGE = 1000

# Days each kind of data is kept.
RETENTION_DAYS = {"raw": 90, "landing": 30, "quarantine": 90, "lookup_cache": 90,
                  "batch_claims": 90, "batch_counter": 90, "month_counter": 400,
                  "exhausted_marker": 45}
