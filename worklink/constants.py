"""Fixed values. They must equal the published pipeline's for results to agree."""

# education ladder: text -> level, in order of precedence for partial matches
EDUCATION_LEVELS = {
    "8th pass": 1, "8th": 1,
    "10th pass": 2, "10th": 2, "ssc": 2, "matriculation": 2,
    "12th pass": 3, "12th": 3, "hsc": 3, "intermediate": 3,
    "iti": 4, "diploma": 4, "iti/diploma": 4, "polytechnic": 4,
    "graduate": 5, "graduation": 5, "bachelor": 5,
    "b.tech": 5, "b.sc": 5, "b.com": 5, "b.a": 5, "be": 5,
    "postgraduate": 6, "post graduate": 6, "master": 6, "m.tech": 6, "mba": 6,
}

# matching
WEIGHTS = {"role": 0.40, "location": 0.30, "salary": 0.20, "education": 0.10}
CONFIDENCE_FLOOR = 0.40
ROLE_PAIR_FLOOR = 0.30
ROLE_FIT = 0.50
LOCATION_FIT = 0.50
CONFIDENCE_LABELS = ((0.80, "High"), (0.60, "Medium"), (0.40, "Low"))
LOWEST_LABEL = "Very Low"
RIGHT_FIT = "Right Fit"
PARTIAL_FIT = "Partial Fit"

# salary basis by nature of job
STIPEND_WORDS = ("internship", "apprenticeship", "trainee", "stipend")
TASK_RATE_WORDS = ("task", "piece", "gig", "freelance", "daily wage", "daily-wage")

# test and spam records; words and domains of an own organisation are passed by the caller
TEST_ORG_WORDS = ("test", "demo", "trial", "sample", "dummy", "fake", "xyz")
TEST_PLUS_ADDRESS = r"(?i)\+(test|demo|trial|sample)\d*@"
COUNTRY_PREFIXES = ("91", "091", "0")
PHONE_LENGTHS = (8, 13)

# labels of free text
SECTORS = (
    "Manufacturing", "IT & Technology", "Finance & Banking", "Healthcare",
    "Education & Training", "Retail & Sales", "Construction & Real Estate",
    "Agriculture", "Logistics & Transport", "Hospitality & Tourism",
    "Government & Public Sector", "Media & Entertainment", "Telecommunications",
    "Energy & Utilities", "Automotive", "Textiles & Apparel", "Any", "Other",
)
COLLARS = ("White Collar", "Blue Collar", "Grey Collar", "Any")
ROLE_FIELDS = (
    "role", "sector", "collar",
    "blue_collar_equivalent", "grey_collar_equivalent", "white_collar_equivalent",
)
LABEL_BATCH = 50

# columns whose text is labelled
LOCATION_COLUMNS = {
    "profile": ["location_city", "location_state", "location_address",
                "location_country", "current_location", "hometown"],
    "organization": ["address"],
    "job_posting": ["provider_location_city", "provider_location_state",
                    "provider_location_address", "provider_location_country"],
    "job_application": ["app_location_city", "app_location_state",
                        "app_location_address", "seeker_current_location"],
}
ROLE_COLUMNS = {
    "profile": ["role"],
    "job_posting": ["role", "title", "job_title"],
    "job_application": ["job_role", "job_title"],
}

# follow-up and action labels
PROVIDER_ACTIONS = ("Nudge job providers", "Check job freshness")
JOB_FOLLOW_UPS = (
    "Update Location", "Update Role", "Update Openings", "Update Salary",
    "Update Contact Details", "Shortlist / Reject Applications",
)
SEEKER_FOLLOW_UPS = (
    "Update Name", "Update Location", "Update Contact Details", "Update Role",
)
REQUEST_TYPE = "Jobs"
SEEKER_ACTION = "Kaam Ki Baat"

# sources
SEEKER_TABLES = ("profile", "user", "member", "organization")
PROVIDER_TABLES = ("job_posting", "job_application", "member", "organization", "user")
STATES = ("KA", "UP")
