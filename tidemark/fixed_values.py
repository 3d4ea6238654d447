"""Fixed values.

Domain lists, labels, patterns and thresholds that results depend on. They are
data, not logic: every rule that uses them lives elsewhere in the package.
"""

from __future__ import annotations

# --- special members -------------------------------------------------------
UNKNOWN_KEY = -1
UNKNOWN_LABEL = "Unknown"
INDEPENDENT_KEY = 0
INDEPENDENT_NAME = "Independent (no chain)"
INDEPENDENT_BAND = "Independent (1)"

# --- identifiers and text --------------------------------------------------
ID_WIDTH = 6
ZIP_WIDTH = 5
TEXT_ENCODING = "ISO-8859-1"
WHITESPACE = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0"
# text that a reader of delimited files takes as "no value"
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
TRUE_WORDS = ["Y", "YES", "TRUE", "1"]
FALSE_WORDS = ["N", "NO", "FALSE", "0"]

# --- dates: (pattern, shape), tried in this order ---------------------------
DATE_FORMATS = [
    ("yyyy-M-d", r"^\d{4}-\d{1,2}-\d{1,2}$"),
    ("M/d/yyyy", r"^\d{1,2}/\d{1,2}/\d{4}$"),
    ("d/M/yyyy", r"^\d{1,2}/\d{1,2}/\d{4}$"),
    ("yyyy/M/d", r"^\d{4}/\d{1,2}/\d{1,2}$"),
    ("M-d-yyyy", r"^\d{1,2}-\d{1,2}-\d{4}$"),
]
CALENDAR_START = "1960-01-01"
CALENDAR_END = "2027-12-31"
COVID_FIRST_DAY_AFTER = "2020-02-29"
COVID_LAST_DAY = "2021-12-31"
MONTH_NAMES_TH = [
    "มกราคม", "กุมภาพันธ์", "มีนาคม", "เมษายน", "พฤษภาคม", "มิถุนายน",
    "กรกฎาคม", "สิงหาคม", "กันยายน", "ตุลาคม", "พฤศจิกายน", "ธันวาคม",
]

# --- plausibility ----------------------------------------------------------
OCCUPANCY_RANGE = (0.0, 1.2)
TURNOVER_RANGE = (0.0, 200.0)
PROPORTION_MEDIAN = 1.5

# --- ownership type -> group -----------------------------------------------
FOR_PROFIT = "For profit"
NON_PROFIT = "Non profit"
GOVERNMENT = "Government"
OWNERSHIP_GROUPS = {
    "For profit - Corporation": FOR_PROFIT,
    "For profit - Individual": FOR_PROFIT,
    "For profit - Limited Liability company": FOR_PROFIT,
    "For profit - Partnership": FOR_PROFIT,
    "Government - City": GOVERNMENT,
    "Government - City/county": GOVERNMENT,
    "Government - County": GOVERNMENT,
    "Government - Federal": GOVERNMENT,
    "Government - Hospital district": GOVERNMENT,
    "Government - State": GOVERNMENT,
    "Non profit - Church related": NON_PROFIT,
    "Non profit - Corporation": NON_PROFIT,
    "Non profit - Other": NON_PROFIT,
}
OWNERSHIP_ORDER = [FOR_PROFIT, NON_PROFIT, GOVERNMENT]
CHAIN_BAND_ORDER = [
    "Independent (1)", "Small chain (2-9)", "Medium chain (10-49)", "Large chain (50+)",
]
FLAG_DOMAIN = {"Y": "SFF", "N": "None"}
FLAG_ABSENT = "None"
FOCUS_VALUES = ["SFF", "SFF Candidate"]
FINE = "Fine"
DENIAL = "Payment Denial"

# --- states: code, FIPS (None where the population file has none), name, region
STATES = [
    ("AL", "01", "Alabama", "South"), ("AK", "02", "Alaska", "West"),
    ("AZ", "04", "Arizona", "West"), ("AR", "05", "Arkansas", "South"),
    ("CA", "06", "California", "West"), ("CO", "08", "Colorado", "West"),
    ("CT", "09", "Connecticut", "Northeast"), ("DE", "10", "Delaware", "South"),
    ("DC", "11", "District of Columbia", "South"), ("FL", "12", "Florida", "South"),
    ("GA", "13", "Georgia", "South"), ("HI", "15", "Hawaii", "West"),
    ("ID", "16", "Idaho", "West"), ("IL", "17", "Illinois", "Midwest"),
    ("IN", "18", "Indiana", "Midwest"), ("IA", "19", "Iowa", "Midwest"),
    ("KS", "20", "Kansas", "Midwest"), ("KY", "21", "Kentucky", "South"),
    ("LA", "22", "Louisiana", "South"), ("ME", "23", "Maine", "Northeast"),
    ("MD", "24", "Maryland", "South"), ("MA", "25", "Massachusetts", "Northeast"),
    ("MI", "26", "Michigan", "Midwest"), ("MN", "27", "Minnesota", "Midwest"),
    ("MS", "28", "Mississippi", "South"), ("MO", "29", "Missouri", "Midwest"),
    ("MT", "30", "Montana", "West"), ("NE", "31", "Nebraska", "Midwest"),
    ("NV", "32", "Nevada", "West"), ("NH", "33", "New Hampshire", "Northeast"),
    ("NJ", "34", "New Jersey", "Northeast"), ("NM", "35", "New Mexico", "West"),
    ("NY", "36", "New York", "Northeast"), ("NC", "37", "North Carolina", "South"),
    ("ND", "38", "North Dakota", "Midwest"), ("OH", "39", "Ohio", "Midwest"),
    ("OK", "40", "Oklahoma", "South"), ("OR", "41", "Oregon", "West"),
    ("PA", "42", "Pennsylvania", "Northeast"), ("RI", "44", "Rhode Island", "Northeast"),
    ("SC", "45", "South Carolina", "South"), ("SD", "46", "South Dakota", "Midwest"),
    ("TN", "47", "Tennessee", "South"), ("TX", "48", "Texas", "South"),
    ("UT", "49", "Utah", "West"), ("VT", "50", "Vermont", "Northeast"),
    ("VA", "51", "Virginia", "South"), ("WA", "53", "Washington", "West"),
    ("WV", "54", "West Virginia", "South"), ("WI", "55", "Wisconsin", "Midwest"),
    ("WY", "56", "Wyoming", "West"), ("PR", "72", "Puerto Rico", "Territory"),
    ("GU", None, "Guam", "Territory"), ("VI", None, "U.S. Virgin Islands", "Territory"),
    ("AS", None, "American Samoa", "Territory"),
    ("MP", None, "Northern Mariana Islands", "Territory"),
]

# --- population source ------------------------------------------------------
ALL_AGES = 999
ELDERLY_FROM = 65
BOTH_SEXES = 0
NATIONAL_FIPS = "00"
POPULATION_YEARS = [2020, 2021, 2022, 2023, 2024]
POPULATION_VARIABLES = [
    "B01001_020E", "B01001_021E", "B01001_022E", "B01001_023E", "B01001_024E", "B01001_025E",
    "B01001_044E", "B01001_045E", "B01001_046E", "B01001_047E", "B01001_048E", "B01001_049E",
]
POPULATION_MIN_STATES = 51
POPULATION_TOTAL_RANGE = (50_000_000, 75_000_000)
POPULATION_OUTSIDE_TOTAL = "PR"

# --- file name -> logical table, first match wins, case-insensitive ----------
FILE_PATTERNS = [
    ("provider_info", r"(?:^|_)(?:NH_)?ProviderInfo(?:_Download)?(?:_[A-Za-z]{3}\d{4})?\.csv$"),
    ("penalties", r"(?:^|_)(?:NH_)?Penalties(?:_Download)?(?:_[A-Za-z]{3}\d{4})?\.csv$"),
    ("survey_summary", r"(?:^|_)(?:NH_)?SurveySummary(?:_Download)?(?:_[A-Za-z]{3}\d{4})?\.csv$"),
    ("citations", r"(?:^|_)(?:NH_)?CitationDescriptions(?:_Download)?(?:_[A-Za-z]{3}\d{4})?\.csv$"),
    ("state_averages", r"(?:^|_)(?:NH_)?State(?:US)?Averages(?:_Download)?(?:_[A-Za-z]{3}\d{4})?\.csv$"),
    ("vbp", r"(?:FY[_ ]\d{4}[_ ])?SNF[_ ]VBP[_ ]Facility[_ ]Performance\.csv$"),
]
REQUIRED_FILE = "provider_info"

# --- column names per era: canonical -> (2026, 2020, 2019); None = not published
PROVIDER_COLUMNS = {
    "ccn": ("CMS Certification Number (CCN)", "Federal Provider Number", "PROVNUM"),
    "provider_name": ("Provider Name", "Provider Name", "PROVNAME"),
    "address": ("Provider Address", "Provider Address", "ADDRESS"),
    "city": ("City/Town", "Provider City", "CITY"),
    "state_code": ("State", "Provider State", "STATE"),
    "zip_code": ("ZIP Code", "Provider Zip Code", "ZIP"),
    "county_ssa": ("Provider SSA County Code", "Provider SSA County Code", "COUNTY_SSA"),
    "county_parish": ("County/Parish", "Provider County Name", "COUNTY_NAME"),
    "urban_flag": ("Urban", None, None),
    "ownership_type": ("Ownership Type", "Ownership Type", "OWNERSHIP"),
    "certified_beds": ("Number of Certified Beds", "Number of Certified Beds", "BEDCERT"),
    "avg_residents_per_day": (
        "Average Number of Residents per Day", "Average Number of Residents per Day", "RESTOT"),
    "avg_residents_footnote": (
        "Average Number of Residents per Day Footnote",
        "Average Number of Residents per Day Footnote", None),
    "provider_type": ("Provider Type", "Provider Type", "CERTIFICATION"),
    "resides_in_hospital": (
        "Provider Resides in Hospital", "Provider Resides in Hospital", "INHOSP"),
    "legal_business_name": ("Legal Business Name", "Legal Business Name", "LBN"),
    "first_approved_date": (
        "Date First Approved to Provide Medicare and Medicaid Services",
        "Date First Approved to Provide Medicare and Medicaid Services", "PARTICIPATION_DATE"),
    "chain_name": ("Chain Name", None, None),
    "chain_id": ("Chain ID", None, None),
    "num_facilities_in_chain": ("Number of Facilities in Chain", None, None),
    "ccrc_flag": (
        "Continuing Care Retirement Community", "Continuing Care Retirement Community",
        "CCRC_FACIL"),
    "special_focus_status": ("Special Focus Status", "Special Focus Status", "SFF"),
    "abuse_icon": ("Abuse Icon", "Abuse Icon", None),
    "changed_ownership_12mo": (
        "Provider Changed Ownership in Last 12 Months",
        "Provider Changed Ownership in Last 12 Months", "CHOW_LAST_12MOS"),
    "overall_rating": ("Overall Rating", "Overall Rating", "OVERALL_RATING"),
    "overall_rating_footnote": (
        "Overall Rating Footnote", "Overall Rating Footnote", "overall_rating_fn"),
    "health_inspection_rating": (
        "Health Inspection Rating", "Health Inspection Rating", "SURVEY_RATING"),
    "staffing_rating": ("Staffing Rating", "Staffing Rating", "STAFFING_RATING"),
    "staffing_rating_footnote": (
        "Staffing Rating Footnote", "Staffing Rating Footnote", "staffing_rating_fn"),
    "reported_total_nurse_hprd": (
        "Reported Total Nurse Staffing Hours per Resident per Day",
        "Reported Total Nurse Staffing Hours per Resident per Day", "TOTHRD"),
    "reported_rn_hprd": (
        "Reported RN Staffing Hours per Resident per Day",
        "Reported RN Staffing Hours per Resident per Day", "RNHRD"),
    "total_nursing_turnover_pct": (
        "Total nursing staff turnover", "Total nursing staff turnover", None),
    "cycle1_total_deficiencies": (
        "Rating Cycle 1 Total Number of Health Deficiencies",
        "Rating Cycle 1 Total Number of Health Deficiencies", "CYCLE_1_DEFS"),
    "latitude": ("Latitude", None, None),
    "longitude": ("Longitude", None, None),
    "processing_date": ("Processing Date", "Processing Date", "FILEDATE"),
}
PENALTY_COLUMNS = {
    "ccn": ("CMS Certification Number (CCN)", "Federal Provider Number", "provnum"),
    "penalty_date": ("Penalty Date", "Penalty Date", "pnlty_date"),
    "penalty_type": ("Penalty Type", "Penalty Type", "pnlty_type"),
    "fine_id": ("Fine ID", None, None),
    "fine_amount_usd": ("Fine Amount", "Fine Amount", "fine_amt"),
    "payment_denial_start_date": (
        "Payment Denial Start Date", "Payment Denial Start Date", "payden_strt_dt"),
    "payment_denial_days": (
        "Payment Denial Length in Days", "Payment Denial Length in Days", "payden_days"),
    "processing_date": ("Processing Date", "Processing Date", "filedate"),
}
ERA_NAMES = ("2026", "2020", "2019")
CANONICAL_COLUMNS = {"provider_info": PROVIDER_COLUMNS, "penalties": PENALTY_COLUMNS}
MUST_HAVE = {
    "provider_info": ["ccn", "provider_name", "state_code", "ownership_type"],
    "penalties": ["ccn", "penalty_date", "penalty_type"],
}

# --- question parameters ----------------------------------------------------
FINES_WINDOW_MONTHS = 36
STAFFING_FLOOR = 3.48
# (lower edge, upper edge, label), lower edge included
STAFFING_BANDS = [
    (0.0, 2.75, "< 2.75"), (2.75, 3.0, "2.75-3.00"), (3.0, 3.25, "3.00-3.25"),
    (3.25, 3.48, "3.25-3.48"), (3.48, 3.75, "3.48-3.75"), (3.75, 4.0, "3.75-4.00"),
    (4.0, 4.25, "4.00-4.25"), (4.25, 4.5, "4.25-4.50"), (4.5, 5.0, "4.50-5.00"),
    (5.0, 99.0, "5.00+"),
]
TURNOVER_BANDS = [
    (0, 30, "< 30%"), (30, 35, "30-35%"), (35, 40, "35-40%"), (40, 45, "40-45%"),
    (45, 50, "45-50%"), (50, 55, "50-55%"), (55, 60, "55-60%"), (60, 65, "60-65%"),
    (65, 101, "65%+"),
]
TURNOVER_CONTROL_BANDS = [
    (0, 40, "< 40%"), (40, 50, "40-50%"), (50, 60, "50-60%"), (60, 101, "60%+"),
]
# open at both ends
COMPARE_STAFFING_BANDS = [
    (None, 3.0, "< 3.0"), (3.0, 3.5, "3.0-3.5"), (3.5, 4.0, "3.5-4.0"),
    (4.0, 4.5, "4.0-4.5"), (4.5, 5.0, "4.5-5.0"), (5.0, None, ">= 5.0"),
]
COMPARE_TURNOVER_BANDS = [
    (None, 30, "< 30%"), (30, 40, "30-40%"), (40, 50, "40-50%"),
    (50, 60, "50-60%"), (60, 70, "60-70%"), (70, None, ">= 70%"),
]
BED_BANDS = [
    (None, 50, "Small (<50 beds)"), (50, 100, "Medium (50-99 beds)"),
    (100, 200, "Large (100-199 beds)"), (200, None, "Very large (200+ beds)"),
]
HOUR_QUARTILES = ["Q1 thinnest", "Q2", "Q3", "Q4 richest"]
MARKET_RATING_BINS = [
    (1.0, 2.75, "< 2.75"), (2.75, 3.0, "2.75–3.00"), (3.0, 3.15, "3.00–3.15"),
    (3.15, 3.3, "3.15–3.30"), (3.3, 5.0, "> 3.30"),
]
SPLIT_CUTS = list(range(25, 71, 5))
SPLIT_MIN_SIDE = 200
RISK_FLAGS = [
    ("flag_special_focus", 3, "special focus"),
    ("flag_low_rating", 2, "1-2 stars"),
    ("flag_prior_fine", 2, "heavily fined"),
    ("flag_deficiencies", 1, "many deficiencies"),
    ("flag_thin_staffing", 1, "below 3.48 HPRD"),
]
RISK_HIGH = 5
RATING_LEVELS = [1, 2, 3, 4, 5]
THIN_BUCKET = 100
FINDING_MIN_GROUP = 50
FINDING_MIN_MARKET = 20
TRACKED_ATTRIBUTES = [
    "provider_name", "legal_business_name", "provider_type", "resides_in_hospital",
    "ccrc_flag", "special_focus_status", "abuse_icon", "bed_size_band",
]
NULL_REPORT_FIELDS = [
    "overall_rating", "special_focus_status", "chain_name", "latitude",
    "total_nursing_turnover_pct",
]
