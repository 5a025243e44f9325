"""The code lists of the source systems.

Results are compared by these strings, so they are stated here once, as they are.
"""

CURRENT_ERP = "D365_FO"
LEGACY_ERP = "AX_2012"

TERRITORIES = ["US-East", "US-West", "Canada-East", "Canada-West"]

# territory_key, country_name, country_code, timezone
REGIONS = [
    ("US-East", "United States", "US", "EST"),
    ("US-West", "United States", "US", "PST"),
    ("Canada-East", "Canada", "CA", "EST"),
    ("Canada-West", "Canada", "CA", "PST"),
]

PRODUCT_LINES = {
    "PAV": "Pavers",
    "SLB": "Slabs",
    "RTW": "Retaining Walls",
    "PCP": "Pool Coping",
    "STP": "Outdoor Steps",
    "FIR": "Fire Pits",
    "MAS": "Masonry",
    "ACC": "Accessories",
}
OTHER_LINE = "Other"

SALES_UNITS = {"PAV": "sf", "SLB": "sf", "MAS": "sf", "RTW": "lf", "PCP": "lf", "STP": "lf"}
OTHER_UNIT = "each"

CHARGE_ACCOUNTS = {
    "DISCOUNT": "4101-DiscountsAllowed",
    "FREIGHT": "5210-FreightOut",
    "PALLET": "5215-PalletCharges",
}

# BU_CODE, BU_NAME, CHANNEL_CODE, CHANNEL_NAME
DIMENSION_VALUES = [
    ("BU-RES", "Residential", "CHN-DEALER", "Dealer Network"),
    ("BU-RES", "Residential", "CHN-DIRECT", "Direct to Homeowner"),
    ("BU-COM", "Commercial", "CHN-DEALER", "Dealer Network"),
    ("BU-COM", "Commercial", "CHN-PROJECT", "Commercial Project"),
    ("BU-PRO", "Pro/Contractor", "CHN-PRO", "Pro Loyalty Program"),
    ("BU-PRO", "Pro/Contractor", "CHN-DEALER", "Dealer Network"),
]

# account, description, category
GL_ACCOUNTS = [
    ("4010", "Sales Revenue - Pavers", "REVENUE"),
    ("4020", "Sales Revenue - Slabs", "REVENUE"),
    ("4030", "Sales Revenue - Walls", "REVENUE"),
    ("4040", "Sales Revenue - FirePits", "REVENUE"),
    ("4101", "Discounts Allowed", "REVENUE_CONTRA"),
    ("5010", "COGS - Raw Materials", "COGS"),
    ("5020", "COGS - Direct Labor", "COGS"),
    ("5030", "COGS - Manufacturing Overhead", "COGS"),
    ("5210", "Freight Out", "OPEX"),
    ("5220", "Marketing & Trade Shows", "OPEX"),
    ("6010", "Salaries & Benefits", "OPEX"),
    ("6020", "Rent & Utilities", "OPEX"),
    ("6030", "IT & Software (Power BI, ERP)", "OPEX"),
    ("7010", "Capex - Equipment", "CAPEX"),
]
GL_CATEGORIES = ["REVENUE", "REVENUE_CONTRA", "COGS", "OPEX", "CAPEX"]

# code, name
DEPARTMENTS = [
    ("SALES", "Sales"),
    ("OPS", "Operations"),
    ("FIN", "Finance"),
    ("IT", "Information Technology"),
    ("MFG", "Manufacturing"),
    ("MKTG", "Marketing"),
]

OPEN_STAGES = [
    "appointmentscheduled",
    "qualifiedtobuy",
    "presentationscheduled",
    "decisionmakerboughtin",
    "contractsent",
]
WON_STAGE = "closedwon"
LOST_STAGE = "closedlost"

LEAD_SOURCES = [
    "Trade Show",
    "Web Form",
    "Referral",
    "Cold Call",
    "Pro Loyalty Program",
    "Dealer Referral",
]

TRAFFIC_SOURCES = [
    "google", "direct", "facebook", "instagram", "pinterest", "houzz", "referral", "email",
]
TRAFFIC_MEDIA = ["organic", "cpc", "social", "referral", "email", "none"]
CAMPAIGNS = [
    "Spring2026-Pavers",
    "HouzzAlwaysOn",
    "ProgramLaunch-Steps",
    "Brand",
    "none",
    "Trade-Hardscape-Show",
]
DEVICES = ["mobile", "desktop", "tablet"]
WEB_EVENTS = ["page_view", "add_to_inspiration", "contact_form", "find_dealer", "request_quote"]
LEAD_EVENTS = ["contact_form", "request_quote", "find_dealer"]

# upper bound in days, bucket name; anything else, an unknown age too, is in the last one
AGING_BUCKETS = [(30, "0-30"), (60, "31-60"), (90, "61-90"), (180, "91-180"), (365, "181-365")]
OLDEST_BUCKET = "365+"

PERSONAS = [
    "HR",
    "FINANCE",
    "SALES_LEADER",
    "SALES_REP",
    "REGIONAL_MGR_US_EAST",
    "REGIONAL_MGR_US_WEST",
    "REGIONAL_MGR_CA_EAST",
    "REGIONAL_MGR_CA_WEST",
    "GLOBAL_LEADERSHIP",
]
