"""Fixed values of the regulatory profile.

Everything in this module is data: the word lists, code tables, bands and
patterns that results depend on. The operators take them as parameters, so a
different domain passes different values.
"""
from __future__ import annotations

from dataclasses import dataclass

DUST, ADJACENT, OTHER = "dust", "adjacent", "other"
HOT, WARM, ARCHIVE = "Hot", "Warm", "Archive"

# ---------------------------------------------------------------- fixed values
# Territory, in report order.
TERRITORY = ("CA", "TX", "FL", "NY", "PA", "IL", "OH", "GA", "NC", "MI")
LOAD_START = "2019-01-01"

# Industry label, code prefixes, points; in priority order. Longest prefix wins.
INDUSTRIES = (
    ("Woodworking, cabinets & furniture", ("321", "337"), 3),
    ("Metal fabrication & machinery", ("332", "333"), 3),
    ("Cement, glass & mineral products", ("327",), 2),
    ("Food & grain processing", ("311",), 2),
    ("Pharmaceutical & nutraceutical", ("3254",), 1),
    ("Plastics, resins & composites", ("326", "3252"), 1),
    ("Foundries", ("3315",), 1),
)

# Words dropped from establishment names.
LEGAL_SUFFIXES = (
    "INC", "INCORPORATED", "LLC", "CO", "COMPANY", "CORP", "CORPORATION",
    "LTD", "LIMITED", "LP", "LLP", "PLLC", "PC", "THE",
)

# Street words and their abbreviations.
STREET_WORDS = (
    ("STREET", "ST"), ("AVENUE", "AVE"), ("AV", "AVE"), ("ROAD", "RD"), ("DRIVE", "DR"),
    ("BOULEVARD", "BLVD"), ("LANE", "LN"), ("COURT", "CT"), ("PARKWAY", "PKWY"),
    ("HIGHWAY", "HWY"), ("PLACE", "PL"), ("CIRCLE", "CIR"), ("TRAIL", "TRL"),
    ("NORTH", "N"), ("SOUTH", "S"), ("EAST", "E"), ("WEST", "W"), ("SUITE", "STE"),
)

# Readable names: words kept in capitals, words put in lower case.
KEEP_UPPER = ("LLC", "USA", "US", "II", "III", "IV", "CNC", "AG", "LP")
SMALL_WORDS = ("AND", "OF", "THE", "FOR", "DBA")

# Text patterns.
RECORD_PREFIX = r"^\s*\d{5,}\s*-\s*"
TRADE_NAME_CUT = r"\b(?:D/B/A|DBA|D B A)\b"
UNIT_CUT = r"\b(?:STE|SUITE|UNIT|BLDG|#)\b"

# Violation type codes.
VIOLATION_TYPES = (
    ("S", "Serious"), ("W", "Willful"), ("R", "Repeat"),
    ("O", "Other-than-serious"), ("U", "Unclassified"),
)
SERIOUS_TYPES = ("S", "W", "R")

# Emphasis program values and the names they are reported under.
DUST_PROGRAM_VALUE = "DUSTEXPL"
PROGRAM_VALUES = ("DUSTEXPL", "SILICA", "SILICA EXPOSURE")
DUST_PROGRAM = "Combustible Dust NEP"
SILICA_PROGRAM = "Silica emphasis program"

# Titles that count as dust evidence in an inspection under the dust program.
GENERAL_DUTY_TITLES = ("General Duty Clause", "Michigan general duty clause")
HAZARD_COMMUNICATION = "hazard communication"

# Federal sections (part 1910): section number, title, category.
FEDERAL_SECTIONS = (
    (94, "Ventilation (grinding, abrasive blasting, spray finishing)", DUST),
    (272, "Grain handling facilities", DUST),
    (1000, "Air contaminants (exposure limits)", DUST),
    (1018, "Inorganic arsenic", DUST),
    (1024, "Beryllium", DUST),
    (1025, "Lead", DUST),
    (1026, "Chromium (VI)", DUST),
    (1027, "Cadmium", DUST),
    (1053, "Respirable crystalline silica", DUST),
    (22, "Walking-working surfaces: housekeeping", ADJACENT),
    (107, "Spray finishing using flammable materials", ADJACENT),
    (134, "Respiratory protection", ADJACENT),
    (252, "Welding, cutting, and brazing", OTHER),
    (307, "Hazardous (classified) locations", ADJACENT),
    (23, "Ladders", OTHER),
    (24, "Step bolts and manhole steps", OTHER),
    (28, "Fall protection", OTHER),
    (29, "Fall protection systems", OTHER),
    (36, "Exit routes: design and construction", OTHER),
    (37, "Exit routes: maintenance", OTHER),
    (95, "Occupational noise exposure", OTHER),
    (119, "Process safety management", OTHER),
    (132, "Personal protective equipment: general", OTHER),
    (133, "Eye and face protection", OTHER),
    (138, "Hand protection", OTHER),
    (141, "Sanitation", OTHER),
    (146, "Permit-required confined spaces", OTHER),
    (147, "Control of hazardous energy (lockout/tagout)", OTHER),
    (151, "Medical services and first aid", OTHER),
    (157, "Portable fire extinguishers", OTHER),
    (176, "Materials handling and storage", OTHER),
    (178, "Powered industrial trucks", OTHER),
    (179, "Overhead and gantry cranes", OTHER),
    (184, "Slings", OTHER),
    (212, "Machine guarding: general requirements", OTHER),
    (213, "Woodworking machinery", OTHER),
    (215, "Abrasive wheel machinery", OTHER),
    (217, "Mechanical power presses", OTHER),
    (219, "Mechanical power-transmission apparatus", OTHER),
    (242, "Hand and portable powered tools", OTHER),
    (253, "Oxygen-fuel gas welding and cutting", OTHER),
    (263, "Bakery equipment", OTHER),
    (265, "Sawmills", OTHER),
    (303, "Electrical: general requirements", OTHER),
    (304, "Electrical: wiring design and protection", OTHER),
    (305, "Electrical: wiring methods", OTHER),
    (333, "Electrical: safety-related work practices", OTHER),
    (1030, "Bloodborne pathogens", OTHER),
    (1200, "Hazard communication", OTHER),
)
WELDING_SECTION = 252
WELDING_PARAGRAPH = "C"
WELDING_TITLE = "Welding: health protection and ventilation"

# Other federal parts: part, title.
FEDERAL_PARTS = (
    ("1904", "Injury and illness recordkeeping"),
    ("1903", "Inspections, citations, and penalties"),
    ("1926", "Construction standard"),
)

# State health rules, series 325: first number, last number, title, category.
STATE_HEALTH_RANGES = (
    (51101, 51108, "Part 301 Air Contaminants", DUST),
    (52001, 52012, "Part 520 Ventilation Control", DUST),
    (50251, 50258, "Part 523 Abrasive Blasting", DUST),
    (52501, 52506, "Part 525 Grinding, Polishing, and Buffing", DUST),
    (59001, 59015, "Part 590 Silica in General Industry", DUST),
    (51901, 51942, "Part 310 Lead in General Industry", DUST),
    (51851, 51886, "Part 309 Cadmium in General Industry", DUST),
    (50141, 50143, "Part 315 Chromium (VI) in General Industry", DUST),
    (34001, 34010, "Part 340 Beryllium", DUST),
    (60051, 60052, "Part 451 Respiratory Protection", ADJACENT),
    (52901, 52931, "Part 529 Welding, Cutting, and Brazing", ADJACENT),
    (47201, 47201, "Part 472 Medical Services and First Aid", OTHER),
    (47401, 47425, "Part 474 Sanitation", OTHER),
    (60001, 60013, "Part 433 Personal Protective Equipment", OTHER),
    (60101, 60128, "Part 380 Noise Exposure", OTHER),
    (63001, 63049, "Part 490 Permit-Required Confined Spaces", OTHER),
    (70001, 70018, "Part 554 Bloodborne Infectious Diseases", OTHER),
    (77001, 77004, "Part 430 Hazard Communication", OTHER),
)

# State safety rules, series 408: part number, title.
STATE_SAFETY_PARTS = (
    (1, "Part 1 General Provisions"),
    (2, "Part 2 Walking-Working Surfaces"),
    (7, "Part 7 Guards for Power Transmission"),
    (8, "Part 8 Portable Fire Extinguishers"),
    (11, "Part 11 Polishing, Buffing & Abrading"),
    (12, "Part 12 Welding and Cutting"),
    (14, "Part 14 Conveyors"),
    (18, "Part 18 Overhead and Gantry Cranes"),
    (21, "Part 21 Powered Industrial Trucks"),
    (23, "Part 23 Hydraulic Power Presses"),
    (24, "Part 24 Mechanical Power Presses"),
    (26, "Part 26 Metalworking Machinery"),
    (27, "Part 27 Woodworking Machinery"),
    (33, "Part 33 Personal Protective Equipment"),
    (38, "Part 38 Hand and Portable Powered Tools"),
    (39, "Part 39 Electrical Systems"),
    (40, "Part 40 Safety-Related Work Practices"),
    (44, "Part 44 Foundries"),
    (45, "Part 45 Die Casting"),
    (49, "Part 49 Slings"),
    (52, "Part 52 Sawmills"),
    (58, "Part 58 Aerial Work Platforms"),
    (62, "Part 62 Plastic Molding"),
    (65, "Part 65 Mills and Calenders for Rubber and Plastic"),
    (76, "Part 76 Spray Finishing"),
    (77, "Part 77 Grain Handling Facilities"),
    (81, "Part 81 Baking Operations"),
    (85, "Part 85 Control of Hazardous Energy"),
    (90, "Part 90 Permit-Required Confined Spaces"),
    (92, "Part 92 Hazard Communication"),
)
STATE_SAFETY_CATEGORY = ((77, DUST), (76, ADJACENT))
HOUSEKEEPING_RULE = 10015

# Emission files: expected year and column headers.
EMISSION_YEAR = 2024
EMISSION_COLUMNS = {
    "year": "1. YEAR",
    "facility_name": "4. FACILITY NAME",
    "state": "8. ST",
    "zip": "9. ZIP",
    "chemical": "37. CHEMICAL",
    "metal": "44. METAL",
    "form_type": "49. FORM TYPE",
    "unit": "50. UNIT OF MEASURE",
    "fugitive_air": "51. 5.1 - FUGITIVE AIR",
    "stack_air": "52. 5.2 - STACK AIR",
    "naics_1": "30. PRIMARY NAICS",
    "naics_2": "31. NAICS 2",
    "naics_3": "32. NAICS 3",
    "naics_4": "33. NAICS 4",
    "naics_5": "34. NAICS 5",
    "naics_6": "35. NAICS 6",
}
BLANK_AMOUNTS = ("NA", "N/A", "NE", "NR")

# Sales dispositions accepted as outcome labels.
DISPOSITIONS = (
    "no_relevant_process", "wrong_facility_entity", "existing_customer", "out_of_territory",
    "not_now", "no_response_after_defined_cadence", "qualified", "disqualified", "unknown",
)
POSITIVE_LABEL = "qualified"
SCORE_VERSION = "rubric-v1"
HISTORY_RUNS = 12

# Lead folders, stages, signals.
PRIORITY_SIZE = 100
PAGE_SIZE = 60
STAGES = (
    ("top", "Not contacted"), ("reached", "Reached out"), ("contact", "In contact"),
    ("audit", "Assessment booked"), ("hold", "On hold"),
)
FOLDERS = ("priority", "all", "hot", "warm", "hold", "reached", "contact", "audit")
SIGNALS = ("nep", "silica", "tri", "wood", "metal")
SILICA_CITATION = "1910.1053"

# Score factors: key, label, short label, maximum, rule text.
FACTORS = (
    ("industry", "Industry fit", "Industry", 3,
     "Woodworking and metal fabrication earn 3. Cement, glass, minerals and food earn 2. "
     "Plastics, pharma and foundries earn 1."),
    ("dust", "Dust evidence", "Dust", 3,
     "3 for a dust-specific citation, 2 for a dust-related citation or dust-program inspection, "
     "1 for any other serious citation. Last 36 months."),
    ("recency", "Recency", "Recent", 3,
     "Dust evidence within 12 months earns 3, within 24 months 2, within 36 months 1."),
    ("size", "Site size", "Size", 2,
     "20–500 employees at the site earns 2. 10–19 or 501–1,000 earns 1."),
    ("tri_air", "EPA air releases", "Air", 1,
     "1 point when the site reported metal air releases to EPA TRI. Reporting is not a violation."),
)
SPOTLIGHT_ORDER = ("dust", "industry", "recency", "size", "tri_air")
MAX_SCORE = 12

# Known reasons why a state has no Hot lead: state, name, reason.
GAP_NOTES = (
    ("CA", "California", "Cal/OSHA cites its own Title 8 rules, which the scorer doesn't classify yet."),
)
RECORD_LINK = "https://www.osha.gov/ords/imis/establishment.inspection_detail?id=%s.015"

# Draft checks.
WORD_LIMIT = 170
BANNED_TOPICS = (
    ("injury or death", r"\b(injur\w*|fatal\w*|death|died|killed|amputat\w*|hospitali\w*)"),
    ("legal action", r"\b(lawsuit\w*|litigation|sued|attorney\w*)\b"),
    ("compliance guarantee",
     r"\b(guarantee\w*|ensure(s|d)? (your )?compliance|make (you|your \w+) compliant|"
     r"bring (you|your \w+) into compliance|osha[- ]approved)"),
    ("pricing", r"\b(price[sd]?|pricing|discount\w*|cost[s]? (only|just))\b"),
)
NUMBER = r"\d[\d,]*(?:\.\d+)?"
COUNT_CLAIM = r"(?i)\b(\d{1,3})\s+(?:[\w-]+\s+)?(citations?|violations?|inspections?)\b"
OFFER_NUMBER = r"(?i)\b\d{1,3}[- ]minutes?\b"
ISSUE_KINDS = (
    ("unknown inspection ID", "unknown inspection ID"),
    ("cites no inspection ID", "talking point without a source"),
    ("is not in the records", "number not in the records"),
    ("doesn't match the records", "wrong count"),
    ("mentions", "banned topic"),
    ("dollar amount", "dollar amount in email"),
    ("words (limit", "email too long"),
    ("sign-off", "missing sign-off"),
)
# Data checks, in report order.
CHECKS = (
    "inspection IDs are unique",
    "every inspection maps to exactly one facility",
    "every citation belongs to a loaded inspection",
    "withdrawn citations are excluded",
    "every cited standard was classified",
    "facilities are in the territory and target industries",
    "inspection dates are inside the load window",
    "site headcounts are 1-4,999 or missing",
    "every facility has exactly one score",
    "scores are 0-12 and equal the sum of their parts",
    "tiers match the score cutoffs",
    "held or low-confidence leads are never outreach-eligible",
    "every Hot lead has cited dust evidence",
    "TRI points require a matched positive metal air release",
)
# What a passed check reports where the text is whole.
CHECK_NOTES = {
    "withdrawn": "0 withdrawn citations kept",
    "scores": "1 score per facility",
    "sums": "all totals consistent",
    "tiers": "Hot 8-12, Warm 5-7, Archive 0-4 or no dust evidence",
    "backed": "all Hot leads backed by records",
}
# Evidence levels 3, 2, 1, 0.
DUST_REASONS = (
    "dust-specific citation",
    "dust-related citation or dust-program inspection",
    "serious citation, not dust-related",
    "no citations in the last 36 months",
)
# Reasons of a score that hold no values.
REASONS = {
    "serious": "A serious OSHA citation that is not dust-related.",
    "no citations": "No qualifying citations in the last 36 months.",
    "no dust": "There is no dust-related evidence, so recency earns nothing.",
    "no headcount": "Site headcount isn't on record.",
    "core size": ". 20–500 is the core range.",
    "near size": ", just outside the 20–500 core range.",
    "other size": ", outside the 10–1,000 range.",
}
# Status lines of a lead.
REVIEW = "A person should review the record before anyone contacts this plant."
NO_TALKING_POINT = "A contested citation is not a sales talking point."
READY = "Ready for outreach. Check the public OSHA record before contacting anyone."
NOT_READY = "Not outreach-ready: the headcount or industry code is uncertain, or the facility match needs review."
# Issue texts of drafts.
ISSUES = {
    "no source": " cites no inspection ID",
    "unknown source": " cites unknown inspection ID ",
    "dollar": "email_body: contains a dollar amount",
}
# ------------------------------------------------------------ end fixed values


@dataclass(frozen=True)
class ScoreRules:
    """Windows, bands and cut-offs of the rubric."""

    window_months: int = 36
    injury_months: int = 24
    recency_bands: tuple = ((3, 12), (2, 24), (1, 36))
    size_bands: tuple = ((2, 20, 500), (1, 10, 1000))
    hot_min: int = 8
    warm_min: int = 5
    industries: tuple = INDUSTRIES

    @property
    def prefixes(self) -> tuple:
        return tuple(p for _, prefixes, _ in self.industries for p in prefixes)


DEFAULT_RULES = ScoreRules()
