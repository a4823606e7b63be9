"""Word lists, weights, limits and texts that decide results.

Every operator takes them as arguments; these are the defaults.
"""

from __future__ import annotations

# Terms whose counts are features, with their weight.
KEY_TERMS: dict[str, float] = {
    "software": 2.5,
    "support": 2.0,
    "provision": 1.0,
    "computer": 1.8,
    "services": 1.3,
    "systems": 1.2,
    "management": 1.0,
    "works": 1.0,
    "package": 1.0,
    "technical": 1.5,
}

# Whole words and phrases that speak against a notice, one point per occurrence.
EXCLUSION_TERMS: tuple[str, ...] = (
    "ground", "investigation", "construction", "building", "road", "bridge",
    "excavation", "concrete", "steel", "infrastructure", "landscaping",
    "drainage", "utilities", "geotechnical", "earthworks", "paving",
    "demolition", "refurbishment", "renovation", "roofing", "flooring",
    "mechanical", "electrical", "plumbing", "hvac", "heating", "ventilation",
    "air conditioning", "boiler", "pump", "pipe", "wiring", "circuit",
    "site", "contractor", "materials", "equipment", "machinery",
    "civil", "structural", "architectural", "survey", "planning",
    "medical", "healthcare", "nursing", "clinical", "pharmaceutical",
    "therapy", "treatment", "patient", "hospital", "clinic",
    "catering", "food", "kitchen", "dining", "restaurant", "meal", "meals",
    "cooking", "chef", "menu", "nutrition", "breakfast", "lunch", "dinner",
    "school meals", "meal service", "food service", "food provision",
    "breakfast provision", "lunch provision", "catering service",
    "cleaning", "maintenance", "janitorial", "waste", "refuse",
    "hygiene", "sanitization", "pest control",
    "transport", "logistics", "delivery", "freight", "shipping",
    "warehouse", "storage", "fleet", "vehicle", "truck",
    "legal", "solicitor", "barrister", "audit", "accounting",
    "insurance", "pension", "investment", "banking",
    "security", "guard", "surveillance", "alarm", "cctv", "monitoring",
    "energy", "renewable", "solar", "wind", "environmental",
    "waste management", "recycling", "sustainability",
)

# Whole words and phrases worth two more points per occurrence.
HEAVY_EXCLUSION_TERMS: tuple[str, ...] = (
    "construction", "building", "road", "bridge", "civil engineering",
    "mechanical", "electrical", "plumbing", "hvac", "infrastructure",
    "excavation", "concrete", "steel", "demolition", "refurbishment",
)

# Phrases found anywhere, also inside longer words, worth one and a half points.
EXCLUSION_PHRASES: tuple[str, ...] = (
    "ground investigation", "site investigation", "civil works",
    "building works", "construction works", "mechanical works",
    "electrical works", "infrastructure works", "road works",
    "maintenance works", "repair works", "cleaning services",
    "security services", "catering services", "transport services",
    "school meals", "meal service", "food service", "breakfast provision",
    "lunch provision", "dinner provision", "catering service", "food provision",
)

AUTHORITY_CODES: dict[str, int] = {
    "Health Service Executive": 1,
    "Dublin City Council": 2,
    "Cork City Council": 3,
    "Galway City Council": 4,
    "Department of Education": 5,
    "Department of Health": 6,
    "Office of Public Works": 7,
    "Transport Infrastructure Ireland": 8,
    "Irish Water": 9,
    "Revenue Commissioners": 10,
}

# Linear score: weight of codes_count, has_codes, title_length, ca_encoded, exclusion_score and
# of the ten key terms in their order.
FEATURE_WEIGHTS: tuple[float, ...] = (
    0.25, 0.10, 0.02, 0.03, -0.80,
    0.08, 0.05, 0.03, 0.02, 0.02, 0.01, 0.01, 0.005, 0.003, 0.003,
)
# Features are divided by these and capped at 1; the others are used as they are.
FEATURE_SCALES: dict[str, float] = {
    "codes_count": 20.0,
    "title_length": 200.0,
    "ca_encoded": 100.0,
    "exclusion_score": 10.0,
}
SIGMOID_SLOPE = 6.0
RULE_THRESHOLD = 0.054
REVIEW_THRESHOLD = 0.050
SIMPLE_THRESHOLD = 0.210
HARD_EXCLUSION = 4.0
SOFT_EXCLUSION = 2.0

# Words in a reply that point outside the scope.
NON_IT_INDICATORS: tuple[str, ...] = (
    "catering", "food service", "cleaning", "maintenance", "construction",
    "building work", "architectural", "medical", "healthcare", "security guard",
    "waste management", "facilities management", "mechanical", "electrical installation",
    "plumbing", "hvac", "surveying", "legal services", "sewerage", "eeg machine",
    "school meals", "breakfast provision", "lunch provision", "meal service",
)
NO_BID_PATTERNS: tuple[str, ...] = (
    "no bid", "do not bid", "don't bid", "not bid", "avoid bid",
    "not suitable", "not appropriate", "not relevant", "outside scope",
    "non-it", "not it related", "not technical", "unrelated", "irrelevant",
)
IT_INDICATORS: tuple[str, ...] = (
    "legitimate it", "genuine it opportunity", "clear it consultancy",
    "this is an it", "solid it opportunity", "technical opportunity",
)

# Texts written into replies and notifications.
KEY_POINTS_MISSING = "AI response could not be fully parsed"
KEY_POINTS_PLAIN = "Claude response was in plain text format"
RECOMMENDATION_MISSING = "See summary"
RECOMMENDATION_FALLBACK = "Review the summary for recommendations"
CONFIDENCE_MISSING = "Moderate confidence"
CONFIDENCE_PLAIN = "Unknown - response format issue"
NOTE_PARSED = "Successfully parsed structured Claude response"
NOTE_OVERRIDE = "⚠️ Claude OVERRODE the ML prediction"
NOTE_INDICATOR = "🚨 NON-IT INDICATOR DETECTED: "
NOTE_NO_BID = "🚫 Claude RECOMMENDS NO BID - Non-IT opportunity"
NOTE_PLAIN = "Claude response could not be parsed as JSON"
NOTE_SENT = "📧 EMAIL NOTIFICATION SENT - Analysis supports bid opportunity"
NOTE_SUPPRESSED = "🚫 EMAIL NOTIFICATION SUPPRESSED - Analysis indicates no bid opportunity"
ACTION_CRITICAL = "🚨 CRITICAL: Claude AI OVERRODE ML bid recommendation - review immediately for accuracy"
ACTION_URGENT = "REVIEW IMMEDIATELY: ML recommends bidding - Claude analysis confirms opportunity"
ACTION_MEDIUM = "⚠️ Review recommended: Some non-IT indicators detected but passed initial screening"
ACTION_DEFAULT = "Review completed AI summary for strategic assessment"
DIRECT_REASONING = "Direct processing - no ML prediction available"
TITLE_ONLY_REASONING = "Title-only analysis - no PDF content available"
MISSING_REASONING = "No reasoning provided"

# Shares and limits of the analyses.
COST_RATIOS: tuple[int, ...] = (1, 10, 25, 50, 100, 200)
MISSED_COST = 50_000
REVIEW_COST = 50
FREQUENCY_BANDS: tuple[tuple[str, int, int | None], ...] = (
    ("1", 1, 1), ("2-5", 2, 5), ("6-20", 6, 20), ("21-100", 21, 100), ("101+", 101, None),
)
