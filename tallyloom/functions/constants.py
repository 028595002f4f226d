"""Fixed values. Results depend on these being exactly as written."""

# --- fixed values: topic-area labels ----------------------------------------
TOPIC_AREAS = {
    "law & justice": "Law & Justice",
    "mission-enabling": "Mission-Enabling",
    "mission-enabling (internal agency support)": "Mission-Enabling",
    "government services (includes benefits and service delivery)": "Government Services",
    "health & medical": "Health & Medical",
    "diplomacy & trade": "Diplomacy & Trade",
    "education & workforce": "Education & Workforce",
    "emergency management": "Emergency Management",
    "transportation": "Transportation",
    "ai used in transportation operations": "Transportation",
    "internal dot research project": "Transportation",
    "dot sponsored external research": "Transportation",
    "other": "Other",
    "natural language processing": "Natural Language Processing",
    "nlp": "Natural Language Processing",
    "deep learning": "Deep Learning",
    "statistical methods": "Statistical Methods",
    "classification": "Classification",
    "aiml platform/environment": "AIML Platform/Environment",
    "administration of ai governance, processes, and procedures": "AI Governance",
    "department-level ai capabilities and capacity": "AI Capability Development",
}

# --- fixed values: complexity points per topic id (0..39) --------------------
TOPIC_COMPLEXITY = {
    0: 3, 1: 5, 2: 2, 3: 3, 4: 3, 5: 4, 6: 2, 7: 3, 8: 3, 9: 3, 10: 3, 11: 2, 12: 2, 13: 4, 14: 5,
    15: 3, 16: 3, 17: 4, 18: 3, 19: 4, 20: 3, 21: 2, 22: 3, 23: 3, 24: 2, 25: 3, 26: 3, 27: 4,
    28: 2, 29: 4, 30: 3, 31: 3, 32: 5, 33: 3, 34: 4, 35: 4, 36: 4, 37: 5, 38: 4, 39: 3,
}

# --- fixed values: complexity points per topic area ---------------------------
AREA_COMPLEXITY = {
    "Health & Medical": 5,
    "AI used in Transportation Operations": 5,
    "Transportation": 5,
    "Law & Justice": 4,
    "Emergency Management": 4,
    "Energy & the Environment": 4,
    "Science & Space": 3,
    "Government Services (includes Benefits and Service Delivery)": 3,
    "Education & Workforce": 3,
    "Mission-Enabling (internal agency support)": 3,
    "Administration of AI Governance, Processes, and Procedures": 2,
    "Department-Level AI Capabilities and Capacity": 2,
    "Natural Language Processing": 3,
    "Deep Learning": 4,
    "Statistical Methods": 3,
    "Classification": 3,
    "AIML Platform/Environment": 3,
    "Other": 2,
    "": 2,
}

# --- fixed values: narrative patterns per complexity level --------------------
LEVEL_PATTERNS = {
    1: [r"\bform\b", r"\bdashboard\b", r"report(ing)?", r"faq\b", r"caption",
        r"\bemail\b", r"data entry", r"voicebot"],
    2: [r"classif(y|ier)", r"lookup", r"keyword", r"translation", r"text extraction",
        r"matching", r"search", r"sentiment", r"autocoder", r"prediction", r"forecast",
        r"regression", r"risk model", r"topic model", r"clustering",
        r"entity (resolution|linkage)", r"normalization", r"data integration",
        r"pattern detection"],
    3: [r"simulation", r"synthetic data", r"anomaly detection", r"timeseries",
        r"fuzzy matching", r"phenotyping", r"network analysis", r"data fusion"],
    4: [r"deep learning", r"neural network", r"computer vision", r"speech recognition",
        r"transformer", r"geospatial", r"bioacoustic", r"autonomous", r"forecasting"],
    5: [r"generative", r"LLM", r"foundation model", r"digital twin", r"RAG",
        r"simulation of the nation", r"VR persona", r"reinforcement learning", r"ChatGPT"],
}

# --- fixed values: impact answers ---------------------------------------------
IMPACT_LABELS = {
    "rights-impacting": "Rights-impacting",
    "safety-impacting": "Safety-impacting",
    "both": "Both",
    "neither": "Neither",
}
TOO_NEW_ANSWERS = [
    "no, use case is too new to fully assess impacts; will be reassessed before end of initiation stage.",
    "no, use case is too new to fully assess impacts; will be reassessed before end of acquisition and development stage.",
    "case-by-case assessment",
]
IMPACT_CLASSES = {0: "Neither", 1: "Rights only", 2: "Safety only", 3: "Both"}

# --- fixed values: boilerplate phrases ------------------------------------------
PRECLEAN_PHRASES = [
    r"\bmission[-\s]+enabling\b",
    r"\buse[-\s]*case(?:s)?\b",
    r"\bintended\s+purpose\b",
    r"\bexpected\s+benefits\b",
]
BOILERPLATE_PHRASES = PRECLEAN_PHRASES + [
    r"\bthis\s+(project|system|tool)\b",
    r"\bprovide(s|d)?\s+(capability|capabilities)\b",
]

# --- fixed values: label word lists ----------------------------------------------
LABEL_HIDE = [
    "use", "case", "cases", "project", "projects", "platform", "platforms", "service", "services", "solution",
    "solutions", "tool", "tools", "implementation", "assessment", "intended", "benefits", "purpose",
]
LABEL_KEEP = [
    "data", "model", "models", "system", "systems", "support", "capability", "capabilities", "privacy",
    "security", "safety", "risk", "fraud", "cyber", "inspection", "screening", "asylum", "border", "maritime",
    "aviation", "medical", "health", "threat", "detection", "text", "imagery", "image", "video", "vision",
    "nlp", "speech", "biometric", "cargo", "port", "foia", "records", "satellite", "maps", "geospatial",
    "legal", "law", "justice",
]
DOMAIN_STOP = [
    "ai", "use", "case", "cases", "model", "models", "data", "dataset", "agency", "agencies", "system",
    "systems", "information", "service", "services", "project", "projects", "u", "s", "us", "gov", "federal",
]
PHRASE_STOP = DOMAIN_STOP + ["provide", "provided", "using", "based"]
KEEP_UPPER = ["AI", "LLM", "NLP", "FOIA", "FAA", "IRS", "VA", "ML", "UAS", "GIS", "EE", "BE"]

# --- fixed values: "nothing to declare" answers ------------------------------------
NO_DEMOGRAPHICS = ["none", "n/a", "na", "not applicable", "no demographic variables"]

# Default English function words; every operator takes the list as an argument.
ENGLISH_STOP = (
    "a about above after again against all also am an and any are as at be because been "
    "before being below between both but by can cannot could did do does doing down during "
    "each few for from further had has have having he her here hers him his how i if in into "
    "is it its itself just me more most my myself no nor not now of off on once only or other "
    "our ours out over own same she should so some such than that the their theirs them then "
    "there these they this those through to too under until up very was we were what when "
    "where which while who whom why will with would you your yours"
).split()
