"""Word lists of the curation rules. All are fixed values, in their natural order."""

#: Terms of which one in a text makes it ban-related, unless it is excluded.
BAN_STRONG = [
    "banned drug", "ban drug", "prohibited drug", "prohibited medicine", "prohibition of drug", "prohibition of fixed", "fdc ban", "fdc prohibit",
    "fixed dose combination", "fixed-dose combination", "section 26a", "drugs banned", "drugs prohibited", "list of drugs prohibited", "manufacture and sale",
]
BAN_WEAK = ["g.s.r", "gsr", "s.o.", "gazette notification"]
EXCLUDED = [
    "fact check", "factcheck", "citizen charter", "citizens charter", "grievance", "press release summary", "annual report", "rti", "right to information",
    "fraudulent website", "social media", "twitter", "instagram", "vacancy", "recruitment", "tender", "budget", "parliament", "lok sabha", "rajya sabha",
]

MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]

#: Names that are no medicine.
NOT_NAMES = [
    *MONTHS,
    "total", "query", "queries", "total queries", "actionable queries", "fact check", "fact check unit", "thread link", "twitter link",
    "status", "target", "summary", "report", "grievance", "date", "page", "till", "result", "action", "actionable",
    "sr. no", "sr no", "sl. no", "sl no", "s.no", "sno", "nchmr.com", "nrrms.com", "niyukti.org", "brs.inc",
    "annexure", "appendix", "schedule", "table", "index", "contents", "preface", "foreword", "introduction", "[unreadable pdf]", "[no entries found]",
]

#: Dosage forms as written -> as stored.
FORMS = {
    "tablet": "Tablet", "tab": "Tablet", "tablets": "Tablet", "capsule": "Capsule", "cap": "Capsule", "capsules": "Capsule", "syrup": "Syrup", "syr": "Syrup",
    "suspension": "Suspension", "susp": "Suspension", "injection": "Injection", "inj": "Injection", "cream": "Cream", "ointment": "Ointment", "gel": "Gel",
    "drops": "Drops", "drop": "Drops", "eye drops": "Eye Drops", "ear drops": "Ear Drops", "nasal drops": "Nasal Drops", "lotion": "Lotion", "powder": "Powder",
    "solution": "Solution", "soln": "Solution", "inhaler": "Inhaler", "spray": "Spray", "patch": "Patch", "suppository": "Suppository", "respules": "Respules",
    "oral liquid": "Oral Liquid", "dry syrup": "Dry Syrup", "infusion": "Infusion", "emulsion": "Emulsion",
}

#: Substrings and whole words that give away a link, a menu entry or an office.
JUNK_PARTS = ["http", "www.", ".com", ".in", ".org", ".net", "link", "click here", "download"]
JUNK_SITES = ["thread link", "twitter", "instagram", "facebook"]
OFFICE_WORDS = [
    "department", "departments", "ministry", "directorate", "committee", "board", "governor", "officer", "officers", "secretary", "minister", "staff strength",
    "seniority", "promotion", "promotions", "training", "about us", "contact", "contact us", "feedback", "sitemap", "gallery", "photo gallery", "login", "search",
    "screen reader", "skip to", "accessibility", "disclaimer", "terms", "increase text", "decrease text", "high contrast", "grayscale", "negative contrast",
    "light background", "tender", "tenders", "career", "careers", "recruitment", "jobs", "advertisement", "policy", "scheme", "schemes", "service", "services",
    "directory", "forms", "orders", "circulars", "statistics", "legislation", "acts", "rules", "notices", "archives", "certificates", "who is who",
    "organization chart", "citizen charter", "government order", "standard treatment", "licence", "know your",
]

#: Signals of pages about single products, of any medicine, and of portals.
PAGE_POSITIVE = [
    "batch", "standard quality", "not of standard quality", "manufacturer", "manufactured by", "substandard", "nsq", "recall", "recalled", "spurious",
    "misbranded", "adulterated", "sample", "formulation", "expiry", "drug name", "product name", "pharmaceutical",
]
PAGE_WEAK = ["drug", "drugs", "medicine", "medicines"]
PAGE_NEGATIVE = [
    "about us", "directory", "forms", "services", "orders", "tenders", "recruitment", "screen reader", "skip to", "sitemap", "contact us", "photo gallery",
    "careers", "grievance", "who is who", "organization chart", "staff strength", "government order",
]
PAGE_MIN_POSITIVE = 2

#: Capitalised words of running text that are no product.
PLAIN_CAPITALS = [
    "The", "This", "That", "These", "Those", "India", "Central", "Government", "Ministry", "Health", "Whereas", "Therefore", "Section", "Schedule", "Gazette",
    "Notification", "New Delhi", "Date",
]

#: Words in a source that route a record to a table, first hit first.
ROUTES = [("unofficial_medicines", ["vaayath", "thehealthmaster", "healthmaster"]), ("ayush_fssai_medicines", ["ayush", "fssai"])]

#: Words that score a link to alerts, with their weight beyond one.
ALERT_WORDS = ["alert", "nsq", "recall", "substandard", "not of standard quality", "drug", "spurious", "notice"]
