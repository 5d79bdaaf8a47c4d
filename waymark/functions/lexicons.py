"""Word lists, patterns and tables that results depend on. Operators take them as parameters."""

# Tag -> terms, matched at word boundaries.
INTENT_TERMS = {
    "quiet": ["quiet", "calm", "peaceful", "silent", "less crowded", "serene"],
    "walking": ["walk", "walking", "trail", "path", "promenade", "lake", "park"],
    "outdoor": ["outdoor", "open air", "park", "lake", "garden", "trail"],
    "scenic": ["scenic", "view", "beautiful", "lake", "sunset", "greenery"],
    "dating": ["date", "romantic", "couple", "cozy", "quiet", "rooftop"],
    "networking": ["founder", "startup", "meetup", "network", "community"],
    "startup": ["startup", "founder", "pitch", "investor", "cowork"],
    "badminton": ["badminton", "shuttle", "court"],
    "football": ["football", "futsal", "turf"],
    "gaming": ["gaming", "arcade", "esports", "board game"],
    "reading": ["book", "library", "reading", "poetry"],
    "spirituality": ["temple", "mosque", "church", "spiritual", "pray"],
    "volunteering": ["volunteer", "ngo", "cause", "donate"],
    "nightlife": ["bar", "club", "pub", "brew", "nightlife", "dj"],
    "family": ["family", "kids", "park", "mall"],
    "student": ["student", "college", "campus", "budget"],
    "travel": ["tourism", "heritage", "museum", "landmark"],
    "luxury": ["luxury", "premium", "fine dining", "resort"],
    "budget": ["budget", "cheap", "affordable", "street food"],
    "solo": ["solo", "quiet", "walk", "work"],
    "friends": ["friends", "group", "hangout", "team"],
}
POSITIVE = ["good", "great", "best", "love", "amazing", "safe", "clean", "friendly", "beautiful"]
NEGATIVE = ["bad", "worst", "crowded", "unsafe", "dirty", "expensive", "slow", "rude"]
MOOD_TERMS = {
    "quiet": ["quiet", "quite", "calm", "peaceful", "silent", "serene", "less crowded"],
    "good_for_walking": ["walk", "walking", "trail", "path", "promenade", "park", "lake", "garden"],
    "outdoor": ["outdoor", "open air", "park", "lake", "garden", "trail"],
    "scenic": ["scenic", "view", "beautiful", "sunset", "lake", "greenery"],
    "family_friendly": ["family", "kids", "children"],
    "nightlife": ["nightlife", "night", "pub", "bar", "club", "midnight"],
    "budget": ["budget", "cheap", "affordable", "street food"],
    "social": ["friends", "group", "hangout", "community"],
}
CENTRES = {
    "begumpet": (17.4447, 78.4665),
    "banjara hills": (17.4138, 78.4398),
    "gachibowli": (17.4401, 78.3489),
    "hitec city": (17.4435, 78.3772),
    "jubilee hills": (17.4326, 78.4071),
    "kukatpally": (17.4948, 78.3996),
    "secunderabad": (17.4399, 78.4983),
}
SEEDS = [
    ("Begumpet", 17.4449, 78.4666), ("Ameerpet", 17.4375, 78.4483), ("Banjara Hills", 17.4149, 78.4347), ("Jubilee Hills", 17.4326, 78.4071),
    ("Madhapur", 17.4483, 78.3915), ("HITEC City", 17.4504, 78.3808), ("Gachibowli", 17.4401, 78.3489), ("Kondapur", 17.4622, 78.3568),
    ("Kukatpally", 17.4948, 78.3996), ("Miyapur", 17.4933, 78.3915), ("Secunderabad", 17.4399, 78.4983), ("Himayatnagar", 17.4007, 78.4895),
    ("Abids", 17.3898, 78.4766), ("Koti", 17.3850, 78.4867), ("Nampally", 17.3847, 78.4701), ("Charminar", 17.3616, 78.4747),
    ("Begum Bazaar", 17.3758, 78.4691), ("Somajiguda", 17.4255, 78.4580), ("Panjagutta", 17.4262, 78.4511), ("Khairatabad", 17.4118, 78.4622),
    ("Kompally", 17.5407, 78.4857), ("Sainikpuri", 17.4895, 78.5482), ("Dilsukhnagar", 17.3687, 78.5247), ("LB Nagar", 17.3457, 78.5522),
    ("Uppal", 17.4056, 78.5591), ("Mehdipatnam", 17.3944, 78.4421), ("Tolichowki", 17.3993, 78.4138), ("Manikonda", 17.4056, 78.3787),
    ("Financial District", 17.4149, 78.3391), ("Shamshabad", 17.2603, 78.3969),
]
SOURCE_LIKE = [
    r"\b(?:top|best)\s+\d+",
    r"^\d+\+?\s+(?:best|top|romantic|late night|mid night|cafes|restaurants|rooftop|hidden gems|places|peaceful)",
    r"\bplaces to visit\b", r"\bthings to do\b", r"\bweekend getaways?\b", r"\bhangout places\b", r"\bromantic places\b",
    r"\bcomplete guide\b", r"\bultimate checklist\b", r"\bwhere to\b", r"\bwhat'?s fuelling\b", r"\blist of\b",
]
BAD_NAMES = [
    "right-triangle", "cross", "organic pages", "home", "hyderabad", "telangana", "about hyderabad", "about us",
    "terms & conditions", "terms and conditions", "privacy policy", "contact us", "blogs", "careers",
]
NON_SERVING = [
    "bus_station", "bus_stop", "police", "bank", "car", "clinic", "crossing", "cycleway", "footway", "health_post", "hospital",
    "kindergarten", "parking", "path", "primary", "primary_link", "residential", "road", "secondary", "secondary_link", "service",
    "tertiary", "tertiary_link", "ticket", "track", "trunk", "unclassified",
]
NON_SERVING_NAMES = [
    r"^address\s*:", r"^timings?\s*:", r"^entry fee\b", r"^skip to content$", r"^read now$", r"^view details$",
    r"^(?:add|apply|create|submit|register|sign\s*up|login|log\s*in|join|follow|share|save|view|read|learn)\b",
    r"^(?:why|what|how|where|when|who)\b", r"^request quote$", r"^upcoming community(?: trips)?$", r"\btour packages?\b", r"\btrips?\b",
    r"\broad\b", r"\broad\s+(?:no|number)\b", r"\brd\s*\d+\b", r"\bward\s+\d+\b", r"\bpolice station\b", r"\bbasthi dawakhana\b",
    r"\bprimary health centre\b", r"\bcheck\s*post\b", r"\bkaman\b",
    r"\b(?:logo|badge|primary image|contribution instructions|privacy policy|terms|cancellation policy|user profile)\b",
    r"\b(?:events|places|restaurants|cafes|clubs|pubs|activities|meetups|conferences|workshops|webinars)\s+in\s+hyderabad\b",
    r"^(?:tech|startup|business|ai|data|web|webinar|workshop|founder|investor)\s+(?:meetups?|events?|conferences?|summits?)$",
    r"^(?:free\s+)?(?:workshop|hackathon|rave party|party night|user group)$",
]
BRANCHES = ["build", "network", "explore", "date"]
BRANCH_BY_CATEGORY = {
    "restaurant": "date", "cafe": "date", "pub": "date", "bar": "date", "nightlife": "date", "bakery": "date",
    "coworking_space": "build", "college": "network", "community_space": "network", "ngo": "network",
}
QUERY_ALIASES = {"quite": "quiet", "placed": "place", "nearby": "near"}
QUERY_STOPS = ["a", "an", "the", "to", "for", "of", "in", "on", "at", "near", "me", "show", "all", "place", "places"]
DATE_PATTERNS = [
    r"\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\s+\d{1,2}(?:,\s*\d{4})?\b",
    r"\b\d{1,2}\s+(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*(?:\s+\d{4})?\b",
    r"\b(?:today|tomorrow|this weekend|every sunday|every saturday)\b",
]
EMAIL, PHONE, POSTAL = r"[\w.+-]+@[\w-]+\.[\w.-]+", r"(?:\+91[-\s]?)?[6-9]\d{9}", r"\b(50[0-9]{4})\b"
SERVING_STOPS = r"\b(?:the|near|at|in|hyderabad|telangana|india)\b"
SIGNAL_CUES = ["review", "people say", "visitors", "users", "crowded", "quiet", "safe", "expensive", "good", "bad"]
SIGNAL_POSITIVE = ["good", "great", "best", "safe", "clean", "friendly", "beautiful", "amazing"]
SIGNAL_NEGATIVE = ["bad", "worst", "unsafe", "dirty", "expensive", "crowded", "rude"]
SIGNAL_INTENTS = {
    "investors": ["investor", "vc", "angel", "funding", "capital"],
    "founders": ["founder", "cofounder", "entrepreneur"],
    "tech": ["tech", "technology", "software", "ai", "developer", "startup"],
    "networking": ["network", "networking", "meetup", "community"],
    "quiet": ["quiet", "calm", "peaceful", "less crowded", "serene"],
    "walking": ["walk", "walking", "trail", "promenade", "lake", "park"],
    "late_night": ["late night", "midnight", "after midnight", "open late"],
    "date": ["date", "romantic", "couple"],
    "family": ["family", "kids", "children"],
    "budget": ["budget", "cheap", "affordable", "free"],
    "luxury": ["luxury", "premium", "fine dining"],
    "spiritual": ["temple", "spiritual", "pray", "darshan", "mosque", "church"],
    "work_friendly": ["wifi", "laptop", "work friendly", "power outlet", "cowork"],
    "women_friendly": ["women friendly", "safe for women", "well lit", "safe"],
    "first_timer_friendly": ["first timer", "beginner friendly", "friendly staff"],
    "hidden_gem": ["hidden gem", "underrated", "less known"],
}
SIGNAL_SAFETY = {"safety": ["safe", "unsafe", "well lit"]}
SIGNAL_PRICE = {"price": ["free", "budget", "expensive", "₹", "rs"]}
KEYWORD_STOPS = ["with", "from", "that", "this", "https", "http", "html", "image", "photo", "and", "the"]
ARTICLE_TERMS = [
    "best", "top", "places to visit", "things to do", "weekend getaway", "guide", "list", "hangout places", "romantic places", "cheap things",
    "cafes in hyderabad", "restaurants in hyderabad", "where to", "what to",
]

# Fixed values of the name rules: words that make a name a place, words of weak place names, and words of pages.
PLACE_HINTS = [
    "bar", "bazaar", "brewery", "cafe", "church", "club", "fort", "garden", "lake", "lounge", "mall", "mandir", "market", "museum",
    "palace", "park", "planetarium", "restaurant", "stadium", "temple", "theatre", "tombs",
]
WEAK_HINTS = ["cohort", "conference", "conferences", "event", "events", "meetup", "meetups", "summit", "webinar", "workshop", "workshops"]
PAGE_TERMS = [
    "about", "address", "blog", "booking", "cancellation", "contact", "directions", "general", "guide", "history", "overview", "package",
    "packages", "payment", "policy", "privacy", "quote", "read", "terms", "timing", "timings", "trip", "trips",
]
PAGE_STARTS = ["about ", "how to ", "where to ", "what to "]
CITY_TERMS = ["hyderabad", "telangana", "secunderabad"]
NO_CARDS = [
    "bus_stop", "bus_station", "car", "clinic", "crossing", "cycleway", "bank", "doctors", "footway", "hospital", "parking", "path", "police",
    "primary", "primary_link", "residential", "road", "secondary", "secondary_link", "service", "tertiary", "tertiary_link", "ticket", "track",
    "trunk", "unclassified", "yes",
]
COLLECTIONS = [
    r"\b(?:events|places|restaurants|cafes|clubs|pubs|bars|things|activities|meetups|conferences|workshops|webinars)\s+in\s+hyderabad\b",
    r"\b(?:hyderabad)\s+(?:events|places|restaurants|cafes|clubs|pubs|bars|things|activities|meetups|conferences|workshops|webinars)\b",
    r"^(?:top|best|popular|upcoming|latest|all)\b",
    r"\b(?:list|guide|collection|calendar|category|directory)\b",
]
COLLECTION_ENDS = [" events", " meetups", " conferences", " workshops", " webinars"]
INSTRUCTIONS = [
    r"^(?:add|apply|create|submit|register|sign\s*up|login|log\s*in|join|follow|share|save|view|read|learn|discovering)\b",
    r"^(?:go to|in hyderabad|adjacent to|located in|near|near to|close to)\b",
    r"^(?:why|what|how|where|when|who)\b",
    r"\b(?:logo|badge|primary image|image number|contribution instructions|privacy policy|terms|cancellation policy|user profile)\b",
    r"\.(?:webp|jpg|jpeg|png|svg|gif|json)\b",
    r"\broad\b",
]
INSTRUCTION_NAMES = ["go to", "in hyderabad", "hotels in hyderabad", "health insurance", "life insurance", "mental health"]
TOPIC_CATEGORIES = ["event", "community", "business", "place", "web_entity"]
TOPICS, ABSTRACT = ["ai", "ml", "data", "analytics", "marketing", "startups", "startup"], ["insurance", "management", "leadership", "vision", "team", "processes"]
EVENT_NAME = r"^(?:tech|startup|business|ai|data|web|webinar|workshop|founder|investor)\s+(?:meetups?|events?|conferences?|summits?)$"
EVENT_NAMES = ["hackathon", "free workshop", "rave party", "party night", "user group"]
STRAY_NAMES = ["linkedin", "telegram", "whatsapp", "messenger", "android", "pinterest", "more", "skip to content"]
OPEN_SOURCES = ["openstreetmap", "wikidata", "wikipedia"]
REJECT_SCORES = {
    "empty_or_short_name": 0.0, "non_card_map_infrastructure": 0.12, "instruction_article_or_page_furniture": 0.08, "bad_fragment_geocoded_from_page_text": 0.1,
    "sentence_like_page_mention_without_location": 0.2, "collection_or_search_result_heading": 0.16, "abstract_topic_not_entity": 0.18, "generic_event_or_topic_name": 0.18,
}
DECISION_WEIGHTS = {
    "long_phrase_name": -0.35, "page_or_navigation_phrase": -0.55, "field_label_extracted_as_name": -0.75, "question_title": -0.35, "real_entity_name_hint": 0.3,
    "strong_identity_evidence": 0.26, "specific_category": 0.08, "has_locality": 0.12, "has_address": 0.18, "has_coordinates": 0.28, "has_media": 0.04, "has_website": 0.08,
    "trusted_structured_source": 0.25, "single_source_page_mention": -0.24, "single_generic_token": -0.18, "generic_collection_heading": -0.35,
}
ADDRESS_NOISE = ["====", "eventsgroups", "reset any day", "#main", "pull request", "github"]
ADDRESS_SHAPE = r"\b(?:road|rd|street|lane|plot|shop|floor|opposite|opp|near|beside|hills|madhapur|gachibowli|kondapur|begumpet|charminar|secunderabad)\b"
ADDRESSES = [
    r"(?i)(?:address|location)\s*[:\-]\s*([^.\n]{15,220}(?:Hyderabad|Telangana|500\d{3})[^.\n]{0,80})",
    r"(?i)((?:Road|Rd|Plot|Shop|Door|H\.?No|Survey|Sy\.?|Street|Lane|Opposite|Near|Beside|Resham|Banjara|Jubilee|Madhapur|Gachibowli)[^.\n]{15,220}(?:Hyderabad|Telangana|500\d{3})[^.\n]{0,80})",
]
# Fixed values of mentioned names.
BAD_MENTIONS = [
    "right-triangle", "cross", "home", "india", "hyderabad", "telangana", "read more", "view all", "show all", "previous", "next", "login", "sign up",
    "privacy policy", "terms", "restaurants", "cafes", "things to do", "places to visit", "about us", "contact us", "careers", "blogs", "general", "payments",
    "follow us on", "get directions", "clear directions", "view details", "read now", "request quote", "map view", "please wait", "facebook", "instagram",
    "linkedin", "twitter", "youtube", "whatsapp",
]
MENTION_NOISE = [
    "http", "www.", "click here", "read more", "view all", "profile pic", "author profile", "slogan mobile", "tour packages", "upcoming trips", "group trips",
    "india trips", "international trips",
]
MENTION_LABEL, MENTION_FILE = r"^(?:address|timings?|entry fee|cancellation policy|privacy policy|terms)", r"\.(?:webp|jpg|jpeg|png|gif|svg)(?:\b|$)"
TOUR_WORDS, TOUR_HINTS = ["trip", "trips", "package", "packages", "tour", "tours", "policy", "overview", "history", "weather"], ["fort", "temple", "palace", "lake", "park", "cafe", "restaurant", "bar", "bazaar", "museum"]
ONE_WORD_NAMES = ["charminar", "gachibowli"]
MENTIONS = [
    r"(?m)(?:^|\n)\s*(?:\d{1,2}[.)-]\s+|[-*]\s+)([A-Z][A-Za-z0-9&'. -]{2,80})",
    r"\*\*([A-Z][A-Za-z0-9&'. -]{2,80})\*\*",
    r"\[([A-Z][A-Za-z0-9&'. -]{2,80})\]\((?:https?://)[^)]+\)",
    r"\b([A-Z][A-Za-z0-9&'. -]{2,70}\s(?:Lake|Park|Fort|Palace|Temple|Museum|Road|Garden|Mall|Market|Cafe|Café|Restaurant|Bar|Pub|Brewery|Workspace|Coworking|Stadium|Club|Foundation|Community|Meetup|Festival|Conference|Summit))\b",
]
CITY_QUERY = r"\b([A-Z][A-Za-z0-9&'. -]{2,70}\s(?:Hyderabad|Secunderabad|Telangana))\b"
# Fixed values of documents: tag -> terms at word boundaries, in this order.
CONTEXTS = {
    "BUILD_NETWORK": ["startup", "founder", "investor", "pitch", "networking", "vc", "angel", "entrepreneur"],
    "COFFEE_WORK": ["coffee", "cafe", "work", "wifi", "cowork", "laptop", "meeting"],
    "DATE_NIGHT": ["date", "romantic", "couple", "rooftop", "cozy", "dinner"],
    "EAT_DRINK": ["restaurant", "food", "biryani", "bar", "pub", "brewery", "cafe"],
    "EXPLORE_CITY": ["heritage", "landmark", "museum", "temple", "fort", "tourism", "attraction"],
    "FRIENDS": ["friends", "hangout", "group", "club", "board game", "community"],
    "LIVE_EVENTS": ["event", "concert", "workshop", "meetup", "screening", "festival", "open mic"],
    "SOLO_RESET": ["quiet", "peaceful", "reading", "library", "walk", "lake", "park", "meditation"],
    "SPORTS_PLAY": ["badminton", "football", "futsal", "cricket", "fitness", "gym", "yoga", "sports"],
    "TONIGHT": ["tonight", "late night", "midnight", "evening", "night"],
}
TEXT_BRANCHES = {
    "investor_meetups": ["investor", "vc", "angel", "funding", "pitch"],
    "startup_networking": ["startup", "founder", "entrepreneur", "networking", "t-hub"],
    "tech_events": ["technology", "tech", "ai", "software", "developer", "hackathon"],
    "quiet_walks": ["quiet", "walk", "walking", "lake", "park", "trail"],
    "late_night_places": ["late night", "midnight", "after midnight", "night"],
    "spiritual_pray": ["temple", "mosque", "church", "spiritual", "pray", "darshan"],
    "coffee_work": ["coffee", "cafe", "wifi", "laptop", "cowork"],
    "date_places": ["date", "romantic", "couple", "cozy"],
    "sports_play": ["badminton", "football", "cricket", "futsal", "sports"],
}
NEGATIVE_TAGS = {
    "too_loud": ["too loud", "noisy", "deafening"], "crowded": ["crowded", "packed", "rush"], "expensive": ["expensive", "overpriced", "costly"],
    "unsafe": ["unsafe", "shady", "not safe"], "poor_parking": ["parking problem", "no parking", "parking issue"], "not_quiet": ["not quiet", "very loud"],
}
# Fixed values of documents: tag -> terms anywhere in the text.
AMENITIES = {
    "wifi": ["wifi", "wi-fi", "internet"], "power_outlets": ["power outlet", "charging", "plug point"], "parking": ["parking", "valet"], "outdoor_seating": ["outdoor seating", "open air"],
    "air_conditioning": ["air conditioned", "ac ", "a/c"], "wheelchair_accessible": ["wheelchair", "accessible"], "pet_friendly": ["pet friendly", "pets allowed"],
    "alcohol": ["alcohol", "bar", "beer", "cocktail"], "live_music": ["live music", "dj", "band"], "sports_facility": ["court", "turf", "pitch", "gym"],
    "reservation_required": ["reservation", "booking required", "book in advance"],
}
MOODS = ["quiet", "peaceful", "lively", "romantic", "casual", "premium", "spiritual", "sporty", "intellectual", "artsy", "family"]
LOUD, SILENT = ["loud", "noisy", "dj"], ["quiet", "peaceful", "silent"]
CROWDS = {"students": "student", "families": "familie", "founders": "founder", "investors": "investor", "tourists": "tourist", "couples": "couple", "friends": "friend"}
FRIENDLY = {
    "solo": (["solo"], ["not solo"]), "couple": (["couple", "date"], ["not for couples"]), "family": (["family", "kids"], ["not for families"]),
    "work": (["wifi", "laptop", "work friendly"], ["not work friendly"]), "women": (["women friendly", "safe for women", "safe"], ["unsafe"]),
    "first_timer": (["first timer", "beginner friendly"], []),
}
LOCALITIES = [
    "begumpet", "hitec city", "madhapur", "gachibowli", "kondapur", "jubilee hills", "banjara hills", "ameerpet", "secunderabad", "raidurg", "kukatpally", "charminar", "abids",
]
ALWAYS_OPEN, LATE, AFTER_MIDNIGHT = ["24 hours", "open 24"], ["midnight", "late night", "open late", "after midnight"], ["midnight", "after midnight"]
HOURS = r"((?:mon|tue|wed|thu|fri|sat|sun|daily|open|timings)[^.\n]{0,120}(?:am|pm|hours))"
FREE_ENTRY = ["free entry", "free event", "entry free", "no entry fee"]
PRICE, RATING, RATING_COUNT, MEMBERS = r"(?:₹|rs\.?\s?)([0-9][0-9,]{1,6})", r"\b([1-5](?:\.\d)?)\s*(?:/|out of)\s*5\b", r"\b([0-9][0-9,]{1,8})\s+(?:reviews|ratings)\b", r"\b([0-9][0-9,]{1,8})\s+(?:members|followers)\b"
EVENT_TERMS, COMMUNITY_TERMS = ["event", "workshop", "meetup", "concert", "ticket", "register"], ["community", "club", "group", "ngo", "volunteer", "meetup"]
COMMUNITY_TYPES = [("ngo", ["ngo", "volunteer"]), ("startup_group", ["startup", "founder"]), ("sports_group", ["sports"]), ("religious_group", ["religious", "spiritual"])]
NAME_CATEGORIES = [
    ("restaurant", ["cafe", "café", "restaurant", "biryani", "bar", "pub", "brewery"]), ("event", ["event", "festival", "concert", "workshop", "meetup", "conference", "summit"]),
    ("community", ["community", "club", "group", "ngo", "foundation", "collective"]), ("business", ["cowork", "workspace", "startup", "company", "store", "shop"]),
    ("activity", ["badminton", "football", "gaming", "fitness", "gym", "yoga", "cricket"]),
    ("attraction", ["lake", "park", "fort", "palace", "temple", "museum", "garden", "mall", "market", "road"]),
]
# Fixed values of pages.
RELEVANT = [
    "hyderabad", "secunderabad", "telangana", "hitec city", "gachibowli", "madhapur", "jubilee hills", "banjara hills", "begumpet", "kondapur", "ameerpet", "charminar",
]
PAGE_CATEGORIES = {
    "restaurant": ["restaurant", "food", "cafe", "biryani", "bar", "pub"], "event": ["event", "festival", "concert", "workshop", "meetup", "screening"],
    "community": ["community", "club", "group", "volunteer", "ngo", "foundation"], "attraction": ["landmark", "tourism", "museum", "park", "lake", "temple", "fort"],
    "business": ["coworking", "startup", "company", "business", "store", "shop"], "activity": ["badminton", "football", "gaming", "fitness", "yoga", "cricket"],
}
USEFUL_LINKS = ["hyderabad", "event", "venue", "places", "things-to-do", "restaurant", "cafe", "community", "festival", "tourism", "calendar"]
BLOCKED_LINKS = ["login", "signup", "privacy", "terms", "javascript:", "mailto:", "tel:"]
SOCIAL = ["instagram", "facebook", "youtube", "twitter", "x.com", "linkedin"]
BRANDS = ["zomato", "swiggy", "tripadvisor", "wanderlog", "lbb", "magicpin", "eazydiner", "google"]
# Fixed values of web evidence.
EVIDENCE_STOPS = ["the", "and", "cafe", "restaurant", "hyderabad", "telangana", "india", "near", "road"]
TRUSTED_SITES = ["zomato", "swiggy", "tripadvisor", "wanderlog", "lbb"]
BLOCKED_URLS = ["login", "signup", "privacy", "terms", "mailto:", "tel:"]
EVIDENCE_AMENITIES = ["parking", "valet", "outdoor seating", "wifi", "kid friendly", "family"]
CUISINES = ["north eastern", "asian", "korean", "thai", "momos", "biryani", "cafe", "coffee", "bakery", "restaurant"]
EVIDENCE_LOCALITIES = [
    "banjara hills", "jubilee hills", "madhapur", "hitec city", "gachibowli", "kondapur", "begumpet", "ameerpet", "secunderabad", "kukatpally", "charminar", "abids",
    "financial district", "nampally", "tank bund",
]
EVIDENCE_RATING, EVIDENCE_HOURS, EVIDENCE_PRICE = r"\b([1-5](?:\.\d)?)\s*(?:/|out of)?\s*5\b", r"((?:daily|mon|tue|wed|thu|fri|sat|sun|open)[^.\n]{0,120}(?:am|pm|hours))", r"(?:₹|rs\.?\s*)([0-9][0-9,]{1,6})(?:\s*for\s*two)?"
POOR_IMAGES = ["logo", "icon", "sprite", "avatar"]
IMAGE_STOPS = ["the", "and", "near", "hyderabad", "telangana", "india"]
URL_COORDINATES = [r"@(-?\d+\.\d+),(-?\d+\.\d+)", r"!3d(-?\d+\.\d+)!4d(-?\d+\.\d+)", r"!2d(-?\d+\.\d+)!3d(-?\d+\.\d+)", r"(-?17\.\d+)\s*,\s*(78\.\d+)"]
TEXT_COORDINATES, COORDINATE_KEYS = r"\b(17\.\d{4,})\s*,\s*(78\.\d{4,})\b", ["destination", "query", "q", "ll"]
# Fixed values of branches: category -> branch, and the words that decide for other categories, first to last.
APP_BRANCHES = {
    "restaurant": "date", "cafe": "date", "pub": "date", "bar": "date", "nightlife": "date", "bakery": "date", "attraction": "explore", "historic": "explore", "park": "explore",
    "lake": "explore", "religion": "explore", "museum": "explore", "mall": "explore", "market": "explore", "shopping": "explore", "theatre": "explore", "gaming_center": "explore",
    "sports_venue": "explore", "gym": "explore", "college": "network", "coworking_space": "build", "community_space": "network", "ngo": "network", "place": "explore",
}
APP_BRANCH_WORDS = [("build", r"\b(?:cowork|startup|founder|office|company)\b"), ("network", r"\b(?:community|ngo|college|meet|network)\b"), ("date", r"\b(?:cafe|restaurant|pub|bar|lounge|bakery)\b")]
BRANCH_TERMS = [("build", ["startup", "cowork", "founder"]), ("network", ["network", "community", "college"]), ("date", ["date"])]
BRANCH_TAGS = {"date": ["date", "friends"], "build": ["startup", "work", "networking"], "network": ["networking", "community"], "explore": ["explore"]}
ENGINE_CROWDS = {"students": "student", "families": "familie", "founders": "founder", "tourists": "tourist", "couples": "couple", "friends": "friend"}
ENGINE_MOODS = ["quiet", "peaceful", "lively", "crowded", "cozy", "outdoor", "scenic", "premium", "casual", "spiritual"]
# Fixed values of map tags: values that are not served, value -> category, and the categories that are served beside these.
UNSERVED_TAGS = [
    "atm", "bank", "bench", "bicycle_parking", "bus_station", "bus_stop", "clinic", "doctors", "fuel", "hospital", "parking", "pharmacy", "police", "post_box", "post_office",
    "taxi", "toilets",
]
MAP_CATEGORIES = {
    "restaurant": "restaurant", "fast_food": "restaurant", "food_court": "restaurant", "cafe": "cafe", "coffee": "cafe", "pub": "pub", "bar": "bar", "nightclub": "nightlife",
    "bakery": "bakery", "attraction": "attraction", "viewpoint": "attraction", "museum": "museum", "gallery": "museum", "park": "park", "garden": "park", "water": "lake", "lake": "lake",
    "place_of_worship": "religion", "mall": "mall", "marketplace": "market", "department_store": "shopping", "cinema": "theatre", "theatre": "theatre",
    "amusement_arcade": "gaming_center", "sports_centre": "sports_venue", "fitness_centre": "gym", "gym": "gym", "coworking": "coworking_space", "coworking_space": "coworking_space",
    "college": "college", "university": "college", "ngo": "ngo",
}
MAP_EXTRA = ["historic", "sports_venue", "community_space"]
MAP_KEYS = ["amenity", "tourism", "leisure", "shop", "office", "historic", "natural", "water", "sport"]
MAP_AUDIENCE = [
    (["park", "lake", "mall", "attraction", "museum", "religion"], ["family", "solo", "friends"]), (["cafe", "coworking_space"], ["students", "professionals", "friends"]),
    (["pub", "bar", "nightlife"], ["friends", "adults", "date"]),
]
MAP_AMENITIES = ["wheelchair", "outdoor_seating", "internet_access", "wifi", "takeaway", "delivery", "parking", "air_conditioning", "smoking", "toilets"]
MAP_SUBCATEGORIES = ["amenity", "tourism", "leisure", "shop", "office", "historic", "sport", "cuisine", "religion", "denomination"]
MAP_ALIASES = ["alt_name", "official_name", "short_name", "name:en", "old_name"]
MAP_TAGS = {
    "restaurant": ["food", "friends", "family", "date", "casual"], "cafe": ["coffee", "quiet", "work", "reading", "date", "friends"], "pub": ["nightlife", "friends", "music", "after_work"],
    "bar": ["nightlife", "friends", "date", "after_work"], "nightlife": ["nightlife", "music", "friends", "late_night"], "bakery": ["food", "dessert", "casual", "family"],
    "attraction": ["travel", "tourism", "family", "solo", "friends"], "historic": ["culture", "tourism", "heritage", "family"], "park": ["quiet", "walking", "family", "solo", "friends", "nature"],
    "lake": ["quiet", "walking", "date", "nature", "family"], "religion": ["spirituality", "quiet", "family", "culture"], "museum": ["culture", "learning", "family", "students"],
    "mall": ["shopping", "family", "friends", "date"], "market": ["shopping", "budget", "local", "family"], "theatre": ["entertainment", "date", "friends", "family"],
    "gaming_center": ["gaming", "friends", "students"], "sports_venue": ["sports", "fitness", "friends"], "gym": ["fitness", "health", "solo"],
    "coworking_space": ["startup", "networking", "work", "founders", "professionals"], "college": ["students", "learning", "community"], "ngo": ["volunteering", "community", "social_impact"],
    "community_space": ["community", "networking", "events"],
}
# Fixed values of the first frontier: map categories, knowledge bases, web queries.
SEED_CATEGORIES = [
    "food", "nightlife", "sports", "entertainment", "culture", "religion", "education", "tourism", "shopping", "coworking", "startup", "ngo", "parks", "lakes", "museums", "theaters", "fitness",
]
SEED_QUERIES = [
    "Hyderabad events this week", "Hyderabad communities clubs volunteer groups", "Hyderabad hidden gems places to visit", "Hyderabad startup meetups coworking communities",
    "Hyderabad badminton football gaming activities", "Hyderabad temples museums parks lakes attractions", "Hyderabad food nightlife cafes restaurants",
]
# Fixed values of name cleaning: what is cut out, in this order, and the signs that are stripped at both ends.
CARD_CUTS, CARD_STRIP = [r"^\s*\d+\s*(?:[.)-]|\.\s*)\s*", r"\s+\|\s+.*$", r"(?i)\s+-\s+(?:Hyderabad|Telangana|Review|Timings|Entry Fee).*$"], " \\-:|"
MENTION_CUTS = [r"^\d{1,2}[.)-]\s*", r"\s+[-–—:]\s+.*$", r"(?i)\s*[-|:]\s*(?:Hyderabad|Secunderabad|Telangana|Review|Timings|Entry Fee).*$", r"\s+\(?\d{4}\)?$"]
MENTION_STRIP = " \\-–—:|"
QUERY_CUTS, SEARCH_CUTS = [r"(?i)\s*[-|:]\s*(?:Review|Timings|Entry Fee|Hyderabad).*$"], [r"(?i)\b(?:review|photos?|image|primary image)\b"]
