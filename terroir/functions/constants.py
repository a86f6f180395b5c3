"""Fixed values.

Everything in this module is a fixed value: the words, codes, patterns and
numbers below decide results and must stay as they are. No logic lives here.
"""

# Territory levels and the source scales that name them.
LEVELS = ("city", "department", "region")
SCALE_TO_LEVEL = {
    "commune": "city",
    "departement": "department",
    "département": "department",
    "region": "region",
    "région": "region",
}
SCALE_SUBSTRINGS = (
    ("city", ("commune",)),
    ("department", ("depart", "départ")),
    ("region", ("region", "région")),
)

# Property type -> column suffix of the wide price statistics.
PROPERTY_TYPES = {
    "houses": "maison",
    "apartments": "appartement",
    "houses_apartments": "apt_maison",
    "commercial": "local",
}

# Age bin suffix -> midpoint in years.
AGE_BIN_MIDPOINTS = {
    "0014": 7.0,
    "1529": 22.0,
    "3044": 37.0,
    "4559": 52.0,
    "6074": 67.0,
    "7589": 82.0,
    "90P": 95.0,
}
CENSUS_YEARS = (2009, 2014, 2020)

# Department code -> region code.
DEPARTMENT_TO_REGION = {
    "75": "11", "77": "11", "78": "11", "91": "11", "92": "11", "93": "11", "94": "11",
    "18": "24", "28": "24", "36": "24", "37": "24", "41": "24", "45": "24",
    "21": "27", "25": "27", "39": "27", "58": "27", "70": "27", "71": "27", "89": "27", "90": "27",
    "14": "28", "27": "28", "50": "28", "61": "28",
    "02": "32", "59": "32", "60": "32", "62": "32", "80": "32",
    "08": "44", "10": "44", "51": "44", "52": "44", "54": "44", "55": "44", "57": "44", "67": "44", "68": "44",
    "44": "45", "49": "45", "53": "45", "72": "45", "85": "45",
    "22": "53", "29": "53", "35": "53", "56": "53",
    "16": "75", "17": "75", "19": "75", "23": "75", "24": "75", "33": "75",
    "40": "75", "47": "75", "64": "75", "79": "75", "86": "75", "87": "75",
    "09": "76", "12": "76", "31": "76", "32": "76", "46": "76", "65": "76", "66": "76", "81": "76", "82": "76",
    "01": "84", "03": "84", "07": "84", "15": "84", "26": "84", "38": "84",
    "42": "84", "43": "84", "63": "84", "69": "84", "73": "84", "74": "84",
    "04": "93", "05": "93", "06": "93", "13": "93", "83": "93", "84": "93",
    "2A": "94", "2B": "94",
}

# Keyword found in an address tail -> city, in matching order.
CITY_KEYWORDS = (
    ("paris", "paris"),
    ("lyon", "lyon"),
    ("bordeaux", "bordeaux"),
    ("mérignac", "bordeaux"),
    ("merignac", "bordeaux"),
    ("marseille", "marseille"),
    ("nantes", "nantes"),
    ("lille", "lille"),
    ("toulouse", "toulouse"),
    ("saint-malo", "saint-malo"),
    ("strasbourg", "strasbourg"),
)

# Centroids (key, lat, lon, label); the order decides substring matches.
CENTROIDS = (
    ("paris", 48.8566, 2.3522, "Paris"),
    ("lyon", 45.764, 4.8357, "Lyon"),
    ("bordeaux", 44.8378, -0.5792, "Bordeaux"),
    ("marseille", 43.2965, 5.3698, "Marseille"),
    ("nantes", 47.2184, -1.5536, "Nantes"),
    ("lille", 50.6292, 3.0573, "Lille"),
    ("toulouse", 43.6047, 1.4442, "Toulouse"),
    ("strasbourg", 48.5734, 7.7521, "Strasbourg"),
    ("saint-malo", 48.6493, -2.0257, "Saint-Malo"),
    ("merignac", 44.8416, -0.645, "Mérignac"),
    ("dept-75", 48.8566, 2.3522, "Paris (75)"),
    ("dept-69", 45.764, 4.8357, "Rhône (69)"),
    ("dept-33", 44.8378, -0.5792, "Gironde (33)"),
    ("dept-13", 43.2965, 5.3698, "Bouches-du-Rhône (13)"),
    ("dept-44", 47.2184, -1.5536, "Loire-Atlantique (44)"),
    ("dept-59", 50.6292, 3.0573, "Nord (59)"),
    ("dept-31", 43.6047, 1.4442, "Haute-Garonne (31)"),
)

# Listing defaults.
DEFAULT_TITLE = "Annonce sans titre"
DEFAULT_ADDRESS = "Adresse non renseignée"
DEFAULT_FLOOR = "—"
DEFAULT_SCORE = 75.0
DEFAULT_IMAGE = ("https://picsum.photos/seed/", "/800/600")
TAG_LABELS = (
    ("furnished", "Meublé"),
    ("balcony", "Balcon"),
    ("terrace", "Terrasse"),
    ("parking", "Parking"),
    ("elevator", "Ascenseur"),
)
SOURCE_ALIASES = (
    ("seloger", ("seloger",)),
    ("leboncoin", ("leboncoin", "lbc")),
    ("bienici", ("bienici", "bien'ici")),
)
REJECT_REASONS = {
    "price": "Prix manquant ou invalide",
    "rooms": "Nombre de pièces manquant ou invalide",
    "surface": "Surface manquante ou invalide",
    "coordinates": "Coordonnées lat/lon manquantes — géocodage requis",
}

# Flat variants of the synthetic market listings (rooms, surface, suffix, type, title).
MARKET_VARIANTS = (
    (1, 28.0, "studio", "studio", "Studio"),
    (2, 48.0, "t2", "appartement", "T2"),
    (3, 68.0, "t3", "appartement", "T3"),
)
MARKET_URL = "https://dvf.data.gouv.fr/commune/"
MARKET_TAGS = ("DVF", "Marché local")
MARKET_MIN_RENT = 400.0
MARKET_RENT_DIVISOR = 180.0

# Similarity weights and kilometres per degree.
SIMILAR_PRICE_WEIGHT = 2.0
SIMILAR_KM_WEIGHT = 0.05
KM_PER_LAT = 111.0
KM_PER_LON = 85.0
SIMILAR_MAX_SCORE = 1.2
SIMILAR_LIMIT = 6

MAX_PAGE_SIZE = 200

# Review columns, in order of preference.
REVIEW_TEXT_COLUMNS = (
    "comments", "comment", "review_text", "review", "text", "content",
    "comments_fr", "comments_en", "reviewContent",
)
REVIEW_DATE_COLUMNS = ("date", "review_date", "reviewDate")

# French stop words and sentiment lexicon.
STOPWORDS = (
    "de", "la", "le", "les", "des", "du", "un", "une", "et", "en", "pour", "avec",
    "sur", "au", "aux", "par", "dans", "que", "qui", "ne", "pas", "plus", "ou",
    "est", "sont", "je", "tu", "il", "elle", "nous", "vous", "ils", "elles",
    "ce", "ces", "cette", "ca", "tres", "trop",
)
POSITIVE_WORDS = (
    "bien", "super", "excellent", "parfait", "magnifique", "agreable", "calme",
    "propre", "spacieux", "lumineux", "recommande", "adorable", "sympa",
    "confortable", "tranquille", "paisible", "famille", "jardin", "centre",
    "metro", "transport",
)
NEGATIVE_WORDS = (
    "bruit", "bruyant", "sale", "mauvais", "nul", "horrible", "cher", "petit",
    "etroite", "insalubre", "danger", "pollution", "travaux", "odeur",
)
TOKEN_PATTERN = "[a-zA-ZÀ-ÖØ-öø-ÿ']{2,}"
MIN_REVIEW_CHARS = 120
TOP_TERMS = 30

# Keyword lists for term hits.
CALM_KEYWORDS = (
    "calme", "tranquille", "village", "jardin", "école", "ecole", "famille",
    "quartier", "paisible", "verdure",
)
TRANSPORT_KEYWORDS = ("métro", "metro", "transport", "gare", "tram", "bus")
ACTIVITY_KEYWORDS = ("restaurant", "café", "cafe", "centre", "ville", "animé", "anime", "culture")

# Default score weights.
LIVE_WEIGHTS = {"price": 0.35, "population": 0.20, "sentiment": 0.30, "market": 0.15}
QUIET_WEIGHTS = {"calm": 0.45, "quiet": 0.35, "affordable": 0.20}
CALM_HIT_POINTS = 12.0
NEUTRAL_SCORE = 50.0
FALLBACK_YEAR = 2023
REVIEW_CITIES = {"paris": "75056", "lyon": "69123", "bordeaux": "33063"}

# Source labels written to fact tables.
PRICE_SOURCE = "DVF Statistiques (POC)"
POPULATION_SOURCE = "INSEE 7632446 (POC)"
REVIEW_SOURCE = "Inside Airbnb (POC)"

# Listing link patterns per site (case-insensitive, on the URL path).
LINK_PATTERNS = {
    "seloger": (
        r"/annonces/[^/]+/[^/]+/\d+\.htm",
        r"/locations/[^/]+/\d+\.htm",
        r"/annonces/locations/",
        r"/annonces/achat/",
        r"/annonces/[^/]+/[^/]+/\d+",
    ),
    "leboncoin": (r"/ad/locations/\d+", r"/vi/\d+", r"/ad/\d+"),
    "bienici": (r"/annonce/location/[^/]+", r"/annonce/achat/[^/]+", r"/annonce/[^/]+/\d+"),
}
# Links that the crawl job takes from a page unless told otherwise.
CRAWL_LINKS_PER_PAGE = 40

# Window variables that may hold a page's state, in scan order.
STATE_VARIABLES = (
    "__INITIAL_STATE__",
    "__PRELOADED_STATE__",
    "__SERVER_SIDE_PROPS__",
    "__STORE__",
    "__REDUX_STATE__",
    "__STATE__",
    "SELOGER_DATA",
    "__APP_STATE__",
)
# Fixed value: how such a variable is assigned; CORE is the name without the underscores around it.
STATE_PATTERN = r'(?m)window(?:\["NAME"\]|\.__CORE__)\s*=\s*(\{[\s\S]+?\});?\s*(?:window|$)'
JSONLD_TYPES = ("RealEstateListing", "Apartment", "House", "Product", "Offer")
ENERGY_GRADES = ("A", "B", "C", "D", "E", "F", "G")

# Event names.
EVENT_CRAWL = "listing.url"
EVENT_RAW = "listing.raw"
EVENT_CREATED = "listing.created"
EVENT_BOOTSTRAPPED = "listings.bootstrapped"
EVENT_INGESTION = "ingestion_completed"
