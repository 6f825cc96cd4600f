"""Tables and constants that results depend on, stated as they must be."""

# --- fixed values: currency, radii, thresholds -----------------------------------------------
USD_TO_CAD = 1.35
EARTH_KM = 6371.0
EARTH_MILES = 3959.0
PRICE_RANGE_USD = (25.0, 2000.0)
PLAUSIBLE_MILES = (0.0, 50.0)
MAJOR_EVENT_SCORE = 10.0
WEIGHT_OFFSET_KM = 0.1
MIN_COVERAGE = 0.2
MAX_MISSING_PCT = 15.0
DEFAULT_GUESTS = 2
DENIED_HOTELS = ["scarborough home"]

# --- fixed values: texts that mean "no value" ------------------------------------------------
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- fixed values: columns -------------------------------------------------------------------
DEDUPE_KEY = ["Hotel name", "Check-in Date", "Check-out Date", "Room Type", "Date"]
METADATA_FIRST = ["Date", "Source", "Number of People", "Check-in Date", "Check-out Date"]
PRICE_NAMES = ["price_usd", "price", "Price"]
ESSENTIAL_COLUMNS = [
    "Hotel name", "price_usd", "price_cad", "Check-in Date", "Check-out Date", "district",
    "latitude", "longitude", "room_category", "is_weekend", "is_holiday", "booking_lead_time",
    "length_of_stay", "Distance from attraction",
]
WEATHER_KEEP = [
    "STATION_NAME", "CLIMATE_IDENTIFIER", "ID", "LOCAL_DATE", "PROVINCE_CODE", "LOCAL_YEAR",
    "LOCAL_MONTH", "LOCAL_DAY", "MEAN_TEMPERATURE", "MIN_TEMPERATURE", "MAX_TEMPERATURE",
    "TOTAL_PRECIPITATION", "TOTAL_RAIN", "TOTAL_SNOW", "SNOW_ON_GROUND", "SPEED_MAX_GUST",
    "MAX_REL_HUMIDITY",
]
WEATHER_DEFAULTS = {
    "MEAN_TEMPERATURE": 10.5,
    "MAX_TEMPERATURE": 15.2,
    "MIN_TEMPERATURE": 5.8,
    "TOTAL_PRECIPITATION": 66.2,
    "TOTAL_SNOW": 0.0,
    "SNOW_ON_GROUND": 0.0,
    "SPEED_MAX_GUST": 45.0,
    "MAX_REL_HUMIDITY": 85.0,
}
COLUMN_TYPES = {
    "Number of People": "bigint",
    "price_usd": "double",
    "price_cad": "double",
    "Distance from attraction": "double",
    "booking_lead_time": "bigint",
    "length_of_stay": "bigint",
    "week_of_year": "bigint",
    "latitude": "double",
    "longitude": "double",
    "hotel_latitude": "double",
    "hotel_longitude": "double",
    "events_count": "bigint",
    "events_total_score": "double",
    "events_max_score": "double",
    "events_avg_score": "double",
    "events_earliest_day": "bigint",
    "events_latest_day": "bigint",
    "events_avg_day": "double",
    "events_span_days": "bigint",
    "events_density": "double",
    "min_distance_to_event": "double",
    "max_distance_to_event": "double",
    "avg_distance_to_events": "double",
    "median_distance_to_events": "double",
    "is_holiday": "boolean",
    "is_weekend": "boolean",
    "has_major_event": "boolean",
    "has_multiple_events": "boolean",
    "has_nearby_event_1km": "boolean",
    "has_nearby_event_5km": "boolean",
    "Date": "date",
    "Check-in Date": "date",
    "Check-out Date": "date",
}
MODEL_FEATURES = [
    "Distance from attraction", "district", "latitude", "longitude", "district_simple",
    "distance_category", "booking_lead_time", "length_of_stay", "lead_time_category",
    "stay_category", "room_category", "Number of People", "is_weekend", "is_holiday",
    "week_of_year", "weekend_holiday", "checkin_month", "checkin_day_of_week",
    "checkin_quarter", "events_total_score", "events_max_score", "events_count",
    "has_major_event", "has_multiple_events", "event_intensity", "MEAN_TEMPERATURE",
    "temp_category",
]

# --- fixed values: right-closed buckets (edges, labels) --------------------------------------
INF = float("inf")
DISTANCE_BINS = ([-1, 0.5, 1.0, 2.0, 5.0, INF], ["very_close", "close", "nearby", "moderate", "far"])
LEAD_BINS = ([-1, 0, 7, 30, 90, INF], ["same_day", "week", "month", "quarter", "long_term"])
STAY_BINS = ([0, 1, 3, 7, 14, INF], ["overnight", "short", "week", "extended", "long_term"])
EVENT_BINS = ([-1, 0, 50, 100, 200, INF], ["no_events", "low", "medium", "high", "peak"])
TEMPERATURE_BINS = ([-50, 0, 10, 20, 30, 50], ["very_cold", "cold", "mild", "warm", "hot"])

# --- fixed values: district centres in list order; the last one is the default ---------------
DISTRICTS = [
    ("Entertainment District", 43.6426, -79.3871),
    ("Financial District", 43.6489, -79.3817),
    ("Bloor-Yorkville", 43.6706, -79.3951),
    ("Fashion District", 43.6553, -79.3906),
    ("The Annex", 43.6708, -79.4037),
    ("Old Town", 43.6503, -79.3717),
    ("Yonge - Dundas", 43.6566, -79.3805),
    ("Queen West", 43.6439, -79.4001),
    ("King Street West", 43.6435, -79.3929),
    ("Church-Wellesley Village", 43.6688, -79.3826),
    ("Cabbagetown", 43.6658, -79.3636),
    ("Leslieville", 43.6595, -79.3384),
    ("The Beaches", 43.6677, -79.2930),
    ("Liberty Village", 43.6393, -79.4198),
    ("CityPlace", 43.6393, -79.3916),
    ("Harbourfront", 43.6389, -79.3817),
    ("Distillery District", 43.6503, -79.3589),
    ("Regent Park", 43.6581, -79.3624),
    ("Moss Park", 43.6551, -79.3724),
    ("Garden District", 43.6580, -79.3776),
    ("St. Lawrence", 43.6487, -79.3717),
    ("Chinatown", 43.6532, -79.3977),
    ("Kensington Market", 43.6548, -79.4005),
    ("Little Italy", 43.6548, -79.4169),
    ("Junction Triangle", 43.6598, -79.4448),
    ("Roncesvalles", 43.6458, -79.4489),
    ("High Park", 43.6537, -79.4637),
    ("Parkdale", 43.6398, -79.4328),
    ("Mimico", 43.6055, -79.4969),
    ("Airport Area", 43.6777, -79.6248),
    ("Etobicoke", 43.6205, -79.5132),
    ("North York", 43.7615, -79.4111),
    ("Scarborough", 43.7764, -79.2318),
    ("East York", 43.6890, -79.3327),
    ("York", 43.6896, -79.4879),
    ("Toronto", 43.6532, -79.3832),
]
DEFAULT_DISTRICT = "Toronto"

# --- fixed values: attractions in list order; the first one is the default -------------------
ATTRACTIONS = [
    ("Rogers Centre", 43.6414, -79.3894),
    ("CN Tower", 43.6426, -79.3871),
    ("Union Station", 43.6452, -79.3806),
    ("Royal Ontario Museum", 43.6677, -79.3948),
    ("Casa Loma", 43.6780, -79.4103),
]

# --- fixed values: keyword rules, first match wins -------------------------------------------
ADDRESS_RULES = [
    ("Entertainment District", ["entertainment", "theatre", "theater"]),
    ("Financial District", ["financial", "bay street", "king street"]),
    ("Bloor-Yorkville", ["bloor", "yorkville", "rosedale"]),
    ("Fashion District", ["fashion", "garment"]),
    ("The Annex", ["annex", "university of toronto"]),
    ("Old Town", ["old town", "st lawrence", "front street"]),
    ("Yonge - Dundas", ["yonge", "dundas", "eaton"]),
    ("Queen West", ["queen west", "ossington"]),
    ("King Street West", ["king street west", "king west"]),
    ("Church-Wellesley Village", ["church", "wellesley", "gay village"]),
    ("Cabbagetown", ["cabbagetown", "parliament"]),
    ("Leslieville", ["leslieville", "queen east"]),
    ("The Beaches", ["beaches", "beach", "woodbine"]),
    ("Liberty Village", ["liberty village", "liberty"]),
    ("Cityplace", ["cityplace", "city place", "fort york"]),
    ("Harbourfront", ["harbourfront", "harbour", "waterfront"]),
    ("Distillery District", ["distillery", "cherry street"]),
    ("Chinatown", ["chinatown", "spadina"]),
    ("Kensington Market", ["kensington"]),
    ("Little Italy", ["little italy", "college street"]),
    ("Parkdale", ["parkdale", "king street west"]),
    ("Airport Area", ["airport", "pearson", "dixon"]),
    ("Etobicoke", ["etobicoke", "islington"]),
    ("North York", ["north york", "sheppard", "finch"]),
    ("Scarborough", ["scarborough"]),
    ("East York", ["east york"]),
    ("York", ["york", "weston"]),
]
HOTEL_NAME_RULES = [
    ("Airport Area", ["airport", "pearson"]),
    ("Entertainment District", ["theatre", "theater", "entertainment"]),
    ("Financial District", ["financial", "bay street"]),
    ("Queen West", ["queen west"]),
    ("The Beaches", ["beach", "beaches"]),
    ("Bloor-Yorkville", ["bloor", "yorkville"]),
    ("Harbourfront", ["harbour", "waterfront"]),
    ("King Street West", ["king west"]),
    ("Distillery District", ["distillery"]),
    ("North York", ["north york"]),
    ("Etobicoke", ["etobicoke"]),
    ("Scarborough", ["scarborough"]),
]
# (label, words of which one must occur, words of which one must occur as well or nothing)
ROOM_RULES = [
    ("Large Apartment", ["apartment", "condo", "house", "bungalow"], ["three", "3", "four", "4"]),
    ("Two-Bedroom Apartment", ["apartment", "condo", "house", "bungalow"], ["two", "2"]),
    ("One-Bedroom Apartment", ["apartment", "condo", "house", "bungalow"], ["one", "1", "studio"]),
    ("Apartment", ["apartment", "condo", "house", "bungalow"], []),
    ("Luxury Suite", ["suite"], ["presidential", "penthouse", "luxury"]),
    ("Junior Suite", ["suite"], ["junior"]),
    ("Suite", ["suite"], []),
    ("Deluxe Room", ["deluxe", "premium", "superior", "executive", "business"], []),
    ("Studio", ["studio"], []),
    ("Family Room", ["family", "triple", "quad", "two queen", "two double", "two bed"], []),
    ("Accessible Room", ["accessible", "handicap", "mobility"], []),
    ("Economy Room", ["budget", "economy", "basic", "shared bathroom", "hostel"], []),
    ("Standard King", ["king"], []),
    ("Standard Queen", ["queen"], []),
    ("Standard Double", ["double", "twin"], []),
    ("Standard Single", ["single"], []),
    ("Standard Room", ["standard", "room"], []),
]
DEFAULT_ROOM = "Standard"

# --- fixed values: event scores --------------------------------------------------------------
SPECIAL_EVENTS = [
    ("film festival", 12.0),
    ("tiff", 12.0),
    ("pride", 11.5),
    ("caribbean carnival", 11.0),
    ("caribana", 11.0),
    ("indy", 10.5),
    ("marathon", 10.0),
    ("fan expo", 9.5),
    ("nuit blanche", 9.0),
    ("luminato", 9.0),
    ("cne", 8.5),
    ("canadian national exhibition", 8.5),
]
SEGMENT_SCORES = {
    "Sports": 9, "Music": 8, "Arts & Theatre": 6, "Miscellaneous": 3, "Undefined": 2, "N/A": 2,
}
GENRE_SCORES = {
    "Hockey": 9, "Basketball": 9, "Baseball": 8, "R&B": 7, "Rock": 7, "Pop": 7, "Theatre": 6,
    "Soccer": 7, "Comedy": 5, "Undefined": 2, "N/A": 2,
}
SUBGENRE_SCORES = {
    "NHL": 10, "NBA": 10, "MLB": 9, "Musical": 7, "R&B": 7, "Rock": 7, "Pop": 7,
    "Alternative": 6, "Undefined": 2, "N/A": 2,
}
DEFAULT_PART_SCORE = 2
VENUE_MULTIPLIERS = {
    "Rogers Centre": 1.5, "Scotiabank Arena": 1.2, "Budweiser Stage": 1.2,
    "Coca-Cola Coliseum": 1.0, "History": 1.0, "Massey Hall": 1.0,
    "The Danforth Music Hall": 1.0, "Meridian Hall": 1.0, "Ed Mirvish Theatre": 1.0,
    "Comedy Bar - Danforth": 0.8, "NOVENUE": 0.5,
}
DEFAULT_VENUE_MULTIPLIER = 0.9

# --- fixed values: fields of a captured listing card -----------------------------------------
# (column, patterns tried in order; group 1 is the text)
LISTING_FIELDS = [
    ("Hotel name", [r'data-testid="title"[^>]*>([^<]+)<']),
    ("Address", [r'data-testid="address"[^>]*>([^<]+)<']),
    ("Room Type", [
        r'data-testid="availability-single"[\s\S]*?<h4[^>]*>([^<]+)<',
        r'class="[^"]*(?:room-type|sr-hotel__room-info)[^"]*"[^>]*>([^<]+)<',
    ]),
    ("Distance from attraction", [
        r'<span[^>]*data-testid="distance"[^>]*>([^<]+)<',
        r'class="[^"]*(?:distance|sr-hotel__distance)[^"]*"[^>]*>([^<]+)<',
    ]),
    ("Deal Info", [r'data-testid="property-card-deal"[^>]*>([^<]+)<']),
    ("price", [r'data-testid="price-and-discounted-price"[^>]*>([^<]+)<']),
]
MISSING_TEXT = "N/A"
