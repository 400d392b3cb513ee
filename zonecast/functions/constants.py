"""Fixed values.

These must equal the ride simulator's published constants for results to agree
(zone centres and demand factors, hour bands, weather factors, vehicle fares,
the surge band, the historical-trip mapping constants). Stated plainly, in
natural order, together. Everything derived from them lives in other modules.
"""

# --- fixed values: city zones (name, centre latitude, centre longitude, demand factor)
ZONES = [
    ("airport", 13.1986, 77.7066, 1.8),
    ("railway_station", 12.9784, 77.5707, 2.2),
    ("cbd", 12.9716, 77.5946, 1.5),
    ("mall", 12.9352, 77.6245, 1.2),
    ("residential", 13.0200, 77.5800, 1.0),
]

# --- fixed values: vehicles
VEHICLE_TYPES = ["bike", "auto", "cab_economy", "cab_premium"]

# --- fixed values: demand by hour band (inclusive hour ranges)
PEAK_HOURS_MORNING = (8, 10)
PEAK_HOURS_EVENING = (17, 20)
NIGHT_HOURS = (2, 5)
PEAK_DEMAND = 3.0
NIGHT_DEMAND = 0.3
NORMAL_DEMAND = 1.0

# --- fixed values: weather states and their demand factors
WEATHER_STATES = ["clear", "cloudy", "rain"]
WEATHER_DEMAND = {"clear": 1.0, "cloudy": 1.1, "rain": 1.6}

# --- fixed values: surge band
SURGE_MIN = 1.0
SURGE_MAX = 3.5

# --- fixed values: domains
RIDE_STATUSES = ["requested", "completed", "cancelled"]
DRIVER_STATUSES = ["online", "offline", "on_trip"]
PAYMENT_METHODS = ["cash", "card", "upi", "wallet"]

# --- fixed values: historical trip mapping
HIST_ZONE_EDGES = [0, 50, 100, 150, 200]  # right-closed bins, last bin open-ended
HIST_ZONE_LABELS = ["zone_A", "zone_B", "zone_C", "zone_D", "zone_E"]
HIST_PAYMENT_CODES = {1: "card", 2: "cash"}
MILES_TO_KM = 1.60934
USD_TO_INR = 83.0
TIP_RATIO_EPSILON = 0.01

# --- fixed values: dashboard / metric TTLs (seconds)
TTL_ZONE_DEMAND = 30
TTL_LIVE_TOTAL = 60
TTL_DRIVER_LOCATION = 15
TTL_DASHBOARD = 900

# --- fixed values: stream and quality thresholds
WATERMARK_DELAY = "10 minutes"
STALE_AFTER_HOURS = 2
STALE_WARN_FRACTION = 0.10
PROMOTION_MAE_THRESHOLD = 15.0
RETENTION_HOURS = 168
LIVE_WINDOW_SECONDS = 300

# --- fixed values: model features
CATEGORICAL_FEATURES = ["city_zone", "vehicle_type", "weather", "status"]
NUMERIC_FEATURES = ["distance_km", "fare_base_inr", "event_hour"]
TARGET = "surge_multiplier"


def tenths(x: float) -> int:
    return int(round(x * 10))
