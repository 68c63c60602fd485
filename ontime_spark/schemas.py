"""Table schemas, feature lists and the fixed values results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ----------------------------------------------------------------------------------------------
# Fixed values (must equal the published behaviour for equal results)
# ----------------------------------------------------------------------------------------------
TARGET_COL = "is_delayed"
DELAY_THRESHOLD_MINUTES = 15
SMOOTHING = 100
ROLLING_WINDOW = 7
TRAIN_MONTHS = tuple(range(1, 11))
TEST_MONTHS = (11, 12)
RANDOM_STATE = 42

TEMPORAL_FEATURES = (
    "hour_of_day", "day_of_week", "month", "is_weekend", "is_holiday",
    "hour_sin", "hour_cos", "month_sin", "month_cos",
)
WEATHER_FEATURES = (
    "origin_wind_speed", "origin_visibility", "origin_ceiling", "origin_temp", "origin_precip",
    "origin_has_thunderstorm", "origin_has_snow", "origin_has_fog",
    "dest_wind_speed", "dest_visibility", "dest_ceiling", "dest_temp", "dest_precip",
    "dest_has_thunderstorm", "dest_has_snow", "dest_has_fog",
    "ifr_conditions_origin", "ifr_conditions_dest",
)
AIRPORT_FEATURES = (
    "origin_flights_per_hour", "dest_flights_per_hour",
    "origin_delay_rate_rolling", "dest_delay_rate_rolling",
    "is_origin_hub", "is_dest_hub",
)
ROUTE_FEATURES = ("distance", "route_avg_delay", "carrier_delay_rate")
CATEGORICAL_FEATURES = ("carrier", "origin", "dest")

FEATURE_COLUMNS = (TEMPORAL_FEATURES + WEATHER_FEATURES + AIRPORT_FEATURES
                   + ROUTE_FEATURES + CATEGORICAL_FEATURES)  # 39, model-matrix order
NUMERIC_FEATURES = tuple(c for c in FEATURE_COLUMNS if c not in CATEGORICAL_FEATURES)  # 36

# Numeric columns coerced by the cleaning step.
NUMERIC_CANDIDATES = (
    "arr_delay", "distance", "crs_dep_time",
    "origin_wind_speed", "origin_visibility", "origin_ceiling", "origin_temp", "origin_precip",
    "dest_wind_speed", "dest_visibility", "dest_ceiling", "dest_temp", "dest_precip",
)
STRING_COLUMNS = ("carrier", "origin", "dest")

# Raw weather defaults per suffix (knots, statute miles, feet, degrees F, in/hr, flags).
WEATHER_DEFAULTS = {
    "wind_speed": 8.0, "visibility": 10.0, "ceiling": 25000, "temp": 60.0, "precip": 0.0,
    "has_thunderstorm": 0, "has_snow": 0, "has_fog": 0,
}
RAW_WEATHER_SUFFIXES = tuple(WEATHER_DEFAULTS)

# Thresholds: IFR ceiling (ft) / visibility (mi); wind calm / strong / severe (kt);
# distance short / long (mi); risk bands and decision threshold (probability).
IFR_CEILING_FT = 1000
IFR_VISIBILITY_MI = 3.0
WIND_CALM_KT = 10
WIND_STRONG_KT = 25
WIND_SEVERE_KT = 35
SHORT_MI = 500
LONG_MI = 1500
RISK_LOW = 0.3
RISK_HIGH = 0.6
DECISION_THRESHOLD = 0.5

# Defaults for scoring inputs that omit a column.
SCORING_DEFAULTS = {
    "carrier": "AA", "origin": "ATL", "dest": "LAX", "crs_dep_time": 1200, "distance": 1000,
    "arr_delay": 0, "cancelled": 0,
    "origin_wind_speed": 8.0, "origin_visibility": 10.0, "origin_ceiling": 25000,
    "origin_temp": 60.0, "origin_precip": 0.0,
    "origin_has_thunderstorm": 0, "origin_has_snow": 0, "origin_has_fog": 0,
    "dest_wind_speed": 8.0, "dest_visibility": 10.0, "dest_ceiling": 25000,
    "dest_temp": 60.0, "dest_precip": 0.0,
    "dest_has_thunderstorm": 0, "dest_has_snow": 0, "dest_has_fog": 0,
}  # fl_date defaults to the current date

# Top 50 US airports by passenger traffic.
HUB_AIRPORTS = (
    "ATL", "DFW", "DEN", "ORD", "LAX", "JFK", "LAS", "MCO", "MIA", "CLT",
    "SEA", "PHX", "EWR", "SFO", "IAH", "BOS", "FLL", "MSP", "LGA", "DTW",
    "PHL", "SLC", "DCA", "SAN", "BWI", "TPA", "AUS", "IAD", "BNA", "MDW",
    "HNL", "DAL", "PDX", "STL", "RDU", "HOU", "SJC", "SMF", "MCI", "OAK",
    "MSY", "CLE", "SAT", "PIT", "IND", "CMH", "CVG", "RSW", "JAX", "ABQ",
)

# IATA -> ICAO for the same 50 airports.
IATA_TO_ICAO = {
    "ATL": "KATL", "DFW": "KDFW", "DEN": "KDEN", "ORD": "KORD",
    "LAX": "KLAX", "JFK": "KJFK", "LAS": "KLAS", "MCO": "KMCO",
    "MIA": "KMIA", "CLT": "KCLT", "SEA": "KSEA", "PHX": "KPHX",
    "EWR": "KEWR", "SFO": "KSFO", "IAH": "KIAH", "BOS": "KBOS",
    "FLL": "KFLL", "MSP": "KMSP", "LGA": "KLGA", "DTW": "KDTW",
    "PHL": "KPHL", "SLC": "KSLC", "DCA": "KDCA", "SAN": "KSAN",
    "BWI": "KBWI", "TPA": "KTPA", "AUS": "KAUS", "IAD": "KIAD",
    "BNA": "KBNA", "MDW": "KMDW", "HNL": "PHNL", "DAL": "KDAL",
    "PDX": "KPDX", "STL": "KSTL", "RDU": "KRDU", "HOU": "KHOU",
    "SJC": "KSJC", "SMF": "KSMF", "MCI": "KMCI", "OAK": "KOAK",
    "MSY": "KMSY", "CLE": "KCLE", "SAT": "KSAT", "PIT": "KPIT",
    "IND": "KIND", "CMH": "KCMH", "CVG": "KCVG", "RSW": "KRSW",
    "JAX": "KJAX", "ABQ": "KABQ",
}

# Approximate airport coordinates (lat, lon) used for the nearest-station fallback.
AIRPORT_APPROX_COORDS = {
    "ATL": (33.64, -84.43), "DFW": (32.90, -97.04), "DEN": (39.86, -104.67),
    "ORD": (41.97, -87.91), "LAX": (33.94, -118.41), "JFK": (40.64, -73.78),
    "LAS": (36.08, -115.15), "MCO": (28.43, -81.31), "MIA": (25.80, -80.29),
    "CLT": (35.21, -80.94), "SEA": (47.45, -122.31), "PHX": (33.44, -112.01),
    "EWR": (40.69, -74.17), "SFO": (37.62, -122.38), "IAH": (29.98, -95.34),
    "BOS": (42.37, -71.01), "FLL": (26.07, -80.15), "MSP": (44.88, -93.22),
    "LGA": (40.78, -73.87), "DTW": (42.21, -83.35), "PHL": (39.87, -75.24),
    "SLC": (40.79, -111.98), "DCA": (38.85, -77.04), "SAN": (32.73, -117.19),
    "BWI": (39.18, -76.67), "TPA": (27.98, -82.53), "AUS": (30.20, -97.67),
    "IAD": (38.95, -77.46), "BNA": (36.13, -86.68), "MDW": (41.79, -87.75),
    "HNL": (21.32, -157.92), "DAL": (32.85, -96.85), "PDX": (45.59, -122.60),
    "STL": (38.75, -90.37), "RDU": (35.88, -78.79), "HOU": (29.65, -95.28),
    "SJC": (37.36, -121.93), "SMF": (38.70, -121.59), "MCI": (39.30, -94.71),
    "OAK": (37.72, -122.22), "MSY": (29.99, -90.26), "CLE": (41.41, -81.85),
    "SAT": (29.53, -98.47), "PIT": (40.49, -80.23), "IND": (39.72, -86.29),
    "CMH": (40.00, -82.89), "CVG": (39.05, -84.67), "RSW": (26.54, -81.76),
    "JAX": (30.49, -81.69), "ABQ": (35.04, -106.61),
}

# ICAO coordinates used by the ADS-B bounding-box congestion count.
ADSB_AIRPORT_COORDS = {
    "KATL": (33.6407, -84.4277), "KDFW": (32.8998, -97.0403), "KDEN": (39.8561, -104.6737),
    "KORD": (41.9742, -87.9073), "KLAX": (33.9425, -118.4081), "KJFK": (40.6413, -73.7781),
    "KLAS": (36.0840, -115.1537), "KMCO": (28.4312, -81.3081), "KMIA": (25.7959, -80.2870),
    "KCLT": (35.2140, -80.9431), "KSEA": (47.4502, -122.3088), "KPHX": (33.4373, -112.0078),
    "KEWR": (40.6895, -74.1745), "KSFO": (37.6213, -122.3790), "KIAH": (29.9844, -95.3414),
    "KBOS": (42.3656, -71.0096), "KFLL": (26.0742, -80.1506), "KMSP": (44.8848, -93.2223),
    "KLGA": (40.7769, -73.8740), "KDTW": (42.2124, -83.3534), "KPHL": (39.8744, -75.2424),
    "KSLC": (40.7884, -111.9778), "KDCA": (38.8512, -77.0402), "KSAN": (32.7338, -117.1933),
    "KBWI": (39.1754, -76.6684), "KTPA": (27.9755, -82.5332), "KAUS": (30.1975, -97.6664),
    "KIAD": (38.9531, -77.4565), "KBNA": (36.1263, -86.6774), "KMDW": (41.7868, -87.7522),
    "PHNL": (21.3187, -157.9225), "KDAL": (32.8471, -96.8518), "KPDX": (45.5898, -122.5951),
    "KSTL": (38.7487, -90.3700), "KRDU": (35.8776, -78.7875), "KHOU": (29.6454, -95.2789),
    "KSJC": (37.3626, -121.9290), "KSMF": (38.6954, -121.5908), "KMCI": (39.2976, -94.7139),
    "KOAK": (37.7213, -122.2208), "KMSY": (29.9934, -90.2580), "KCLE": (41.4117, -81.8498),
    "KSAT": (29.5337, -98.4698), "KPIT": (40.4915, -80.2329), "KIND": (39.7173, -86.2944),
    "KCMH": (39.9980, -82.8919), "KCVG": (39.0488, -84.6678), "KRSW": (26.5362, -81.7552),
    "KJAX": (30.4941, -81.6879), "KABQ": (35.0402, -106.6090),
}

BTS_TYPES = {
    "Year": T.ShortType(), "Quarter": T.ByteType(), "Month": T.ByteType(),
    "DayofMonth": T.ByteType(), "DayOfWeek": T.ByteType(), "FlightDate": T.StringType(),
    "Reporting_Airline": T.StringType(), "Origin": T.StringType(), "Dest": T.StringType(),
    "CRSDepTime": T.ShortType(),
    **{c: T.FloatType() for c in (
        "DepTime", "DepDelay", "DepDelayMinutes", "ArrDelay", "ArrDelayMinutes", "Cancelled",
        "Diverted", "CRSElapsedTime", "Distance", "CarrierDelay", "WeatherDelay", "NASDelay",
        "SecurityDelay", "LateAircraftDelay")},
}
# Carrier column candidates, first present wins.
CARRIER_CANDIDATES = (
    "Reporting_Airline", "carrier", "Marketing_Airline_Network", "IATA_CODE_Reporting_Airline",
)

# Station inventory columns; the three ids stay strings.
STATION_SCHEMA = T.StructType([
    T.StructField("USAF", T.StringType()), T.StructField("WBAN", T.StringType()),
    T.StructField("STATION NAME", T.StringType()), T.StructField("CTRY", T.StringType()),
    T.StructField("STATE", T.StringType()), T.StructField("ICAO", T.StringType()),
    T.StructField("LAT", T.DoubleType()), T.StructField("LON", T.DoubleType()),
    T.StructField("ELEV(M)", T.DoubleType()), T.StructField("BEGIN", T.IntegerType()),
    T.StructField("END", T.IntegerType()),
])

ADSB_FLIGHT_SCHEMA = T.StructType([
    T.StructField("icao24", T.StringType()), T.StructField("callsign", T.StringType()),
    T.StructField("estDepartureAirport", T.StringType()),
    T.StructField("estArrivalAirport", T.StringType()),
    T.StructField("firstSeen", T.LongType()), T.StructField("lastSeen", T.LongType()),
    T.StructField("estDepartureAirportHorizDistance", T.IntegerType()),
    T.StructField("estDepartureAirportVertDistance", T.IntegerType()),
    T.StructField("estArrivalAirportHorizDistance", T.IntegerType()),
    T.StructField("estArrivalAirportVertDistance", T.IntegerType()),
    T.StructField("departureAirportCandidatesCount", T.IntegerType()),
    T.StructField("arrivalAirportCandidatesCount", T.IntegerType()),
])

# Canonical flights table after cleaning.
FLIGHTS_SCHEMA = T.StructType(
    [T.StructField("fl_date", T.DateType()), T.StructField("carrier", T.StringType()),
     T.StructField("origin", T.StringType()), T.StructField("dest", T.StringType()),
     T.StructField("crs_dep_time", T.IntegerType()), T.StructField("arr_delay", T.DoubleType()),
     T.StructField("cancelled", T.IntegerType()), T.StructField("distance", T.DoubleType())]
    + [T.StructField(f"{side}_{s}", T.IntegerType() if s.startswith("has_") else T.DoubleType())
       for side in ("origin", "dest") for s in RAW_WEATHER_SUFFIXES]
)
