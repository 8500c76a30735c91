"""Fixed values of the sensor network: places, thresholds, feature lists.

Everything in this file is data.  Operators take these tables as DataFrames, so
a deployment with other stations or sources passes its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: stations (name, short code, latitude, longitude) -------------
STATIONS = [
    ("SAN YSIDRO", "SY", 32.552794, -117.047286),
    ("NESTOR - BES", "NB", 32.567097, -117.090656),
    ("IB CIVIC CTR", "IB", 32.576139, -117.115361),
]
PRIMARY_STATION = "NESTOR - BES"
BACKUP_STATION = "IB CIVIC CTR"

# --- fixed values: candidate sources (name, latitude, longitude) -----------------
SOURCES = [
    ("Stewart's Drain", 32.54064, -117.05801),
    ("Smuggler's Gulch", 32.5377, -117.08623),
    ("Hollister St PS", 32.5476, -117.088374),
    ("Goat Canyon", 32.5369, -117.09916),
    ("Goat Canyon PS", 32.543476, -117.108026),
    ("Del Sol Canyon", 32.5393, -117.06885),
    ("Silva Drain", 32.539743, -117.064269),
    ("Saturn Blvd Bridge", 32.559383, -117.092992),
    ("Hollister St Bridge N", 32.554177, -117.084135),
    ("Hollister St Bridge S", 32.551466, -117.084021),
    ("Dairy Mart Bridge", 32.548531, -117.064293),
    ("Oneonta Slough Near IB", 32.570082, -117.126724),
    ("Tijuana River Beach Outlet", 32.556206, -117.126178),
    ("Tijuana River Crossing Camino De La Plaza W", 32.542103, -117.054117),
    ("Tijuana River Crossing Camino De La Plaza E", 32.542166, -117.050325),
    ("San Diego Bay ponds Otay River Outlet", 32.594557, -117.113542),
    ("San Diego Bay Ponds near Fruitdale", 32.595305, -117.091869),
]

# --- fixed values: aggregate source zones and their default rates (g/s) ----------
ZONES = [("east", 32.541, -117.058), ("west", 32.570, -117.127), ("south", 32.537, -117.099)]

ZONE_RATES = [("east", 20.0), ("west", 10.0), ("south", 137.0)]
TOTAL_RATE = 167.0
ZONE_OF_SOURCE = {
    "east": [
        "Stewart's Drain", "Silva Drain", "Tijuana River Crossing Camino De La Plaza W",
        "Tijuana River Crossing Camino De La Plaza E", "Dairy Mart Bridge", "Del Sol Canyon",
    ],
    "west": [
        "Oneonta Slough Near IB", "Tijuana River Beach Outlet", "Hollister St PS",
        "San Diego Bay ponds Otay River Outlet", "San Diego Bay Ponds near Fruitdale",
    ],
    "south": [
        "Smuggler's Gulch", "Goat Canyon", "Goat Canyon PS", "Hollister St Bridge N", "Hollister St Bridge S",
        "Saturn Blvd Bridge",
    ],
}

# --- fixed values: channel waypoints, upstream order ------------------------------
CHANNEL_WAYPOINTS = [
    (32.570082, -117.127240), (32.563000, -117.127000), (32.556206, -117.126178),
    (32.559383, -117.092992), (32.558000, -117.088000), (32.554177, -117.084135),
    (32.551466, -117.084021), (32.548000, -117.084000), (32.547600, -117.088374),
    (32.546000, -117.090000), (32.541000, -117.078000), (32.541000, -117.070000),
    (32.539743, -117.064269), (32.548531, -117.064293), (32.542103, -117.054117),
    (32.542166, -117.050325), (32.538600, -117.086230), (32.538000, -117.092000),
    (32.536900, -117.099160), (32.543476, -117.108026), (32.540000, -117.115000),
    (32.539300, -117.068850),
]

# --- fixed values: dispersion coefficients (a_y, a_z) by stability class; the
# exponent is 0.894 for both axes in every class -----------------------------------
PLUME_COEFFICIENTS = [
    ("A", 0.22, 0.20), ("B", 0.16, 0.12), ("C", 0.11, 0.08),
    ("D", 0.08, 0.06), ("E", 0.06, 0.03), ("F", 0.04, 0.016),
]
PLUME_EXPONENT = 0.894
METRES_PER_DEGREE = 111_320.0
REFERENCE_LATITUDE = 32.55
MOLAR_MASS_H2S = 34.08
MOLAR_VOLUME = 24.45

# --- fixed values: river sources (name, kind, base, flow dependent, tide dependent, points) ---
RIVER_SOURCES = [
    ("Tijuana River Main Channel", "channel", 0.75, True, True, [
        (32.5469, -117.0442), (32.5456, -117.0512), (32.5445, -117.0578), (32.5434, -117.0645),
        (32.5412, -117.0712), (32.5389, -117.0789), (32.5367, -117.0867), (32.5345, -117.0945),
        (32.5334, -117.1023), (32.5323, -117.1101), (32.5312, -117.1178), (32.5301, -117.1234),
    ]),
    ("Goat Canyon", "confluence", 1.25, True, False, [
        (32.5456, -117.0712), (32.5478, -117.0689), (32.5500, -117.0667), (32.5523, -117.0645),
    ]),
    ("Smuggler's Gulch", "confluence", 1.0, True, False, [
        (32.5412, -117.0867), (32.5434, -117.0845), (32.5456, -117.0823),
    ]),
    ("Dairy Mart Road Bridge", "bridge", 1.0, True, False, [(32.5456, -117.0512)]),
    ("Hollister Street Bridge", "bridge", 0.9, True, False, [(32.5445, -117.0578)]),
    ("I-5 Freeway Crossing", "bridge", 1.5, True, True, [(32.5345, -117.0945)]),
    ("Stewart's Drain", "outfall", 1.75, False, False, [
        (32.5523, -117.0456), (32.5501, -117.0478), (32.5478, -117.0500),
    ]),
    ("Yogurt Canyon", "confluence", 1.1, True, False, [
        (32.5389, -117.0623), (32.5412, -117.0601), (32.5434, -117.0578),
    ]),
    ("River Mouth/Estuary", "upwelling", 2.0, False, True, [
        (32.5301, -117.1234), (32.5312, -117.1212), (32.5323, -117.1189), (32.5334, -117.1167),
    ]),
    ("Border Field Wetlands", "upwelling", 0.75, False, True, [
        (32.5345, -117.1234), (32.5367, -117.1256), (32.5389, -117.1278),
    ]),
]

# --- fixed values: sewage sources (name, lat, lon, flow factor, pH offset, oxygen factor) ---
SEWAGE_SOURCES = [
    ("tj_river_mouth", 32.5301, -117.1234, 1.5, -0.3, 0.5),
    ("south_bay_wwtp", 32.5289, -117.1445, 1.2, 0.0, 0.7),
    ("punta_bandera", 32.5234, -117.0987, 1.0, 0.2, 1.0),
    ("goat_canyon", 32.5456, -117.0712, 0.8, -0.1, 0.6),
    ("stewarts_drain", 32.5527, -117.0419, 0.7, 0.0, 0.8),
]
# --- fixed values: minor community sources (name, lat, lon, base emission) ---
MINOR_SOURCES = [
    ("Imperial Beach", 32.5783, -117.1134, 15.0), ("Chula Vista", 32.6401, -117.0842, 20.0),
    ("National City", 32.6781, -117.0992, 18.0), ("Otay Mesa", 32.5578, -116.9834, 8.0),
]

# --- fixed values: grids (south, north, west, east, rows, columns) ---
FOOTPRINT_GRID = (32.50, 32.62, -117.18, -117.02, 120, 160)
FORWARD_GRID_BOUNDS = (32.45, 32.70, -117.25, -117.00)

# --- fixed values: thresholds ------------------------------------------------------
PPB_LOW, PPB_MED, PPB_HIGH = 5.0, 10.0, 30.0
WATCH_PPB, CRITICAL_PPB = 30.0, 100.0
QUIET_HOURS, CLOSE_WAIT_HOURS = 3.0, 1.5
LOCAL_TZ = "America/Los_Angeles"
PLANT_BASELINE_MGD = 23.5
PROB_30_ALERT, PROB_10_ALERT, PROB_5_ALERT, PROB_5_CAUTION = 0.35, 0.5, 0.5, 0.25

# --- fixed values: forecast horizons in hours (start inclusive, end exclusive) ------
HORIZONS = [("nowcast", 0, 3), ("near", 3, 6), ("mid", 6, 12), ("day_ahead", 12, 24)]
PRODUCT_WINDOWS = [("nowcast", 0, 3), ("nearcast", 3, 6), ("forecast", 6, 24)]
CASCADE = [("tier_1", "nowcast", 5.0, 0.5), ("tier_2", "nearcast", 10.0, 0.5), ("tier_3", "forecast", 30.0, 0.5)]
TIER_PPB = [("tier_1", 5.0), ("tier_2", 10.0), ("tier_3", 30.0)]

# --- fixed values: score weights per tier -------------------------------------------
TIER_WEIGHTS = {
    "tier_1": {
        "sbiwtp_flow_mgd": -0.24, "sbiwtp_anomaly": -0.13, "sbiwtp_sli": 0.19, "sbiwtp_deficit": 0.17,
        "precipitation": -0.14, "flow_log": 0.17, "wind_speed_10m": -0.34, "wind_speed_min": -0.27,
        "stable_atm": 0.27,
    },
    "tier_2": {
        "sbiwtp_flow_mgd": -0.24, "sbiwtp_anomaly": -0.13, "sbiwtp_sli": 0.19, "sbiwtp_deficit": 0.17,
        "precipitation": -0.14, "flow_log": 0.17, "wind_speed_10m": -0.34, "wind_speed_min": -0.27,
        "stable_atm": 0.27,
    },
    "tier_3": {
        "sbiwtp_flow_mgd": -0.16, "sbiwtp_sli": 0.13, "sbiwtp_deficit": 0.10, "precipitation": -0.14,
        "flow_log": 0.38, "wind_speed_10m": -0.54, "wind_speed_min": -0.43, "stable_atm": 0.50,
        "temperature_2m": 0.18, "dewpoint_2m": 0.30, "surface_pressure": -0.15,
    },
}

# --- fixed values: quiet-night mean and standard deviation per feature ---------------
QUIET_STATS = {
    "sbiwtp_flow_mgd": (26.58, 4.67), "sbiwtp_anomaly": (0.05, 0.16), "sbiwtp_sli": (2.46, 5.23),
    "sbiwtp_deficit": (0.66, 1.45), "precipitation": (0.07, 0.48), "flow_log": (0.77, 0.71),
    "wind_speed_10m": (5.83, 4.14), "wind_speed_min": (3.5, 2.8), "stable_atm": (0.47, 0.50),
    "temperature_2m": (15.66, 2.91), "dewpoint_2m": (11.94, 6.88), "surface_pressure": (1013.57, 3.08),
}
SINGLE_STATION_STATS = {
    "sbiwtp_flow_mgd": (24.39, 1.60), "sbiwtp_anomaly": (0.003, 0.062), "sbiwtp_sli": (1.88, 3.19),
    "sbiwtp_deficit": (0.49, 0.81), "precipitation": (0.00, 0.01), "flow_log": (0.37, 0.19),
    "wind_speed_10m": (4.54, 1.82), "wind_speed_min": (3.63, 1.46), "stable_atm": (0.55, 0.50),
    "temperature_2m": (18.31, 1.39), "dewpoint_2m": (15.76, 1.39), "surface_pressure": (1012.62, 1.99),
}

# --- fixed values: model feature lists ------------------------------------------------
FEATURES_33 = [
    "temperature_2m", "wind_speed_10m", "wind_direction_sin", "wind_direction_cos", "wind_gusts_10m",
    "precipitation", "relative_humidity_2m", "surface_pressure", "cloud_cover", "dewpoint_2m",
    "wind_speed_10m_avg_2h", "wind_speed_10m_avg_3h", "wind_gusts_10m_max_2h", "wind_gusts_10m_max_3h",
    "tide_height", "tidal_state_encoded", "hour_sin", "hour_cos", "month_sin", "month_cos", "is_night",
    "source_regime", "wind_temp_interaction", "humidity_temp_interaction", "stable_atm", "wind_x_stable_atm",
    "h2s_lag_1h", "h2s_lag_3h", "h2s_lag_6h", "h2s_rolling_6h", "h2s_rolling_24h", "flow_lag_6h",
    "flow_rolling_24h",
]
PLANT_FEATURES = [
    "sbiwtp_flow_mgd", "sbiwtp_anomaly", "sbiwtp_deficit", "sbiwtp_flow_x_temp", "sbiwtp_hourly_mgd", "sbiwtp_sli",
]
# in the order that stored legacy models expect
FEATURES_44 = [
    "temperature_2m", "wind_speed_10m", "wind_direction_sin", "wind_direction_cos", "wind_gusts_10m",
    "precipitation", "relative_humidity_2m", "surface_pressure", "cloud_cover", "dewpoint_2m",
    "wind_speed_10m_avg_2h", "wind_speed_10m_avg_3h", "wind_speed_10m_avg_4h", "wind_gusts_10m_max_2h",
    "wind_gusts_10m_max_3h", "wind_gusts_10m_max_4h", "tide_height", "tidal_state_encoded", "hour_sin", "hour_cos",
    "month_sin", "month_cos", "is_night", "source_regime", "flow_log", "flow_low", "flow_high",
    "wind_temp_interaction", "humidity_temp_interaction", "stable_atm", "wind_x_stable_atm", "h2s_lag_1h",
    "h2s_lag_3h", "h2s_lag_6h", "h2s_rolling_6h", "h2s_rolling_24h", "flow_lag_6h", "flow_rolling_24h",
] + PLANT_FEATURES
FEATURES_19 = [
    "temperature_2m", "wind_speed_10m", "wind_direction_sin", "wind_direction_cos", "relative_humidity_2m",
    "tide_height", "tidal_state_encoded", "month_sin", "month_cos", "is_night", "source_regime", "stable_atm",
    "h2s_lag_1h", "h2s_lag_3h", "h2s_lag_6h", "h2s_rolling_6h", "h2s_rolling_24h", "flow_lag_6h",
    "flow_rolling_24h",
]
FEATURES_11 = [
    "temperature_2m", "stable_atm", "is_night", "source_regime", "wind_speed_10m", "wind_direction_sin",
    "wind_direction_cos", "h2s_lag_1h", "h2s_lag_3h", "h2s_rolling_6h", "h2s_rolling_24h",
]
FEATURE_SETS = {"legacy": FEATURES_44, "evidence": FEATURES_33, "lean": FEATURES_19, "minimal": FEATURES_11}


def literal_table(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A small fixed table as a local relation; ``columns`` is a DDL list."""
    names = [c.strip().split(" ")[0] for c in columns.split(",")]
    types = [c.strip().split(" ")[1] for c in columns.split(",")]

    def text(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"{v!r}D" if isinstance(v, float) else str(v)

    values = ", ".join("(" + ", ".join(text(v) for v in r) + ")" for r in rows)
    casts = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in zip(names, types))
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({', '.join(names)})")


def stations(spark: SparkSession) -> DataFrame:
    return literal_table(
        spark, [(n, la, lo) for n, _, la, lo in STATIONS],
        "site_name string, station_lat double, station_lon double",
    )


def sources(spark: SparkSession) -> DataFrame:
    return literal_table(spark, SOURCES, "source string, source_lat double, source_lon double")


def zones(spark: SparkSession) -> DataFrame:
    return literal_table(spark, ZONES, "source string, source_lat double, source_lon double")


def waypoints(spark: SparkSession) -> DataFrame:
    rows = [(i, la, lo) for i, (la, lo) in enumerate(CHANNEL_WAYPOINTS)]
    return literal_table(spark, rows, "ord int, lat double, lon double")
