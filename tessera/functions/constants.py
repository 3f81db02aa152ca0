"""Fixed values that results depend on. They mirror the behaviour being
rebuilt and must not be tuned."""

# --- fixed values: order lifecycle event types, in lifecycle order ---------
EVENT_TYPES = [
    "order_created",
    "kitchen_started",
    "kitchen_finished",
    "order_ready",
    "driver_arrived",
    "driver_picked_up",
    "driver_ping",
    "delivered",
]

# --- fixed values: event types that the lifecycle pivot keeps --------------
PIVOT_STAGES = [
    "order_created",
    "kitchen_started",
    "kitchen_finished",
    "order_ready",
    "driver_arrived",
    "driver_picked_up",
    "delivered",
]

# --- fixed values: demand weight per hour of day (0..23) -------------------
HOUR_WEIGHTS = [
    0.1, 0.05, 0.02, 0.01, 0.01, 0.05,
    0.2, 0.3, 0.4, 0.5, 0.6,
    0.9, 1.0, 0.9, 0.5,
    0.4, 0.5, 0.8,
    1.0, 1.0, 0.9, 0.6, 0.4, 0.2,
]

# --- fixed values: demand multiplier per weekday (0=Monday .. 6=Sunday) ----
DAY_MULTIPLIERS = [1.0, 1.0, 1.0, 1.0, 1.25, 1.35, 1.15]

# --- fixed values: fault-injection rates -----------------------------------
NULL_RATE = 0.05
LATE_EVENT_RATE = 0.03
DUPLICATE_RATE = 0.02
MALFORMED_JSON_RATE = 0.01

# --- fixed values: JSON corruption kinds -----------------------------------
CORRUPTIONS = ["truncate", "missing_brace", "missing_quote", "extra_comma"]

# --- fixed values: brand momentum growth per day ---------------------------
MOMENTUM_RATE = {"growing": 1.005, "stable": 1.0, "declining": 0.997}

# --- fixed values: misc ----------------------------------------------------
PING_INTERVAL_SEC = 60
KM_PER_DEGREE = 111
VEHICLE_TYPES = ["car", "bike", "scooter"]

# --- fixed values: names and columns of the pipeline's datasets ------------
CREATED, PING = "order_created", "driver_ping"
SILVER_COLUMNS = [
    "event_id", "event_type", "event_timestamp", "ts", "ts_seconds", "order_id", "location_id", "sequence", "body",
    "brand_id", "order_total", "latitude", "longitude", "driver_id",
    "event_hour", "event_day_of_week", "is_weekend", "event_date", "city_name",
]
STAGE_TIMES = {
    "order_created": "created_at",
    "kitchen_started": "kitchen_started_at",
    "kitchen_finished": "kitchen_finished_at",
    "order_ready": "order_ready_at",
    "driver_arrived": "driver_arrived_at",
    "driver_picked_up": "pickup_at",
    "delivered": "delivered_at",
}
STAGE_DURATIONS = {
    "kitchen_duration_min": ("kitchen_started_at", "kitchen_finished_at"),
    "delivery_duration_min": ("pickup_at", "delivered_at"),
    "total_duration_min": ("created_at", "delivered_at"),
}
PERFORMANCE_MEANS = {
    "avg_kitchen_time_min": "kitchen_duration_min",
    "avg_delivery_time_min": "delivery_duration_min",
    "avg_total_time_min": "total_duration_min",
}
BRAND_COLUMNS = [
    "brand_id", "brand_name", "total_orders", "total_revenue", "avg_order_value",
    "locations_served", "first_order_date", "last_order_date",
]
