"""Explicit schemas; nothing is inferred in production paths. Names are fixed values: those of the raw documents, of GTFS and of the events."""

RAW = """
metadata struct<extracted_at: string, source: string, total_vehicles: int>,
payload struct<hr: string, l: array<struct<c: string, cl: int, sl: int, lt0: string, lt1: string, qv: int,
  vs: array<struct<p: int, a: boolean, ta: string, py: double, px: double, sv: string, `is`: string>>>>>
"""
STOPS = "stop_id int, stop_name string, stop_desc string, stop_lat double, stop_lon double"
STOP_TIMES = "trip_id string, arrival_time string, departure_time string, stop_id int, stop_sequence int"
ROUTES = "route_id string, agency_id string, route_short_name string, route_long_name string, route_type int, route_color string, route_text_color string"
TRIPS = "route_id string, service_id string, trip_id string, trip_headsign string, direction_id int, shape_id string"
FREQUENCIES = "trip_id string, start_time string, end_time string, headway_secs int"
CALENDAR = "service_id string, monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, sunday int, start_date string, end_date string"
GTFS = {"stops": STOPS, "stop_times": STOP_TIMES, "routes": ROUTES, "trips": TRIPS, "frequencies": FREQUENCIES, "calendar": CALENDAR}
# The columns of trusted positions; quarantined ones have two more.
POSITION_COLUMNS = [
    "extracao_ts", "veiculo_id", "linha_lt", "linha_code", "linha_sentido", "lt_destino", "lt_origem", "veiculo_acessivel", "veiculo_ts", "veiculo_lat", "veiculo_long", "is_circular",
    "first_stop_id", "first_stop_lat", "first_stop_lon", "last_stop_id", "last_stop_lat", "last_stop_lon", "distance_to_first_stop", "distance_to_last_stop", "trip_linear_distance",
]
QUARANTINE_COLUMNS = [*POSITION_COLUMNS, "invalid_reason", "validation_failed_at"]
TRIP_DETAILS = (
    "trip_id string, first_stop_id int, first_stop_name string, first_stop_lat double, first_stop_lon double, last_stop_id int, last_stop_name string, last_stop_lat double, last_stop_lon double,"
    " trip_linear_distance double, is_circular boolean"
)
EVENT = "timestamp timestamp, level string, service string, component string, event string, message string, execution_id string, correlation_id string, status string, error_type string, error_message string, metadata string"
FINISHED_KEY = ["trip_start_time", "vehicle_id", "trip_id"]
FACT_KEY = ["started_at", "vehicle_id", "trip_id"]
