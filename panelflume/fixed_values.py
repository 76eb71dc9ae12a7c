"""Default calendars, look-up tables, grids and model constants.

Everything here is data that results depend on, stated as plain text. Functions in the package take these as
defaults and accept any table of the same shape instead.
"""

# Entity dimension
# (route, desc, base_pax_weekly, avg_yield, distance_km, competitors,
#  comp_capacity_share, business_mix, avg_load_factor, trend_pa)
ROUTES = [
    ("SYD-MEL", "Sydney–Melbourne", 95000, 185, 713, ["Virgin", "Rex"], 0.42, 0.22, 0.845, 0.031),
    ("SYD-BNE", "Sydney–Brisbane", 48000, 195, 924, ["Virgin"], 0.38, 0.19, 0.828, 0.028),
    ("MEL-PER", "Melbourne–Perth", 26000, 310, 2699, ["Virgin"], 0.35, 0.28, 0.821, 0.024),
    ("SYD-ADL", "Sydney–Adelaide", 22000, 215, 1165, ["Virgin", "Rex"], 0.39, 0.18, 0.812, 0.021),
    ("BNE-PER", "Brisbane–Perth", 14000, 340, 3606, ["Virgin"], 0.31, 0.31, 0.808, 0.019),
    ("SYD-CBR", "Sydney–Canberra", 11000, 165, 248, ["Rex"], 0.28, 0.41, 0.798, 0.018),
    ("MEL-ADL", "Melbourne–Adelaide", 17000, 175, 653, ["Virgin", "Rex"], 0.41, 0.16, 0.805, 0.022),
    ("SYD-PER", "Sydney–Perth", 18000, 295, 3278, ["Virgin"], 0.36, 0.26, 0.830, 0.025),
    ("MEL-BNE", "Melbourne–Brisbane", 35000, 205, 1748, ["Virgin"], 0.39, 0.21, 0.835, 0.027),
    ("ADL-PER", "Adelaide–Perth", 8500, 270, 2130, ["Rex"], 0.25, 0.24, 0.792, 0.016),
]

# Annual macro table (year, cash rate, consumer price growth, fuel index) and defaults for other years
MACRO = [
    (2019, 0.015, 0.017, 100.0),
    (2020, 0.0025, 0.009, 62.0),
    (2021, 0.001, 0.032, 78.0),
    (2022, 0.030, 0.072, 142.0),
    (2023, 0.043, 0.055, 118.0),
    (2024, 0.043, 0.038, 108.0),
]
DEFAULT_RATE = 0.035
DEFAULT_CPI = 0.025
DEFAULT_FUEL = 100.0

# School holiday intervals, both ends included
SCHOOL_HOLIDAYS = [
    ("2018-12-14", "2019-01-28"), ("2019-12-19", "2020-01-28"), ("2020-12-17", "2021-01-27"),
    ("2021-12-17", "2022-01-31"), ("2022-12-15", "2023-01-30"), ("2023-12-14", "2024-01-29"),
    ("2019-04-06", "2019-04-21"), ("2020-04-09", "2020-04-26"), ("2021-04-01", "2021-04-18"),
    ("2022-04-09", "2022-04-24"), ("2023-04-01", "2023-04-16"), ("2024-04-06", "2024-04-21"),
    ("2019-07-05", "2019-07-21"), ("2020-07-10", "2020-07-26"), ("2021-07-09", "2021-07-25"),
    ("2022-07-08", "2022-07-24"), ("2023-07-07", "2023-07-23"), ("2024-07-05", "2024-07-21"),
    ("2019-09-21", "2019-10-06"), ("2020-09-26", "2020-10-11"), ("2021-09-18", "2021-10-03"),
    ("2022-09-17", "2022-10-02"), ("2023-09-23", "2023-10-08"), ("2024-09-21", "2024-10-06"),
]

# Public holidays
PUBLIC_HOLIDAYS = [
    "2019-01-01", "2019-01-28", "2019-04-19", "2019-04-20", "2019-04-22", "2019-04-25", "2019-06-10",
    "2019-12-25", "2019-12-26",
    "2020-01-01", "2020-01-27", "2020-04-10", "2020-04-13", "2020-04-25", "2020-06-08", "2020-12-25",
    "2020-12-28",
    "2021-01-01", "2021-01-26", "2021-04-02", "2021-04-05", "2021-04-25", "2021-06-14", "2021-12-27",
    "2021-12-28",
    "2022-01-03", "2022-01-26", "2022-04-15", "2022-04-18", "2022-04-25", "2022-06-13", "2022-09-22",
    "2022-12-26", "2022-12-27",
    "2023-01-02", "2023-01-26", "2023-04-07", "2023-04-10", "2023-04-25", "2023-06-12", "2023-12-25",
    "2023-12-26",
    "2024-01-01", "2024-01-26", "2024-03-29", "2024-04-01", "2024-04-25", "2024-06-10", "2024-12-25",
    "2024-12-26",
]

# Demand events (event_id, event_date, city, peak_mult, lead_weeks)
EVENTS = [
    ("AO_2019", "2019-01-14", "MEL", 1.18, 4),
    ("F1_2019", "2019-03-17", "MEL", 1.22, 3),
    ("AFL_GF_2019", "2019-09-28", "MEL", 1.17, 2),
    ("NRL_GF_2019", "2019-10-06", "SYD", 1.12, 2),
    ("AO_2020", "2020-01-20", "MEL", 1.17, 4),
    ("F1_2020", "2020-03-15", "MEL", 1.03, 2),
    ("AO_2021", "2021-02-08", "MEL", 1.14, 3),
    ("AFL_GF_2021", "2021-09-25", "MEL", 1.14, 2),
    ("AO_2022", "2022-01-17", "MEL", 1.16, 4),
    ("F1_2022", "2022-04-10", "MEL", 1.21, 3),
    ("AFL_GF_2022", "2022-09-24", "MEL", 1.16, 2),
    ("NRL_GF_2022", "2022-10-02", "SYD", 1.13, 2),
    ("AO_2023", "2023-01-16", "MEL", 1.19, 4),
    ("F1_2023", "2023-04-02", "MEL", 1.24, 3),
    ("AFL_GF_2023", "2023-09-30", "MEL", 1.18, 2),
    ("NRL_GF_2023", "2023-10-01", "SYD", 1.14, 2),
    ("AO_2024", "2024-01-14", "MEL", 1.20, 4),
    ("F1_2024", "2024-03-24", "MEL", 1.25, 3),
    ("AFL_GF_2024", "2024-09-28", "MEL", 1.19, 2),
    ("NRL_GF_2024", "2024-10-06", "SYD", 1.15, 2),
]

# Demand-shock regimes (from_date included, to_date excluded, factor at start, factor at end);
# the factor is 1 outside all regimes
REGIMES = [
    ("2020-03-23", "2020-05-01", 1.0, 0.05),
    ("2020-05-01", "2020-10-01", 0.05, 0.05),
    ("2020-10-01", "2021-11-01", 0.05, 0.45),
    ("2021-11-01", "2022-09-01", 0.45, 1.0),
]

# Competition rules (year, competitor that must be listed or None, leisure share to exceed or None, factor)
COMPETITION_RULES = [
    (2024, "Rex", None, 0.65),
    (2023, None, 0.7, 1.08),
]

# Seasonal index amplitudes (harmonic, sine amplitude, cosine amplitude) over 52 weeks
SEASONAL_HARMONICS = [(1, 0.08, 0.12), (2, 0.04, 0.03)]

# Effect sizes of the demand, yield and load-factor equations
SCHOOL_EFFECT = 0.14
PUBLIC_HOLIDAY_EFFECT = 0.06
RATE_EFFECT = 0.8
NEUTRAL_RATE = 0.015
FUEL_DEMAND_EFFECT = 0.08
FUEL_YIELD_EFFECT = 0.12
LOAD_YIELD_EFFECT = 0.35
COMPETITION_YIELD_EFFECT = 0.08
MIN_PAX = 50
MIN_YIELD = 80.0
LOAD_FACTOR_BOUNDS = (0.30, 0.99)
SHOCKED_LOAD_FACTOR_BOUNDS = (0.05, 0.99)

# Calendar and model settings
DATA_START = "2019-01-07"
DATA_END = "2024-12-30"
BASE_YEAR = 2019
SEASON_WEEKS = 52
CV_FOLDS = 3
CV_FOLD_WEEKS = 8
TEST_WEEKS = 26
BOOTSTRAP_DRAWS = 300
IMPORTANCE_REPEATS = 15
BOOST_PARAMS = {"trees": 300, "depth": 4, "step": 0.05, "subsample": 0.8, "min_leaf": 5, "seed": 42}
CV_TREES = 200

# Holt-Winters parameter grid, in search order, and the parameters used when no fit is finite
ALPHA_GRID = [0.10, 0.20, 0.30, 0.40, 0.50, 0.60]
BETA_GRID = [0.05, 0.10, 0.15, 0.20]
GAMMA_GRID = [0.05, 0.10, 0.15, 0.20, 0.25, 0.30]
FALLBACK_PARAMS = (0.3, 0.1, 0.15)

# Unit-root test. Critical values, and p-value segments (tau from, tau to, p at from, p at to),
# each closed at its upper end; p is 0.001 up to the first segment and 0.9 beyond the last
UNIT_ROOT_CRITICAL = {"1%": -3.4336, "5%": -2.8621, "10%": -2.5671}
UNIT_ROOT_SEGMENTS = [
    (-3.5, -2.9, 0.01, 0.05),
    (-2.9, -2.6, 0.05, 0.10),
    (-2.6, -2.0, 0.10, 0.50),
    (-2.0, 0.0, 0.90, 0.50),
]
UNIT_ROOT_P_LOW = 0.001
UNIT_ROOT_P_HIGH = 0.9
MIN_UNIT_ROOT_OBS = 10

# Feature codes with display names
FEATURES = [
    ("week_sin", "Week (sin)"), ("week_cos", "Week (cos)"),
    ("month_sin", "Month (sin)"), ("month_cos", "Month (cos)"),
    ("is_summer", "Summer flag"), ("is_winter", "Winter flag"), ("year_idx", "Year trend"),
    ("school_holiday", "School holiday"), ("public_holiday", "Public holiday"),
    ("event_multiplier", "Event multiplier"), ("covid_factor", "COVID factor"),
    ("competition_index", "Competition index"), ("rba_cash_rate", "RBA cash rate"),
    ("fuel_index", "Fuel index"), ("cpi_index", "CPI index"), ("business_mix", "Business mix"),
    ("pax_lag4", "Pax lag 4w"), ("pax_lag8", "Pax lag 8w"), ("pax_lag13", "Pax lag 13w"),
    ("pax_lag52", "Pax lag 52w (YoY)"), ("pax_yoy_growth", "YoY growth rate"),
    ("rolling_mean_4w", "Rolling mean 4w"), ("rolling_std_4w", "Rolling std 4w"),
    ("rolling_mean_13w", "Rolling mean 13w"), ("pax_vs_rolling", "Pax vs rolling avg"),
    ("yield_lag4", "Yield lag 4w"), ("comp_x_biz", "Competition×Biz mix"),
    ("rate_x_biz", "Rate×Biz mix"), ("fuel_x_yield", "Fuel×Yield"), ("covid_x_school", "COVID×School"),
]
FEATURE_COLS = [code for code, _ in FEATURES]

# Elasticity controls, first date used and least number of observations
ELASTICITY_CONTROLS = [
    "school_holiday", "event_multiplier", "covid_factor", "competition_index", "week_sin", "week_cos",
]
ELASTICITY_START = "2022-01-01"
ELASTICITY_MIN_OBS = 60

# Natural experiment
DID_EXPERIMENT = {
    "treatment_date": "2024-07-01",
    "treatment_routes": ["SYD-ADL", "MEL-ADL"],
    "control_routes": ["SYD-MEL", "MEL-BNE"],
    "pre_weeks": 52,
    "post_weeks": 26,
    "outcomes": ["yield_aud", "pax"],
}

# Cabin allocation, in class order first, biz, prem, eco
CABINS = ["first", "biz", "prem", "eco"]
DEFAULT_MIX = [0.06, 0.19, 0.13, 0.62]
FILL_RATES = [0.72, 0.88, 0.85, 0.92]
MAX_MIX = [0.12, 0.30, 0.20, 0.80]
FILL_SIGNAL_CAP = 1.25
ALLOCATION_DEFAULTS = {
    "capacity": 189, "lf_target": 0.85, "ob_rate": 0.05, "min_eco_pct": 0.45, "min_first_pct": 0.05,
}
CABIN_YIELDS = {"first": 4200.0, "biz": 1850.0, "prem": 680.0, "eco": 310.0}
BASE_YIELD = 189.0
MARKET_SHARE = 0.58
DEFAULT_DAILY_FLIGHTS = 5
DAILY_FLIGHTS = [
    ("SYD-MEL", 14), ("SYD-BNE", 9), ("MEL-PER", 4), ("SYD-ADL", 5), ("BNE-PER", 3),
    ("SYD-CBR", 3), ("MEL-ADL", 4), ("SYD-PER", 3), ("MEL-BNE", 6), ("ADL-PER", 2),
]
SWEEP_LOW, SWEEP_HIGH, STAGE_SWEEP_HIGH, SWEEP_STEP = 0.40, 0.80, 0.76, 5

# Proportional what-if heuristic (fill ceiling, mix softening, split of excess seats over biz and prem,
# split of the seats left after economy over first and biz, economy floor grid: start, step, points)
WHATIF_FILL_CAP = 0.95
WHATIF_SOFTENING = 0.01
WHATIF_EXCESS_SPLIT = (0.6, 0.4)
WHATIF_REST_SPLIT = (0.12, 0.36)
WHATIF_GRID = (0.40, 0.02, 15)
