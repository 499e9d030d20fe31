"""How the driver's tables play the roles of the measurement series.

Fixed values: every parameter below is part of the query definitions (and of the oracle
SQL); changing one changes the answers.

level series   lineitem: entity l_suppkey, date l_shipdate, level l_extendedprice; one row per
               (supplier, day) keeping the newest submission (highest order and line).
driver series  orders summed per (customer, order day); customer = station. Orders end some
               months before the shipments, so the last level windows are uncovered.
paired series  lineitem per (returnflag, ship day): two members whose placed / removed
               columns are exclusive (sign of a net quantity) plus a density for one.
"""

# level series
LEVEL_SCOPE = ("1995-01-01", "2001-12-31")
EVENT_THRESHOLD = 50000.0           # change < -threshold is an event (strict)
ZERO_FLOOR = 2000.0                 # level below this counts as a zero level

# driver series
SUSPECT_MOD, SUSPECT_REM = 10, 5    # suspect stations: key % 10 = 5
SUSPECT_NOTE = "Ratio to the other stations drops in the last years: suspected calibration drift."

# paired series
BASIN_SCOPE = "N"                   # the one basin analysed
BASIN_MEMBERS = ("AGUA_DOCE", "SALMOURA")

# calendar and yearly questions
SEASON = (2, 5)
CUTOFF_MONTH = 7
BASE_YEARS = (1995, 2000)
STUDY_YEAR = 2001
RECENT_FROM = 1998                  # Z6 listing starts here
